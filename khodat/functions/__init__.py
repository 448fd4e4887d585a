"""Column expressions: listing text parsers, date helpers and the working-day calendar."""
