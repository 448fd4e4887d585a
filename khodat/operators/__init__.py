"""Relational operators: projections, dedup, sizing, merge, table writes, maintenance, scripts."""
