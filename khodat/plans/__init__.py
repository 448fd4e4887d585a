"""The composed loads: pages to listings, and source to raw to staging to warehouse."""
