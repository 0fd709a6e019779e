"""tillwise.sources."""
