"""tillwise.functions."""
