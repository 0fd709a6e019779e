"""tillwise.operators."""
