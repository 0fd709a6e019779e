"""tillwise.plans."""
