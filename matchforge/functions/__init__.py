"""Column expressions and ranking helpers shared by the plans."""
