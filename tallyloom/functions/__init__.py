"""Column expressions: masking, measures and display text."""
