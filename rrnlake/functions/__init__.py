"""Column expressions: ids, lineages, sequences."""
