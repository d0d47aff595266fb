"""Column-expression helpers (geo, codes, text)."""
