"""Column expressions: the 15-minute time grid, codes and casts."""
