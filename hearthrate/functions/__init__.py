"""Column expressions: no jobs, no shuffles, usable inside any select."""
