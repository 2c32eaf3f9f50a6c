"""Column expressions: no actions, no shuffles, no Python workers except where noted."""
