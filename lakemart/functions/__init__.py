"""Column expressions and small helpers: fixed values, text, nested lists, seeded order, row index, joins."""
