"""Column expressions: money, business predicates, time and text."""
