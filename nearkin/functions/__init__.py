"""Column expressions and the small Arrow/numpy helpers used inside tasks."""
