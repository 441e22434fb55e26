"""Column expressions: text folding, numeric rules, list membership."""
