"""Column expressions: fixed patterns, Python-compatible text helpers and the
in-row HTML element matcher."""
