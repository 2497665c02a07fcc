"""Registered queries over the corpus tables, their DuckDB oracles, the stream
forms registered as queries, and the compare tool."""
