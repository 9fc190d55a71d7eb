"""The registered queries, their stand-in inputs and their DuckDB oracles."""
