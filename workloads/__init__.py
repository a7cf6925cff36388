"""The registered queries, their DuckDB counterparts, and the views both run on."""
