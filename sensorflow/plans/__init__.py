"""Assembly and entry points: targets (the targets build), jobs (targets, climatology,
persistence and metadata jobs), queries (the registered operator queries), oracle (their
DuckDB SQL) and compare (the order-insensitive comparison used by the tests)."""
