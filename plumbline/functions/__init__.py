"""Column expressions: one cell (``cells``) or one row of a column family (``rows``)."""
