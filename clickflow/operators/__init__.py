"""DataFrame → DataFrame operators for the four jobs and the result-table semantics."""
