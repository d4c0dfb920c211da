"""Independent SQL statements of the queries, for side-by-side checks on another engine."""
