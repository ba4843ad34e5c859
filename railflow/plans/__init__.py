"""Named queries (the user-level API) and the two ETL flows."""
