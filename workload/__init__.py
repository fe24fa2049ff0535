"""The driver's queries over its event tables, and the SQL they must match."""
