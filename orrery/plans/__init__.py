"""The operators applied to the given tables, each with the SQL that checks it."""
