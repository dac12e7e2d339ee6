"""DataFrame operators. Column names are arguments; nothing here knows a table."""
