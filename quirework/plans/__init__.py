"""Plan shapes shared by operators, and the query catalogue."""
