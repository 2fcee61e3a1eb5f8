"""Plan shapes shared by several operators, and the query registry."""
