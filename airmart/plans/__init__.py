"""Plan composition: join strategy, materialization and the query registry."""
