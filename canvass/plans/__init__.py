"""Stage graph, reports and the query registry."""
