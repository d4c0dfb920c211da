"""How the operators are put together: lazy model graph, table layers, named queries."""
