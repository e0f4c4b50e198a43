"""DataFrame operators: graph, paths, iterative graph algorithms, ML and metrics."""
