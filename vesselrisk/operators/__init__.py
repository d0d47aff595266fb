"""Operators: DataFrame -> DataFrame building blocks (tracks, range joins, graph, ...)."""
