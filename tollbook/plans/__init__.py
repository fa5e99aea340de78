"""Whole jobs: chains of operators, the query catalogue and its SQL twins."""
