"""Compositions of operators: test fixtures, the query catalogue and its SQL twins."""
