"""Compositions of operators into the jobs' outputs, and the query registry."""
