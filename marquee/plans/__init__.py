"""Compositions of operators into stages and jobs."""
