"""Compositions: whole jobs, and the queries that cover every operator."""
