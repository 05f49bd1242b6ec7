"""Relational operators of the spend warehouse: staging, build, reports, views, checks, profiling."""
