"""The operators wired to the test tables, each with the SQL that gives the same rows."""

from importlib import import_module

from lakeops.queries.registry import ORACLES, QUERIES

MODULES = ("scans", "sinks", "projections", "joins", "aggregates", "windows", "sets", "functions", "streams", "merges", "quality", "jobs")

for _module in MODULES:
    import_module(f"lakeops.queries.{_module}")

__all__ = ["ORACLES", "QUERIES"]
