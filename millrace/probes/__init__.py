"""Queries over the driver tables.  Importing the modules fills the registry."""

from importlib import import_module

from millrace.probes.registry import ORACLES, QUERIES

# Fixed list: a missing module must fail, not vanish.
for _area in ("sources", "rows", "joins", "statistics", "ordered", "functions", "models",
              "quality", "telemetry", "features", "generation"):
    import_module(f"millrace.probes.{_area}")

__all__ = ["ORACLES", "QUERIES"]
