"""Registered queries; importing this package fills the registry."""

from importlib import import_module

from faultline.queries.registry import ORACLES, QUERIES

for _topic in ("silver", "gold", "ledger", "publish", "workload", "disk", "rollup"):
    import_module(f"faultline.queries.{_topic}_queries")

__all__ = ["ORACLES", "QUERIES"]
