"""All registered queries; importing the package fills the catalogue."""

from importlib import import_module

from opsloom.plans.catalogue import CATALOGUE, Query, Tables

for _name in ("accounts", "cleaning", "workload", "flights", "timeseries", "decisions", "metrics", "reports", "text", "streams", "learning"):
    import_module(f"opsloom.plans.{_name}")

__all__ = ["CATALOGUE", "Query", "Tables"]
