"""Registered queries, by area; importing this package fills the catalogue."""

from millrace.plans import changes, forms, relational, scalar, surface, timeseries
from millrace.plans.catalogue import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "changes", "forms", "relational", "scalar", "surface", "timeseries"]
