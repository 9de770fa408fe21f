"""Every operator as a query over the driver's tables, each with an independent SQL twin where SQL can express it."""

from glasswatch.catalog.registry import ORACLES, QUERIES, load_all

__all__ = ["ORACLES", "QUERIES", "load_all"]
