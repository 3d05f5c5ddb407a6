"""Canonical tables: ``adapter.SalesData`` (the driver's files), ``tables.TableData``
(tables of a catalog), ``stored.StoredData`` (facts bucketed and partitioned by ``stored.store``)
and ``sql_views`` (the adapter's derivations as SQL for the oracle)."""

from .adapter import SalesData
from .stored import StoredData, store
from .tables import TableData

__all__ = ["SalesData", "StoredData", "TableData", "store"]
