"""Canonical tables from a catalog: ``TableData`` offers the same methods as
``SalesData`` over tables named by the user."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas


class TableData:
    """``names`` maps the keys of ``schemas.ALL`` to table or view names
    (``catalog.database.table``); keys left out are looked up as
    ``{database}.{key}``.  A table is checked against its schema when first
    used: missing columns and columns of another kind raise ``ValueError``.
    """

    def __init__(self, spark: SparkSession, names: Mapping[str, str] | None = None, database: str | None = None):
        unknown = set(names or ()) - set(schemas.ALL)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}; known: {sorted(schemas.ALL)}")
        self.spark, self.names, self.database = spark, dict(names or {}), database

    def _table(self, key: str) -> DataFrame:
        name = self.names.get(key) or (f"{self.database}.{key}" if self.database else key)
        df = self.spark.table(name)
        kinds = {f.name: f.dataType for f in df.schema}
        for field in schemas.ALL[key]:
            if field.name not in kinds:
                raise ValueError(f"{name}: column {field.name} is missing")
            if not _compatible(field.name, kinds[field.name], field.dataType):
                raise ValueError(f"{name}: column {field.name} is {kinds[field.name].simpleString()}, "
                                 f"expected {field.dataType.simpleString()}")
        return df.select(*schemas.ALL[key].names)

    def header(self, territory: bool = False, ship_date: bool = False) -> DataFrame:
        return self._table("header")       # both columns are stored here

    def po_header(self, line_total: bool = False) -> DataFrame:
        """Purchase orders; with ``line_total`` those that have lines, and their sum."""
        header = self._table("po_header")
        if line_total:
            totals = self._table("po_detail").groupBy("PurchaseOrderID").agg(F.sum("LineTotal").alias("LineTotal"))
            header = header.join(totals, "PurchaseOrderID")
        return header

    def __getattr__(self, key: str):
        if key not in schemas.ALL:
            raise AttributeError(key)
        return lambda: self._table(key)


def _compatible(name: str, have: T.DataType, want: T.DataType) -> bool:
    """Same family: whole numbers, decimals, dates and times; keys may be
    whole numbers or strings."""
    families = [(T.IntegralType,), (T.DecimalType,), (T.DateType, T.TimestampType, T.TimestampNTZType)]
    if name.endswith(("ID", "Code")):
        families.append((T.StringType, T.IntegralType))
    return type(have) is type(want) or any(isinstance(want, f) and isinstance(have, f) for f in families)
