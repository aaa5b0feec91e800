"""One lake: Bronze tables in, checked and Gold tables written under a root folder.

A checked table holds all rows of an entity, laid out by outcome: Silver is its valid folder, the quarantine its
other one. So one pass over the wide rows fills both sinks, without a second scan and without persisting them, and a
reader of either prunes the other away. Gold models read Silver as written instead of validating raw rows again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.model import ENTITIES
from ledgerline.plans import gold, silver
from ledgerline.sources.files import exists, scan, write_table

OUTCOME = "outcome"
VALID, QUARANTINED = "valid", "quarantined"


class Lake:
    """`on_demand` lakes write a table when it is first asked for; others only read what was built before.

    `gather` is False where Bronze already has the year and month layout, so that writing needs no shuffle
    (unless a lookup has shuffled the rows meanwhile).
    """

    def __init__(
        self, spark: SparkSession, root: str, bronze: Callable[[str], DataFrame],
        on_demand: bool = True, gather: bool = True,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bronze = cache(bronze)  # opening a table lists its files and reads a footer, so it is done once
        self._on_demand = on_demand
        self._gather = gather
        self._open: dict[str, DataFrame] = {}

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def silver(self, name: str) -> DataFrame:
        return self._checked(name, VALID).select(ENTITIES[name].bronze_schema.names)

    def quarantine(self, name: str) -> DataFrame:
        return self._checked(name, QUARANTINED).select(ENTITIES[name].quarantine_schema.names)

    def gold(self, name: str) -> DataFrame:
        return self._table(self.path("gold", name), gold.SCHEMAS[name], lambda: self.build_gold(name))

    def build_silver(self, name: str) -> None:
        """Check an entity and write its valid and quarantined rows."""
        layout = ENTITIES[name].layout
        outcome = F.when(F.col("quality_error").isNull(), VALID).otherwise(QUARANTINED)
        folders = (OUTCOME, *layout)
        still, *shuffled = [part.withColumn(OUTCOME, outcome) for part in silver.checked_parts(name, self.bronze)]
        if layout and self._gather:
            still = still.hint("rebalance", *folders)
        if layout:  # rows that a lookup has shuffled are brought together again; the others lie as Bronze has them
            shuffled = [part.hint("rebalance", *folders) for part in shuffled]
        path = self.path("checked", name)
        write_table(reduce(DataFrame.unionByName, shuffled, still), path, folders, gather=False)
        self._open.pop(path, None)

    def build_gold(self, name: str) -> None:
        path = self.path("gold", name)
        write_table(gold.MODELS[name](self.silver), path, gold.LAYOUTS.get(name, ()), spread=gold.FOLDER_TASKS)
        self._open.pop(path, None)

    def _checked(self, name: str, outcome: str) -> DataFrame:
        schema = T.StructType([*ENTITIES[name].quarantine_schema.fields, T.StructField(OUTCOME, T.StringType())])
        rows = self._table(self.path("checked", name), schema, lambda: self.build_silver(name))
        return rows.where(F.col(OUTCOME) == outcome)

    def _table(self, path: str, schema: T.StructType, build: Callable[[], None]) -> DataFrame:
        known = path in self._open
        if self._on_demand and not (known and exists(self.spark, path)):  # not written yet, or cleaned up since
            build()
            known = False
        if not known:
            self._open[path] = scan(self.spark, path, schema)
        return self._open[path]
