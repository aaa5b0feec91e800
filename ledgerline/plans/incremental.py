"""Silver and Gold kept up to date by increments, with the results of one full run over everything received so far.

An increment brings new Bronze rows for any of the entities. Rows that are already there change their verdict for two
reasons only: a new row has their key, so that both are duplicates now, or a parent that they were waiting for has come (for
cards also: their account's type may be another one). The keys of such rows are the dirty keys. New rows and the old rows of
dirty keys are checked again, by the same plan as in a full run, against the keys of all Bronze parents; the outcome is
appended as a batch of its own, and the dirty keys say which rows of earlier batches it replaces. Nothing else is rewritten,
and old tables are read by their key columns, but for the rows of dirty keys.

Gold keeps a mergeable state per account, merchant, day, type and status, one part a batch: what the batch adds, and, with
the opposite sign, what the replaced rows had added before. Counts and sums follow from the states alone. A minimum or
maximum cannot be taken back, so groups that something was taken back from look theirs up among their own rows.

A batch counts once its commit is written, as the last step; a run that fails before is repeated under the same number and
overwrites what it left. Readers see committed batches only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.model import ENTITIES
from ledgerline.operators.checks import stack
from ledgerline.operators.keys import matched_keys, unmatched_keys
from ledgerline.operators.lookup import lookup, measured_bytes
from ledgerline.operators.membership import Membership
from ledgerline.operators.sieve import Sieve
from ledgerline.plans import gold, silver
from ledgerline.plans.bronze import add_partition_columns
from ledgerline.session import broadcast_budget, materialise
from ledgerline.sources.files import conform, exists, remove, scan, write_table

FEW_BATCHES = 4  # as many have their replaced keys sieved one by one
BATCH = T.StructField("batch", T.IntegerType())
GROUP = ("account_id", "merchant_id", "transaction_date", "transaction_type", "status")
# State column -> (its value over rows, how parts are merged). What is summed can be taken back, what is not cannot.
STATE: dict[str, tuple[str, str]] = {
    "n": ("count(1)", "sum"),
    "amount_sum": ("sum(amount)", "sum"),
    "amount_cents": ("try_sum(try_cast(rint(amount * 100) AS bigint))", "try_sum"),
    "amount_odd": ("count_if(NOT coalesce(try_cast(rint(amount * 100) AS bigint) / 100D = amount, false))", "sum"),
    "low": ("min(amount)", "min"),
    "high": ("max(amount)", "max"),
    "first_at": ("min(transaction_timestamp)", "min"),
    "last_at": ("max(transaction_timestamp)", "max"),
}
LOAN_STATE: dict[str, tuple[str, str]] = {
    "total_payments": ("count(1)", "sum"),
    "paid_payments": ("count_if(status = 'PAID')", "sum"),
    "pending_payments": ("count_if(status = 'PENDING')", "sum"),
    "late_payments": ("count_if(status = 'LATE')", "sum"),
    "amount_sum": ("sum(CASE WHEN status = 'PAID' THEN amount ELSE 0D END)", "sum"),
    "amount_cents": ("try_sum(try_cast(rint((CASE WHEN status = 'PAID' THEN amount ELSE 0D END) * 100) AS bigint))", "try_sum"),
    "amount_odd": ("count_if(status = 'PAID' AND NOT coalesce(try_cast(rint(amount * 100) AS bigint) / 100D = amount, false))", "sum"),
}


def _movements(rows: DataFrame) -> DataFrame:
    return rows.withColumn("transaction_date", F.to_date("transaction_timestamp"))


# Kept state -> (the entity whose rows it adds up, how they are prepared, its groups, its columns).
KEPT: dict[str, tuple[str, Callable[[DataFrame], DataFrame], tuple[str, ...], dict[str, tuple[str, str]]]] = {
    "account_day": ("transactions", _movements, GROUP, STATE),
    "loan": ("loan_payments", lambda rows: rows, ("loan_id",), LOAN_STATE),
}
TAKEN = "taken_back"  # rows that were taken back from a group
TOTAL = "coalesce(CASE WHEN amount_odd = 0 THEN amount_cents / 100D END, amount_sum)"  # as the full run adds money up


def collect_state(rows: DataFrame, by: Sequence[str], state: Mapping[str, tuple[str, str]], sign: int) -> DataFrame:
    """One state row a group of what `rows` add, or (`sign` -1) of what taking them back changes."""
    held = rows.groupBy(*by).agg(*(F.expr(value).alias(name) for name, (value, _) in state.items()), F.count(F.lit(1)).alias(TAKEN))
    if sign > 0:
        return held.withColumn(TAKEN, F.lit(0).cast("long"))
    return held.withColumns({
        name: -F.col(name) if merge.endswith("sum") else F.lit(None).cast(held.schema[name].dataType)
        for name, (_, merge) in state.items()})


def merge_state(parts: DataFrame, by: Sequence[str], state: Mapping[str, tuple[str, str]]) -> DataFrame:
    """The parts of each group together."""
    return parts.groupBy(*by).agg(*(F.expr(f"{merge}({name})").alias(name) for name, (_, merge) in state.items()), F.sum(TAKEN).alias(TAKEN))


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*(F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields))


class IncrementalLake:
    """A lake under `root` that takes increments numbered from 1."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str, batch: int) -> str:
        return f"{self.root}/{layer}/{name}/batch={batch}"

    def _written(self, layer: str, name: str, batch: int) -> str:
        """The path of a part that is there; `apply` has written it."""
        return self.path(layer, name, batch)

    def committed(self) -> int:
        """The number of the last committed batch, 0 if there is none."""
        batch = 0
        while exists(self.spark, f"{self.path('commits', 'batches', batch + 1)}/_SUCCESS"):
            batch += 1
        return batch

    def _read(self, layer: str, name: str, schema: T.StructType, batches: range) -> DataFrame:
        """The rows of some batches, with their number in `batch`."""
        whole = T.StructType([*schema.fields, BATCH])
        paths = [self._written(layer, name, batch) for batch in batches]
        if not paths:
            return _empty(self.spark, whole)
        return self.spark.read.schema(whole).option("basePath", paths[0].rsplit("/", 1)[0]).parquet(*paths)

    def bronze(self, name: str, upto: int | None = None) -> DataFrame:
        last = self.committed() if upto is None else upto
        return self._read("bronze", name, ENTITIES[name].bronze_schema, range(1, last + 1)).drop("batch")

    def _replaced(self, name: str, upto: int) -> DataFrame:
        """(key, replaced): the last batch that replaced the rows of a key."""
        key = T.StructType([ENTITIES[name].columns[ENTITIES[name].key]])
        keys = self._read("replaced", name, key, range(1, upto + 1))
        return keys.groupBy(ENTITIES[name].key).agg(F.max("batch").alias("replaced"))

    def checked(self, name: str, upto: int | None = None, among: DataFrame | None = None) -> DataFrame:
        """All rows with their error after batch `upto`, NULL for valid ones; only those with a key in `among`, if given.

        Where the replaced keys are too many to broadcast, each of a few batches drops the keys replaced after it, unshuffled; of
        many batches the rows that a sieve lets through are shuffled. Rows of the last batch cannot have been replaced.
        """
        last = self.committed() if upto is None else upto
        key, schema = ENTITIES[name].key, ENTITIES[name].quarantine_schema
        rows = self._read("checked", name, schema, range(1, last + 1))
        if among is not None:
            among = Membership(materialise(among), key, rows)
            rows = among.kept(rows)
        if last < 2:  # the first batch replaces nothing
            return rows.select(schema.names)
        replaced = materialise(self._replaced(name, last))
        stays = []
        # `among` has just left few rows.
        if among is None and measured_bytes(replaced) > broadcast_budget(self.spark):
            if last <= FEW_BATCHES and broadcast_budget(self.spark) >= 0:
                return reduce(DataFrame.unionByName, [
                    self._still(name, batch, replaced).select(schema.names) for batch in range(1, last + 1)])
            rows = Sieve(replaced, key).marked(rows, "_maybe")
            possible = F.col("_maybe") & (F.col("batch") < last)
            stays, rows = [rows.where(~possible)], rows.where(possible)
        placed = lookup(rows, replaced, key, "left").where("replaced IS NULL OR batch >= replaced")
        return reduce(DataFrame.unionByName, [part.select(schema.names) for part in (*stays, placed)])

    def _still(self, name: str, batch: int, replaced: DataFrame) -> DataFrame:
        """The checked rows of a batch whose key no later batch has replaced."""
        key = ENTITIES[name].key
        rows = self._read("checked", name, ENTITIES[name].quarantine_schema, range(batch, batch + 1))
        later = materialise(replaced.where(F.col("replaced") > batch).select(key))
        return Membership(later, key, rows).dropped(rows)

    def silver(self, name: str, upto: int | None = None) -> DataFrame:
        return silver.valid_rows(name, self.checked(name, upto))

    def quarantine(self, name: str, upto: int | None = None) -> DataFrame:
        return silver.quarantined_rows(name, self.checked(name, upto))

    # One increment

    def apply(self, batch: int, increment: Mapping[str, DataFrame]) -> None:
        """Take in an increment: entity -> its new rows, with or without year and month. Entities may be missing.

        `batch` is the next number; the last committed one again does nothing, so that a caller that does not know how a
        run ended can repeat it.
        """
        done = self.committed()
        if batch == done:
            return
        if batch != done + 1:
            raise ValueError(f"batch {batch} cannot follow batch {done}")
        for name in ENTITIES:
            self._take(name, batch, increment.get(name))
        for name in ENTITIES:
            self._check(name, batch)
        for kept in KEPT:
            self._collect(kept, batch)
        write_table(self.spark.range(1).select(F.lit(batch).alias("number")), self.path("commits", "batches", batch))

    def _take(self, name: str, batch: int, rows: DataFrame | None) -> None:
        entity = ENTITIES[name]
        if rows is None:
            rows = _empty(self.spark, entity.columns)
        rows = add_partition_columns(conform(rows, entity.columns), entity.date_column)
        write_table(rows, self.path("bronze", name, batch))

    def _new(self, name: str, batch: int) -> DataFrame:
        return self._read("bronze", name, ENTITIES[name].bronze_schema, range(batch, batch + 1)).drop("batch")

    def dirty_keys(self, name: str, batch: int) -> DataFrame:
        """Keys of earlier rows whose verdict batch `batch` may change."""
        entity = ENTITIES[name]
        old, new = self.bronze(name, batch - 1), self._new(name, batch)
        keys = [matched_keys(old.where(F.col(entity.key).isNotNull()), entity.key, new, entity.key).select(entity.key)]
        for reference in entity.references:
            came = self._new(reference.parent, batch).select(reference.parent_key)
            if name != "cards":  # a card's account may also have got another type
                before = self.bronze(reference.parent, batch - 1).select(reference.parent_key)
                came = unmatched_keys(came, reference.parent_key, before, reference.parent_key).select(reference.parent_key)
            parents = came.where(F.col(reference.parent_key).isNotNull()).distinct()
            waiting = lookup(
                old.select(entity.key, reference.column).where(F.col(entity.key).isNotNull()),
                materialise(parents.select(F.col(reference.parent_key).alias(reference.column))), reference.column, sparse=True)
            keys.append(waiting.select(entity.key))
        return reduce(DataFrame.unionByName, keys).distinct()

    def _check(self, name: str, batch: int) -> None:
        entity = ENTITIES[name]
        key = T.StructType([entity.columns[entity.key]])
        dirty = self.dirty_keys(name, batch) if batch > 1 else _empty(self.spark, key)
        write_table(dirty, self.path("replaced", name, batch))
        dirty = scan(self.spark, self.path("replaced", name, batch), key)
        affected = self._new(name, batch)
        if batch > 1:  # written once: every key set and the rows themselves are read from it
            before = self.bronze(name, batch - 1)
            old = Membership(dirty, entity.key, before).kept(before)
            write_table(affected.unionByName(old), self.path("affected", name, batch))
            affected = scan(self.spark, self.path("affected", name, batch), entity.bronze_schema)
        tables = lambda other: affected if other == name else self.bronze(other, batch)
        write_table(reduce(DataFrame.unionByName, silver.checked_parts(name, tables)), self.path("checked", name, batch))
        if batch > 1:
            remove(self.spark, self.path("affected", name, batch))

    def _collect(self, kept: str, batch: int) -> None:
        name, prepared, by, state = KEPT[kept]
        entity = ENTITIES[name]
        key = T.StructType([entity.columns[entity.key]])
        rows = silver.valid_rows(name, scan(self.spark, self._written("checked", name, batch), entity.quarantine_schema))
        parts = [collect_state(prepared(rows), by, state, 1)]
        if batch > 1:
            dirty = scan(self.spark, self._written("replaced", name, batch), key)
            taken = silver.valid_rows(name, self.checked(name, batch - 1, among=dirty))
            parts.append(collect_state(prepared(taken), by, state, -1))
        write_table(stack(parts), self.path("state", kept, batch))

    # Gold from the states

    def _state(self, kept: str) -> DataFrame:
        # Written by `_collect`, so the schema is the first batch's; all batches have the same.
        paths = [self._written("state", kept, batch) for batch in range(1, self.committed() + 1)]
        return self.spark.read.parquet(*paths)

    def _repaired(self, merged: DataFrame, by: Sequence[str], wanted: Mapping[str, str]) -> DataFrame:
        """`merged` without empty groups, with the `wanted` minima and maxima of groups that rows were taken back from
        looked up among the rows that are left."""
        left = merged.where("n > 0")
        key = F.struct(*by).alias("_group")
        touched = materialise(left.where(f"{TAKEN} > 0").select(key))
        rows = _movements(self.silver("transactions")).select(*by, "amount", "transaction_timestamp").withColumn("_group", key)
        own = lookup(rows, touched, "_group", sparse=True).groupBy("_group").agg(
            *(F.expr(STATE[name][0]).alias(f"_own_{name}") for name in wanted))
        found = lookup(left.withColumn("_group", key), materialise(own), "_group", "left")
        right = {name: F.when(F.col(TAKEN) > 0, F.col(f"_own_{name}")).otherwise(F.col(name)) for name in wanted}
        return found.withColumns(right).drop("_group", *(f"_own_{name}" for name in wanted))

    def daily_transaction_summary(self) -> DataFrame:
        by = ("transaction_date", "transaction_type", "status")
        merged = self._repaired(merge_state(self._state("account_day"), by, STATE), by, {"low": "min", "high": "max"})
        return merged.select(
            *by, F.col("n").alias("transaction_count"), F.expr(TOTAL).alias("total_amount"),
            F.expr(f"({TOTAL}) / n").alias("average_amount"), F.col("low").alias("minimum_amount"),
            F.col("high").alias("maximum_amount"))

    def customer_transaction_metrics(self) -> DataFrame:
        kinds = {f"{kind.lower()}_count": f"transaction_type = '{kind}'"
                 for kind in ("PIX", "CARD_PURCHASE", "TRANSFER", "DEPOSIT", "WITHDRAWAL")}
        kinds |= {f"{status.lower()}_transactions": f"status = '{status}'" for status in ("COMPLETED", "FAILED", "PENDING")}
        counted = {name: (f"CASE WHEN {condition} THEN n ELSE 0 END", "sum") for name, condition in kinds.items()}
        parts = self._state("account_day").withColumns({name: F.expr(value) for name, (value, _) in counted.items()})
        per_account = self._repaired(
            merge_state(parts, ("account_id",), STATE | counted), ("account_id",), {"first_at": "min", "last_at": "max"})
        owners = self.silver("accounts").select("account_id", "customer_id")
        per_customer = merge_state(lookup(per_account, owners, "account_id"), ("customer_id",), STATE | counted)
        found = lookup(per_customer, self.silver("customers").select("customer_id", "customer_segment"), "customer_id")
        return found.select(
            "customer_id", "customer_segment", F.col("n").alias("transaction_count"),
            F.expr(TOTAL).alias("total_transaction_amount"), F.expr(f"({TOTAL}) / n").alias("average_transaction_amount"),
            *kinds, F.col("first_at").alias("first_transaction_at"), F.col("last_at").alias("last_transaction_at"))

    def merchant_performance(self) -> DataFrame:
        statuses = {f"{status.lower()}_transactions": (f"CASE WHEN status = '{status}' THEN n ELSE 0 END", "sum")
                    for status in ("COMPLETED", "FAILED", "PENDING")}
        parts = self._state("account_day").where("merchant_id IS NOT NULL").withColumns(
            {name: F.expr(value) for name, (value, _) in statuses.items()})
        per_account = merge_state(parts, ("merchant_id", "account_id"), STATE | statuses).where("n > 0")
        unique = {"unique_accounts": ("1", "sum")}
        per_merchant = merge_state(per_account.withColumn("unique_accounts", F.lit(1).cast("long")), ("merchant_id",), STATE | statuses | unique)
        merchant = ["merchant_id", "merchant_name", "merchant_category", "city", "state"]
        return lookup(per_merchant, self.silver("merchants").select(merchant), "merchant_id").select(
            *merchant, F.col("n").alias("transaction_count"), F.expr(TOTAL).alias("total_transaction_amount"),
            F.expr(f"({TOTAL}) / n").alias("average_transaction_amount"), *statuses, "unique_accounts")

    def loan_portfolio(self) -> DataFrame:
        counts = ("total_payments", "paid_payments", "pending_payments", "late_payments")
        held = merge_state(self._state("loan"), ("loan_id",), LOAN_STATE).select(
            "loan_id", *counts, F.expr(TOTAL).alias("total_paid_amount"))
        loans = self.silver("loans").withColumnRenamed("status", "loan_status")
        names = [*counts, "total_paid_amount"]
        found = lookup(loans, held, "loan_id", "left").fillna(0, names)
        return found.withColumn("remaining_amount", F.col("principal_amount") - F.col("total_paid_amount")).select(
            gold.SCHEMAS["loan_portfolio"].names)


MODELS: dict[str, Callable[[IncrementalLake], DataFrame]] = {
    "daily_transaction_summary": IncrementalLake.daily_transaction_summary,
    "customer_transaction_metrics": IncrementalLake.customer_transaction_metrics,
    "merchant_performance": IncrementalLake.merchant_performance,
    "loan_portfolio": IncrementalLake.loan_portfolio,
}


class DealtLake(IncrementalLake):
    """A lake that has taken in `count` increments dealt from whole tables, each part of it written when it is first asked for.

    A part is written from what `apply` would have written it from, by the same steps: an entity is checked against its own
    Bronze rows and its parents' alone, so whoever asks for accounts has neither transactions nor Gold states made.
    """

    def __init__(self, spark: SparkSession, root: str, tables: Callable[[str], DataFrame], count: int):
        super().__init__(spark, root)
        self._deal = cache(lambda name: deal_increments(name, tables(name), f"{self.root}/increments", count))
        self._count = count
        self._there: set[tuple[str, str, int]] = set()

    def path(self, layer: str, name: str, batch: int) -> str:
        return super().path("increments" if layer == "bronze" else layer, name, batch)

    def committed(self) -> int:
        return self._count

    def apply(self, batch: int, increment: Mapping[str, DataFrame]) -> None:
        raise ValueError("a dealt lake has all its increments")

    def _written(self, layer: str, name: str, batch: int) -> str:
        made = "checked" if layer == "replaced" else layer  # one step writes both
        if made == "bronze":
            self._deal(name)  # one step writes those of all batches
        elif (made, name, batch) not in self._there:
            if made == "checked":
                self._check(name, batch)
            else:
                self._collect(name, batch)
            self._there.add((made, name, batch))
        return self.path(layer, name, batch)


def deal_increments(name: str, rows: DataFrame, folder: str, count: int) -> None:
    """The Bronze rows of an entity dealt one by one over `count` increments, written under `folder` as the batches of a lake:
    copies of a row, and rows and their parents, come in different ones. Every increment gets its folder, also without rows."""
    entity = ENTITIES[name]
    bronze = add_partition_columns(conform(rows, entity.columns), entity.date_column)
    dealt = bronze.withColumn("batch", (F.pmod(F.monotonically_increasing_id(), F.lit(count)) + 1).cast("int"))
    write_table(dealt, f"{folder}/{name}", ["batch"], gather=False)
    for batch in range(1, count + 1):
        if not exists(rows.sparkSession, f"{folder}/{name}/batch={batch}"):
            write_table(bronze.limit(0), f"{folder}/{name}/batch={batch}")
