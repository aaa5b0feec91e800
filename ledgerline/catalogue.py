"""The registered queries: every operator of the product over the supplied tables.

A query takes (spark, folder) and returns a DataFrame over whole tables. Sums and averages of doubles depend on the
order of addition in their last bits, so results meant for comparison are put on a fixed grid by `on_grid`; the plans
themselves do not round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.model import ENTITIES, PARTITION_COLUMNS
from ledgerline.operators.checks import stack
from ledgerline.plans import allotment, bronze, comparisons, derive, gold, incremental, levels, marts, profile, quality, silver, timeline
from ledgerline.plans.lake import OUTCOME, VALID
from ledgerline.plans.publish import TARGETS, Publisher, Target, guard, prepare, schema_findings, PublishError
from ledgerline.sources.files import conform, scan, scan_tree, write_table
from ledgerline.streaming import windows
from ledgerline.workspace import fresh_folder, gold_over, incremental_over, lake_over, raw_over

Query = Callable[[SparkSession, str], DataFrame]

# Digits kept of computed doubles, by column name.
GRID = {
    **dict.fromkeys(
        ("total_amount", "total_transaction_amount", "total_paid_amount", "total_late_amount", "remaining_amount",
         "total_loan_amount", "total_principal"), 2),
    **dict.fromkeys(
        ("average_amount", "average_transaction_amount", "average_principal", "average_interest_rate", "null_percent",
         "q1", "q3", "upper_limit"), 4),
    "value": 2,
}


def grid(column: str, digits: int) -> str:
    """SQL for the nearest multiple of 10^-digits; halves, and what is within rounding noise of them, go up."""
    return f"CAST(floor({column} * 1e{digits} + 0.50001E0) AS DOUBLE) / 1e{digits}"


def on_grid(rows: DataFrame) -> DataFrame:
    kinds = dict(rows.dtypes)
    columns = {name: F.expr(grid(name, GRID[name])) for name in rows.columns if name in GRID and kinds[name] == "double"}
    return rows.withColumns(columns) if columns else rows


def _summary(name: str, rows: DataFrame) -> DataFrame:
    """One row that tells whether a table came through whole: rows, key total, dated rows and date range."""
    entity = ENTITIES[name]
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(entity.key).alias("key_total"),
        F.count(entity.date_column).alias("dated_rows"), F.min(entity.date_column).alias("first_date"),
        F.max(entity.date_column).alias("last_date"),
    ).select(F.lit(name).alias("entity"), "*")


def _write_generated(spark: SparkSession, folder: str, names: Iterable[str]) -> str:
    """Write generated tables as an upstream system would leave them, one Parquet path per entity."""
    base = fresh_folder(spark, "generated")
    for name in names:
        write_table(raw_over(spark, folder)(name), f"{base}/{name}.parquet")
    return base


# Sources and sinks


def scan_generated(spark: SparkSession, folder: str) -> DataFrame:
    base = _write_generated(spark, folder, ENTITIES)
    return stack([
        _summary(name, scan(spark, f"{base}/{name}.parquet", entity.columns)) for name, entity in ENTITIES.items()
    ])


def bronze_ingest(spark: SparkSession, folder: str) -> DataFrame:
    base = _write_generated(spark, folder, ENTITIES)
    target = fresh_folder(spark, "bronze")
    results = []
    for name, entity in ENTITIES.items():
        rows = bronze.ingest(spark, name, f"{base}/{name}.parquet", f"{target}/{name}")
        counts = rows.groupBy(*PARTITION_COLUMNS).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum(entity.key).alias("key_total")
        )
        results.append(counts.select(F.lit(name).alias("entity"), "*"))
    return stack(results)


def scan_bronze(spark: SparkSession, folder: str) -> DataFrame:
    base = _write_generated(spark, folder, ["transactions"])
    target = fresh_folder(spark, "bronze")
    return bronze.ingest(spark, "transactions", f"{base}/transactions.parquet", f"{target}/transactions")


def scan_silver(spark: SparkSession, folder: str) -> DataFrame:
    lake = lake_over(spark, folder)
    return stack([_summary(name, lake.silver(name)) for name in ENTITIES])


def scan_gold(spark: SparkSession, folder: str) -> DataFrame:
    """A Gold table read back from its folders by day."""
    return on_grid(lake_over(spark, folder).gold("daily_transaction_summary"))


def sink_daily_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """Totals per day of a summary written here."""
    name = "daily_transaction_summary"
    path = fresh_folder(spark, name)
    summary = gold.MODELS[name](lake_over(spark, folder).silver)
    write_table(summary, path, gold.LAYOUTS[name], spread=gold.FOLDER_TASKS)
    return on_grid(scan(spark, path, gold.SCHEMAS[name]).groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("transaction_count").alias("transaction_count"),
        F.sum("total_amount").alias("total_amount"),
    ))


def scan_glob_hive(spark: SparkSession, folder: str) -> DataFrame:
    """Silver transactions through a wildcard over the year and month folders."""
    lake = lake_over(spark, folder)
    lake.silver("transactions")
    base = f"{lake.path('checked', 'transactions')}/{OUTCOME}={VALID}"
    return scan_tree(spark, f"{base}/year=*/month=*/*.parquet", base, ENTITIES["transactions"].bronze_schema)


def normalize_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """Zoned timestamps become microseconds without zone."""
    rows = raw_over(spark, folder)("cards")
    zoned = rows.withColumns({name: F.col(name).cast("timestamp") for name in ("issued_at", "expires_at")})
    return conform(zoned, ENTITIES["cards"].columns).select("card_id", "issued_at", "expires_at")


def sink_overwrite(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """Valid rows over a table that held the quarantined ones."""
    declared = ENTITIES[entity]
    path = fresh_folder(spark, f"sink-{entity}")
    rows = silver.checked(entity, lake_over(spark, folder).bronze)
    write_table(silver.quarantined_rows(entity, rows).drop("quality_error"), path, declared.layout)
    write_table(silver.valid_rows(entity, rows), path, declared.layout)
    return scan(spark, path, declared.bronze_schema)


def quarantine_sink(spark: SparkSession, folder: str) -> DataFrame:
    lake = lake_over(spark, folder)
    return stack([
        lake.quarantine(name).groupBy("quality_error").agg(F.count(F.lit(1)).alias("error_count"))
        .select(F.lit(name).alias("entity"), "*")
        for name in ENTITIES
    ])


# Publication


def _publisher(spark: SparkSession) -> Publisher:
    location = fresh_folder(spark, "published")
    return Publisher(spark, f"ledgerline_{location.rsplit('-', 1)[1]}", location)


def _gold(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """Gold models as plans over Silver."""
    return gold_over(lake_over(spark, folder))


def _written_gold(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """Gold tables as written, which is what gets published."""
    return lake_over(spark, folder).gold


DAILY = next(target for target in TARGETS if target.partition)


def scan_catalog_table(spark: SparkSession, folder: str) -> DataFrame:
    target = Target("customer_360")
    publisher = _publisher(spark)
    publisher.publish(_written_gold(spark, folder)(target.name), target)
    return on_grid(publisher.table(target.name))


def publish_nonempty_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Which Gold tables may be published; a table without rows may not."""
    tables = {target.name: _gold(spark, folder)(target.name) for target in TARGETS}
    tables["customer_360_without_customers"] = tables["customer_360"].where("customer_id IS NULL")
    results = []
    for name, rows in tables.items():
        try:
            guard(rows, name)
            verdict = "publish"
        except PublishError:
            verdict = "refuse"
        count = rows.agg(F.count(F.lit(1)).alias("row_count"))
        results.append(count.select(F.lit(name).alias("table_name"), "row_count", F.lit(verdict).alias("verdict")))
    return stack(results)


def publish_prepare(spark: SparkSession, folder: str) -> DataFrame:
    target = Target("customer_transaction_metrics")
    return on_grid(prepare(_written_gold(spark, folder)(target.name), target, files=32))


def publish_create(spark: SparkSession, folder: str) -> DataFrame:
    publisher = _publisher(spark)
    publisher.create(prepare(_gold(spark, folder)(DAILY.name), DAILY), DAILY)
    return on_grid(publisher.table(DAILY.name))


def publish_overwrite_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Republish completed transactions only: days that have some are replaced, the other days stay as they were."""
    publisher = _publisher(spark)
    daily = _gold(spark, folder)(DAILY.name)
    publisher.create(prepare(daily, DAILY), DAILY)
    publisher.overwrite_partitions(prepare(daily.where("status = 'COMPLETED'"), DAILY), DAILY)
    spark.catalog.refreshTable(publisher.full_name(DAILY.name))
    return on_grid(publisher.table(DAILY.name))


def publish_schema_check(spark: SparkSession, folder: str) -> DataFrame:
    """Findings per column when the SQL customer mart meets the published customer view, with the rows concerned."""
    publisher = _publisher(spark)
    target = Target("customer_360")
    publisher.publish(_written_gold(spark, folder)(target.name), target)
    table = publisher.table(target.name)
    mart = _model(spark, folder, "customer_360_mart").withColumn("total_cards", F.col("total_cards").cast("string"))
    findings = schema_findings(mart.drop("total_loans").schema, table.schema)
    rows = table.agg(F.count(F.lit(1)).alias("row_count"))
    described = F.array(*(F.struct(*(F.lit(text).alias(name) for name, text in zip(
        ("column_name", "finding", "detail"), finding))) for finding in findings))
    return rows.select("row_count", F.inline(described))


def publish_count_check(spark: SparkSession, folder: str) -> DataFrame:
    """Source and published rows of every target after two publications. The second one of the daily summary lacks its
    first day, which the table keeps: that publication is refused, and the counts differ from its source."""
    publisher = _publisher(spark)
    source = _written_gold(spark, folder)

    def compared(scope: str, rows: DataFrame, target: Target) -> DataFrame:
        return quality.reconcile(
            scope,
            [quality.totals(publisher.table(target.name), "actual", {"rows": "count(*)"})],
            [quality.totals(rows, "expected", {"rows": "count(*)"})],
        )

    results = []
    for target in TARGETS:
        rows = source(target.name)
        publisher.publish(rows, target)
        if target == DAILY:
            first_day = rows.agg(F.min(target.partition).alias("day"))  # one row
            later = rows.join(F.broadcast(first_day), F.col(target.partition) == F.col("day"), "left_anti")
            try:
                publisher.publish(later, target)
            except PublishError:
                results.append(compared(f"{target.name}_without_first_day", later, target))
        else:
            publisher.publish(rows, target)
        results.append(compared(target.name, rows, target))
    return stack(results)


def publish_history(spark: SparkSession, folder: str) -> DataFrame:
    """The last five of six publications of one table."""
    publisher = _publisher(spark)
    target = Target("merchant_performance")
    rows = _written_gold(spark, folder)(target.name)
    for _ in range(6):
        publisher.publish(rows, target)
    return publisher.history(target.name).select("table_name", "operation", "record_count")


# Everything that is a plan over Bronze, Silver or Gold


def _model(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return marts.model(spark, name, lake_over(spark, folder).silver)


def _over_bronze(plan: Callable[[Callable], DataFrame]) -> Query:
    return lambda spark, folder: on_grid(plan(lake_over(spark, folder).bronze))


def _over_silver(plan: Callable[[Callable], DataFrame]) -> Query:
    return lambda spark, folder: on_grid(plan(lake_over(spark, folder).silver))


def _over_gold(plan: Callable[[Callable], DataFrame]) -> Query:
    return lambda spark, folder: on_grid(plan(_gold(spark, folder)))


def _checked_and_unchecked(compare: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """Customer metrics as published and over unchecked rows, on the grid before they are compared."""
    def compared(spark: SparkSession, folder: str) -> DataFrame:
        unchecked = comparisons.unchecked_customer_metrics(lake_over(spark, folder).bronze)
        return compare(on_grid(_written_gold(spark, folder)("customer_transaction_metrics")), on_grid(unchecked))

    return compared


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


ARRIVALS = 4  # micro-batches that the events are dealt into


def _files(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _arrived(spark: SparkSession, folder: str) -> str:
    """The events as files that arrived one after the other."""
    source = f"{fresh_folder(spark, 'arrivals')}/events"
    windows.deal_arrivals(_events(spark, folder), source, ARRIVALS, files=_files(spark))
    return source


def stream_event_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly totals by event type, as a stream leaves them."""
    source, sink = _arrived(spark, folder), windows.BatchSink(fresh_folder(spark, "windows"))
    windows.run(windows.window_totals(windows.read_stream(spark, source, _files(spark))), sink, fresh_folder(spark, "progress"), "update")
    return windows.latest(windows.written(spark, sink, windows.WINDOW_ROWS), ["window_start", "event_type"])


def stream_event_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of each user, as a stream leaves them."""
    source, sink = _arrived(spark, folder), windows.BatchSink(fresh_folder(spark, "sessions"))
    totals = windows.session_totals(windows.read_stream(spark, source, _files(spark)))
    windows.run_to_the_end(spark, source, totals, sink, fresh_folder(spark, "progress"), _files(spark))
    return windows.written(spark, sink, windows.SESSION_ROWS).drop("batch")


def _over_raw(plan: Callable[[Callable], DataFrame]) -> Query:
    return lambda spark, folder: on_grid(plan(raw_over(spark, folder)))


def _reconciliation(check: Callable) -> Query:
    return lambda spark, folder: check(lake_over(spark, folder).silver, _gold(spark, folder))


def build() -> dict[str, Query]:
    found: dict[str, Query] = {
        "scan_generated": scan_generated,
        "scan_bronze": scan_bronze,
        "scan_silver": scan_silver,
        "scan_gold": scan_gold,
        "scan_glob_hive": scan_glob_hive,
        "scan_catalog_table": scan_catalog_table,
        "bronze_ingest": bronze_ingest,
        "normalize_timestamps": normalize_timestamps,
        "sink_overwrite_flat": partial(sink_overwrite, entity="customers"),
        "sink_overwrite_partitioned": partial(sink_overwrite, entity="transactions"),
        "sink_daily_partitioned": sink_daily_partitioned,
        "quarantine_sink": quarantine_sink,
    }
    for name, entity in ENTITIES.items():
        found[f"norm_{name}"] = _over_bronze(partial(silver.normalised, name))
        found[f"validate_{name}"] = _over_bronze(partial(silver.validated, name))
        found[f"dup_{name}"] = _over_bronze(partial(silver.checked_duplicates, name))
        found[f"silver_{name}"] = lambda spark, folder, name=name: lake_over(spark, folder).silver(name)
        found[f"quarantine_{name}"] = lambda spark, folder, name=name: lake_over(spark, folder).quarantine(name)
        found[f"errors_{name}"] = lambda spark, folder, name=name: silver.error_counts(
            lake_over(spark, folder).quarantine(name))
    for key, name in (
        ("fk_accounts_customer", "accounts"), ("fk_transactions_account", "transactions"),
        ("fk_cards_account", "cards"), ("fk_loans_customer", "loans"), ("fk_payments_loan", "loan_payments"),
    ):
        found[key] = _over_bronze(partial(silver.checked_references, name))
    found["rule_cards_savings"] = _over_bronze(silver.checked_savings_cards)
    found["quality_counts"] = lambda spark, folder: quality.row_counts(
        lake_over(spark, folder).silver, lake_over(spark, folder).quarantine)

    for name in gold.MODELS:
        found[f"gold_{name}"] = _over_silver(gold.MODELS[name])
    found["top_merchants"] = _over_gold(lambda model: gold.top_merchants(model("merchant_performance")))
    found["loan_status_counts"] = _over_gold(lambda model: gold.status_counts(model("loan_portfolio")))
    found["customer_segment_counts"] = _over_gold(lambda model: gold.segment_counts(model("customer_360")))
    for part in gold.CUSTOMER_PARTS:
        found[f"c360_{part.__name__}"] = _over_silver(part)

    for name in marts.MODELS:
        found[name] = lambda spark, folder, name=name: on_grid(_model(spark, folder, name))

    found["qa_silver_pk"] = _over_silver(quality.primary_keys)
    found["qa_fk"] = _over_silver(quality.silver_references)
    found["qa_business_rules"] = _over_silver(quality.business_rules)
    for entity, column in quality.DISTRIBUTIONS:
        found[f"dist_{entity}_{column}"] = _over_silver(partial(quality.distribution, entity=entity, column=column))
    found["stats_transactions"] = _over_silver(quality.transaction_stats)
    found["stats_loans"] = _over_silver(quality.loan_stats)
    found["stats_payments"] = _over_silver(quality.payment_stats)
    found["null_counts"] = _over_silver(
        lambda tables: quality.null_counts(tables("transactions"), ENTITIES["transactions"].columns.names))
    found["qa_gold_composite_key"] = _over_gold(quality.gold_daily_key)
    found["qa_gold_pk"] = _over_gold(quality.gold_keys)
    for key, check in quality.RECONCILIATIONS.items():
        found[key] = _reconciliation(check)
    for layer in quality.COLUMN_TESTS:
        found[layer] = lambda spark, folder, layer=layer: quality.data_tests(
            layer, lambda name: _model(spark, folder, name))

    found["profile_columns"] = _over_raw(profile.columns)
    found["profile_duplicate_rows"] = _over_raw(profile.duplicates)
    found["profile_pk"] = _over_raw(profile.primary_keys)
    found["profile_fk"] = _over_raw(quality.raw_references)
    found["profile_transactions"] = _over_raw(profile.transactions)
    found["profile_loans"] = _over_raw(profile.loans)
    found["card_merchant_check"] = _over_raw(profile.card_merchants)
    found["amount_outliers_iqr"] = _over_raw(profile.outliers)

    found["publish_nonempty_guard"] = publish_nonempty_guard
    found["publish_prepare"] = publish_prepare
    found["publish_create"] = publish_create
    found["publish_overwrite_partitions"] = publish_overwrite_partitions
    found["publish_schema_check"] = publish_schema_check
    found["publish_count_check"] = publish_count_check
    found["publish_history"] = publish_history
    found["installment_schedule"] = _over_silver(lambda tables: derive.installment_schedule(tables("loans")))
    for name in ENTITIES:
        found[f"incremental_silver_{name}"] = lambda spark, folder, name=name: incremental_over(spark, folder).silver(name)
    found["incremental_quarantine_transactions"] = lambda spark, folder: incremental_over(spark, folder).quarantine("transactions")
    for name, model in incremental.MODELS.items():
        found[f"incremental_gold_{name}"] = lambda spark, folder, model=model: on_grid(model(incremental_over(spark, folder)))
    found["asof_account_state"] = _over_silver(timeline.transactions_with_state)
    found["transactions_by_account_state"] = _over_silver(timeline.transactions_by_state)
    found["open_accounts_at_payments"] = _over_silver(timeline.open_accounts_at_payments)
    found["overlapping_loans"] = _over_silver(timeline.overlapping_loans)
    found["event_sessions"] = lambda spark, folder: timeline.event_sessions(_events(spark, folder))
    found["event_running_totals"] = lambda spark, folder: timeline.event_running_totals(_events(spark, folder))
    found["stream_event_windows"] = stream_event_windows
    found["stream_event_sessions"] = stream_event_sessions
    found["account_cube"] = _over_silver(levels.account_cube)
    found["account_rollup"] = _over_silver(levels.account_rollup)
    found["sketch_checks"] = _over_silver(levels.sketch_checks)
    found["top_merchants_by_state_month"] = _over_silver(comparisons.top_merchants_by_state_and_month)
    found["customer_row_differences"] = _checked_and_unchecked(comparisons.customer_row_differences)
    found["customer_reconciliation"] = _checked_and_unchecked(comparisons.customer_reconciliation)
    found["bronze_silver_differences"] = lambda spark, folder: comparisons.bronze_silver_differences(
        "accounts", lake_over(spark, folder).bronze, lake_over(spark, folder).silver)
    for name in ENTITIES:
        found[f"failures_{name}"] = _over_bronze(partial(comparisons.failure_rows, name))
    found["failure_combinations"] = _over_bronze(comparisons.failure_combinations)
    found["allotted_payments"] = _over_silver(allotment.allotted)
    found["eligible_card_accounts"] = _over_silver(lambda tables: derive.eligible_card_accounts(tables("accounts")))
    return found
