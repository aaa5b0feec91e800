"""Mergeable summaries kept by day, and their answers for longer spans beside exact ones.

A day's summary holds a HyperLogLog sketch of its ids and a KLL sketch of its values; both merge without the rows, so a month
or a year costs one row a day. The checks compare with exact figures: the distinct ids counted, and the exact rank of the
quantile that a sketch answers, which is a count and needs no sorting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_REGISTERS = 14  # 2^14 registers: a standard error of 0.8 %
DISTINCT_BOUND = 0.04  # five standard errors
KLL_SIZE = 400  # ranks within 0.7 % with a chance of 99 %
RANK_BOUND = 0.02


def daily(rows: DataFrame, by: Sequence[str], id_column: str, value: str) -> DataFrame:
    """(by, ids, shares, n): a sketch of the ids and one of the values for each group, with the number of values."""
    return rows.groupBy(*by).agg(
        F.hll_sketch_agg(id_column, F.lit(LG_REGISTERS)).alias("ids"),
        F.kll_sketch_agg_double(value, F.lit(KLL_SIZE)).alias("shares"), F.count(value).alias("n"))


def merged(summaries: DataFrame, by: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """(by, n, distinct_estimate, q0, q1, ...): the summaries of each group merged and asked."""
    together = summaries.groupBy(*by).agg(
        F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("distinct_estimate"),
        F.kll_merge_agg_double("shares", F.lit(KLL_SIZE)).alias("_shares"))
    return together.select(*by, "n", "distinct_estimate", *(
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_shares", F.lit(share))).alias(f"q{at}")
        for at, share in enumerate(quantiles)))


def in_bounds(
    rows: DataFrame, answers: DataFrame, by: Sequence[str], id_column: str, value: str, quantiles: Sequence[float],
) -> DataFrame:
    """(by, n, distinct_ids, distinct_check, quantile_check): exact numbers, and whether the sketches' answers are within
    their bounds of them: PASS or FAIL. `answers` hold one row a group, as few as the groups are."""
    exact = rows.groupBy(*by, id_column).agg(F.count(value).alias("_n")).groupBy(*by).agg(
        F.sum("_n").alias("n"), F.count(id_column).alias("distinct_ids"))
    asked = rows.join(answers.drop("n"), list(by))
    below = [F.count_if(F.col(value) < F.col(f"q{at}")).alias(f"_below{at}") for at in range(len(quantiles))]
    upto = [F.count_if(F.col(value) <= F.col(f"q{at}")).alias(f"_upto{at}") for at in range(len(quantiles))]
    ranks = asked.groupBy(*by).agg(*below, *upto)
    held = exact.join(answers.drop("n"), list(by)).join(ranks, list(by))
    close = F.abs(F.col("distinct_estimate") - F.col("distinct_ids")) <= F.greatest(F.lit(1.0), F.col("distinct_ids") * DISTINCT_BOUND)
    right = F.lit(True)
    for at, share in enumerate(quantiles):  # the wanted rank lies among the ranks of the value, give or take the bound
        slack = F.greatest(F.lit(1.0), F.col("n") * RANK_BOUND)
        right = right & (F.col(f"_below{at}") <= F.col("n") * share + slack) & (F.col(f"_upto{at}") >= F.col("n") * share - slack)
    verdict = lambda condition, name: F.when(condition, "PASS").otherwise("FAIL").alias(name)
    return held.select(*by, "n", "distinct_ids", verdict(close, "distinct_check"), verdict(right, "quantile_check"))
