"""Sets of items that occur together often, level by level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialise


def frequent_itemsets(rows: DataFrame, items: str, least: int, longest: int) -> DataFrame:
    """(itemset, support): sets of one to `longest` items that at least `least` rows hold, items in ascending order.

    Rows come down to their distinct sets of items with a count first, however many rows there are. A set is extended by
    larger items only, and only if it was frequent, so no set is made twice and none whose part is rare. NULL and repeated
    items count once or not at all.
    """
    baskets = materialise(
        rows.select(F.array_sort(F.array_distinct(F.array_compact(items))).alias("held")).where(F.size("held") > 0)
        .groupBy("held").agg(F.count(F.lit(1)).alias("n")))
    levels = []
    grown = baskets.select("held", "n", F.array().cast("array<string>").alias("itemset"))
    for _ in range(longest):
        last = F.try_element_at("itemset", F.lit(-1))
        larger = F.filter("held", lambda item: last.isNull() | (item > last))
        grown = grown.select("held", "n", "itemset", F.explode(larger).alias("item")).select(
            "held", "n", F.concat("itemset", F.array("item")).alias("itemset"))
        frequent = materialise(grown.groupBy("itemset").agg(F.sum("n").alias("support")).where(F.col("support") >= least))
        levels.append(frequent)
        grown = grown.join(frequent.select("itemset"), "itemset").select("held", "n", "itemset")
    return reduce(DataFrame.unionByName, levels)
