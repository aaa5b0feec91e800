"""Exact distinct counts at every level of a cube, from one pass over distinct rows.

The rows come down to distinct (dimensions, id) once, with all the counting of copies done before the shuffle. Every level
is then merged from these: where its groups hold many ids for each block of 32,768 as bitmaps, 4 KB a group and block, which
merge in the map tasks and have no further distinct; where they hold few, as distinct rows, which are smaller than a bitmap
there. Which way a level goes is decided by its measured numbers of rows and blocks and does not change the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialise

DENSE = 512  # ids a block from which a bitmap of 4 KB is smaller than the ids themselves


def levels_of(dimensions: Sequence[str], kind: str = "cube") -> list[tuple[str, ...]]:
    """The groupings of a cube or of a rollup, finest first."""
    if kind == "rollup":
        return [tuple(dimensions[:size]) for size in range(len(dimensions), -1, -1)]
    return [level for size in range(len(dimensions), -1, -1) for level in combinations(dimensions, size)]


def distinct_counts(
    rows: DataFrame, dimensions: Sequence[str], id_column: str, levels: Sequence[Sequence[str]], name: str, dense: int = DENSE,
) -> DataFrame:
    """(dimensions, level, `name`): distinct ids in each group of each level.

    `level` has a bit for each dimension, the first one highest, set where the level leaves it out, as GROUPING_ID has it;
    a dimension left out is NULL. Ids are whole numbers; NULL ids count for nothing, but their groups are there.
    """
    base = materialise(rows.select(*dimensions, F.col(id_column).cast("long").alias("_id")).distinct())
    block, bit = F.bitmap_bucket_number("_id"), F.bitmap_bit_position("_id")
    widths = [F.approx_count_distinct(F.struct(*level, block.alias("_block"))).alias(f"_{at}") for at, level in enumerate(levels)]
    sizes = base.agg(F.count(F.lit(1)).alias("rows"), *widths).first()
    merged = []
    for at, level in enumerate(levels):
        if len(level) == len(dimensions):  # distinct already
            counted = base.groupBy(*level).agg(F.count("_id").alias(name))
        elif sizes[f"_{at}"] and sizes["rows"] / sizes[f"_{at}"] >= dense:
            blocks = base.groupBy(*level, block.alias("_block")).agg(
                F.bitmap_construct_agg(bit).alias("_held"), F.count("_id").alias("_ids"))
            counted = blocks.groupBy(*level).agg(F.sum(F.when(F.col("_ids") > 0, F.bitmap_count("_held")).otherwise(0)).alias(name))
        else:
            counted = base.select(*level, "_id").distinct().groupBy(*level).agg(F.count("_id").alias(name))
        grouping = sum(1 << (len(dimensions) - 1 - place) for place, one in enumerate(dimensions) if one not in level)
        kinds = dict(base.dtypes)
        merged.append(counted.select(
            *(F.col(one) if one in level else F.lit(None).cast(kinds[one]).alias(one) for one in dimensions),
            F.lit(grouping).cast("long").alias("level"), F.col(name).cast("long").alias(name)))
    return reduce(DataFrame.unionByName, merged)
