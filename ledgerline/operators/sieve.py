"""A sieve before a shuffle: which rows may have their key in a set of keys that is too large to broadcast.

The keys' hashes become bits, at most 2^MOST_BITS of them, in rows of WORDS numbers; these are broadcast, 25 MB at most
whatever the number of keys. A row whose bit is not set has no match for certain and need not be shuffled; the others, those
with a match and a few by chance, go on to the join that decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialise

LEAST_BITS, MOST_BITS = 16, 27
BITS_A_KEY = 16
WORDS = 64  # numbers of 64 bits in a row of the sieve


class Sieve:
    """Bits for the non-NULL values of `key` in `keys`. Sieves of another `seed` let other keys through by chance."""

    def __init__(self, keys: DataFrame, key: str, seed: int = 0):
        wanted = max(1, keys.count() * BITS_A_KEY)
        self.key = key
        self._seed = seed
        self.bits = min(max(LEAST_BITS, (wanted - 1).bit_length()), MOST_BITS)
        place = keys.where(F.col(key).isNotNull()).select(self._place().alias("place"))
        words = place.groupBy(F.shiftright("place", 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("held"))
        rows = words.groupBy(F.shiftright("word", 6).alias("_sieve_row")).agg(
            F.map_from_entries(F.collect_list(F.struct((F.col("word") % WORDS).cast("int").alias("at"), "held"))).alias("held"))
        whole = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda at: F.coalesce(F.element_at("held", at), F.lit(0).cast("long")))
        self.rows = materialise(rows.select("_sieve_row", whole.alias("_sieve_words")))

    def _place(self) -> Column:
        seeded = (self.key, F.lit(self._seed)) if self._seed else (self.key,)
        return F.xxhash64(*seeded).bitwiseAND((1 << self.bits) - 1)

    def marked(self, rows: DataFrame, name: str) -> DataFrame:
        """`rows` with a boolean column: False where the key is certainly not in the set, or NULL."""
        place = rows.withColumn("_sieve_place", self._place())
        met = place.withColumn("_sieve_row", F.shiftright("_sieve_place", 12)).join(F.broadcast(self.rows), "_sieve_row", "left")
        bit = F.expr("shiftright(_sieve_words[CAST(shiftright(_sieve_place, 6) & 63 AS INT)], CAST(_sieve_place & 63 AS INT)) & 1")
        found = F.coalesce(bit == 1, F.lit(False)) & F.col(self.key).isNotNull()
        return met.withColumn(name, found).select(*rows.columns, name)

    def kept(self, rows: DataFrame) -> DataFrame:
        """The rows that may have a match."""
        return self.marked(rows, "_maybe").where("_maybe").drop("_maybe")
