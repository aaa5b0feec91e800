"""Which rows have their key in a set, exactly, without a shuffle of the rows however large the set is.

A set within the broadcast budget is broadcast. A larger one becomes a sieve (see operators.sieve), which lets all members through
and some other keys by chance. These others are found among the keys asked for, as keys alone, and sieved in turn under
another seed, which stops them and, by chance, a few members; so it goes on, each set a fraction of the one two levels before, until
what is let through wrongly is within the budget and is broadcast itself. Only keys that a sieve let through are shuffled.

Without a budget, and for a set with more keys than a sieve has bits, it does not end so (`settled` is False): then what the last
level lets through is left to the shuffle join of `lookup`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.keys import unmatched_keys
from ledgerline.operators.lookup import lookup, measured_bytes
from ledgerline.operators.sieve import MOST_BITS, Sieve
from ledgerline.session import broadcast_budget, materialise

MOST_LEVELS = 16


class Membership:
    """The non-NULL values of `key` in `keys`, each once and written already, for rows whose keys all occur in `asked`."""

    def __init__(self, keys: DataFrame, key: str, asked: DataFrame):
        budget = broadcast_budget(keys.sparkSession)
        self._key = key
        self._asked = asked.select(key)
        self._levels: list[Sieve] = []
        self._last = keys.select(key)  # what the last level lets through wrongly, or all keys if there is no level
        before = None
        self.settled = measured_bytes(self._entries()) <= budget
        while not self.settled and 0 <= budget and len(self._levels) < MOST_LEVELS and self._last.count() <= 1 << MOST_BITS:
            level = Sieve(self._last, key, seed=len(self._levels))
            if before is None:
                wrong = unmatched_keys(level.kept(self._asked), key, self._last, key).select(key)
            else:
                wrong = level.kept(before)
            self._levels.append(level)
            before, self._last = self._last, materialise(wrong)
            self.settled = measured_bytes(self._entries()) <= budget

    def _entries(self) -> DataFrame:
        return self._last.withColumn("_last", F.lit(True))

    def marked(self, rows: DataFrame, name: str) -> DataFrame:
        """`rows` with a boolean column: whether the key is in the set; False for NULL."""
        columns = rows.columns
        passed = [f"_passed_{number}" for number in range(len(self._levels))]
        for level, column in zip(self._levels, passed):
            rows = level.marked(rows, column)
        rows = lookup(rows, self._entries(), self._key, "left", counted=self._asked)
        member = F.coalesce(F.col("_last"), F.lit(False))
        for column in reversed(passed):
            member = F.col(column) & ~member
        return rows.withColumn(name, member).select(*columns, name)

    def kept(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is in the set."""
        return self.marked(rows, "_member").where("_member").drop("_member")

    def dropped(self, rows: DataFrame) -> DataFrame:
        """The other rows."""
        return self.marked(rows, "_member").where("NOT _member").drop("_member")
