"""As-of look-ups, running totals, sessions, span joins, differences, rankings, cubes and itemsets against brute force,
with keys cut into few and into many slices."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import cubes, intervals
from ledgerline.operators.differences import changed_rows, multiset_difference
from ledgerline.operators.itemsets import frequent_itemsets
from ledgerline.operators.ordered import Slices, as_of, cut_points, running_totals, sessions
from ledgerline.operators.ranking import best_of_groups
from ledgerline.plans import allotment, timeline
from ledgerline.workspace import lake_over
from tests.conftest import SMALL

BEGIN = datetime(2024, 1, 1)
FLOORS = [1_000_000, 100, 16]


def minutes(count):
    return BEGIN + timedelta(minutes=count)


@pytest.fixture(scope="module")
def moves():
    """Half of the rows belong to one key, a tenth of them to one moment; some have no key or no moment."""
    chance = random.Random(1)
    return [(at, chance.choice([1, 1, 1, 2, 3, None]),
             None if chance.random() < 0.02 else minutes(5 if chance.random() < 0.1 else chance.randrange(3_000)), chance.randrange(9_999) / 100)
            for at in range(1_500)]


@pytest.fixture(scope="module")
def states():
    chance = random.Random(2)
    return [(chance.choice([1, 1, 2, 4, None]), None if chance.random() < 0.02 else minutes(chance.randrange(3_000)), chance.choice("abc"),
             chance.choice([None, 1, 2])) for _ in range(300)]


def frame(spark, moves):
    return spark.createDataFrame(moves, "id long, k long, at timestamp_ntz, v double").repartition(3)


@pytest.mark.parametrize("floor", FLOORS)
def test_as_of(spark, moves, states, floor):
    rank = lambda state: (state[1], state[2], state[3] is not None, state[3] or 0)
    wanted = Counter()
    for row in moves:
        before = [state for state in states if row[1] is not None and state[0] == row[1] and row[2] and state[1] and state[1] <= row[2]]
        wanted[(*row, *(max(before, key=rank)[1:] if before else (None, None, None)))] += 1
    told = spark.createDataFrame(states, "k long, since timestamp_ntz, s string, n long")
    found = as_of(frame(spark, moves), told, "k", "at", "since", ["s", "n"], floor=floor)
    assert found.columns == ["id", "k", "at", "v", "since", "s", "n"]
    assert Counter(map(tuple, found.collect())) == wanted


def test_as_of_without_states_or_rows(spark, moves):
    told = spark.createDataFrame([], "k long, since timestamp_ntz, s string")
    rows = frame(spark, moves)
    assert as_of(rows, told, "k", "at", "since", ["s"]).where("s IS NULL AND since IS NULL").count() == len(moves)
    assert as_of(rows.limit(0), told, "k", "at", "since", ["s"]).count() == 0


@pytest.mark.parametrize("floor", FLOORS)
def test_running_totals(spark, moves, floor):
    found = running_totals(frame(spark, moves), "k", ["at"], {"n": "1", "cents": "CAST(rint(v * 100) AS BIGINT)"}, floor=floor)
    got = {row.id: (row.n, row.cents) for row in found.collect()}
    for at, key, moment, _ in moves:
        upto = [row for row in moves if row[1] == key and (row[2] is None or moment is not None and row[2] <= moment)]
        assert got[at] == ((None, None) if key is None else (len(upto), sum(round(row[3] * 100) for row in upto)))


@pytest.mark.parametrize("floor", FLOORS)
def test_sessions(spark, moves, floor):
    wanted = {}
    for key in (1, 2, 3):
        number, last = 0, None
        for row in sorted((row for row in moves if row[1] == key and row[2]), key=lambda row: (row[2], row[0])):
            number += last is None or row[2] - last > timedelta(minutes=6)
            last = row[2]
            wanted[row[0]] = number
    found = sessions(frame(spark, moves), "k", "at", "6 MINUTES", tie=["id"], floor=floor)
    assert {row.id: row.session for row in found.collect()} == wanted and max(wanted.values()) > 50


def test_large_keys_are_cut_evenly(spark, moves):
    """No slice holds more than a few times the floor, and equal places stay together."""
    places = frame(spark, moves).where("k IS NOT NULL AND at IS NOT NULL").select("k", F.struct("at", "id").alias("place"))
    slices = Slices(places, "k", 60)
    dealt = slices.dealt(places, F.lit(0))
    sizes = [row["count"] for row in dealt.groupBy("k", "_slice").count().collect()]
    assert len(sizes) > 12 and max(sizes) <= 4 * 60
    numbers = sorted((row.place, row._slice) for row in dealt.where("k = 1").collect())
    assert [number for _, number in numbers] == sorted(number for _, number in numbers)
    assert cut_points(places, "k", 1_000_000).isEmpty()


def test_as_of_is_one_window_where_no_key_is_large(spark):
    """One shuffle of the transactions, and no window over a whole table."""
    plan = timeline.transactions_with_state(lake_over(spark, SMALL).silver)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Exchange SinglePartition" not in plan


# Spans


def touch(a, b):
    (s, e), (f, g) = a, b
    if s is None or f is None:
        return False
    e, g = (10**15 if end is None else end for end in (e, g))
    return s <= e and f <= g and max(s, f) <= min(e, g)


@pytest.fixture(scope="module")
def spans():
    chance = random.Random(3)

    def span():
        start = None if chance.random() < 0.03 else chance.randrange(-5_000, 5_000)
        return start, None if chance.random() < 0.05 else (start or 0) + chance.choice([0, 0, -3, 5, 100, 3_000, chance.randrange(2_000)])

    return ([(at, chance.choice([1, 1, 1, 2, None]), *span()) for at in range(300)],
            [(at, chance.choice([1, 1, 2, 3]), *span()) for at in range(200)])


@pytest.mark.parametrize("floor", [1_000_000, 25])
@pytest.mark.parametrize("width", [1, 10, 100_000])
def test_overlapping(spark, spans, floor, width):
    left = spark.createDataFrame(spans[0], "a long, k long, s long, e long").repartition(3)
    right = spark.createDataFrame(spans[1], "b long, k long, f long, g long").repartition(2)
    wanted = Counter((x[0], y[0]) for x in spans[0] for y in spans[1] if x[1] is not None and x[1] == y[1] and touch(x[2:], y[2:]))
    found = intervals.overlapping(left, right, ("s", "e"), ("f", "g"), keys=["k"], width=width, floor=floor)
    assert Counter((row.a, row.b) for row in found.collect()) == wanted and found.columns == ["k", "a", "s", "e", "b", "f", "g"]
    wanted = Counter((x[0], y[0]) for x in spans[0] for y in spans[1] if touch(x[2:], y[2:]))
    found = intervals.overlapping(left.drop("k"), right.drop("k"), ("s", "e"), ("f", "g"), width=width, floor=floor)
    assert Counter((row.a, row.b) for row in found.collect()) == wanted
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_overlapping_of_nothing(spark, spans):
    left = spark.createDataFrame(spans[0], "a long, k long, s long, e long")
    right = spark.createDataFrame([], "b long, k long, f long, g long")
    found = intervals.overlapping(left, right, ("s", "e"), ("f", "g"), keys=["k"])
    assert found.count() == 0 and found.columns == ["k", "a", "s", "e", "b", "f", "g"]
    with pytest.raises(ValueError):
        intervals.overlapping(left, left, ("s", "e"), ("s", "e"), keys=["k"])


def test_spread_join_of_hot_keys(spark):
    """A key with most rows on both sides gives every pair once."""
    left = spark.range(300).selectExpr("id AS a", "if(id < 250, 7, id) AS k")
    right = spark.range(200).selectExpr("id AS b", "if(id < 150, 7, id) AS k")
    found = intervals.spread_join(left, right, "k", floor=40)
    assert found.where("k = 7").count() == found.where("k = 7").distinct().count() == 250 * 150
    assert found.where("k <> 7").count() == 0 and intervals.spread_join(left, right, "k", floor=40).columns == ["k", "a", "b"]


def test_span_joins_broadcast_neither_side(spark):
    """What is exploded into bins looks small to the optimizer, so its estimates must not decide."""
    left, right = (spark.range(300).selectExpr(f"id AS {name}", "id % 7 AS k") for name in "ab")
    for floor in (10_000, 20):
        plan = intervals.spread_join(left, right, "k", floor)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.split("Join Inner", 1)[1].splitlines()[0].count("merge") == 1, plan


def test_allotment_of_ranges_end_to_end(spark):
    """Against brute force, where ranges begin and end together, and without a broadcast of instalments."""
    rows = spark.createDataFrame([(k, float(100 * k), 0.0, 4 * k) for k in range(1, 6)],
                                 "loan_id long, principal_amount double, interest_rate double, term_months long")
    loans = rows.withColumn("created_at", F.lit(BEGIN))
    paid = [(k, 10 * k + n, BEGIN + timedelta(days=n), amount) for k in (1, 2, 4, 9)
            for n, amount in enumerate([25.0, 12.5, 12.5, 60.01, 300.0])]
    payments = spark.createDataFrame(paid, "loan_id long, payment_id long, payment_date timestamp, amount double")
    tables = {"loans": loans, "loan_payments": payments.withColumn("status", F.lit("PAID"))}
    wanted = Counter()
    for k in (1, 2, 4):
        due = [(number, 2500 * (number - 1) + 1, 2500 * number) for number in range(1, 4 * k + 1)]
        until = 0
        for _, payment, _, amount in (one for one in paid if one[0] == k):
            begin, until = until + 1, until + round(amount * 100)
            wanted += Counter((k, number, payment, min(until, high) - max(begin, low) + 1)
                              for number, low, high in due if low <= until and begin <= high)
    found = allotment.allotted(tables.__getitem__)
    assert Counter(map(tuple, found.collect())) == wanted
    assert "BroadcastNestedLoopJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_allotment_with_large_loans(spark):
    """The same allotment when a loan's payments are cut into slices."""
    silver = lake_over(spark, SMALL).silver
    whole = Counter(map(tuple, allotment.allotted(silver).collect()))
    assert whole == Counter(map(tuple, allotment.allotted(silver, floor=16).collect())) and whole


# Differences


def test_multiset_difference(spark):
    chance = random.Random(4)
    pick = lambda: (chance.choice([1, None]), chance.choice([1, None, 2]), chance.choice([0.0, -0.0, float("nan"), None, 1.5]))
    plain = lambda row: (row[0], row[1], "nan" if row[2] != row[2] else None if row[2] is None else row[2] + 0.0)
    left, right = [pick() for _ in range(80)], [pick() for _ in range(70)]
    wanted = Counter(map(plain, left))
    wanted.subtract(Counter(map(plain, right)))
    schema = "x long, y long, z double"
    found = multiset_difference(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)).collect()
    assert {plain((row.x, row.y, row.z)): row.difference for row in found} == {row: n for row, n in wanted.items() if n}
    with pytest.raises(ValueError):
        multiset_difference(spark.createDataFrame(left, schema), spark.createDataFrame([(1, "a", 1.0)], "x long, y string, z double"))


def test_equal_tables_are_not_shuffled_in_full(spark):
    """Rows meet as hashes; in full they are only grouped after the look-up of unequal hashes."""
    rows = spark.read.parquet(f"{SMALL}/orders.parquet")
    found = multiset_difference(rows, rows.repartition(3))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 0 and "BroadcastHashJoin" in plan


def test_changed_rows(spark):
    schema = "k long, a long, b string"
    left = spark.createDataFrame([(1, 1, "x"), (2, 2, None), (3, 3, "z"), (4, 4, "q"), (4, 4, "q"), (5, 5, "same")], schema)
    right = spark.createDataFrame([(1, 1, "x"), (2, 9, "y"), (4, 4, "q"), (5, 5, "same"), (6, 6, "n"), (7, 1, "a"), (7, 2, "a")], schema)
    found = {row.k: (row.status, row.changed) for row in changed_rows(left, right, ["k"]).collect()}
    assert found == {2: ("changed", "a,b"), 3: ("only_left", None), 4: ("only_left", None), 6: ("only_right", None), 7: ("repeated", None)}


# Ranking, levels, itemsets


@pytest.mark.parametrize("count", [3, 1_500])
def test_best_of_groups(spark, count):
    rows = spark.range(6_000).selectExpr("id", "id % 2 AS g", "pmod(xxhash64(id), 1000) AS score")
    wanted = defaultdict(list)
    for row in sorted(rows.collect(), key=lambda row: (-row.score, row.id)):
        wanted[row.g].append(row.id)
    best = best_of_groups(rows, ["g"], [F.desc("score"), F.asc("id")], count)
    assert {(row.g, row.rank, row.id) for row in best.collect()} == {
        (g, rank, one) for g, ids in wanted.items() for rank, one in enumerate(ids[:count], start=1)}
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan if count <= 1_000 else plan.count("Window [") >= 2


@pytest.mark.parametrize("dense", [0, 3, 10**9])
def test_distinct_counts_at_all_levels(spark, dense):
    chance = random.Random(6)
    rows = [(chance.choice([1, 2, None]), chance.choice("ab"), chance.choice([None, *range(0, 200_000, 9_973)])) for _ in range(600)]
    table = spark.createDataFrame(rows, "m long, s string, id long").repartition(3)
    found = Counter(map(tuple, cubes.distinct_counts(table, ["m", "s"], "id", cubes.levels_of(["m", "s"]), "ids", dense).collect()))
    wanted = Counter()
    for level, keep in ((0, (0, 1)), (1, (0,)), (2, (1,)), (3, ())):
        groups = defaultdict(set)
        for row in rows:
            groups[tuple(row[at] if at in keep else None for at in (0, 1))].add(row[2])
        wanted.update((*group, level, len(ids - {None})) for group, ids in groups.items())
    assert found == wanted


def test_levels():
    assert cubes.levels_of("ab") == [("a", "b"), ("a",), ("b",), ()]
    assert cubes.levels_of("abc", "rollup") == [("a", "b", "c"), ("a", "b"), ("a",), ()]


def test_frequent_itemsets(spark):
    chance = random.Random(7)
    baskets = [[one for one in "abcde" if chance.random() < 0.4] + (["a"] if chance.random() < 0.3 else []) for _ in range(200)] + [None, [None, "e"]]
    found = {tuple(row.itemset): row.support for row in frequent_itemsets(
        spark.createDataFrame([(held,) for held in baskets], "held array<string>"), "held", 20, 3).collect()}
    counts = Counter(group for held in baskets if held for size in (1, 2, 3) for group in combinations(sorted(set(held) - {None}), size))
    assert found == {group: n for group, n in counts.items() if n >= 20}
