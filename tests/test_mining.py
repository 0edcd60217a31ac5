import itertools
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators import mining
from millrace.operators.series import with_position


def sets_of(df):
    return {tuple(r["items"]): r.freq for r in df.collect()}


def sequences_of(df):
    return {tuple(map(tuple, r.sequence)): r.freq for r in df.collect()}


def test_two_equal_baskets(spark):
    df = spark.createDataFrame([(["3", "2", "3"],), (["3", "2"],)], "b array<string>")
    model = mining.mine_baskets(df, "b", 0.2, 0.8, partitions=10)
    assert sets_of(mining.itemsets_of(model)) == {("2",): 2, ("3",): 2, ("2", "3"): 2}
    rules = {(r.antecedent[0], r.consequent[0]): r.confidence for r in mining.rules_of(model).collect()}
    assert rules == {("2", "3"): 1.0, ("3", "2"): 1.0}


def test_pairs_against_every_subset(spark):
    rng = random.Random(2)
    baskets = {b: {i for i in range(9) if rng.random() < 0.1 * i} for b in range(120)}
    baskets = {b: items for b, items in baskets.items() if items} | {500: set(range(9)), 501: {0}}
    rows = [(b, f"i{i}") for b, items in baskets.items() for i in items] * 2
    df = spark.createDataFrame(rows, "b int, i string")
    model = mining.mine_pairs(df, ["b"], "i", 0.25, 0.6)
    least = math.ceil(0.25 * len(baskets))
    want = {}
    for size in range(1, 10):
        for items in itertools.combinations(range(9), size):
            n = sum(set(items) <= basket for basket in baskets.values())
            if n >= least:
                want[tuple(f"i{i}" for i in items)] = n
    assert sets_of(mining.itemsets_of(model)) == want
    rules = {(tuple(r.antecedent), r.consequent[0]): r.confidence for r in mining.rules_of(model).collect()}
    expected = {}
    for items, n in want.items():
        for last in items:
            rest = tuple(i for i in items if i != last)
            if rest and n / want[rest] >= 0.6:
                expected[rest, last] = n / want[rest]
    assert rules == pytest.approx(expected)


def test_sequences_of_sets(spark):
    # Four sequences of item sets and their frequent sequences.
    rows = [([[1, 2], [3]],), ([[1], [3, 2], [1, 2]],), ([[1, 2], [5]],), ([[6]],)]
    df = spark.createDataFrame(rows, "s array<array<int>>")
    want = {((1,),): 3, ((2,),): 3, ((3,),): 2, ((1, 2),): 3, ((1,), (3,)): 2}
    assert sequences_of(mining.frequent_sequences(df, "s", 0.5, 5)) == want


@pytest.fixture(scope="module")
def events(spark):
    """Short groups and one long one."""
    rng = random.Random(4)
    rows = [(g, t, rng.choice("abcd")) for g in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(99, t, rng.choice("abbbcd" if t % 3 else "ab")) for t in range(200)]
    return rows, spark.createDataFrame(rows, "g int, t int, e string").repartition(5).cache()


def brute(rows, min_support, max_length):
    groups = {}
    for g, t, e in sorted(rows):
        groups.setdefault(g, []).append(e)
    least, found = math.ceil(min_support * len(groups)), {}
    for length in range(1, max_length + 1):
        for pattern in itertools.product("abcd", repeat=length):
            n = 0
            for events in groups.values():
                rest = iter(events)
                n += all(p in rest for p in pattern)
            if n >= least:
                found[pattern] = n
    return found


@pytest.mark.parametrize("bits", [2, None])
@pytest.mark.parametrize("support", [0.05, 0.3])
def test_grown_sequences(spark, events, bits, support):
    rows, df = events
    got = mining.grow_sequences(df, ["g"], ["t"], "e", support, max_length=4, bits=bits).collect()
    assert {tuple(r.sequence): r.freq for r in got} == brute(rows, support, 4)


def test_pairs_of_first_and_last_occurrences(spark, events):
    rows, df = events
    got = mining.frequent_pairs(df, ["g"], ["t"], "e", 0.05).collect()
    assert {tuple(r.sequence): r.freq for r in got} == brute(rows, 0.05, 2)


def test_tied_times_follow_the_second_column(spark):
    df = spark.createDataFrame([(1, 5, 1, "b"), (1, 5, 2, "a")], "g int, t int, n int, e string")
    found = {tuple(r.sequence) for r in mining.frequent_pairs(df, ["g"], ["t", "n"], "e", 1.0).collect()}
    assert ("b", "a") in found and ("a", "b") not in found
    found = {tuple(r.sequence) for r in mining.grow_sequences(df, ["g"], ["t", "n"], "e", 1.0).collect()}
    assert ("b", "a") in found and ("a", "b") not in found


def test_sets_by_time(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 2, "a"), (1, 2, "a"), (2, 1, "q")], "g int, t int, e string")
    got = {r.g: r.sequence for r in mining.sequences_of_sets(df, ["g"], "t", "e").collect()}
    assert got == {1: [["z"], ["a", "b"]], 2: [["q"]]}


def test_salted_item_join_gives_the_same_sets(spark, monkeypatch):
    rows = [(b, f"i{i}") for b in range(60) for i in range(5) if (b + i) % (i + 1) == 0]
    df = spark.createDataFrame(rows, "b int, i string")
    plain = sets_of(mining.itemsets_of(mining.mine_pairs(df, ["b"], "i", 0.1)))
    monkeypatch.setattr(mining, "BROADCAST_ROWS", 0)
    assert sets_of(mining.itemsets_of(mining.mine_pairs(df, ["b"], "i", 0.1))) == plain


def brute_sets(rows, min_support, max_length):
    """Every pattern of item sets that some group holds, by growing all of its sub-patterns."""
    groups = {}
    for g, t, e in rows:
        groups.setdefault(g, {}).setdefault(t, set()).add(e)
    least, found = math.ceil(min_support * len(groups)), {}
    for times in groups.values():
        held = {((),)}
        for t in sorted(times):
            subsets = [c for n in range(1, max_length + 1) for c in itertools.combinations(sorted(times[t]), n)]
            held |= {(*p, c) for p in held for c in subsets if sum(map(len, p)) + len(c) <= max_length}
        for p in held - {((),)}:
            found[p[1:]] = found.get(p[1:], 0) + 1
    return {p: n for p, n in found.items() if n >= least}


@pytest.mark.parametrize("bits", [1, None])
@pytest.mark.parametrize("support,length", [(0.1, 3), (0.3, 5)])
def test_grown_set_sequences(spark, bits, support, length):
    rng = random.Random(7)
    rows = [(g, t, rng.choice("abc")) for g in range(30) for t in range(rng.randrange(1, 4)) for _ in range(rng.randrange(1, 4))]
    rows += [(99, t, rng.choice("abcz" if t > 9 else "ab")) for t in range(14) for _ in range(2)]
    df = spark.createDataFrame(rows, "g int, t int, e string").repartition(3)
    got = mining.grow_set_sequences(df, ["g"], "t", "e", support, max_length=length, bits=bits)
    assert sequences_of(got) == brute_sets(rows, support, length)


def test_set_sequences_equal_prefixspan(spark):
    # Four sequences of item sets.
    sequences = [[[1, 2], [3]], [[1], [3, 2], [1, 2]], [[1, 2], [5]], [[6]]]
    rows = [(g, t, x) for g, s in enumerate(sequences) for t, items in enumerate(s) for x in items]
    df = spark.createDataFrame(rows, "g int, t int, x int")
    want = {((1,),): 3, ((2,),): 3, ((3,),): 2, ((1, 2),): 3, ((1,), (3,)): 2}
    assert sequences_of(mining.grow_set_sequences(df, ["g"], "t", "x", 0.5)) == want


def test_index_is_no_larger_than_the_events(spark, events):
    rows, df = events
    steps = with_position(df, ["t"], ["g"], "_idx").select("g", "_idx", F.col("e").alias("_item"), F.lit(1).alias("_size"))
    for bits in (0, 2, 5):
        index = mining.sparse_index(steps.withColumn("_stretch", F.shiftright("_idx", bits)), ["g"]).collect()
        held = [(r.g, i["_item"], x) for r in index for i in r["_items"] for x in i["_at"]]
        assert len(held) == len(set(held)) == len(rows) and len(index) <= len(rows)
        assert all(x >> bits == r["_stretch"] for r in index for i in r["_items"] for x in i["_at"])
        ends = {r.g: max(q["_stretch"] for q in index if q.g == r.g) for r in index}
        assert all(r["_more"] == (r["_stretch"] < ends[r.g]) for r in index)


def test_pairs_of_rare_items_are_never_made(spark):
    """Groups of many items that no other group has: without their pairs this takes a moment, with them minutes."""
    df = spark.range(20 * 1600).selectExpr("id div 1600 g", "id % 1600 t", "if(id % 1600 < 2, cast(id % 1600 as string), cast(id as string)) e")
    began = time.time()
    found = {tuple(r.sequence): r.freq for r in mining.frequent_pairs(df, ["g"], ["t"], "e", 0.5).collect()}
    assert found == {("0",): 20, ("1",): 20, ("0", "1"): 20} and time.time() - began < 20
