"""Operators against brute force, with one key that holds a third of the rows or more."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from featuremill.operators import attribution, canonical, outcomes, relevance, rings, rows
from featuremill.operators.skew import lookup_where, salted_join


def skewed_rows(n=900, seed=7):
    """(key, day offset in minutes, kind, id): half of the rows belong to key 0."""
    rng = random.Random(seed)
    return [(0 if rng.random() < 0.5 else rng.randrange(1, 40), rng.randrange(0, 3000), rng.choice("abc"), i) for i in range(n)]


@pytest.mark.parametrize("slices", [(60, 86_400), (600, 3600), (7200, 7200), (10**9, 10**9)])
def test_last_before_equals_lag(spark, slices):
    data = skewed_rows()
    df = spark.createDataFrame(data, "k int, m int, kind string, id int").withColumn(
        "ts", F.expr("cast('2024-01-01' as timestamp_ntz) + make_dt_interval(0, 0, m)")
    )
    got = attribution.last_before(
        df, ["k"], "ts", "id", {"any": lambda r: F.lit(True), "only_a": lambda r: r["kind"] == "a"}, slices
    ).select("id", F.col("any.m").alias("m1"), F.col("only_a.m").alias("m2"))
    got = {r.id: (r.m1, r.m2) for r in got.collect()}
    expected = {}
    groups = defaultdict(list)
    for k, m, kind, i in data:
        groups[k].append((m, i, kind))
    for g in groups.values():
        g.sort()
        last = last_a = None
        for m, i, kind in g:
            expected[i] = (last, last_a)
            last = m
            if kind == "a":
                last_a = m
    assert got == expected


def test_last_before_splits_a_hot_group_and_hour(spark):
    """Half of the rows lie in one hour of one group: no task of the look-back meets more than a small part of them."""
    n = 400_000
    hot = F.col("id") % 2 == 0
    df = spark.range(n).select(
        F.when(hot, 0).otherwise(F.col("id") % 997).alias("k"), "id",
        F.expr("cast('2024-01-01' as timestamp_ntz) + make_dt_interval(0, 0, 0, cast(id % 3600 as double))").alias("ts"),
    )
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        found = attribution.last_before(df, ["k"], "ts", "id", {"prev": lambda r: F.lit(True)})
        w = Window.partitionBy("k").orderBy("ts", "id")
        want = df.select("id", F.lag("id").over(w).alias("prev"))
        assert found.where("prev is null").count() == want.where("prev is null").count() == 997
        cells = df.groupBy("k", attribution.time_slice(F.col("ts"), attribution.SLICES[0]).alias("s")).count()
        assert cells.agg(F.max("count")).first()[0] < n / 50
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_sliced_row_number_with_nulls(spark):
    data = [(None if k == 3 else k, m, i) for k, m, _, i in skewed_rows()]
    df = spark.createDataFrame(data, "k int, m int, id int")
    got = rows.sliced_row_number(df, ["k"], F.floor(F.col("m") / 100), [F.col("m"), F.col("id")], "n")
    got = {r.id: r.n for r in got.collect()}
    expected, seen = {}, Counter()
    for k, _, i in sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2])):
        seen[k] += 1
        expected[i] = seen[k]
    assert got == expected


def test_first_row_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 as k", "id")
    best = rows.first_row(df, ["k"], [F.col("id").desc()])
    assert {r.k: r.id for r in best.collect()} == {i % 7: i for i in range(1000)}
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_top_list_keeps_order(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 9), (2, "z", 1)], "k int, v string, s int")
    got = rows.top_list(df, ["k"], [F.col("s").desc(), F.col("v")], "v", 2, "top").collect()
    assert {r.k: r.top for r in got} == {1: ["c", "a"], 2: ["z"]}


def test_group_totals_equal_window(spark):
    df = spark.createDataFrame([(k, m) for k, m, _, _ in skewed_rows()], "k int, m int")
    got = rows.with_group_totals(df, ["k"], {"t": F.sum("m")}).agg(F.sum("t")).first()[0]
    totals = Counter()
    n = Counter()
    for k, m, _, _ in skewed_rows():
        totals[k] += m
        n[k] += 1
    assert got == sum(totals[k] * n[k] for k in n)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(spark, how):
    many = spark.createDataFrame([(k, i) for k, _, _, i in skewed_rows()], "k int, id int")
    few = spark.createDataFrame([(k, f"n{k}") for k in range(0, 30)], "k int, name string")
    a = sorted(map(str, salted_join(many, few, ["k"], ["id"], 8, how).select("k", "id", "name").collect()))
    b = sorted(map(str, many.join(few, "k", how).select("k", "id", "name").collect()))
    assert a == b and len(a) > 0


def test_fan_out_gives_every_pair_once(spark):
    members = spark.createDataFrame([("g", f"q{i}") for i in range(20)] + [("h", "q99")], "group_key string, query string")
    features = spark.createDataFrame([("g", i, i * 1.0) for i in range(50)] + [("h", 1, 2.0)], "group_key string, item int, x double")
    out = canonical.fan_out(members, features, "group_key", ["item"], 8)
    assert out.count() == 20 * 50 + 1
    assert out.select("query", "item").distinct().count() == 20 * 50 + 1


def test_key_map_takes_the_least_id(spark):
    d = spark.createDataFrame([("A  b", "z", "v1"), ("a b", "Y", "v1"), ("a b", "x", "v0"), (" ", "q", "v1")], "query_text string, query_id string, version string")
    assert [tuple(r) for r in canonical.query_key_map(d, "v1").collect()] == [("a b", "y")]


def test_streaks(spark):
    rng = random.Random(3)
    data = [(k, t, i, int(rng.random() < 0.4)) for i, (k, t, _, _) in enumerate(skewed_rows(400, 5))]
    data += [(500, 1, 9001, 1), (500, 2, 9002, 1), (501, 1, 9003, 0)]
    df = spark.createDataFrame(data, "k int, t int, id int, bad int")
    got = {r.k: (r.last_outcome, r.streak_len) for r in outcomes.current_streak(df, ["k"], ["t", "id"], "bad").collect()}
    groups = defaultdict(list)
    for k, t, i, bad in data:
        groups[k].append((t, i, bad))
    expected = {}
    for k, g in groups.items():
        g.sort(reverse=True)
        n = 0
        while n < len(g) and g[n][2] == g[0][2]:
            n += 1
        expected[k] = (g[0][2], n)
    assert got == expected


def test_medians(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    row = df.agg(outcomes.lower_median(F.col("x")).alias("lo"), outcomes.upper_median(F.col("x")).alias("hi")).first()
    assert (row.lo, row.hi) == (2.0, 3.0)


def test_ring_sums_do_not_shrink(spark):
    from featuremill.functions import hexgrid

    cells = spark.range(60).select(hexgrid.pack(F.col("id") % 8, F.expr("id div 8")).alias("c"), F.lit(1).alias("x"))
    out = rings.ring_sums(cells, "c", {"x": "x{r}"}, range(6)).collect()
    assert all(r.x0 <= r.x1 <= r.x2 <= r.x3 <= r.x4 <= r.x5 for r in out)
    assert sum(r.x0 for r in out) == 60
    assert sum(r.x5 for r in out) == 60 * 91


def test_bm25_against_formula(spark):
    import math

    docs = {1: "red small ring", 2: "red red bolt", 3: "blue bolt"}
    corpus = spark.createDataFrame([(k, v) for k, v in docs.items()], "item int, title string")
    pairs = spark.createDataFrame([("Red bolt", 1), ("Red bolt", 2), ("Red bolt", 3)], "query string, item int")
    got = {(r["item"], r.term): r.score for r in relevance.field_scores(corpus, pairs, "item", ["title"]).collect()}
    avg = 8 / 3
    expected = {}
    for i, t in docs.items():
        words = t.split()
        for term in ("red", "bolt"):
            f = words.count(term)
            if f:
                df = sum(term in d.split() for d in docs.values())
                idf = math.log(1 + (3 - df + 0.5) / (df + 0.5))
                expected[(i, term)] = idf * f / (f + 1.2 * (0.5 + 0.5 * len(words) / avg))
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(v) for k, v in expected.items())


def test_lookup_where_only_where_needed(spark):
    many = spark.createDataFrame([(1, None, 5), (2, 9, 5), (3, None, None), (4, None, 6), (5, None, 5)], "id int, own int, key bigint")
    dim = spark.createDataFrame([(5, 50), (7, 70)], "key bigint, mapped int")
    out = lookup_where(many, dim, "key", F.col("own").isNull(), ["id"])
    assert sorted((r.id, r.mapped) for r in out.collect()) == [(1, 50), (2, None), (3, None), (4, None), (5, 50)]


def test_lookup_where_spreads_rows_without_a_key(spark):
    many = spark.range(4000).select("id", F.lit(None).cast("bigint").alias("key"))
    dim = spark.createDataFrame([(5, 50)], "key bigint, mapped int")
    for conf in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(conf, "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r.n for r in lookup_where(many, dim, "key", F.lit(True), ["id"]).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        for conf in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled"):
            spark.conf.unset(conf)
    assert len(sizes) == 8 and max(sizes) < 2 * 4000 / 8
