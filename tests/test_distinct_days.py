"""Distinct counts over days from bitmaps, against sets of ids."""

import random
from datetime import date, timedelta

from featuremill.operators import distinct_days as dd

START = date(2024, 1, 1)


def rows():
    rng = random.Random(3)
    made = [(START + timedelta(days=rng.randrange(20)), rng.choice("ab"), f"u{int(rng.expovariate(1 / 300))}") for _ in range(6000)]
    # One key has more ids than a bucket holds.
    made += [(START + timedelta(days=n % 3), "big", f"id{n}") for n in range(70_000)]
    return [*made, *made[:500], (START, "a", None), (START, None, "u1"), (None, "a", "u2")]


def test_windows_from_daily_bitmaps_alone(spark, tmp_path):
    data = rows()
    df = spark.createDataFrame(data, "date date, k string, id string")
    df.write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    known = spark.createDataFrame([], "id string, number bigint")
    # The dictionary grows day by day; numbers stay and are dense.
    for n in (1, 2, 20):
        until = START + timedelta(days=n)
        seen = df.where((df["date"] < until) | df["date"].isNull())
        held = {r.id: r.number for r in known.collect()}
        path = str(tmp_path / f"numbers{n}")
        known.unionByName(dd.new_numbers(seen, known)).write.parquet(path)
        known = spark.read.parquet(path)
        now = {r.id: r.number for r in known.collect()}
        assert held.items() <= now.items() and sorted(now.values()) == list(range(len(now)))
    dd.daily_bitmaps(df, known, ["k"]).write.parquet(str(tmp_path / "daily"))
    daily = spark.read.parquet(str(tmp_path / "daily"))
    assert daily.where("k = 'big'").select("bucket").distinct().count() >= 3
    for a, b in ((0, 14), (3, 4), (0, 1), (0, 20), (19, 40)):
        lo, hi = START + timedelta(days=a), START + timedelta(days=b)
        want: dict[str | None, set] = {}
        for on, k, x in data:
            if on is not None and lo <= on < hi and x is not None:
                want.setdefault(k, set()).add(x)
        made = {r.k: r.n for r in dd.distinct_over(daily, ["k"], lo, hi).collect()}
        assert made == {k: len(x) for k, x in want.items()}


def test_nothing_new(spark):
    known = spark.createDataFrame([("a", 0), ("b", 1)], "id string, number bigint")
    assert dd.new_numbers(spark.createDataFrame([("b",), (None,)], "id string"), known).collect() == []
    assert [tuple(r) for r in dd.new_numbers(spark.createDataFrame([("c",), ("c",)], "id string"), known).collect()] == [("c", 2)]
    assert dd.distinct_over(spark.createDataFrame([], "date date, k string, bucket bigint, bits binary"), ["k"], START, START).collect() == []


def test_a_few_ids_take_little_room(spark):
    """Ids far apart make a bitmap each: it must not be much larger than the id."""
    ids = [(START, "a", f"u{n}", n * 40_000) for n in range(50)] + [(START, "b", "u0", 0), (START, "b", "last", 63), (START, "b", "next", 64)]
    df = spark.createDataFrame([r[:3] for r in ids], "date date, k string, id string")
    numbers = spark.createDataFrame(list({r[2]: r[2:] for r in ids}.values()), "id string, number bigint")
    daily = dd.daily_bitmaps(df, numbers, ["k"])
    room = [len(r.bits) if isinstance(r.bits, bytearray) else 8 for r in daily.collect()]
    assert len(room) == 52 and sum(room) <= 1000
    made = {r.k: r.n for r in dd.distinct_over(daily, ["k"], START, START + timedelta(days=1)).collect()}
    assert made == {"a": 50, "b": 3}


def test_older_bitmaps_can_be_counted(spark):
    one = bytearray(4096)
    one[0] = 5
    daily = spark.createDataFrame([(START, "a", 1, one), (START, "a", 2, one)], "date date, k string, bucket bigint, bits binary")
    assert [tuple(r) for r in dd.distinct_over(daily, ["k"], START, START + timedelta(days=1)).collect()] == [("a", 4)]
