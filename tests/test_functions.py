import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from featuremill.functions import dates, hexgrid, ratios, text
from featuremill.functions.dates import Bound
from featuremill.functions.jsonpaths import double_array_or_nulls, text_array, unquoted


def one(spark, *columns):
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return list(row)


def test_ratios_never_raise(spark):
    lit = F.lit
    assert one(
        spark, ratios.ratio(lit(1), lit(0)), ratios.ratio_or_zero(lit(1), lit(0)), ratios.ratio(lit(None), lit(2)),
        ratios.ratio_or_zero(lit(1), lit(None)), ratios.ratio_if_positive(lit(1), lit(-2)), ratios.ratio(lit(1), lit(4)),
    ) == [None, 0.0, None, 0.0, None, 0.25]


def test_smoothing(spark):
    lit = F.lit
    got = one(
        spark, ratios.beta_smoothed(lit(1), lit(9), 1.0, 1.0), ratios.prior_mean_smoothed(lit(10), lit(50), 2.0, 50.0),
        ratios.parent_smoothed(lit(1), lit(0), lit(0.5), 100.0), ratios.parent_smoothed(lit(1), lit(1), lit(None).cast("double"), 100.0),
        ratios.shrunk_rate(lit(None).cast("double"), lit(10), lit(0.4), 30), ratios.ratio_eps(lit(1), lit(0)),
    )
    assert got[0] == pytest.approx(2 / 11) and got[1] == pytest.approx(1.1) and got[2] == pytest.approx(0.51)
    assert got[3] is None and got[4] == pytest.approx(0.4) and got[5] == pytest.approx(1e5)


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2026-03-01T00:00:00+00:00", date(2026, 3, 1)),
        ("2026-03-01T00:00:00Z", date(2026, 3, 1)),
        ("2026-03-01 00:00:00", date(2026, 3, 1)),
        ("2026-03-01", date(2026, 3, 1)),
        ("2026-03-01T02:00:00+05:00", date(2026, 2, 28)),
        ("2026-03-01T00:00:00.123456+00:00", date(2026, 3, 1)),
    ],
)
def test_partition_dates(value, expected):
    assert dates.parse_partition_date(value) == expected


@pytest.mark.parametrize("value", ["", "yesterday", "2026-13-01", None])
def test_bad_partition_dates(value):
    with pytest.raises(ValueError, match="unsupported partition timestamp"):
        dates.parse_partition_date(value)


def test_business_day(spark):
    assert dates.utc_midnight(date(2024, 2, 1)) == datetime(2024, 1, 31, 19)
    late = F.lit("2024-01-31 19:00:00").cast("timestamp_ntz")
    early = F.lit("2024-01-31 18:59:59").cast("timestamp_ntz")
    assert one(spark, dates.business_date(late), dates.business_date(early)) == [date(2024, 2, 1), date(2024, 1, 31)]


def test_window_bounds(spark):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-20')) as date")
    as_of = date(2024, 1, 15)
    expected = {
        Bound.HALF_OPEN: (date(2024, 1, 12), date(2024, 1, 14)),
        Bound.CLOSED: (date(2024, 1, 12), date(2024, 1, 15)),
        Bound.UP_TO: (date(2024, 1, 13), date(2024, 1, 15)),
    }
    for bound, (lo, hi) in expected.items():
        got = days.where(dates.in_window(F.col("date"), as_of, 3, bound)).agg(F.min("date"), F.max("date")).first()
        assert tuple(got) == (lo, hi)


def test_trailing_sums_grow_with_the_window(spark):
    df = spark.sql("select 1 as k, explode(sequence(date'2024-01-01', date'2024-03-31')) as date, 1 as x")
    row = df.groupBy("k").agg(*dates.trailing_sums({"x": "x_{w}"}, (1, 7, 30), date(2024, 2, 10), Bound.HALF_OPEN)).first()
    assert (row.x_1, row.x_7, row.x_30) == (1.0, 7.0, 30.0)


def test_text(spark):
    q = lambda s: text.normalise_query(F.lit(s))
    assert one(spark, q("  Чёрный \t Кот  "), q("A  B"), q(" "), text.non_blank(F.lit(" `x` ")), text.non_blank(F.lit("  "))) == [
        "черный кот", "a b", "", "'x'", None,
    ]


def test_canonical_key_ignores_word_order(spark):
    key = lambda s, words=(): text.canonical_query_key(F.lit(s), words)
    assert one(spark, key("красные кроссовки бег"), key("Бег  кроссовки красные")) == ["бег красные кроссовки"] * 2
    # A longer phrase wins over its prefix; only whole words go; repeated words stay.
    assert one(
        spark, key("aksiya tavarlar telefon", ["aksiya", "aksiya tavarlar"]), key("sale", ["sale"]), key("salesman a", ["sale"]), key("b a b"),
    ) == ["telefon", None, "a salesman", "a b b"]


def test_stop_words_with_special_characters(spark):
    assert one(spark, text.strip_stop_words(F.lit("50% c++ off"), ["50%"]))[0].startswith("50%")  # no word edge after %
    assert text.stop_word_regex([" ", ""]) is None


def test_json_arrays(spark):
    j = F.lit('{"a": [1.5, 2], "s": "0.5", "n": 0.25}')
    got = one(
        spark, double_array_or_nulls(j, "$.a", F.array(F.lit(1), F.lit(2))), double_array_or_nulls(j, "$.zz", F.array(F.lit(1), F.lit(2))),
        text_array(F.get_json_object(j, "$.s")), unquoted(F.get_json_object(j, "$.s")), unquoted(F.lit("x")),
    )
    assert got == [[1.5, 2.0], [None, None], None, "0.5", "x"]


def test_hex_rings():
    counts = {}
    for _, _, ring in hexgrid.ring_offsets(5):
        counts[ring] = counts.get(ring, 0) + 1
    assert counts == {0: 1, 1: 6, 2: 12, 3: 18, 4: 24, 5: 30}


def test_hex_cell_round_trip(spark):
    cells = spark.sql("select q, r from (select explode(sequence(-40, 40, 7)) as q) cross join (select explode(sequence(-33, 33, 5)) as r)")
    packed = cells.withColumn("c", hexgrid.pack(F.col("q"), F.col("r")))
    back = packed.select(
        "q", "r", "c", hexgrid.axial_q(F.col("c")).alias("q2"), hexgrid.axial_r(F.col("c")).alias("r2"),
        hexgrid.cell_of(hexgrid.centre_lat(F.col("c")), hexgrid.centre_lon(F.col("c"))).alias("c2"),
    )
    assert back.where("q <> q2 or r <> r2 or c <> c2").count() == 0


def test_hex_neighbours_are_nearest(spark):
    """Centres at ring 1 are one edge-to-edge step away, for any cell."""
    a = hexgrid.pack(F.lit(3), F.lit(-2))
    for dq, dr, ring in hexgrid.ring_offsets(1):
        b = hexgrid.pack(F.lit(3 + dq), F.lit(-2 + dr))
        d, k = one(
            spark,
            hexgrid.distance_m(hexgrid.centre_lat(a), hexgrid.centre_lon(a), hexgrid.centre_lat(b), hexgrid.centre_lon(b)),
            hexgrid.ring_distance(a, b),
        )
        assert k == ring
        assert d == pytest.approx(ring * hexgrid.LEVEL9_EDGE_M * math.sqrt(3), rel=1e-3, abs=1e-6)
