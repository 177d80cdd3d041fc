"""The public grid: known ids, exhaustive round trips, rings against steps, and the tables made on it."""

import math
import random

import pytest
from featuremill.functions import geogrid as g
from featuremill.operators.grids import PublicGrid
from pyspark.sql import functions as F

# Published examples of public cell ids: (lat, lon, level, id).
KNOWN = [
    (37.775938728915946, -122.41795063018799, 9, 0x8928308280FFFFF),
    (37.3615593, -122.0553238, 5, 0x85283473FFFFFFF),
    (37.3615593, -122.0553238, 7, 0x87283472BFFFFFF),
    (40.689167, -74.044444, 10, 0x8A2A1072B59FFFF),
    (55.71290588, 37.79506683, 15, 644325524701193974),
]


def test_known_cells_and_their_parents(spark):
    for lat, lon, level, cell in KNOWN:
        point = spark.createDataFrame([(lat, lon)], "lat double, lon double")
        coarser = [n for n in (level - 1, level - 3) if n >= 0]
        made = g.with_cells(point, F.col("lat"), F.col("lon"), {"c": level}).select("c", *[g.parent_cell(F.col("c"), n).alias(f"p{n}") for n in coarser]).first()
        assert made.c == cell
        # The digits of a parent begin those of the cell.
        for n in coarser:
            assert made[f"p{n}"] >> 3 * (15 - n) & (1 << 45 + 7 - 3 * (15 - n)) - 1 == cell >> 3 * (15 - n) & (1 << 45 + 7 - 3 * (15 - n)) - 1
    cells = spark.createDataFrame([(0x8928308280FFFFF,), (599405990164561919,), (None,)], "c long")
    made = cells.select(g.cell_text(F.col("c")), g.parent_cell(F.col("c"), 3), g.level_of(F.col("c"))).collect()
    assert made[0][0] == "8928308280fffff" and made[1][1] == 590398848891879423 and made[0][2] == 9 and tuple(made[2]) == (None, None, None)


def test_known_centre_and_rings(spark):
    cell = g.with_places(spark.createDataFrame([(644325524701193974,)], "c long"), "c", "p", 15).select(g.centre(F.col("p"), 15)).first()[0]
    assert (cell.lat, cell.lon) == pytest.approx((55.712902431456676, 37.79506616830255), abs=1e-12)
    # Published neighbourhoods of one step, at levels 15 and 3.
    for level, source, want in (
        (15, 644325529233966508, [644325529233966508, 644325529233966497, 644325529233966510, 644325529233966504, 644325529233966509, 644325529233966355, 644325529233966354]),
        (3, 590080540275638271, [590080540275638271, 590080815153545215, 590080471556161535, 590080677714591743, 590077585338138623, 590077447899185151, 590079509483487231]),
    ):
        grid = PublicGrid(level)
        df = spark.createDataFrame([(source, source)], "c long, s long")
        made = grid.outer(grid.scatter(grid.inner(df, "c"), "c", 1, "n", "ring"), "n").collect()
        assert sorted(r.n for r in made) == sorted(want)
        assert {r.n for r in made if r.ring == 0} == {source}


def every_cell(level):
    """All ids of a level, by their digits."""
    made = g.shape()
    for base in range(122):
        tails = [[]]
        for _ in range(level):
            tails = [t + [d] for t in tails for d in range(7)]
        for digits in tails:
            if base in made.pentagons and next((d for d in digits if d), 0) == g.K:
                continue
            yield (1 << 59) + (level << 52) + (base << 45) + sum(d << 3 * (15 - r) for r, d in enumerate(digits, 1)) + 8 ** (15 - level) - 1


@pytest.fixture(scope="module")
def level2(spark, tmp_path_factory):
    cells = [(c,) for c in every_cell(2)]
    assert len(cells) == 2 + 120 * 7**2
    base = str(tmp_path_factory.mktemp("cells"))
    g.with_places(spark.createDataFrame(cells, "c long"), "c", "p", 2).withColumn("m", g.centre(F.col("p"), 2)).write.parquet(f"{base}/x")
    return spark.read.parquet(f"{base}/x")


def test_all_cells_round_trip(spark, level2):
    back = g.with_ids(level2, "p", "same", 2).select("c", "same").collect()
    assert len(back) == 5882 and all(r.same == r.c for r in back)
    placed = g.with_cells(level2, F.col("m.lat"), F.col("m.lon"), {"same": 2}).select("c", "same").collect()
    assert len(placed) == 5882 and all(r.same == r.c for r in placed)
    assert level2.select("p").distinct().count() == 5882


def test_base_cells_are_in_order_and_apart():
    made = g.shape()
    centres = [made.point(f, *ij) for f, ij in made.homes]
    assert len(made.corners) == 12 and len(made.pentagons) == 12 and len(centres) == 122
    assert all(a[2] >= b[2] - 1e-9 for a, b in zip(centres, centres[1:], strict=False))
    assert min(math.dist(a, b) for i, a in enumerate(centres) for b in centres[:i]) > 0.28


def test_neighbours_against_the_nearest_middles(spark, level2):
    """A neighbour has its middle near: compared with the five or six nearest of all middles."""
    steps = {r.c: set(r.n) for r in level2.select("c", g.neighbours(F.col("p"), 2).alias("n")).collect()}
    place = {r.c: r.p for r in level2.collect()}
    middle = {r.c: g._sphere(math.radians(r.m.lat), math.radians(r.m.lon)) for r in level2.collect()}
    pentagons = {c for c in steps if len(steps[c]) == 5}
    assert len(pentagons) == 12 and all(len(n) == 6 for c, n in steps.items() if c not in pentagons)
    rng = random.Random(5)
    for c in [*pentagons, *rng.sample(sorted(steps), 60)]:
        nearest = sorted(middle, key=lambda x, c=c: math.dist(middle[x], middle[c]))[1 : 1 + len(steps[c])]
        assert {place[x] for x in nearest} == steps[c]


def test_rings_are_steps_everywhere(spark, level2):
    grid = PublicGrid(2)
    source = level2.select(F.col("p").alias("s"), F.col("p").alias("c"))
    made = grid.scatter(source, "c", 2, "n", "ring").collect()
    steps = {r.p: set(r.n) for r in level2.select("p", g.neighbours(F.col("p"), 2).alias("n")).collect()}
    found = {}
    for r in made:
        assert found.setdefault((r.s, r.n), r.ring) == r.ring
    assert len(found) == len(made)
    for s in steps:
        one = steps[s]
        two = set().union(*(steps[x] for x in one)) - one - {s}
        assert found[s, s] == 0 and all(found[s, n] == 1 for n in one) and all(found[s, n] == 2 for n in two)
    assert len(made) == sum(1 + len(steps[s]) + len(set().union(*(steps[x] for x in steps[s])) - steps[s] - {s}) for s in steps)


def test_missing_points(spark):
    points = spark.createDataFrame([(None, 1.0), (1.0, None), (90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0)], "lat double, lon double")
    cells = [r.c for r in g.with_cells(points, F.col("lat"), F.col("lon"), {"c": 9}).collect()]
    assert cells[:2] == [None, None] and None not in cells[2:] and cells[4] == cells[5]
    with pytest.raises(ValueError, match="levels"):
        g.with_cells(points, F.col("lat"), F.col("lon"), {"c": 16})
