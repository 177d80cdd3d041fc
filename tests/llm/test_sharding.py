import random
import zlib
from itertools import product

import pytest
from featuremill.llm import kk_sharding as op
from odd import odd_docs, odd_rows


@pytest.mark.parametrize("seed", range(8))
def test_differencing_places_add_up(seed):
    rng, k = random.Random(seed), 3
    parts = [[rng.randint(0, 50) for _ in range(k)] for _ in range(rng.randint(1, 9))]
    sums, places = op.difference(parts)
    again = [0] * k
    for part, place in zip(parts, places, strict=True):
        assert sorted(place) == list(range(k))
        for x, p in zip(part, place, strict=True):
            again[p] += x
    assert again == list(sums)


def test_differencing_is_near_the_best():
    sizes = [8, 7, 6, 5, 4, 3]
    sums, _ = op.difference([[0, 0, s] for s in sizes])
    best = min(max(t) - min(t) for pick in product(range(3), repeat=6) for t in [[sum(s for s, p in zip(sizes, pick, strict=True) if p == j) for j in range(3)]])
    assert best <= max(sums) - min(sums) <= best + 2


def check(rows, made, shards):
    assert len(made) == len(rows)
    by_id = {}
    for r in made:
        by_id.setdefault(r.doc_id, []).append((r.size, r.text_crc32))
    want = {}
    for d, t, *_ in rows:
        want.setdefault(d, []).append((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())))
    assert {k: sorted(v) for k, v in by_id.items()} == {k: sorted(v) for k, v in want.items()}
    for j in range(shards):
        slots = sorted(r.slot for r in made if r.shard == j)
        assert slots == list(range(len(slots)))
    places = {}
    for r in made:
        places.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert all(len(p) == 1 for p in places.values())


def test_odd_rows(spark):
    made = op.shard_documents(odd_docs(spark)).collect()
    check(odd_rows(), made, 8)


def test_many_levels_stay_tight(spark):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randint(1, 400) + str(i), None, None, 0) for i in range(900)] + [(2000 + i, "copy " * 4, None, None, 0) for i in range(300)]
    made = op.shard_documents(odd_docs(spark, rows), shards=4, block_groups=40, fan_in=4, slice_rows=25).collect()
    check(rows, made, 4)
    totals = [sum(r.size for r in made if r.shard == j) for j in range(4)]
    assert max(totals) - min(totals) <= sum(totals) / 4000


def test_empty_table(spark):
    assert op.shard_documents(odd_docs(spark, [])).count() == 0
