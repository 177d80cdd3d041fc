import random

import pytest
from featuremill.llm import decontamination as op
from odd import folded_words, odd_docs, odd_rows, prose

ITEMS = [(1, prose(1, 40)), (2, "two words"), (3, None), (4, ""), (5, prose(2, 30)), (5, prose(2, 30)), (6, "the " * 20), (7, "word"), (None, prose(5, 25)), (8, "!!!")]


def brute(rows, items, window=13):
    windows = {}
    for item, text in items:
        own = folded_words(text)
        size = min(window, len(own))
        for at in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[at : at + size]), set()).add("" if item is None else str(item))
    made = []
    for doc, text, *_ in rows:
        own, hit, found = folded_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(own) - size + 1):
                if holders := windows.get(tuple(own[at : at + size])):
                    hit.update(range(at, at + size))
                    found |= holders
        made.append((doc, len(own), len(hit), sorted(found)))
    return sorted(made, key=str)


def result(docs, benchmark, **settings):
    found = op.match_documents(docs, benchmark, **settings)
    rows = found.select("doc_id", "n_words", op.n_hit(found["hit_spans"]).alias("n"), "items").collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_odd_rows(spark, benchmark):
    assert result(odd_docs(spark), benchmark) == brute(odd_rows(), ITEMS)


def test_blocks_of_the_benchmark_give_the_same(spark, benchmark):
    assert result(odd_docs(spark), benchmark, block_bytes=100) == brute(odd_rows(), ITEMS)


def test_empty_tables(spark, benchmark):
    assert result(odd_docs(spark, []), benchmark) == []
    assert result(odd_docs(spark), benchmark.limit(0)) == brute(odd_rows(), [])


def test_filter_keeps_columns_and_clean_rows(spark, benchmark):
    kept = op.decontaminate(odd_docs(spark), benchmark)
    assert kept.columns == odd_docs(spark).columns
    hit = {(d, n) for d, n, h, _ in brute(odd_rows(), ITEMS) if h and 20 * h >= n}
    assert kept.count() == sum((d, n) not in hit for d, n, *_ in brute(odd_rows(), ITEMS))


def test_longest_matches(spark, benchmark):
    rows = {(r.item, r.item_word): r for r in op.longest_matches(odd_docs(spark), benchmark).collect()}
    assert rows["1", 0].n_words == 40 and rows["1", 0].doc_word == 0
    assert rows["1", 5].n_words == 35 and rows["1", 5].doc_word == 5


@pytest.mark.parametrize("seed", range(6))
def test_shards_of_few_words(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(str(i), text(rng.randint(1, 12))) for i in range(8)]
    rows = [(i, text(rng.randint(0, 40))) for i in range(12)]
    block = op.test_block(items, 4)
    made = [(n, sum(b - a for a, b in spans), sorted({block.items[i] for i in found})) for n, spans, found in op.Shard([t.encode() for _, t in rows], block, block.longest_window).windows()]
    assert made == [tuple(x[1:]) for x in sorted(brute(rows, items, 4), key=lambda x: x[0])]


def test_a_long_item_costs_no_more_than_short_ones():
    """The search goes as deep as a window, whatever the length of the longest item."""
    long_ = prose(900, 20_000)
    items = [(str(i), prose(i, 100)) for i in range(40)]
    texts = [(i, prose(100 + i, 300)) for i in range(200)] + [(500, " ".join(long_.split()[700:900])), (501, items[3][1])]
    shards = [op.Shard([t.encode() for _, t in texts], b, b.longest_window) for b in (op.test_block(items, 13), op.test_block([*items, ("long", long_)], 13))]
    assert shards[0].array.levels == shards[1].array.levels or shards[1].array.bits > shards[0].array.bits
    assert max(s.array.levels * s.array.per_key for s in shards) < 13 + 62
    found = shards[1].windows()
    assert [(n, sum(b - a for a, b in spans), items) for n, spans, items in found[-2:]] == [(200, 200, {40}), (100, 100, {3})]


@pytest.mark.parametrize("seed", range(4))
def test_longest_matches_against_brute_force(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items, docs = [(str(i), text(rng.randint(3, 30))) for i in range(5)], [text(rng.randint(0, 60)) for _ in range(8)]
    block = op.test_block(items, 3)
    shard = op.Shard([d.encode() for d in docs], block, block.deepest)
    made = {int(s): int(n) for s, n, *_ in zip(*shard.longest(), strict=True)}
    want, number = {}, 0
    for _, item in items:
        own = item.split()
        for at in range(len(own)):
            held = [n for d in docs for b in range(len(d.split())) for n in [next((k for k in range(len(own) - at + 1) if own[at : at + k] != d.split()[b : b + k]), len(own) - at + 1) - 1]
                    if len(d.split()) - b >= 3]
            if held and max(held) > 0:
                want[number] = max(held)
            number += 1
    assert made == want
