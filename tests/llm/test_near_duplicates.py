import random
from collections import Counter

import numpy as np
import pytest
from featuremill.llm import bag_minhash as op
from odd import folded_words, odd_docs, odd_rows, prose


def bag(text):
    own = folded_words(text)
    return Counter(zip(*(own[i:] for i in range(min(5, len(own)))), strict=False))


def jaccard(a, b):
    least = sum((a & b).values())
    return least / (a.total() + b.total() - least)


def roots(rows, similarity=0.8):
    """A row number that stands for each row's class, by comparing all pairs."""
    bags, root = [bag(t) for _, t, *_ in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "") if not (bags[i] and bags[j]) else jaccard(bags[i], bags[j]) >= similarity
            if same:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def classes(rows):
    """Smallest id of each row's class."""
    root, least = roots(rows), {}
    for i, (doc, *_) in zip(root, rows, strict=True):
        if doc is not None:
            least[i] = min(least.get(i, doc), doc)
    return sorted(((doc, least.get(i)) for i, (doc, *_) in zip(root, rows, strict=True)), key=str)


def result(docs):
    return sorted(((r.doc, r.class_id) for r in op.near_duplicate_classes(docs).collect()), key=str)


def test_odd_rows(spark):
    assert result(odd_docs(spark)) == classes(odd_rows())


def test_chains_and_large_groups(spark):
    rng, rows = random.Random(8), []
    base = prose(77, 200).split()
    for i in range(40):  # many near copies of one text
        own = base.copy()
        for _ in range(2):
            own[rng.randrange(200)] = f"new{i}x{rng.random()}"
        rows.append((len(rows), " ".join(own), None, None, 0))
    chain = prose(78, 200).split()
    for i in range(12):  # each near the last one, the ends far apart
        chain = [*chain[8:], *prose(500 + i, 8).split()]
        rows.append((len(rows), " ".join(chain), None, None, 0))
    rows += [(len(rows) + i, prose(1000 + i, 150), None, None, 0) for i in range(30)]
    rng.shuffle(rows)
    assert result(odd_docs(spark, rows, clashes=False)) == classes(rows)


def test_keep_one_of_each_class(spark):
    docs = odd_docs(spark)
    kept = op.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    # Two texts share the id 6, and each is the first of its class.
    assert len(ids) == len(set(roots(odd_rows())))
    assert {x for x in ids if x is not None} == {c for _, c in classes(odd_rows()) if c is not None}


def test_empty_table(spark):
    assert result(odd_docs(spark, [])) == []
    assert op.keep_one(odd_docs(spark, [])).count() == 0


@pytest.mark.parametrize("counts", [(1, 1), (3, 1), (7, 5), (100, 80), (1000, 4)])
def test_signatures_estimate_weighted_jaccard(counts):
    rng = np.random.default_rng(9)
    shared, x, y = (rng.integers(1, 2**63, 60, dtype=np.uint64) for _ in range(3))
    sets = []
    for own, n in ((x, counts[0]), (y, counts[1])):
        hashes, n_each = np.concatenate([shared, own[:10]]), np.concatenate([np.full(60, n), np.full(10, 2)])
        order = np.argsort(hashes)
        sets.append((hashes[order], n_each[order]))
    m = 4000
    times = op.signatures(sets, m)
    want = 60 * min(counts) / (60 * max(counts) + 40)
    assert abs((times[0] == times[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / m) + 1e-9
    # The first of a Poisson process with the multiset's weight as its rate.
    total = 60 * counts[0] + 20
    assert abs(times[0].mean() * total - 1) < 5 / np.sqrt(m)


def test_signatures_do_not_depend_on_the_batch():
    sets = [op.ShingleHasher().multiset(prose(i, 30 + 40 * i).encode().split()) for i in range(6)]
    together = op.signatures(sets, 50)
    assert all(np.array_equal(op.signatures([s], 50)[0], row) for s, row in zip(sets, together, strict=True))


def test_components(spark):
    rng = random.Random(1)
    nodes = [i.to_bytes(4, "big") for i in range(60)]
    pairs = [tuple(rng.sample(nodes, 2)) for _ in range(45)]
    root = {n: n for n in nodes}
    for _ in nodes:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    made = {bytes(r.key): bytes(r.root) for r in op.components(spark.createDataFrame(pairs, "a binary, b binary")).collect()}
    assert made == {n: root[n] for p in pairs for n in p}


def test_blocks_find_the_near_pairs():
    rng = random.Random(6)
    base, nodes = prose(7, 60).split(), []
    for i in range(30):
        own = base.copy()
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(60)] = f"w{rng.randrange(9)}"
        nodes.append({"key": bytes([i]), "root": bytes([i % 7]), "bands": [5, i % 3, 9 if i % 2 else i], "text": " ".join(own + own[:3] * (i % 2))})
    want = set()
    for x in nodes:
        for y in nodes:
            common = next((p for p, q in zip(x["bands"], y["bands"], strict=True) if p == q), None)
            if x["key"] > y["key"] and x["root"] != y["root"] and common == 5 and jaccard(bag(x["text"]), bag(y["text"])) >= 0.8:
                want.add((x["key"], y["key"]))
    hasher, found = op.ShingleHasher(), []
    blocks = [nodes[:11], nodes[11:20], nodes[20:]]
    for i, left in enumerate(blocks):
        for right in blocks[i:]:
            found += op.near_pairs(hasher, 5, left, right, 0.8)
    assert len(found) == len(set(found)) and set(found) == want
    assert op.near_pairs(hasher, 6, nodes[:11], nodes[11:20], 0.8) == []


def test_large_buckets_go_through_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "SMALL", 2)
    monkeypatch.setattr(op, "BLOCK", 5)
    monkeypatch.setattr(op, "PIVOT_ROUNDS", 1)
    test_chains_and_large_groups(spark)
