import hashlib
import random
from fractions import Fraction
from zlib import crc32

import pytest
from featuremill.llm import periodic_runs, queries
from odd import odd_docs, odd_rows, odd_tables, prose, spaced_words
from pyspark.sql import functions as F


def brute(words, least=24, repeats=3):
    """Every lag, every stretch."""
    found = {}
    for p in range(1, len(words) // repeats + 1):
        a = 0
        while a + p < len(words):
            b = a
            while b + p < len(words) and words[b] == words[b + p]:
                b += 1
            if b > a and b + p - a >= max(least, repeats * p):
                found.setdefault((a, b + p), p)
            a = max(a, b) + 1
    return sorted((a, b - a, p) for (a, b), p in found.items())


def planted(doc, words):
    h = crc32(str("" if doc is None else doc).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p if i >= a else i] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contract(doc, text):
    words = planted(doc, spaced_words(text))
    runs = brute(words)
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc, len(runs), *numbers, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(kept))


def rows():
    rng = random.Random(8)
    made = [r for r in odd_rows() if len(r[1] or "") < 50_000]
    for i in range(120):
        words = []
        for _ in range(rng.randint(1, 6)):
            period = [rng.choice("abcdefg") for _ in range(rng.randint(1, 12))]
            words += (period * 9)[: rng.randint(5, 70)] if rng.random() < 0.6 else prose(rng.randint(0, 10**6), 15).split()
        made.append((1000 + i, rng.choice([" ", "\n", " \t "]).join(words), "en", "s", 0))
    return made


def test_query_is_the_contract(spark, tmp_path):
    base = odd_tables(spark, str(tmp_path), rows())
    made = queries.op11_periodic_runs(spark, base)
    assert made.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [contract(d, t) for d, t, *_ in rows()]
    assert sorted((tuple(r) for r in made.collect()), key=str) == sorted(want, key=str)
    assert sum(r[1] for r in want) > 60 and max(r[1] for r in want) > 1


@pytest.mark.parametrize(("least", "repeats"), [(24, 3), (6, 2), (1, 2), (10, 4)])
def test_runs_against_brute_force(least, repeats):
    rng = random.Random(least)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(0, 3)):
            words = []
            for _ in range(rng.randint(0, 8)):
                period = [rng.choice("abc").encode() for _ in range(rng.randint(1, 9))]
                words += (period * 12)[: rng.randint(1, 50)] if rng.random() < 0.6 else [rng.choice("abcdefghij").encode() for _ in range(rng.randint(1, 20))]
            texts.append(words)
        assert periodic_runs.runs_of(texts, least, repeats) == [brute(w, least, repeats) for w in texts]


def test_equal_hash_sums_neither_make_nor_hide_a_run(monkeypatch):
    words = [b"a", b"b"] * 30 + [b"c"] + [b"a", b"b", b"d"] * 20
    monkeypatch.setattr(periodic_runs.LagScan, "_same", lambda self, at, lag, size: at >= 0)
    assert periodic_runs.runs_of([words], 24, 3) == [brute(words)]


def test_splitting_leaves_only_frequent_words():
    codes = [0, 1] * 20 + [2] + [3, 4, 5] * 10 + [0] * 10
    import numpy as np

    assert periodic_runs.frequent_segments(np.array(codes), np.array([len(codes)]), 24, 3) == [(0, 40), (41, 81)]
    # The word 0 ends the second text's segment only once the first text is counted apart.
    assert periodic_runs.frequent_segments(np.array([0] * 30 + [0, 0] + [1] * 30), np.array([30, 62]), 24, 3) == [(0, 30), (32, 62)]


def test_long_texts(spark):
    words = prose(5, 30_000).split()
    words[7000:7000] = ["x", "y", "z"] * 400
    words[20_000:20_000] = words[100:3100] * 3
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = periodic_runs.find_runs(docs).first()
    want = [tuple(r) for r in row.runs]
    assert (7000, 1200, 3) in want and any(p == 3000 and n >= 9000 for _, n, p in want)
    assert row.n_words == len(words)
    kept = periodic_runs.kept_words(words, want)
    assert row.collapsed == " ".join(kept) and len(words) - len(kept) >= 1197 + 6000


def test_columns_and_empty_tables(spark):
    made = periodic_runs.find_runs(odd_docs(spark).withColumn("runs", F.lit("clash")))
    assert {c: 1 for c in made.columns} == {c: made.columns.count(c) for c in made.columns}
    assert made.count() == len(odd_rows())
    assert periodic_runs.find_runs(odd_docs(spark, []), collapsed="none").collect() == []


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1 AS doc_id, CAST(concat(repeat(concat(X'61FF20', X'6220'), 20), X'C3') AS STRING) AS text")
    row = periodic_runs.find_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(0, 40, 2)] and row.collapsed == "a� b �"
