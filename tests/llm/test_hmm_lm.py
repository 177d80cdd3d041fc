import math
from collections import Counter
from itertools import product

import numpy as np
from featuremill.llm import hmm_lm as op
from odd import odd_docs, odd_rows, prose, spaced_words
from pyspark.sql import functions as F

SMALL = op.Shape(states=3, own_classes=20, shared_classes=7, frequent=40, segment=8, steps=3)


def tokens(text):
    return [w.encode().lower() for w in spaced_words(text)]


def brute_base(rows, training):
    counts = Counter(w for r in rows if training(r[0]) for w in [*tokens(r[1]), None])
    total, distinct = counts.total(), len(counts)
    made = []
    for doc, text, *_ in rows:
        own = [*tokens(text), None]
        made.append((doc, len(own), sum(counts[w] > 0 for w in own), total, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)))
    return sorted(made, key=lambda r: (str(r[0]), r[1]))


def scored(docs, shape=SMALL):
    made = op.score_documents(docs, "training", shape=shape).collect()
    return sorted(made, key=lambda r: (str(r.doc_id), r.n_tokens))


def check(rows, made, training):
    want = brute_base(rows, training)
    assert [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in made] == [w[:4] for w in want]
    assert np.allclose([r.base_score for r in made], [w[4] for w in want], rtol=1e-9, atol=1e-9)
    assert all(r.score < 0 or r.n_tokens == 1 for r in made)


def test_odd_rows(spark):
    rows = odd_rows()
    made = scored(odd_docs(spark, rows).withColumn("training", F.coalesce(F.col("doc_id") % 3 != 1, F.lit(True))))
    check(rows, made, lambda d: d is None or d % 3 != 1)


def test_without_training_rows_and_empty(spark):
    rows = odd_rows()[:6]
    check(rows, scored(odd_docs(spark, rows).withColumn("training", F.lit(False))), lambda d: False)
    assert scored(odd_docs(spark, []).withColumn("training", F.lit(True))) == []


def test_training_beats_the_base_on_held_out_texts(spark):
    rng = np.random.default_rng(3)
    halves = [["red", "blue", "green", "grey"], ["one", "two", "three", "four"]]
    rows = [(i, " ".join(str(rng.choice(halves[(j // 3) % 2])) for j in range(60)), None, None, 0) for i in range(80)]
    made = scored(odd_docs(spark, rows).withColumn("training", F.col("doc_id") % 4 != 0), op.Shape(states=4, own_classes=20, shared_classes=7, frequent=40, segment=16, steps=25))
    held = [r for r in made if r.doc_id % 4 == 0]
    # A half goes on with chance 2/3: knowing it is worth 1 - H(1/3) = 0.08 bits a word, 30 decimal digits over 20 texts of 60.
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 25


def model(seed=1, k=3, n=5):
    rng = np.random.default_rng(seed)
    norm = lambda x: x / x.sum(-1, keepdims=True)
    return op.Hmm(norm(rng.random(k)), norm(rng.random((k, k))), norm(rng.random((k, n))))


def paths(seq, m):
    """(states, probability) of all state paths."""
    for p in product(range(len(m.start)), repeat=len(seq)):
        chance = m.start[p[0]] * m.emit[p[0], seq[0]]
        for a, b, x in zip(p, p[1:], seq[1:], strict=False):
            chance *= m.move[a, b] * m.emit[b, x]
        yield p, chance


def test_forward_is_exact():
    m, rng = model(), np.random.default_rng(5)
    seqs = [rng.integers(0, 5, n) for n in (3, 1, 6, 2, 6)]
    want = [math.log(sum(c for _, c in paths(s, m))) for s in seqs]
    assert np.allclose(op.log_likelihoods(seqs, m), want)
    long = [rng.integers(0, 5, 5000)]
    assert np.isfinite(op.log_likelihoods(long, m)).all()


def test_expected_counts_are_exact():
    m, rng = model(2), np.random.default_rng(6)
    seqs = [rng.integers(0, 5, n) for n in (4, 2, 5)]
    starts, moves, emissions = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for s in seqs:
        every = list(paths(s, m))
        total = sum(c for _, c in every)
        for p, c in every:
            starts[p[0]] += c / total
            for a, b in zip(p, p[1:], strict=False):
                moves[a, b] += c / total
            for z, x in zip(p, s, strict=True):
                emissions[z, x] += c / total
    made = op.expected_counts(seqs, np.ones(3, bool), m, op.stationary(m.move))
    assert np.allclose(made[0], starts) and np.allclose(made[1], moves) and np.allclose(made[2], emissions)


def test_probabilities_of_all_words_add_up(spark):
    """Chances of every one-word text over seen words, plus the unseen share of each class, give the chance of length one."""
    rows = [(i, prose(i, 30), None, None, 0) for i in range(20)]
    words = sorted({w.decode() for _, t, *_ in rows for w in tokens(t)})
    docs = odd_docs(spark, [*rows, *((1000 + i, w, None, None, 0) for i, w in enumerate(words))]).withColumn("training", F.col("doc_id") < 1000)
    one = sum(10**r.score for r in scored(docs) if r.doc_id >= 1000)
    assert 0 < one < 1
