import random

import numpy as np
import pytest
from featuremill.llm import toxicity as op
from odd import odd_docs, odd_rows, prose


def maximal(scores):
    """The definition: take the best segment, then the same left and right of it."""
    if not len(scores):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    best, at = 0.0, None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            if total[b] - total[a] > best + 1e-9:
                best, at = total[b] - total[a], (a, b)
    if at is None:
        return []
    a, b = at
    return [*maximal(scores[:a]), (a, b, best), *((x + b, y + b, s) for x, y, s in maximal(scores[b:]))]


@pytest.mark.parametrize("seed", range(40))
def test_segments_follow_their_definition(seed):
    rng = random.Random(seed)
    scores = np.array([rng.choice([-3, -2, -1, -1, 1, 2, 4]) + rng.random() / 100 for _ in range(rng.randint(0, 25))])
    found, want = op.segments(scores), maximal(scores)
    assert [x[:2] for x in found] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in found], [x[2] for x in want])


def labelled(spark, n=300):
    rng, rows, labels = random.Random(4), [], []
    for i in range(n):
        own, toxic = prose(2000 + i, 120).split(" "), i % 5 == 0
        if toxic:
            for at in rng.sample(range(120 - 3), 5):
                own[at] = rng.choice(["nastyword", "vilething", "grubling"])
        rows.append((i, " ".join(own), None, None, 0))
        labels.append((i, 1, int(toxic)))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents(spark):
    rows, labels = labelled(spark)
    docs = odd_docs(spark, rows)
    model = op.learn(docs, labels.filter("doc_id < 200"))
    made = op.score_documents(docs.filter("doc_id >= 200"), model).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 5 == 0) for r in made)
    assert all(bool(r.passages) for r in made if r.doc_id % 5 == 0)
    # An inflected form was never seen; its beginning was.
    odd = op.score_documents(odd_docs(spark, [(1, prose(9, 60) + " nastywordish " + prose(10, 60) + " vilethings", None, None, 0)]), model).first()
    assert {(p.start, p.end) for p in odd.passages} >= {(60, 61)} and odd.score >= 0.5


def test_odd_rows_and_labels(spark):
    rows, _ = labelled(spark, 60)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(60)] + [(3, None), (None, 1), (5, 0), (7, 0), (7, 0)], "doc_id long, toxic int")
    docs = odd_docs(spark, [*rows, *((1000 + (d or 0), t, *x) for d, t, *x in odd_rows()), (None, None, None, None, None)])
    made = op.score_documents(docs, op.learn(docs, labels)).collect()
    assert len(made) == 60 + len(odd_rows()) + 1 and all(0 <= r.score <= 1 for r in made)


def test_without_labels_or_rows(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in op.score_documents(docs, op.learn(docs, none)).collect()} == {0.0}
    one_class = spark.createDataFrame([(4, 0), (5, 0)], "doc_id long, toxic int")
    assert {r.score for r in op.score_documents(docs, op.learn(docs, one_class)).collect()} == {0.0}
    assert op.score_documents(odd_docs(spark, []), op.learn(docs, none)).count() == 0


def test_extreme_value_fit():
    rng = np.random.default_rng(2)
    n = rng.integers(50, 2000, 5000)
    best = (np.log(0.1 * n) - np.log(-np.log(rng.random(5000)))) / 0.8
    decay, scale = op.extreme_value(best, n)
    assert abs(decay - 0.8) < 0.05 and abs(np.log(scale / 0.1)) < 0.4
