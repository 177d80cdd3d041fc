import re

from featuremill.llm import quality_rules as op
from odd import odd_docs, odd_rows, prose, spaced_words


def base(text):
    own = spaced_words(text)
    seen, hit = {}, set()
    for i in range(len(own) - 7):
        seen.setdefault(tuple(own[i : i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            hit.update(j for i in places for j in range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if spaced_words(x)]
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_base_counts_of_odd_rows(spark):
    made = op.score_quality(odd_docs(spark)).collect()
    assert len(made) == len(odd_rows())
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in made if r.doc_id is not None)
    want = []
    for doc, text, *_ in odd_rows():
        if doc is not None:
            counts = base(text)
            want.append((doc, *counts, counts[0] < 20 or 100 * counts[4] > 30 * counts[0]))
    assert got == sorted(want)


def test_verdicts(spark):
    good = [(i, prose(100 + i, 150), None, None, 0) for i in range(60)]
    marks = [(100 + i, " ".join(w + "***" for w in prose(200 + i, 150).split()), None, None, 0) for i in range(6)]
    shout = [(200 + i, " ".join(w.upper() + "!!" for w in prose(300 + i, 150).split()), None, None, 0) for i in range(6)]
    bars = [(300 + i, " | ".join(prose(400 + i, 150).split()), None, None, 0) for i in range(6)]
    docs = odd_docs(spark, good + marks + shout + bars)
    kept = {r.doc_id for r in op.keep_good(docs).collect()}
    assert kept == set(range(60))
    assert op.keep_good(docs).columns == docs.columns


def test_empty_table(spark):
    assert op.score_quality(odd_docs(spark, [])).count() == 0
    assert op.keep_good(odd_docs(spark, [])).count() == 0
    assert op.fit([], 5, 4.0, op.PRIOR).good == op.PRIOR.good


def test_fit_finds_rule_accuracies():
    import random

    rng, patterns = random.Random(3), {}
    for _ in range(20_000):
        good = rng.random() < 0.9
        votes = tuple(None if rng.random() < 0.2 else int(rng.random() < (0.98 if good else 0.3)) for _ in op.RULES)
        patterns[votes] = patterns.get(votes, 0) + 1
    model = op.fit(sorted(patterns.items(), key=str), 60, 4.0, op.PRIOR)
    assert abs(model.good - 0.9) < 0.01
    assert all(abs(x - 0.98) < 0.01 for x in model.keep_if_good) and all(abs(x - 0.3) < 0.06 for x in model.keep_if_bad)


def test_plan_has_no_python(spark):
    plan = op.judged(op.with_features(odd_docs(spark)), op.PRIOR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
