import numpy as np
from featuremill.llm import language_id as op
from odd import odd_docs, odd_rows


def test_learned_languages(spark):
    syllables = {"aa": ["tha", "ing", "er"], "bb": ["eau", "que", "oi"], "cc": ["sch", "ung", "ei"]}
    rng = np.random.default_rng(1)
    text = lambda lang, n: " ".join("".join(rng.choice(syllables[lang], 2)) for _ in range(n))
    rows = [(i, text(lang, 40), lang, None, 0) for i, lang in enumerate(["aa", "bb", "cc"] * 10)]
    profile = op.learn_profiles(odd_docs(spark, rows))
    tests = [(i, text(lang, 15), lang, None, 0) for i, lang in enumerate(["aa", "bb", "cc"] * 5)]
    found = op.identify(odd_docs(spark, tests), profile, carry=("doc_id", "lang")).collect()
    assert all(r.lang_pred == r.lang and 0 < r.score <= 1 for r in found)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    found = op.identify(docs, op.learn_profiles(docs)).collect()
    assert len(found) == len(odd_rows())
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in range(4))
    assert all(r.lang_pred in ("en", "de") and 0 <= r.score <= 1 for r in found if r.doc_id and r.doc_id > 3)


def test_without_languages(spark):
    docs = odd_docs(spark)
    profile = op.learn_profiles(docs.limit(0))
    assert profile.languages == []
    assert {r.lang_pred for r in op.identify(docs, profile).collect()} == {"und"}
    assert op.identify(docs.limit(0), profile).count() == 0


def test_bundles_are_sums_of_bound_letters():
    bundler = op.Bundler(64, 3, 7)
    texts = ["", "Ab, c!", "12", "zz"]
    made = dict(bundler.bundle(texts))
    assert made[0] is None and made[2] is None
    for at, plain in ((1, " ab c "), (3, " zz ")):
        codes = [0 if c == " " else ord(c) for c in plain]
        want = sum(np.roll(bundler.letter(a), 2).astype(int) * np.roll(bundler.letter(b), 1) * bundler.letter(c) for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))
        assert np.array_equal(made[at], want)
    alone = dict(bundler.bundle(["zz"]))
    assert np.array_equal(alone[0], made[3])
