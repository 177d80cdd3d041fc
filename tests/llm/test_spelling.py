import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from featuremill.llm import queries, spelling
from odd import odd_docs, odd_rows, odd_tables, prose
from registry.compare import compare, connect

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(word, alphabet):
    for i in range(len(word) + 1):
        for c in alphabet:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1 :]
        if i < len(word):
            yield word[:i] + word[i + 1 :]


def brute(counts, ratio=10):
    """Every edit of every word, looked up."""
    alphabet = {c for w in counts for c in w}
    near = {w: {x for x in one_edit(w, alphabet) if x in counts and x != w} for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    made = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        made[w] = (w, form[w], root, n, len(near[w]), counts.get(form[w]))
    return sorted(made.values())


def contract(rows):
    words = Counter()
    for doc, text, *_ in rows:
        for run in LETTERS.findall(text or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return brute({w: n for w, n in words.items() if len(w) >= 7 and n >= 2})


def variants(seed, n):
    rng = random.Random(seed)
    made, stems = [], ["".join(rng.choices("abcdeé", k=rng.randint(7, 11))) for _ in range(n)]
    for i, stem in enumerate(stems):
        edits = [x for x in one_edit(stem, "abcéÿ") if len(x) >= 7]
        made += [stem] * rng.choice([1, 2, 30, 400]) + rng.choices(edits, k=12) * rng.choice([1, 2, 3]) + [rng.choice(edits)] * 25
        made += [next(one_edit(rng.choice(edits), "z"))] * (i % 3)
    made += ["colorful"] * 900 + ["colourful"] * 40 + ["colourfull"] * 2
    rng.shuffle(made)
    return made


def rows():
    words, made = variants(3, 25), odd_rows()
    for i in range(0, len(words), 60):
        made.append((2000 + i, ", ".join(w.upper() if k % 7 == 0 else w for k, w in enumerate(words[i : i + 60])), "en", "s", 0))
    return made


def test_query_is_the_contract(spark, tmp_path):
    made = queries.op13_spelling_variants(spark, odd_tables(spark, str(tmp_path), rows()))
    want = contract(rows())
    assert sorted(tuple(r) for r in made.select("word", "form", "root", "n", "n_near", "form_n").collect()) == want
    assert sum(r[1] is not None for r in want) > 50 and ("colourfull", "colourful", "colorful") in {r[:3] for r in want}


@pytest.mark.parametrize("odd", [False, True])
def test_query_equals_its_sql(spark, sf_dir, tmp_path, odd):
    base = odd_tables(spark, str(tmp_path), rows()) if odd else sf_dir
    con = connect(sf_dir)
    if odd:
        con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{base}/documents.parquet/*.parquet')")
    status, n = compare(queries.op13_spelling_variants(spark, base), con, queries.ORACLES["op13_spelling_variants"])
    assert status == "exact" and n > 100


def test_blocks_of_large_groups(spark):
    counts = Counter(variants(9, 40))
    counts |= Counter({"sharedprefix" + w: 3 for w in {prose(i, 1).strip(".") for i in range(300)}})
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long")
    # Blocks of 20 words cut every larger group.
    for block in (20, spelling.BLOCK):
        made = spelling.spelling_forms(vocab, block=block)
        assert sorted(tuple(r) for r in made.collect()) == brute(counts)


def test_short_words_ties_and_repeats(spark):
    words = ["a", "b", "ab", "ba", "aa", "aab", "aaa", "abab", "baba", "ababa", "é", "éa"]
    vocab = spark.createDataFrame([*((w, 2) for w in words), ("a", 3), ("", 5), (None, 7)], "word string, n long")
    counts = defaultdict(int, {w: 2 for w in words} | {"a": 5})
    assert sorted(tuple(r) for r in spelling.spelling_forms(vocab, ratio=2).collect()) == brute(dict(counts), 2)


def test_near_words_against_brute_force():
    rng = random.Random(0)
    for _ in range(200):
        base = ["".join(rng.choices("abcé", k=rng.randint(1, 9))) for _ in range(10)]
        words = {x for w in base for x in (w, *rng.choices([*one_edit(w, "abx")], k=3)) if x}
        counts = {w: rng.randint(1, 4) for w in words}
        units, made = defaultdict(list), {}
        for w, n in counts.items():
            for shorter in {len(w), len(w) - 1} - {0}:
                half = shorter // 2
                units[shorter, 0, w[:half]].append((3, w, n))
                units[shorter, 1, w[len(w) - half :]].append((3, w, n))
        for (shorter, side, _), own in units.items():
            for w, k, best, n in spelling.unit_results(shorter, side, own):
                total, first = made.get(w, (0, (0, "")))
                made[w] = total + k, min(first, (-n, best))
        want = {}
        for w in counts:
            near = {x for x in one_edit(w, {c for x in counts for c in x}) if x in counts and x != w}
            if near:
                want[w] = len(near), min((-counts[x], x) for x in near)
        assert made == want


def test_empty_tables(spark):
    assert spelling.spelling_forms(spark.createDataFrame([], "word string, n long")).count() == 0
    assert spelling.vocabulary(spelling.letter_runs(odd_docs(spark, []))).count() == 0
    assert spelling.letter_runs(odd_docs(spark, [(1, None, None, None, None), (2, "A×b Āc", None, None, None)])).collect() == [(2, "a×b"), (2, "c")]
