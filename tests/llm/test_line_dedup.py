import hashlib
import random

import pytest
from featuremill.llm import line_dedup
from odd import odd_docs, odd_rows


def kept_lines(rows, min_chars=40, min_docs=5):
    """(lines, lines that stay) of each row."""

    def key(line):
        made = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in made)

    holders = {}
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(-1 if doc is None else doc)
    made = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        own = -1 if doc is None else doc
        made.append((lines, [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and max(holders[key(x)]) != own)]))
    return made


def brute(rows):
    digest = lambda kept: hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return sorted(((r[0], len(x), len(x) - len(y), digest(y)) for r, (x, y) in zip(rows, kept_lines(rows), strict=True)), key=str)


def result(docs):
    made = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs), digest=True)
    return sorted((tuple(r) for r in made.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=str)


def test_odd_rows(spark):
    assert result(odd_docs(spark)) == brute(odd_rows())


def test_text_form_keeps_other_columns(spark):
    docs = odd_docs(spark).drop("n_lines")
    made = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    assert {*docs.columns, "n_lines", "n_dropped"} == set(made.columns)
    assert made.filter("shard = 'clash'").count() == len(odd_rows())


def test_empty_table(spark):
    assert result(odd_docs(spark, [])) == []


def test_a_line_in_every_document_over_many_ranges(spark):
    lines = [f"line number {i} with enough characters to count as a key" for i in range(6)]
    rng = random.Random(5)
    rows = [(i, "\n".join([lines[0], *rng.choices(lines, k=3), f"own {i}"]), None, None, 0) for i in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(odd_docs(spark, rows, clashes=False)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("cuts", [[], [1], [3], [7, 8], list(range(1, 12))])
def test_streams_cut_anywhere_agree(cuts):
    rows = [(b"a", d, 0, 1, b"") for d in (9, 8, 7, 6, 5, 4, 3)] + [(b"b", d, 0, 1, b"") for d in (5, 4)] + [(b"c", d, 0, 1, b"") for d in (6, 5, 4, 3, 2)]
    edges = [0, *cuts, len(rows)]
    made = [x for a, b in zip(edges, edges[1:], strict=False) for x in line_dedup.stream_runs(iter(rows[a:b]), 5)]
    totals = {}
    for h, doc, *_, kind, n in made:
        if kind == line_dedup.TOTAL:
            top, seen = totals.get(h, (-1, 0))
            totals[h] = max(top, doc), seen + n
    lost = {(x[0], x[1]) for x in made if x[5] == line_dedup.DECIDED}
    lost |= {(x[0], x[1]) for x in made if x[5] == line_dedup.OPEN and totals[x[0]][1] >= 5 and totals[x[0]][0] != x[1]}
    assert lost == {(b"a", d) for d in (8, 7, 6, 5, 4, 3)} | {(b"c", d) for d in (5, 4, 3, 2)}
