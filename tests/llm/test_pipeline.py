import base64
import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from featuremill.llm import quality_rules
from test_decontamination import brute as hits
from test_line_dedup import kept_lines
from test_near_duplicates import classes
from odd import odd_rows, prose

ITEM = prose(901, 45)


def corpus():
    rows = [(i, prose(i, 80 + i), "en", "s", 0) for i in range(40)]
    rows += [(100 + i, " ".join(w + "###" for w in prose(300 + i, 90).split()), "en", "s", 0) for i in range(4)]
    shared = "a licence line that many documents carry at their very end"
    rows += [(200 + i, prose(500 + i, 90) + "\n" + shared, "en", "s", 0) for i in range(7)]
    rows += [(300 + i, prose(3, 83), "de", "s", 0) for i in range(3)]
    rows += [(400, prose(700, 40) + " " + ITEM + " " + prose(701, 40), "en", "s", 0)]
    return [*rows, *((1000 + (d or 0), *x) for d, *x in odd_rows())]


@pytest.fixture(scope="module")
def sf_dir_(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long")).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def test_run_against_brute_force(spark, sf_dir_):
    made = corpus_pipeline.run(spark, sf_dir_).collect()
    docs = spark.read.parquet(f"{sf_dir_}/documents.parquet")
    rows = [tuple(r) for r in quality_rules.keep_good(docs).collect()]
    good = {r[0] for r in rows}
    assert {i for i in range(40)} <= good and not good & set(range(100, 104))
    assert sum(x != y for x, y in kept_lines(rows)) >= 6
    rows = [(d, "\n".join(y), *x) for (d, _, *x), (_, y) in zip(rows, kept_lines(rows), strict=True)]
    stay = {c for _, c in classes(rows)}
    seen, unique = set(), []
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        if r[0] in stay and r[0] not in seen:
            seen.add(r[0])
            unique.append(r)
    dirty = {d for d, n, h, _ in hits(unique, [(1, ITEM)]) if h and 20 * h >= n}
    assert dirty == {400}
    want = {d for d, *_ in unique} - dirty
    assert {r.doc_id for r in made} == want and all(r.decodes for r in made)

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {d: reference.encode_ordinary(t) for d, t, *_ in unique}
    digest = lambda x: hashlib.sha256(str(list(x)).encode()).hexdigest()
    assert {r.doc_id: digest(r.ids) for r in made} == {d: digest(ids[d]) for d in want}


def test_stages_return_the_columns_of_documents(spark, sf_dir_):
    docs = spark.read.parquet(f"{sf_dir_}/documents.parquet")
    for empty in (docs.limit(0), docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, empty, sf_dir_).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir_).count() == 0
