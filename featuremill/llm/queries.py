"""Registered queries of the operators, with the SQL they are checked against where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.llm import (
    bag_minhash, byte_bpe, decontamination, forced_bpe, hmm_lm, kk_sharding, language_id, line_dedup, periodic_runs, quality_rules, spelling,
    token_cache, toxicity,
)
from featuremill.llm.common import crc_of_id, shared_path, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (crc_of_id() % 3 == 1).alias("held_out"))
    profile = language_id.learn_profiles(docs.filter(~F.col("held_out")))
    return language_id.identify(docs.drop("lang"), profile, carry=("doc_id", "held_out"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.match_documents(docs, table(spark, sf_dir, "benchmark"))
    hits = decontamination.n_hit(F.col("hit_spans"))
    return found.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.is_contaminated(hits, F.col("n_words")).alias("contaminated"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.score_quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (crc_of_id() % 7 != 2).alias("training"))
    return hmm_lm.score_documents(docs, "training").withColumn("held_out", ~F.col("training")).drop("training")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bag_minhash.near_duplicate_classes(docs).select(F.col("doc").alias("doc_id"), "class_id", "class_size")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs), digest=True)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # A cache of its own for every call: each run encodes all distinct texts.
    counts = token_cache.count_tokens(docs, shared_path(spark, "token-cache"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return kk_sharding.shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocab = byte_bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.round_trip(docs, vocab).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (crc_of_id() % 5 == 0).alias("held_out"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(crc_of_id() % 5 != 0)
    model = toxicity.learn(docs, labels)
    scored = toxicity.score_documents(docs, model, carry=("doc_id", "held_out"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): where h = crc32(doc_id) is divisible by 10, the words from a = g % n on repeat the p words there.

    g is a tenth of h, n the number of words and p = 1 + (n - a) // (3 + g % 8).
    """
    h = crc_of_id()
    words = F.when(h % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    sized = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("w")).withColumn("n", F.size("w"))
    a = F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int")
    placed = sized.withColumn("a", a).withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    period = F.slice("w", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    planted = F.slice(F.concat(F.slice("w", F.lit(1), F.col("a")), F.flatten(F.array_repeat(period, times))), F.lit(1), F.col("n"))
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.find_runs(docs, carry=["doc_id"], collapsed="digest")
    best = found.withColumn("best", periodic_runs.strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.*", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.runs_text(F.col("runs")), 256).alias("runs_sha256"), "collapsed_sha256",
    )


def op12_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return forced_bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


def planted_words(docs: DataFrame) -> DataFrame:
    """(word): every run of letters; where 31 divides h = crc32(doc_id:run), without its code point h % length."""
    # A shorter run cannot become a word of seven.
    runs = spelling.letter_runs(docs).filter(F.length("word") >= 7)
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    hashed = runs.select("word", h.alias("h"))
    cut = spelling.without_point(F.col("word"), (F.col("h") % F.length("word")).cast("int"))
    return hashed.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("word")).alias("word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.spelling_forms(spelling.vocabulary(planted_words(docs)))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line, lower_ascii AS key, length(lower_ascii) AS n
  FROM (
    SELECT doc_id, pos, line,
      translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
    FROM (
      SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
    )
  )
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE n >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.pos, l.line, r.key IS NOT NULL AND l.doc_id <> r.keeper AS dropped
  FROM lines l LEFT JOIN repeated r ON l.key = r.key AND l.n >= 40
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP13_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(256) r(b)
  )
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY 1, 2
), digits AS (
  SELECT run, k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS d FROM runs
), hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(d) // 2),
      lambda i: 16 * (strpos('0123456789ABCDEF', d[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', d[2 * i + 2]) - 1)),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1]))) AS h
  FROM digits, crc
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, k FROM hashed
), vocabulary AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), shorter AS (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, v.word, v.n FROM shorter s JOIN vocabulary v ON s.rest = v.word
  UNION SELECT v.word, s.word, s.n FROM shorter s JOIN vocabulary v ON s.rest = v.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
), formed AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM vocabulary v LEFT JOIN best b USING (word)
), chain AS (
  SELECT word, word AS last, 0 AS step FROM formed
  UNION ALL SELECT c.word, f.form, c.step + 1 FROM chain c JOIN formed f ON c.last = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT word, arg_max(last, step) AS root FROM chain GROUP BY word) r USING (word)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_quality_rules": op3_quality_rules,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_sharding": op8_sharding,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_toxicity": op10_toxicity,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_forced_bpe": op12_forced_bpe,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLES: dict[str, str] = {"op6_line_dedup": OP6_SQL, "op13_spelling_variants": OP13_SQL}
