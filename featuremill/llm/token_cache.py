"""Token counts through a digest cache.

The cache is a table of (tokenizer digest, content digest, tokens) in a shared folder. Contents are normalised only as far as
counts allow: NULL text is empty text. Digests are joined to the cache; of the contents that it lacks, one row each is
encoded, and the counts are appended. A content that a third of all rows share is one row of the digest table and is never
gathered: its copies meet only in the join of short digest rows, which adaptive execution splits.

Defined results: rows with equal ids are separate rows; an empty table gives an empty result and appends nothing; a cache that
several runs append to at once may hold a count twice, and is read by its distinct rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.llm.common import byte_texts, staged
from featuremill.llm.units import UnitEncoder, UnitMemo, one_thread

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Of the file and of the library that reads it."""
    import sentencepiece
    import tokenizers

    library = sentencepiece.__version__ if path.endswith(".model") else tokenizers.__version__
    with open(path, "rb") as file:
        return hashlib.sha256(library.encode() + b"\0" + file.read()).hexdigest()


def _cuts_at_spaces(spec: dict) -> bool:
    """Whether a tokenizer file is plain byte-level BPE, whose texts may be cut into units."""
    pre = spec.get("pre_tokenizer") or {}
    loose = any(t.get("lstrip") or t.get("rstrip") or any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", []))
    return not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not loose


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Texts to token counts, as the library gives them for the whole text without added special tokens."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    one_thread()
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()

    def encode(texts: list[str]) -> list[int]:
        return [len(x.ids) for x in made.encode_batch_fast(texts, add_special_tokens=False)]

    with open(path, encoding="utf-8") as file:
        if not _cuts_at_spaces(json.load(file)):
            return encode
    ids_of = UnitEncoder(made)
    memo = UnitMemo(lambda units: [len(ids) for ids in ids_of(units)])
    return lambda texts: [sum(units) for units in memo.results(texts)]


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """Distinct rows of the cache; empty where there is none yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path).distinct()


def count_tokens(
    docs: DataFrame, cache_path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row; appends the counts that the cache lacked.

    ``tokenizer_path`` is a local file that all executors have, as the vocabulary package installs it.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc"), F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    keys = staged(keyed.drop("text"), "token-keys")

    known = read_cache(spark, cache_path).filter(F.col("tokenizer") == version)
    misses = keys.groupBy("digest").agg(F.min("doc").alias("doc")).join(known, "digest", "left_anti")
    same = (keyed["digest"] == misses["digest"]) & keyed["doc"].eqNullSafe(misses["doc"])
    texts = keyed.join(misses, same, "left_semi").select("digest", "text")

    def run(batches):
        count = counter(tokenizer_path)
        for batch in batches:
            found = count([*map(bytes.decode, byte_texts(batch.column(1)))])
            yield pa.RecordBatch.from_arrays(
                [pa.array([version] * batch.num_rows, pa.string()), batch.column(0), pa.array(found, pa.int64())], names=["tokenizer", "digest", "n_tokens"]
            )

    # Repeated rows of one id and text are encoded each; one count is stored.
    new = staged(texts.mapInArrow(run, CACHE_SCHEMA).dropDuplicates(["digest"]), "token-misses")
    new.write.mode("append").parquet(cache_path)
    counts = known.unionByName(new).select("digest", "n_tokens")
    return keys.join(counts, "digest").select(F.col("doc").alias(id_col), "n_bytes", "n_tokens")
