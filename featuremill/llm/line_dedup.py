"""Repeated lines across documents, by range-partitioned hashes that are streamed in order.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. A key of at least ``min_chars`` code
points found in at least ``min_docs`` documents loses all its lines, except those of the largest document id holding it.

Every (key digest, document) pair is one row with the positions of its lines. The rows are range-partitioned and sorted by
digest and, within a digest, by descending document id. A task streams its range: the first document of a digest is the one
that keeps its lines, and at most ``min_docs`` rows are held until it is known that the others lose theirs. The ranges cut
through a digest where it is frequent, so no key has to fit in a task; the first and last digest of a range are settled by
their totals, at most two rows per range. The result is one compressed keep bitmap per document that loses lines.

Defined results: NULL or empty text is one empty line; rows without an id count as one document, smaller than all others;
rows that share an id have bitmaps of their own (told apart by a hash of the text) and count as one document.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremill.llm.common import ASCII_SPACE, byte_texts, map_texts, staged

DECIDED, OPEN, TOTAL = 0, 1, 2

_KEYS = "h binary, doc long, th long, n_lines int, at binary"
_RUNS = "h binary, doc long, th long, n_lines int, at binary, kind int, n_docs long"


def line_keys(text: bytes, min_chars: int) -> tuple[int, dict[bytes, list[int]]]:
    """Number of lines, and the positions of each key that is long enough."""
    lines, found = text.split(b"\n"), {}
    for at, line in enumerate(lines):
        key = line.strip(ASCII_SPACE).lower()
        if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
            found.setdefault(key, []).append(at)
    return len(lines), found


def _key_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [], [], [], [], []
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, th, text in zip(ids, hashes, byte_texts(batch.column(2)), strict=True):
                n_lines, found = line_keys(text, min_chars)
                for key, at in found.items():
                    row = xxhash.xxh3_128_digest(key), doc, th, n_lines, np.array(at, np.int32).tobytes()
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            kinds = pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["h", "doc", "th", "n_lines", "at"])

    return docs.mapInArrow(run, _KEYS)


def stream_runs(rows: Iterator[tuple], min_docs: int) -> Iterator[tuple]:
    """Rows (h, doc, th, n_lines, at) in order of (h, doc descending) to rows with a kind and a count of documents.

    DECIDED rows lose their lines. The first digest of a stream may have begun before it, and the last may go on behind it:
    their undecided rows come out as OPEN, and one TOTAL row gives the documents seen and the largest.
    """
    run, doc, top, n_docs, held, first = None, None, None, 0, [], True

    def close(last: bool) -> Iterator[tuple]:
        if first or last:
            yield run, top, None, None, None, TOTAL, n_docs
            for x in held:
                yield *x, OPEN, 0

    for row in rows:
        if row[0] != run:
            if run is not None:
                yield from close(False)
                first = False
            run, doc, top, n_docs, held = row[0], row[1], row[1], 1, []
        elif row[1] != doc:
            doc, n_docs = row[1], n_docs + 1
        if first:
            yield *row, OPEN, 0
        elif n_docs < min_docs:
            held.append(row)
        else:
            for x in [*held, row]:
                if x[1] != top:
                    yield *x, DECIDED, 0
            held = []
    if run is not None:
        yield from close(True)


def _streamed(keys: DataFrame, min_docs: int) -> DataFrame:
    order = F.col("h"), F.col("doc").desc_nulls_last()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64()
        names = ["h", "doc", "th", "n_lines", "at", "kind", "n_docs"]
        full: list[tuple] = []

        def flush() -> pa.RecordBatch:
            made = [pa.array(c, k) for c, k in zip(zip(*full, strict=True), kinds, strict=True)]
            full.clear()
            return pa.RecordBatch.from_arrays(made, names=names)

        for row in stream_runs(rows(batches), min_docs):
            full.append(row)
            if len(full) >= 10_000:
                yield flush()
        if full:
            yield flush()

    return keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _RUNS)


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """(doc, th, n_lines, keep): a zlib-compressed bitmap of the lines to keep, for each document that loses some.

    ``th`` is ``xxhash64`` of the text; bit i, most significant first, stands for line i.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    runs = staged(_streamed(staged(_key_rows(source, min_chars), "line-keys"), min_docs), "line-runs")
    totals = runs.filter(F.col("kind") == TOTAL).groupBy("h").agg(F.sum("n_docs").alias("n"), F.max("doc").alias("top"))
    # Two rows for each range at most, whatever the data: sent to the open rows, which one digest may fill.
    late = (
        runs.filter(F.col("kind") == OPEN)
        .join(F.broadcast(totals.filter(F.col("n") >= min_docs)), "h")
        .filter(~F.col("doc").eqNullSafe(F.col("top")))
    )
    part = ["doc", "th", "n_lines", "at"]
    lost = runs.filter(F.col("kind") == DECIDED).select(*part).unionByName(late.select(*part))
    # Bounded by the lines of one document.
    per_doc = lost.groupBy("doc", "th", "n_lines").agg(F.collect_set("at").alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, at in zip(batch.column("n_lines").to_pylist(), batch.column("at").to_pylist(), strict=True):
                bits = np.ones(n, np.uint8)
                bits[np.frombuffer(b"".join(at), np.int32)] = 0
                keep.append(zlib.compress(np.packbits(bits).tobytes(), 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(keep, pa.binary())], names=["doc", "th", "n_lines", "keep"])

    return per_doc.mapInArrow(run, "doc long, th long, n_lines int, keep binary")


def kept_lines(text: bytes, keep: bytes | None) -> tuple[int, int, bytes]:
    """Lines before, lines dropped, and the text of the others."""
    lines = text.split(b"\n")
    if keep is None:
        return len(lines), 0, text
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[: len(lines)]
    return len(lines), int(len(lines) - bits.sum()), b"\n".join(x for x, b in zip(lines, bits, strict=True) if b)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and the kept text, or its sha256 alone where ``digest`` is set."""
    marked = docs.withColumn("_doc", F.col(id_col).cast("long")).withColumn("_th", F.xxhash64(text_col))
    same = marked["_doc"].eqNullSafe(bitmaps["doc"]) & (marked["_th"] == bitmaps["th"])
    joined = marked.join(bitmaps, same, "left").select(*[marked[c] for c in docs.columns], bitmaps["keep"].alias("_keep"))
    out = T.StructField("kept_sha256" if digest else text_col, T.StringType())
    fields = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), out])
    carry = [id_col] if digest else docs.columns

    def open_task():
        def work(columns: dict[str, pa.Array], texts: list[bytes]) -> list[pa.Array]:
            n, dropped, kept = zip(*map(kept_lines, texts, columns["_keep"].to_pylist()), strict=True)
            last = [hashlib.sha256(x).hexdigest() for x in kept] if digest else [x.decode() for x in kept]
            return [pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(last, pa.string())]

        return work

    made = map_texts(joined, text_col, fields, open_task, [*carry, "_keep"])
    return made.drop("_keep")
