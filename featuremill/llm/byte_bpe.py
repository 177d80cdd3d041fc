"""Byte-level BPE: encoding with offsets, and decoding, with the tokenizers library over Arrow batches.

The vocabulary comes from a file of ranks. Every byte stands for one printable character, so a rank's bytes are a string for
the library; the merges are found by merging each token's own bytes with lower ranks until two parts are left. Encoding
cuts a text at each match of the pattern and merges inside a match only. Decoding turns ids into bytes by the reversed table and
joins them before reading UTF-8, so a character that is split between tokens comes back whole.

Defined results: NULL text is empty text and has no tokens; special strings are ordinary text; unknown ids in decoding are
an error of that row, which gives NULL; bytes that are no UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from featuremill.llm.common import map_texts
from featuremill.llm.units import UnitEncoder, UnitMemo, one_thread


def load_ranks(path: str) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is one, else the next free one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(0x100 + others.index(b)) for b in range(256)]


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts whose merge makes the token."""
    parts, top = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], top), i) for i in range(len(parts) - 1))
        if rank >= top:
            raise ValueError(f"no merges lead to token {top}")
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


@dataclass(frozen=True)
class Vocabulary:
    """What a task needs: the tokenizer as text, and the bytes of each id."""

    tokenizer: str
    pieces: list[bytes | None]


def vocabulary(ranks_path: str, pattern: str) -> Vocabulary:
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, chars = load_ranks(ranks_path), byte_characters()
    as_text = {token: "".join(chars[b] for b in token) for token in ranks}
    merges = [tuple(as_text[p] for p in last_merge(t, ranks)) for t in sorted(ranks, key=ranks.get) if len(t) > 1]
    made = Tokenizer(models.BPE(vocab={as_text[t]: r for t, r in ranks.items()}, merges=merges))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    pieces: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return Vocabulary(made.to_str(), pieces)


class Coder:
    """Encodes and decodes inside one task."""

    def __init__(self, vocab: Vocabulary) -> None:
        from tokenizers import Tokenizer

        one_thread()
        self.tokenizer, self.pieces = Tokenizer.from_str(vocab.tokenizer), vocab.pieces
        self.sizes = np.array([len(p or b"") for p in vocab.pieces], np.int64)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids, characters split between tokens included."""
        pieces = self.pieces
        return b"".join([pieces[i] for i in ids])

    def memo(self, make) -> UnitMemo:
        encode = UnitEncoder(self.tokenizer)
        return UnitMemo(lambda units: [make(ids) for ids in encode(units)])

    def char_starts(self, text: bytes, ids: np.ndarray) -> np.ndarray:
        """Of each token: the character that holds its first byte."""
        first = np.cumsum(self.sizes[ids]) - self.sizes[ids]
        begins = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
        return (begins[first] - 1).astype(np.int32)


def _list_array(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int64).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *parts]), pa.int32()))


def encode(docs: DataFrame, vocab: Vocabulary, text_col: str = "text", offsets: bool = True, check: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids``.

    With ``offsets`` also ``char_starts``, the first character of each token; with ``check`` also ``decodes``, whether the ids
    decode to the text.
    """
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if offsets:
        fields.append(T.StructField("char_starts", T.ArrayType(T.IntegerType())))
    if check:
        fields.append(T.StructField("decodes", T.BooleanType()))

    def open_task():
        coder = Coder(vocab)
        memo = coder.memo(lambda ids: (np.array(ids, np.int32).tobytes(), coder.decode(ids)))

        def work(columns: dict[str, pa.Array], texts: list[bytes]) -> list[pa.Array]:
            ids, same = [], []
            for text, units in zip(texts, memo.results(x.decode() for x in texts), strict=True):
                ids.append(np.frombuffer(b"".join([u[0] for u in units]), np.int32))
                same.append(b"".join([u[1] for u in units]) == text)
            made = [pa.array([len(x) for x in ids], pa.int64()), _list_array(ids)]
            if offsets:
                made.append(_list_array([coder.char_starts(t, x) for t, x in zip(texts, ids, strict=True)]))
            return [*made, pa.array(same, pa.bool_())] if check else made

        return work

    return map_texts(docs, text_col, T.StructType(fields), open_task, docs.columns)


def decode(docs: DataFrame, vocab: Vocabulary, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``docs`` with the text of ``ids_col`` in ``out``; NULL where ids are NULL or not in the vocabulary."""
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    schema = T.StructType([*(T.StructField(c, docs.schema[c].dataType, True) for c in kept), T.StructField(out, T.StringType())])

    def run(batches):
        coder = Coder(vocab)

        def text_of(ids: list[int] | None) -> str | None:
            if ids is None or any(i is None or not 0 <= i < len(coder.pieces) or coder.pieces[i] is None for i in ids):
                return None
            return coder.decode(ids).decode("utf-8", "replace")

        for batch in batches:
            texts = pa.array([text_of(x) for x in batch.column(ids_col).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), texts], names=schema.names)

    return docs.mapInArrow(run, schema)


ROUND_TRIP = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    T.StructField("same", T.BooleanType()),
])


def round_trip(docs: DataFrame, vocab: Vocabulary, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode and decode every text: number of tokens, digests of the ids and of the decoded bytes, and whether these are the text's."""

    def open_task():
        coder = Coder(vocab)
        memo = coder.memo(lambda ids: (len(ids), " ".join(map(str, ids)).encode(), coder.decode(ids)))

        def work(columns: dict[str, pa.Array], texts: list[bytes]) -> list[pa.Array]:
            n, digests, decoded, same = [], [], [], []
            for text, units in zip(texts, memo.results(x.decode() for x in texts), strict=True):
                n.append(sum([u[0] for u in units]))
                digests.append(hashlib.sha256(b" ".join([u[1] for u in units if u[0]])).hexdigest())
                back = b"".join([u[2] for u in units])
                decoded.append(hashlib.sha256(back).hexdigest())
                same.append(back == text)
            return [pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string()), pa.array(same, pa.bool_())]

        return work

    return map_texts(docs, text_col, ROUND_TRIP, open_task, list(carry))
