"""BPE encoding and decoding by forced boundaries, for tokenizers with word ends and byte characters.

Two bytes that stand side by side in no token of the vocabulary are never merged, nor is anything across them: whatever the merges
do on one side cannot depend on the other. So every such pair is a certain cut. The text is normalised and split into words as
the file says; no token reaches over a word end. Inside a word, each pair of bytes that no token holds is a cut. Only distinct
fragments are encoded, by the model of the file: the last fragment of a word carries the word end, all others are encoded by
the same merges without it. A pair with the last byte of a word is held only by tokens that end a word. The ids of the
fragments are concatenated.

A text that holds the string of an added token is first cut at ASCII white space, over which no token, normaliser or word reaches;
only the pieces with such a string are encoded by the whole tokenizer. The files have no decoder, so decoding joins the tokens
by one space, as the library does.

Defined results: NULL text is empty text and has no tokens; bytes that are not UTF-8 are read as U+FFFD; an id without a token is left
out in decoding, as the library does; NULL ids decode to NULL; rows with equal ids are separate rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from featuremill.llm.common import map_texts
from featuremill.llm.units import one_thread

# The word pattern and the normalisers for which this holds.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALISERS = ["NFC", "Replace", "Lowercase"]

#: Up to here, texts are normalised and split by Python: no character composes, each is lower-cased alone, and classes are stable.
_TOP = 0x17F
_CLASSES = {x: "".join(re.escape(chr(c)) for c in range(_TOP + 1) if unicodedata.category(chr(c))[0] == x) for x in "LN"}
_BEYOND = re.compile(f"[^\\x00-{chr(_TOP)}]")
_WORDS = re.compile(WORDS.replace(r"\p{L}", _CLASSES["L"]).replace(r"\p{N}", _CLASSES["N"]).replace(r"\s", r"\t-\r \x85\xa0"))


def check_file(spec: dict[str, Any]) -> None:
    """Raise for a tokenizer for which the cuts are not known to be safe."""
    model, pre, normal = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    split, to_bytes = (*pre.get("pretokenizers", []), {}, {})[:2]
    plain = (
        model["type"] == "BPE" and model.get("end_of_word_suffix") and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")),
        split.get("type") == "Split" and split["pattern"] == {"Regex": WORDS} and split["behavior"] == "Removed" and split["invert"],
        to_bytes.get("type") == "ByteLevel" and not to_bytes["add_prefix_space"] and not to_bytes["use_regex"],
        [x["type"] for x in normal.get("normalizers", [])] == NORMALISERS and normal["normalizers"][1]["pattern"] == {"Regex": "\\s+"},
        not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", [])),
        not spec.get("decoder") and not spec.get("post_processor"),
    )
    if not all(plain):
        raise ValueError("not a BPE file with word ends, byte characters, the known word pattern and no decoder")


class Boundaries:
    """Where words are cut: pairs of byte characters that no token holds."""

    def __init__(self, vocabulary: Iterable[str], suffix: str) -> None:
        self.inside: set[str] = set()
        self.at_end: set[str] = set()
        for token in vocabulary:
            ends = token.endswith(suffix) and token != suffix
            own = token.removesuffix(suffix) if ends else token
            pairs = [own[i : i + 2] for i in range(len(own) - 1)]
            if ends and pairs:
                self.at_end.add(pairs.pop())
            self.inside.update(pairs)

    def fragments(self, word: str) -> list[str]:
        """The word between its forced boundaries; the last fragment ends it."""
        last, made, begin = len(word) - 1, [], 0
        for i in range(1, last + 1):
            if word[i - 1 : i + 1] not in (self.at_end if i == last else self.inside):
                made.append(word[begin:i])
                begin = i
        made.append(word[begin:])
        return made


class ForcedCoder:
    """Encodes and decodes inside one task; holds at most about ``limit`` short words and as many fragments between texts."""

    def __init__(self, path: str, make: Callable[[list[int], list[str]], Any], limit: int = 250_000, longest: int = 64) -> None:
        from tokenizers import Tokenizer, models

        one_thread()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        check_file(spec)
        model, self.make, self.limit, self.longest = spec["model"], make, limit, longest
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.suffix = model["end_of_word_suffix"]
        # The same merges for fragments that another one follows.
        self.inner, self.last = models.BPE(vocab=model["vocab"], merges=[tuple(m) for m in model["merges"]]), self.tokenizer.model
        self.boundaries = Boundaries(model["vocab"], self.suffix)
        self.byte_chars = dict(enumerate(_byte_characters()))
        if missing := [c for c in self.byte_chars.values() if c not in model["vocab"] or c + self.suffix not in model["vocab"]]:
            raise ValueError(f"{len(missing)} bytes have no token of their own")
        self.added = re.compile("|".join(re.escape(t["content"]) for t in spec.get("added_tokens", [])) or "(?!)")
        self.known: dict[str, Any] = {}
        self.fragments: dict[tuple[str, bool], tuple[list[int], list[str]]] = {}

    def _fragment(self, text: str, ends: bool) -> tuple[list[int], list[str]]:
        found = self.fragments.get((text, ends))
        if found is None:
            tokens = (self.last if ends else self.inner).tokenize(text)
            found = self.fragments[text, ends] = [t.id for t in tokens], [t.value for t in tokens]
        return found

    def word(self, word: str) -> tuple[list[int], list[str]]:
        """Ids and tokens of a normalised word: those of its fragments, one after the other."""
        own = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.byte_chars)
        *inner, last = self.boundaries.fragments(own)
        if not inner:
            return self._fragment(last, True)
        parts = [*(self._fragment(x, False) for x in inner), self._fragment(last, True)]
        return [i for ids, _ in parts for i in ids], [t for _, tokens in parts for t in tokens]

    def words(self, text: str) -> list[str]:
        """The normalised words of a text without strings of added tokens."""
        if not _BEYOND.search(text):
            return _WORDS.findall(text.lower())
        normal = self.tokenizer.normalizer.normalize_str(text)
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        # The offsets of the words are characters of the normalised text.
        return [normal[a:b] for _, (a, b) in split]

    def results(self, texts: Iterable[bytes]) -> Iterator[list[Any]]:
        """Of each text: ``make`` of each of its words."""
        memo = self.known
        for raw in texts:
            text = raw.decode("utf-8", "replace")
            if self.added.search(text):
                yield self._with_added(raw)
                continue
            own = self.words(text)
            for w in {x for x in own if x not in memo}:
                memo[w] = self.make(*self.word(w))
            yield [*map(memo.__getitem__, own)]
            self._forget(memo, len)
            self._forget(self.fragments, lambda key: len(key[0]))

    def _with_added(self, raw: bytes) -> list[Any]:
        """As ``results``; pieces that hold an added token's string are encoded by the whole tokenizer."""
        made = []
        for piece in raw.split():  # without an argument: at ASCII white space
            text = piece.decode("utf-8", "replace")
            if self.added.search(text):
                whole = self.tokenizer.encode(text, add_special_tokens=False)
                made += [self.make(whole.ids, whole.tokens)] if whole.ids else []
            else:
                made += [self.make(*self.word(w)) for w in self.words(text)]
        return made

    def _forget(self, memo: dict, size: Callable[[Any], int]) -> None:
        if len(memo) > self.limit:
            # The oldest entries are the frequent ones: they were met first.
            kept = dict(islice(((k, v) for k, v in memo.items() if size(k) <= self.longest), self.limit // 2))
            memo.clear()
            memo.update(kept)


def _byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is one, else the next free one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(0x100 + others.index(b)) for b in range(256)]


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids``; ``tokenizer_path`` is a local file that all executors have."""
    fields = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def open_task():
        coder = ForcedCoder(tokenizer_path, lambda ids, tokens: np.array(ids, np.int32).tobytes())

        def work(columns: dict[str, pa.Array], texts: list[bytes]) -> list[pa.Array]:
            ids = [np.frombuffer(b"".join(own), np.int32) for own in coder.results(texts)]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int64).astype(np.int32)
            values = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32())
            return [pa.array([len(x) for x in ids], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), values)]

        return work

    return map_texts(docs, text_col, fields, open_task, docs.columns)


def decode(docs: DataFrame, tokenizer_path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``docs`` with the text of ``ids_col`` in ``out``: its tokens, added ones included, joined by one space."""
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    schema = T.StructType([*(T.StructField(c, docs.schema[c].dataType, True) for c in kept), T.StructField(out, T.StringType())])

    def run(batches):
        from tokenizers import Tokenizer

        token = {i: t for t, i in Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True).items()}
        for batch in batches:
            rows = batch.column(ids_col).to_pylist()
            texts = [None if ids is None else " ".join([token[i] for i in ids if i in token]) for ids in rows]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


ROUND_TRIP = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
])


def round_trip(docs: DataFrame, tokenizer_path: str, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode and decode every text: number of tokens, digests of the ids and of the decoded text."""

    def open_task():
        coder = ForcedCoder(tokenizer_path, lambda ids, tokens: (len(ids), " ".join(map(str, ids)).encode(), " ".join(tokens).encode()))

        def work(columns: dict[str, pa.Array], texts: list[bytes]) -> list[pa.Array]:
            n, digests, decoded = [], [], []
            for own in coder.results(texts):
                n.append(sum([x[0] for x in own]))
                digests.append(hashlib.sha256(b" ".join([x[1] for x in own])).hexdigest())
                decoded.append(hashlib.sha256(b" ".join([x[2] for x in own])).hexdigest())
            return [pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]

        return work

    return map_texts(docs, text_col, ROUND_TRIP, open_task, list(carry))
