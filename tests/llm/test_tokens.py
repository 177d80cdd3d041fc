import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from featuremill.llm import byte_bpe, token_cache
from featuremill.llm.common import shared_path
from featuremill.llm.units import cut
from odd import odd_docs, odd_rows
from tokenizers import Tokenizer

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocab():
    return byte_bpe.vocabulary(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(text):
    return hashlib.sha256(text).hexdigest()


def test_round_trip_of_odd_rows(spark, vocab, reference):
    made = sorted((tuple(r) for r in byte_bpe.round_trip(odd_docs(spark), vocab).collect()), key=str)
    want = []
    for doc, text, *_ in odd_rows():
        ids = reference.encode_ordinary(text or "")
        want.append((doc, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode()), True))
    assert made == sorted(want, key=str)


def test_random_spaces_and_scripts(vocab, reference):
    rng = random.Random(4)
    alphabet = [" ", " ", " ", "\n", "\t", " ", " ", "\x1c", "\x85", "a", "b", "don't", "1", "42", "é", "你", "🙂", "!", "...", "'s", "<|endoftext|>"]
    coder = byte_bpe.Coder(vocab)
    memo = coder.memo(list)
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(3000)]
    for text, units in zip(texts, memo.results(texts), strict=True):
        ids = [i for u in units for i in u]
        assert ids == reference.encode_ordinary(text)
        assert coder.decode(ids).decode() == text
        head, rest = cut(text)
        assert " ".join([head, *rest]) == text


def test_encode_offsets_and_decode(spark, vocab):
    made = byte_bpe.encode(odd_docs(spark), vocab, check=True)
    rows = byte_bpe.decode(made.withColumnRenamed("text", "before"), vocab).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r.text == (r.before or "") and r.decodes and r.n_tokens == len(r.ids) == len(r.char_starts)
        assert r.char_starts == sorted(r.char_starts) and all(0 <= x < len(r.text) for x in r.char_starts)


def test_decode_of_bad_ids(spark, vocab):
    docs = spark.createDataFrame([(1, [72, 10**6]), (2, None), (3, []), (4, [-1])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in byte_bpe.decode(docs, vocab).collect()} == {1: None, 2: None, 3: "", 4: None}


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_odd_rows(spark, file):
    path = public_tokenizers.path(file)
    if file.endswith(".model"):
        import sentencepiece

        one = lambda t, m=sentencepiece.SentencePieceProcessor(model_file=path): len(m.encode(t))
    else:
        one = lambda t, m=Tokenizer.from_file(path): len(m.encode(t, add_special_tokens=False).ids)
    cache = shared_path(spark, "cache")
    rows = [r for r in odd_rows() if r[0] != 17 or file == "byte_bpe_50k.json"]
    made = token_cache.count_tokens(odd_docs(spark, rows), cache, path).collect()
    want = sorted(((d, len((t or "").encode()), one(t or "")) for d, t, *_ in rows), key=str)
    assert sorted((tuple(r) for r in made), key=str) == want


def test_cache_is_used_and_extended(spark):
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), shared_path(spark, "cache")
    token_cache.count_tokens(odd_docs(spark), cache, path).collect()
    first = token_cache.read_cache(spark, cache).count()
    assert first == len({t or "" for _, t, *_ in odd_rows()})
    token_cache.count_tokens(odd_docs(spark, [*odd_rows(), (99, "a new text", None, None, 0)]), cache, path).collect()
    assert spark.read.parquet(cache).count() == first + 1
    # A count in the cache is taken as it is.
    forged = spark.createDataFrame([(token_cache.tokenizer_digest(path), bytearray(hashlib.sha256(b"forged").digest()), 12345)], token_cache.CACHE_SCHEMA)
    forged.write.mode("append").parquet(cache)
    assert token_cache.count_tokens(odd_docs(spark, [(1, "forged", None, None, 0)]), cache, path).first().n_tokens == 12345


def test_empty_table(spark, vocab):
    assert token_cache.count_tokens(odd_docs(spark, []), shared_path(spark, "cache"), public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert byte_bpe.round_trip(odd_docs(spark, []), vocab).count() == 0
