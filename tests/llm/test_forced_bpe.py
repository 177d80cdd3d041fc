import hashlib
import json
import random

import public_tokenizers
import pytest
from featuremill.llm import forced_bpe, queries
from odd import odd_docs, odd_rows, odd_tables
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = [
    " ", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "a", "b", "the", "don't", "'S", "'ll", "1", "42", "é", "é", "́", "你", "好世", "🙂", "👩‍👩‍👧", "!", "...",
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "Σ", "ß", "İ", "ſ", "ǅ", "ﬁ", "한", "ᄒ", "ᅡ", "ع", "\x00", "\x7f", "Ⅷ", "²", "_", "Ÿ", "ª", "µ", "×",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows():
    rng = random.Random(12)
    made = [(500 + i, "".join(rng.choices(PIECES, k=rng.randint(0, 40))), "en", "s", 0) for i in range(400)]
    return [*odd_rows(), *made]


def test_query_is_the_library(spark, library, tmp_path):
    made = queries.op12_forced_bpe(spark, odd_tables(spark, str(tmp_path), rows()))
    assert made.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for doc, text, *_ in rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted((tuple(r) for r in made.collect()), key=str) == sorted(want, key=str)


def test_random_scripts(library):
    rng = random.Random(4)
    ranges = [(32, 127), (0xA0, 0x180), (0x180, 0x500), (0x500, 0xD7FF), (0xE000, 0x1FFFF)]
    texts = ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(chr(rng.randrange(0x180)) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    # A small memory gives the same results.
    coder = forced_bpe.ForcedCoder(PATH, lambda ids, tokens: (ids, tokens), limit=50)
    for text, words in zip(texts, coder.results(t.encode() for t in texts), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert [i for own, _ in words for i in own] == ids
        assert " ".join(t for _, own in words for t in own) == library.decode(ids, skip_special_tokens=False)
    assert len(coder.known) < 200


def test_boundaries_are_pairs_that_no_token_holds():
    vocabulary = json.load(open(PATH))["model"]["vocab"]
    bounds = forced_bpe.Boundaries(vocabulary, "</w>")
    word = "ðŁĻĤæķĻthequickzqx"
    parts = bounds.fragments(word)
    assert "".join(parts) == word and len(parts) > 2
    at = 0
    for part in parts[:-1]:
        at += len(part)
        pair, ends = word[at - 1 : at + 1], at == len(word) - 1
        assert not any(pair in t.removesuffix("</w>") for t in vocabulary if not ends)
    assert forced_bpe.Boundaries(["ab</w>", "bc", "c"], "</w>").fragments("abcab") == ["a", "bc", "ab"]


def test_encode_and_decode(spark, library):
    made = forced_bpe.encode(odd_docs(spark), PATH)
    back = {}
    for r in forced_bpe.decode(made.withColumnRenamed("text", "before"), PATH).collect():
        assert r.ids == library.encode(r.before or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.text == library.decode(r.ids, skip_special_tokens=False)
        back[r.doc_id] = r.text
    assert len(back) == len({d for d, *_ in odd_rows()})
    bad = spark.createDataFrame([(1, [72, 10**6]), (2, None), (3, []), (4, [-1])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in forced_bpe.decode(bad, PATH).collect()} == {1: library.decode([72], skip_special_tokens=False), 2: None, 3: "", 4: ""}


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="word ends"):
        forced_bpe.ForcedCoder(public_tokenizers.path("byte_bpe_50k.json"), lambda ids, tokens: ids)


def test_bytes_that_are_no_text_and_empty_tables(spark, library):
    docs = spark.sql("SELECT 1 AS doc_id, CAST(X'61FF62C3' AS STRING) AS text")
    assert forced_bpe.encode(docs, PATH).first().ids == library.encode("a�b�", add_special_tokens=False).ids
    assert forced_bpe.encode(odd_docs(spark, []), PATH).count() == 0
