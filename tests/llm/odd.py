"""Rows that every operator must take: NULLs, empty and long texts, ties, repeats, clashing extra columns."""

import random
import re

from pyspark.sql import SparkSession

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns named like results or inner columns of the operators.
CLASHES = ("n_words", "score", "items", "hit_spans", "h", "doc", "th", "key", "row", "shard", "slot", "digest", "class_id", "ids", "_quality", "n_lines", "keep", "id")
LINE = "this line of prose is long enough to be a key for sure"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice(["ka", "lo", "mi", "ter", "sun", "ba"]) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") + ("\n" if i % 40 == 39 else "") for i, w in enumerate(made)).replace("\n ", "\n")


def odd_rows() -> list[tuple]:
    copy = prose(1, 120)
    near = copy.split(" ")
    near[60] = "changed"
    texts = [
        None, "", "   \n\t\n ", "!!! ??? ***", "word", "two words", copy, copy, " ".join(near), prose(2, 30_000),
        f"{LINE}\n" * 3 + prose(3, 60), "\n".join([LINE.upper(), prose(4, 50)]), f"  {LINE}\t\n{prose(5, 40)}", f"{LINE}\nx", f"{LINE}", f"y\n{LINE}\r\n",
        "Ünïcödé wörds — “quoted” 你好世界 🙂👩‍👩‍👧 naïve space wide \x1c odd", "a" * 70_000, "the the the the " * 50, "<|endoftext|> inside  two  spaces \n\n end ",
    ]
    rows = [(i, t, ("en", "de", None)[i % 3], "src0", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[6], (6, "same id, other text", None, None, None), (None, copy, None, None, None), (None, LINE + "\nz", "en", "s", 1)]


def odd_docs(spark: SparkSession, rows: list[tuple] | None = None, clashes: bool = True):
    docs = spark.createDataFrame(odd_rows() if rows is None else rows, COLUMNS).repartition(3)
    if clashes:
        from pyspark.sql import functions as F

        docs = docs.withColumns({c: F.lit("clash") for c in CLASHES})
    return docs


def folded_words(text: str | None) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def spaced_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def odd_tables(spark: SparkSession, base: str, rows: list[tuple] | None = None) -> str:
    """A folder with a documents table of odd rows, for the registered queries."""
    odd_docs(spark, rows, clashes=False).write.parquet(f"{base}/documents.parquet")
    return base
