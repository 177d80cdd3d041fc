"""BM25 per (query, item, field) as joins and aggregations over a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.operators.skew import salted_join

# Fixed values of the scoring formula.
BM25_K1 = 1.2
BM25_B = 0.5


def tokens(col: Column) -> Column:
    """Lower-case words of a text, in order, repeats kept."""
    return F.filter(F.split(F.lower(col), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def bm25_idf(n_docs: Column, n_with_term: Column) -> Column:
    return F.log(
        F.lit(1.0) + (n_docs - n_with_term + F.lit(0.5)) / (n_with_term + F.lit(0.5))
    )


def bm25_tf(freq: Column, length: Column, avg_length: Column, k1: float = BM25_K1, b: float = BM25_B) -> Column:
    return freq / (freq + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * length / avg_length))


def field_scores(
    corpus: DataFrame, candidates: DataFrame, item: str, fields: list[str], query: str = "query"
) -> DataFrame:
    """(query, item, field, term, score) for the given candidate pairs.

    Corpus statistics (documents with the term, number of documents, mean
    length) come from aggregations over the whole corpus. Pairs are never
    invented: the candidates are exploded into query terms and hash-joined to
    the postings on (item, term), so work grows with candidates x query length.
    Both join keys include the item, so a very common term is spread over all
    items that contain it.
    """
    long = corpus.select(
        item,
        F.explode(
            F.array(*[F.struct(F.lit(f).alias("field"), tokens(F.col(f)).alias("words")) for f in fields])
        ).alias("f"),
    ).select(item, "f.field", "f.words")
    # Statistics per field are a map with one entry per given field, read as a scalar.
    per_field = (
        long.select("field", F.size("words").alias("length")).where("length > 0").groupBy("field").agg(
            F.struct(
                F.count(F.lit(1)).alias("n_docs"),
                (F.sum("length").cast("double") / F.count(F.lit(1))).alias("avg_length"),
            ).alias("s")
        )
    )
    stats = per_field.select(F.map_from_entries(F.collect_list(F.struct("field", "s")))).scalar()
    postings = (
        long.select(item, "field", F.size("words").alias("length"), F.explode("words").alias("term"))
        .groupBy(item, "field", "term")
        .agg(F.count(F.lit(1)).alias("freq"), F.first("length").alias("length"))
    )
    term_stats = postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("n_with_term"))

    terms = candidates.select(
        query, item, F.explode(F.array_distinct(tokens(F.col(query)))).alias("term")
    )
    found = terms.join(postings, [item, "term"])
    # A common term has very many rows and one row of statistics.
    rated = salted_join(found, term_stats, ["field", "term"], spread_by=[query, item])
    of_field = F.element_at(stats, F.col("field"))
    return rated.select(
        query,
        item,
        "field",
        "term",
        (
            bm25_idf(of_field["n_docs"], F.col("n_with_term"))
            * bm25_tf(F.col("freq"), F.col("length"), of_field["avg_length"])
        ).alias("score"),
    )
