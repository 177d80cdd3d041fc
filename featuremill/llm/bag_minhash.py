"""Near-duplicate classes by BagMinHash signatures, banding and verified multiset overlap.

A text is the multiset of its shingles of five words (a shorter text: one shingle of all its words; words as in
``decontamination``). Two texts are linked if the weighted Jaccard similarity of their multisets, sum of minima over sum of
maxima, is at least ``similarity``; classes are the connected components of the links.

Signatures. A shingle with count c covers the discretised weights 0..c-1, split into the intervals [0,1), [1,2), [2,4), [4,8), ...
Each (shingle, interval) is a Poisson process over time with a rate proportional to the interval's length; its points fall on a
component and on a weight of the interval, and count where that weight is below c. A component's value is the time of its first
point. Equal processes give equal points, so two components agree with the probability of the weighted Jaccard similarity.
Only points up to a time at which all components are likely to have one are drawn, whatever the counts; where a component
has none, the text is drawn anew to twice that time. So no component is left open and none is approximate.

Links. Equal word sequences are one node. Nodes that share a band are candidates. Round one compares each node with the most
central node of its buckets (the one that shares buckets with most others; in a group of near copies, the text they come
from). Later rounds only look at buckets whose nodes are still in several components: all others with the most central node
of the bucket, then with nodes drawn by hash, and at last every pair across components that was not yet compared: of small
buckets as rows, of large ones in blocks, from which only near pairs come out. Texts that hold too much of their own to be
near any other leave before that, which is exact. So a large group of near copies costs about a comparison per member, and no
pair that could join two components goes untested. With ``bands`` 25 and ``rows`` 5, a
pair at similarity 0.8 shares no band with probability 5e-5.

Defined results: the class id is the smallest document id of the class; texts without words form a class by equal text, NULL
being empty; rows without an id take part and have the class of the others; rows with equal ids are separate rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.llm.common import byte_texts, staged
from featuremill.llm.decontamination import words

SHINGLE = 5
#: Rounds of one node per bucket against the others, before all pairs that are left.
PIVOT_ROUNDS = 2
#: Buckets of up to ``SMALL`` nodes give their pairs; larger ones are compared in blocks of about ``BLOCK`` nodes.
SMALL, BLOCK = 8, 128
_GOLD, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class ShingleHasher:
    """Multisets of shingle hashes, inside one task."""

    def __init__(self, limit: int = 500_000) -> None:
        self.of_word: dict[bytes, int] = {}
        self.limit = limit

    def multiset(self, own: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles and their counts."""
        memo = self.of_word
        for w in {x for x in own if x not in memo}:
            memo[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.fromiter(map(memo.__getitem__, own), np.uint64, len(own))
        if len(memo) > self.limit:
            memo.clear()
        width = min(SHINGLE, len(own))
        joint = np.full(len(own) - width + 1, width, np.uint64) if width else np.zeros(0, np.uint64)
        for i in range(width):
            joint = _mix(joint * _ODD + hashes[i : i + len(joint)])
        return np.unique(joint, return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """One row of ``m`` times for each non-empty multiset."""
    shingle = np.concatenate([s for s, _ in sets])
    count = np.concatenate([c for _, c in sets]).astype(np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
    total = np.bincount(owner, weights=count, minlength=len(sets))
    # Processes: interval 0 is [0, 1), interval j is [2^(j-1), 2^j).
    parts, level = [], 0
    alive = np.arange(len(shingle))
    while alive.size:
        start = 0 if level == 0 else 1 << (level - 1)
        alive = alive[count[alive] > start]
        parts.append((alive, np.full(len(alive), level), np.full(len(alive), start), np.full(len(alive), max(1, start))))
        level += 1
    element, levels, starts, lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
    seed = _mix(shingle[element] + levels.astype(np.uint64) * _GOLD)
    below, of = count[element] - starts, owner[element]
    horizon = (np.log(m) + 3.0) / total
    first = np.full(len(sets) * m, np.inf)
    open_ = np.ones(len(sets), bool)
    with np.errstate(over="ignore"):
        while open_.any():
            at = np.flatnonzero(open_[of])
            time, k = np.zeros(len(at)), 0
            while at.size:
                k += 1
                bits = _mix(seed[at] + np.uint64(k) * _GOLD)
                time = time - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (m * lengths[at])
                live = time <= horizon[of[at]]
                at, time, bits = at[live], time[live], _mix(bits[live] ^ _ODD)
                component = ((bits >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
                place = ((bits & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * lengths[at]).astype(np.int64)
                hit = place < below[at]
                np.minimum.at(first, of[at[hit]] * m + component[hit].astype(np.int64), time[hit])
            open_ = np.isinf(first.reshape(len(sets), m)).any(1)
            horizon = np.where(open_, horizon * 2, horizon)
    return first.reshape(len(sets), m)


def band_hashes(times: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band of each signature."""
    bits = times.view(np.uint64).reshape(len(times), bands, rows)
    made = np.broadcast_to(_mix(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD), (len(times), bands))
    for i in range(rows):
        made = _mix((made * _ODD) ^ bits[:, :, i])
    return made.view(np.int64)


def _signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc, th, key, n_shingles, bands): the key is a digest of the word sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher()
        for batch in batches:
            keys, sizes, hashes, pending, elements = [], [], [None] * batch.num_rows, [], 0

            def sign(pending: list, hashes: list) -> None:
                made = band_hashes(signatures([s for _, s in pending], bands * rows), bands, rows) if pending else ()
                for (i, _), row in zip(pending, made, strict=True):
                    hashes[i] = row.tolist()

            for i, text in enumerate(byte_texts(batch.column(2))):
                own = words(text)
                keys.append(xxhash.xxh3_128_digest(b" ".join(own) if own else b"\0" + text))
                sizes.append(max(1, len(own) - SHINGLE + 1) if own else 0)
                if own:
                    pending.append((i, hasher.multiset(own)))
                    elements += len(pending[-1][1][0])
                    if elements > 500_000:
                        sign(pending, hashes)
                        pending, elements = [], 0
            sign(pending, hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))],
                names=["doc", "th", "key", "n_shingles", "bands"],
            )

    return docs.mapInArrow(run, "doc long, th long, key binary, n_shingles long, bands array<long>")


def multiset_jaccard(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two texts with words."""

    def bag(text: bytes) -> Counter:
        own = words(text)
        return Counter(zip(*(own[i:] for i in range(min(SHINGLE, len(own)))), strict=False))

    x, y = bag(a), bag(b)
    least = sum(min(n, y[s]) for s, n in x.items() if s in y)
    return least / max(1, x.total() + y.total() - least)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) that are similar enough."""
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"), F.col("n_shingles").alias("n_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"), F.col("n_shingles").alias("n_b"))
    sizes = [texts.select(F.col("key").alias(k), F.col("n_shingles").alias(f"n_{k}")) for k in "ab"]
    # Sizes alone rule out many pairs: the overlap is at most the smaller one.
    likely = pairs.join(sizes[0], "a").join(sizes[1], "b").filter(F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b")).select("a", "b")
    joined = likely.join(left.drop("n_a"), "a").join(right.drop("n_b"), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [multiset_jaccard(x, y) >= similarity for x, y in zip(byte_texts(batch.column(2)), byte_texts(batch.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(near, pa.bool_())), batch.column(1).filter(pa.array(near, pa.bool_()))], names=["a", "b"])

    return joined.mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(key, root) of every node of the edges (a, b); the root is the smallest key.

    Every node hooks on to its smallest neighbour, and the edges are drawn between what is left, until none are.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    labels = staged(edges.select(F.explode(F.array("a", "b")).alias("key")).distinct().withColumn("root", F.col("key")), "labels")
    while not edges.isEmpty():
        hooks = staged(edges.groupBy("a").agg(F.min("b").alias("to")), "hooks")
        labels = staged(labels.join(hooks, labels["root"] == hooks["a"], "left").select("key", F.coalesce("to", "root").alias("root")), "labels")
        for end in ("a", "b"):
            up = hooks.select(F.col("a").alias("_at"), F.col("to").alias("_to"))
            edges = edges.join(up, edges[end] == up["_at"], "left").withColumn(end, F.coalesce("_to", end)).drop("_at", "_to")
        edges = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    return labels


@contextmanager
def few_rows_a_batch(spark: SparkSession, rows: int = 4) -> Iterator[None]:
    """While a job runs whose rows are large: few of them in an Arrow batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _rooted(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Buckets that still hold several components, with the component of each node."""
    rooted = shared.join(labels, "key", "left").withColumn("root", F.coalesce("root", "key"))
    open_ = rooted.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("bucket")
    return rooted.join(open_, "bucket")


def _pivot_pairs(rooted: DataFrame, draw: int = 0) -> DataFrame:
    """One node of each bucket, the most central or with ``draw`` another one, with the nodes of other components."""
    rank = F.xxhash64("key", "bucket", F.lit(draw)) if draw else F.col("central")
    best = F.max(F.struct(rank.alias("rank"), "key", "root")).alias("best")
    pivots = rooted.groupBy("bucket").agg(best).select("bucket", F.col("best.key").alias("pivot"), F.col("best.root").alias("pivot_root"))
    pairs = rooted.join(pivots, "bucket").filter("root <> pivot_root")
    return pairs.select(F.greatest("key", "pivot").alias("a"), F.least("key", "pivot").alias("b")).distinct()


def _all_pairs(rooted: DataFrame) -> DataFrame:
    """Every pair inside a bucket, between different components; for buckets of bounded size."""
    two = rooted.select("bucket", F.col("key").alias("b"), F.col("root").alias("root_b"))
    return rooted.join(two, "bucket").filter("root <> root_b and key > b").select(F.col("key").alias("a"), "b").distinct()


def _near_in_blocks(rooted: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of large buckets that are near, between different components; only these leave a task.

    The nodes of a bucket are dealt to blocks of about ``BLOCK``, and every two blocks are one row, compared as a matrix. A
    pair that shares several buckets is compared in the first of them.
    """
    count = F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")
    placed = rooted.join(rooted.groupBy("bucket").agg(count), "bucket").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    whole = placed.join(texts.select("key", "text").join(nodes.select("key", "bands"), "key"), "key")
    members = F.collect_list(F.struct("key", "root", "bands", "text")).alias("members")
    blocks = staged(whole.groupBy("bucket", "block").agg(members), "blocks")
    other = blocks.select("bucket", F.col("block").alias("block_b"), F.col("members").alias("members_b"))
    joined = blocks.join(other, "bucket").filter("block <= block_b").select("bucket", "members", "members_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher()
        for batch in batches:
            for bucket, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = near_pairs(hasher, bucket, left, right, similarity)
                ends = [pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    return joined.mapInArrow(run, "a binary, b binary")


def near_pairs(hasher: ShingleHasher, bucket: int, left: list[dict], right: list[dict], similarity: float) -> list[tuple[bytes, bytes]]:
    """Pairs (a, b), a > b, of two blocks whose first common bucket is this one."""
    keys = [[bytes(x["key"]) for x in side] for side in (left, right)]
    bands = [np.array([x["bands"] for x in side], np.int64) for side in (left, right)]
    rank = {k: i for i, k in enumerate(sorted({*keys[0], *keys[1]}))}
    order = [np.array([rank[k] for k in side]) for side in keys]
    names: dict[bytes, int] = {}
    roots = [np.array([names.setdefault(bytes(x["root"]), len(names)) for x in side]) for side in (left, right)]
    same = bands[0][:, None, :] == bands[1][None, :, :]
    first = np.take_along_axis(np.broadcast_to(bands[0][:, None, :], same.shape), same.argmax(2)[:, :, None], 2)[:, :, 0]
    # Two different blocks hold different nodes; a block with itself has every pair twice.
    wanted = same.any(2) & (first == bucket) & (roots[0][:, None] != roots[1][None, :])
    if keys[0] == keys[1]:
        wanted &= order[0][:, None] > order[1][None, :]
    if not wanted.any():
        return []
    owner, tokens, sizes = [], [], []
    for i, x in enumerate([*left, *right]):
        shingles, counts = hasher.multiset(words(x["text"].encode()))
        # The k-th occurrence of a shingle is a token of its own: overlaps of multisets become overlaps of sets.
        level = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        tokens.append(_mix(np.repeat(shingles, counts) + level.astype(np.uint64) * _GOLD))
        owner.append(np.full(len(tokens[-1]), i))
        sizes.append(len(tokens[-1]))
    held, which, times = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    which, owners, shared = which.ravel(), np.concatenate(owner), times > 1
    column = np.cumsum(shared) - 1
    keep = shared[which]
    which, owners, width = column[which[keep]], owners[keep], int(shared.sum())
    overlap = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, width, 20_000):
        here = (which >= at) & (which < at + 20_000)
        table = np.zeros((len(left) + len(right), min(20_000, width - at)), np.float32)
        table[owners[here], which[here] - at] = 1
        overlap += table[: len(left)] @ table[len(left) :].T
    total = np.array(sizes, np.float64)
    joint = total[: len(left), None] + total[None, len(left) :] - overlap
    near = np.argwhere(wanted & (overlap >= similarity * joint - 1e-6))
    return [tuple(sorted((keys[0][i], keys[1][j]), reverse=True)) for i, j in near]


def _linkable(texts: DataFrame, similarity: float) -> DataFrame:
    """Keys of texts of which enough is shared with any other one.

    What no other text holds is in the union with each and in no overlap: where it is more than 1 - ``similarity`` of a
    text, the text has no link.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher()
        for batch in batches:
            for key, text in zip(batch.column(0), byte_texts(batch.column(1)), strict=True):
                shingles, counts = hasher.multiset(words(text))
                keys = pa.array([key.as_py()] * len(shingles), pa.binary())
                yield pa.RecordBatch.from_arrays([keys, pa.array(shingles.view(np.int64)), pa.array(counts.astype(np.int64))], names=["key", "shingle", "n"])

    found = texts.select("key", "text").mapInArrow(run, "key binary, shingle long, n long")
    lone = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders"), F.first("key").alias("key"), F.first("n").alias("n")).filter("holders = 1")
    alone = lone.groupBy("key").agg(F.sum("n").alias("alone"))
    rest = F.col("n_shingles") - F.coalesce("alone", F.lit(0))
    return texts.select("key", "n_shingles").join(alone, "key", "left").filter(rest >= similarity * F.col("n_shingles")).select("key")


def near_duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, bands: int = 25, rows: int = 5
) -> DataFrame:
    """(doc, th, class_id, class_th, class_size) of every row.

    ``th`` is ``xxhash64`` of the text; (class_id, class_th) is the smallest (doc, th) of the class.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    signed = staged(_signed(source, bands, rows), "signatures")
    nodes = staged(
        signed.filter("n_shingles > 0").groupBy("key").agg(F.min(F.struct("doc", "th")).alias("rep"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles")), "nodes"
    )
    buckets = nodes.select(F.explode("bands").alias("bucket"), "key")
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = staged(buckets.join(sizes, "bucket"), "buckets")
    # A node is the more central, the more nodes it shares buckets with.
    central = shared.groupBy("key").agg(F.sum(F.col("n") - 1).alias("central"))
    shared = staged(shared.select("bucket", "key").join(central, "key"), "ranked-buckets")

    reps = nodes.select("key", "rep", "n_shingles").join(shared.select("key").distinct(), "key", "left_semi").select("key", "n_shingles", F.col("rep.doc").alias("rep_doc"), F.col("rep.th").alias("rep_th"))
    same = source["doc"].eqNullSafe(reps["rep_doc"]) & (source["th"] == reps["rep_th"])
    # Repeated rows of one id and text have one key; one of them is enough.
    texts = staged(source.join(reps, same).select("key", "n_shingles", "text").dropDuplicates(["key"]), "candidate-texts")

    rank = F.struct("central", "key")
    pivots = shared.groupBy("bucket").agg(F.max(rank).alias("pivot"))
    best = shared.join(pivots, "bucket").filter("pivot.key <> key").groupBy("key").agg(F.max("pivot").alias("pivot"))
    pairs = staged(best.select(F.greatest("key", "pivot.key").alias("a"), F.least("key", "pivot.key").alias("b")).distinct(), "pairs")
    tested, edges = pairs, staged(_verified(pairs, texts, similarity), "links")
    labels = components(edges)
    for draw in range(PIVOT_ROUNDS + 1):
        rooted = _rooted(shared, labels)
        if draw == 1:
            open_texts = texts.join(rooted.select("key").distinct(), "key", "left_semi")
            shared = staged(shared.join(_linkable(open_texts, similarity), "key", "left_semi"), "open-buckets")
            rooted = _rooted(shared, labels)
        if draw < PIVOT_ROUNDS:
            pairs = _pivot_pairs(rooted, draw)
        else:
            sized = rooted.join(rooted.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "bucket")
            large = staged(sized.filter(F.col("n") > SMALL).drop("n"), "large-buckets")
            pairs = _all_pairs(sized.filter(F.col("n") <= SMALL).drop("n"))
            if not large.isEmpty():
                with few_rows_a_batch(texts.sparkSession):
                    pairs = pairs.unionByName(staged(_near_in_blocks(large, nodes, texts, similarity), "near")).distinct()
        pairs = staged(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            links = staged(_verified(pairs, texts, similarity), "links")
            tested = tested.unionByName(pairs)
            if not links.isEmpty():
                edges = edges.unionByName(links)
                labels = components(edges)

    rooted = signed.select("doc", "th", "key").join(labels, "key", "left").select("doc", "th", F.coalesce("root", "key").alias("root"))
    # The smallest id that is not NULL stands for the class.
    least = F.min_by(F.struct("doc", "th"), F.struct(F.col("doc").isNull(), "doc", "th")).alias("least")
    classes = rooted.groupBy("root").agg(least, F.count(F.lit(1)).alias("class_size"))
    return rooted.join(classes, "root").select(
        "doc", "th", F.col("least.doc").alias("class_id"), F.col("least.th").alias("class_th"), "class_size"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The row of each class with the smallest (id, text hash), with its own columns; of repeated rows, one."""
    classes = near_duplicate_classes(docs, id_col, text_col, **settings)
    kept = classes.filter(F.col("doc").eqNullSafe(F.col("class_id")) & (F.col("th") == F.col("class_th"))).select("doc", "th").distinct()
    marked = docs.withColumn("_doc", F.col(id_col).cast("long")).withColumn("_th", F.xxhash64(text_col))
    same = marked["_doc"].eqNullSafe(kept["doc"]) & (marked["_th"] == kept["th"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["_doc", "_th"]).select(*docs.columns)
