"""Shards of near-equal bytes by Karmarkar-Karp differencing; equal texts stay together.

A partial partition is a list of ``shards`` sums. The two with the largest spread (largest less smallest sum) are combined in
opposite order, largest to smallest, until one is left; reading the combinations backwards gives every group its shard.

On Spark, groups of equal texts are dealt to blocks by digest. A task differences one block into one partial partition; these
are differenced again, ``fan_in`` at a time, until one is left, so no task holds more than a block or ``fan_in`` partial
partitions. A hot group is one item with a large size, whatever its number of rows; groups too large for a block come first,
and the blocks are filled against them. Slots are numbered inside bounded
slices of a shard and shifted by the counts of earlier slices.

Defined results: the size of a row is its UTF-8 bytes plus 1; NULL and empty texts are one group of size 1 a row; a group larger
than an even share fills a shard by itself and the others are balanced around it; rows with equal ids are separate rows with
slots of their own.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.llm.common import staged
from featuremill.operators.rows import sliced_row_number


def difference(parts: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Partial partitions (one list of sums each) to the joint sums, and for each its sums' places in them.

    Places are by the order of the sums given: ``places[i][j]`` is where sum j of part i ended up.
    """
    k = len(parts[0])
    nodes: list[tuple] = []  # (sums ascending, left, right, order of the combined sums) or (sums, -1, -1, order of own sums)
    heap: list[tuple[int, int]] = []
    for sums in parts:
        order = sorted(range(k), key=sums.__getitem__)
        nodes.append(([sums[i] for i in order], -1, -1, order))
        heap.append((sums[order[0]] - sums[order[-1]], len(nodes) - 1))
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        joint = [x + y for x, y in zip(nodes[a][0], reversed(nodes[b][0]), strict=True)]
        order = sorted(range(k), key=joint.__getitem__)
        nodes.append(([joint[i] for i in order], a, b, order))
        heapq.heappush(heap, (joint[order[0]] - joint[order[-1]], len(nodes) - 1))
    labels: list = [None] * len(nodes)
    labels[-1] = list(range(k))
    places: list[list[int]] = [[]] * len(parts)
    for at in range(len(nodes) - 1, -1, -1):
        _, a, b, order = nodes[at]
        own, labels[at] = labels[at], None
        if a < 0:
            back = [0] * k
            for label, j in zip(own, order, strict=True):
                back[j] = label
            places[at] = back
            continue
        left, right = [0] * k, [0] * k
        for label, i in zip(own, order, strict=True):
            left[i], right[k - 1 - i] = label, label
        labels[a], labels[b] = left, right
    return list(nodes[-1][0]), places


def _blocks(n: int, most: int) -> int:
    return max(1, -(-n // most))


def group_shards(groups: DataFrame, shards: int, block_groups: int = 50_000, fan_in: int = 512) -> DataFrame:
    """(digest, size) to (digest, shard).

    A group above a block's even share cannot be balanced inside a block. Such groups, at most ``shards`` for each block, are
    placed first by the same means; every block then begins with its part of their sums and fills up against them.
    """
    found = groups.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total")).first()
    n_blocks = _blocks(found.n, block_groups)
    large = None
    if n_blocks > 1:
        share = found.total // (shards * n_blocks)
        if not groups.filter(F.col("size") > share).isEmpty():
            large = staged(group_shards(groups.filter(F.col("size") > share), shards, block_groups, fan_in).join(groups, "digest"), "shard-large")
            groups = groups.filter(F.col("size") <= share)
    sums = {r.shard: r.total for r in large.groupBy("shard").agg(F.sum("size").alias("total")).collect()} if large else {}

    def leaf_block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "digest"], ascending=[False, True], kind="stable")
        given = [sums.get(j, 0) // n_blocks for j in range(shards)]
        _, places = difference([given, *([0] * (shards - 1) + [int(s)] for s in rows["size"])])
        # Parts are named by the shard of the given sums that they hold.
        name = {p: j for j, p in enumerate(places[0])}
        return pd.DataFrame({"unit": rows["unit"], "digest": rows["digest"], "size": rows["size"], "part": [name[p[-1]] for p in places[1:]]})

    def joint_block(rows: pd.DataFrame) -> pd.DataFrame:
        table = rows.pivot_table(index="unit", columns="part", values="size", aggfunc="sum", fill_value=0).reindex(columns=range(shards), fill_value=0)
        _, places = difference([[int(x) for x in r] for r in table.to_numpy()])
        made = [(rows["parent"].iloc[0], unit, j, p, int(table.loc[unit, j])) for unit, own in zip(table.index, places, strict=True) for j, p in enumerate(own)]
        return pd.DataFrame(made, columns=["parent", "unit", "part", "to", "size"])

    unit = F.pmod(F.xxhash64("digest"), F.lit(n_blocks)).alias("unit")
    leaves = staged(
        groups.select(unit, "digest", "size").groupBy("unit").applyInPandas(leaf_block, "unit long, digest binary, size long, part int"), "shard-groups"
    )
    if large:
        return leaves.select("digest", F.col("part").alias("shard")).unionByName(large.select("digest", "shard"))
    placed, parts, n = leaves.select("digest", "unit", "part"), leaves.groupBy("unit", "part").agg(F.sum("size").alias("size")), n_blocks
    while True:
        n_next = _blocks(n, fan_in)
        joint = staged(
            parts.withColumn("parent", F.pmod("unit", F.lit(n_next))).groupBy("parent").applyInPandas(joint_block, "parent long, unit long, part int, to int, size long"),
            "shard-sums",
        )
        # At most ``shards`` rows per block: small beside the groups, and joined by its measured size.
        placed = placed.join(joint.select("unit", "part", "parent", "to"), ["unit", "part"]).select("digest", F.col("parent").alias("unit"), F.col("to").alias("part"))
        if n_next == 1:
            return placed.select("digest", F.col("part").alias("shard"))
        parts, n = joint.groupBy(F.col("parent").alias("unit"), F.col("to").alias("part")).agg(F.sum("size").alias("size")), n_next


def shard_documents(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", block_groups: int = 50_000, fan_in: int = 512, slice_rows: int = 20_000
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(
        docs.select(
            F.col(id_col).alias("doc"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    placed = staged(rows.join(group_shards(groups, shards, block_groups, fan_in), "digest"), "shard-placed")
    slices = _blocks(placed.count(), slice_rows * shards)
    cell = F.pmod(F.xxhash64("doc", "digest"), F.lit(slices))
    slotted = sliced_row_number(placed, ["shard"], cell, [F.col("doc"), F.col("digest")], "slot")
    return slotted.select(F.col("doc").alias(id_col), "size", "text_crc32", "shard", (F.col("slot") - 1).cast("long").alias("slot"))
