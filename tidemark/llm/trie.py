"""Prefix trie of conversations: which turns they share from the start, and what sharing them saves.

A turn's id is the first 16 bytes of the SHA-256 of its role and text. A conversation is its ids in a row; all are
ranged by that key and their id, so that each shard is one radix tree of bounded size, whatever prefix or whole
conversation is how frequent. Only nodes on the paths of a shard's first and last key can reach into other shards; they
are summed up across shards, and what lies below them by doubling the distance to their ancestors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .radix import Tree, trie_nodes

WIDTH = 16

#: Turns in a shard.
SHARD_TURNS = 100_000

#: Nodes shared between shards are broadcast up to this number; beyond it the join is shuffled.
BROADCAST_ROWS = 200_000

COUNTS = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")
CLOSED, OPEN, ENDS = range(3)
PARTS = pa.schema(
    [("kind", pa.int8()), ("node", pa.binary()), ("parent_node", pa.binary()), ("parent_conv_id", pa.int64())]
    + [(c, pa.int64()) for c in COUNTS]
    + [("size", pa.int64()), ("ends", pa.binary())]
)
PARTS_DDL = "kind byte, node binary, parent_node binary, parent_conv_id long, %s long, size long, ends binary" % " long, ".join(COUNTS)


def turn_id(role: Column, text: Column) -> Column:
    """Fixed-width id of a turn; the role's length keeps role and text apart."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, WIDTH)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id and its turns [id, bytes] in order of turn (NULL first), then role, then text; repeated rows are turns too.

    NULL roles and texts are empty. Rows without a conv_id belong to no conversation. Texts are sorted on disk and
    dropped before a conversation is gathered: a task holds 24 bytes for each of its turns.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = rows.withColumn("place", F.row_number().over(order)).select(
        "conv_id", F.struct("place", turn_id(F.col("role"), F.col("text")).alias("id"), F.octet_length("text").cast("long").alias("bytes")).alias("t")
    )
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return gathered.select("conv_id", F.transform("t", lambda t: F.struct(t["id"], t["bytes"])).alias("turns"))


def _prefixes(key: bytes) -> list[bytes]:
    """Digest of every turn-aligned prefix."""
    running, out = hashlib.sha256(), []
    for at in range(0, len(key) + 1, WIDTH):
        out.append(running.digest()[:WIDTH])
        running.update(key[at : at + WIDTH])
    return out


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Closed nodes, parts of open nodes, and the ids that end at open nodes, of one shard in order of key and id."""
    tree, ids, sizes, first, last = Tree(), [], [], b"", b""
    for batch in batches:
        bytes_ = batch.column(2)
        flat = bytes_.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = (bytes_.offsets.to_numpy() - bytes_.offsets[0].as_py()).tolist()
        for k, (conv, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            tree.insert(key, len(ids))
            first, last = (first if ids else key), key
            ids.append(conv)
            sizes.append(flat[cuts[k] : cuts[k + 1]])
    if not ids:
        return
    nodes = trie_nodes(tree, ids, sizes, WIDTH)
    del tree
    paths = {True: _prefixes(first), False: _prefixes(last)}

    def key_of(node):
        return paths[node.on_first][node.depth]

    for at in range(0, len(nodes), 50_000):
        rows = []
        for node in nodes[at : at + 50_000]:
            parent = None if node.parent is None else nodes[node.parent]
            ends = ",".join(map(str, sorted(ids[r] for r in node.rows)))
            counts = (node.least, node.depth, node.n, node.children, node.leaves, node.saved)
            if node.open:
                up = paths[node.on_first][node.depth - 1] if node.depth else None
                rows.append((OPEN, key_of(node), up, None, *counts, node.size, None))
                if node.rows:
                    rows.append((ENDS, key_of(node), None, None, ids[node.rows[0]], *[None] * 6, ends.encode()))
            else:
                digest = hashlib.sha256(ends.encode()).hexdigest().encode()
                rows.append((CLOSED, None, key_of(parent) if parent.open else None, parent.least, *counts, node.size, digest))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PARTS)], schema=PARTS)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the pieces of each node, which come one after the other; holds one piece at a time."""
    node, running, done = None, None, []
    for batch in batches:
        for n, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if n == node:
                running.update(b"," + piece)
            else:
                if node is not None:
                    done.append((node, running.hexdigest()))
                node, running = n, hashlib.sha256(piece)
    if node is not None:
        done.append((node, running.hexdigest()))
        names, hashes = zip(*done)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(hashes)], ["node", "ends_sha256"])


def _summed(parts: DataFrame) -> DataFrame:
    """Open nodes over all shards: node, its counts, parent_conv_id."""
    merged = parts.where(F.col("kind") == OPEN).groupBy("node").agg(
        F.first("parent_node").alias("parent_node"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.first("size").alias("size"), *[F.sum(c).alias(c) for c in COUNTS[2:]],
    )
    merged = stored(merged, "open-nodes")
    below = merged.groupBy(F.col("parent_node").alias("node")).agg(F.count("*").alias("open_children"))
    nodes = merged.join(below, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0)))
    state = stored(nodes.select(
        "node", F.col("parent_node").alias("up"), (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")), "open-state")
    distance, deepest = 1, merged.agg(F.max("depth")).first()[0] or 0
    while distance <= deepest:
        # Each node holds the sum over all nodes less than ``distance`` below it; ``up`` is the ancestor that far above.
        sums = state.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        onward = state.select(F.col("node").alias("up"), F.col("up").alias("next"))
        state = stored(state.join(sums, "node", "left").join(onward, "up", "left").select(
            "node", F.col("next").alias("up"), (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens")), "open-state")
        distance *= 2
    parents = merged.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("parent_conv_id"))
    kept = nodes.drop("n_leaves", "saved_tokens").join(state.drop("up"), "node").join(parents, "parent_node", "left")
    return kept.select("node", *COUNTS, "parent_conv_id")


def prefix_trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``convs`` has one row per conversation: conv_id and turns [id, bytes] in order (see ``ordered_turns``). A node is
    a distinct sequence of first turns; conv_id is its least member, saved_tokens sums (n_convs - 1) * bytes of the last
    turn over its subtree, ends_sha256 hashes the ids of the conversations that end at it. Conversations without turns
    belong to the root alone; a NULL turns is no turns. NULL ids are left out; an empty table gives no node at all. Other
    columns are ignored. A repeated conv_id counts as often as it comes.
    """
    spark = convs.sparkSession
    turns = F.coalesce("turns", F.expr("cast(array() as array<struct<id:binary,bytes:bigint>>)"))
    key = F.unhex(F.array_join(F.transform(turns, lambda t: F.hex(t["id"])), ""))
    keyed = stored(convs.where("conv_id IS NOT NULL").select("conv_id", key.alias("key"), F.transform(turns, lambda t: t["bytes"]).alias("sizes")), "keys")
    total = keyed.agg(F.sum(F.length("key") / WIDTH + 1)).first()[0] or 0
    shards = int(total // shard_turns) + 1
    ranged = keyed.repartitionByRange(shards, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = stored(ranged.mapInArrow(_shard, PARTS_DDL), "trie-parts")
    summed = stored(_summed(parts), "open-summed")
    pieces = parts.where(F.col("kind") == ENDS).select("node", "conv_id", "ends")
    hashes = pieces.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(_hashed, "node binary, ends_sha256 string")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    opened = summed.join(hashes, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    parents = summed.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("above"))
    if summed.count() <= BROADCAST_ROWS:
        parents = F.broadcast(parents)
    closed = parts.where(F.col("kind") == CLOSED).join(parents, "parent_node", "left")
    closed = closed.withColumn("parent_conv_id", F.coalesce("above", "parent_conv_id")).withColumn("ends_sha256", F.col("ends").cast("string"))
    columns = ["conv_id", "depth", "parent_conv_id", *COUNTS[2:], "ends_sha256"]
    return opened.select(*columns).unionByName(closed.select(*columns))
