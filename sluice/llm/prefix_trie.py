"""The trie of conversations' common beginnings, from vertical bitmaps.

Conversations are dealt over shards of successive ids. A shard indexes every (position, turn) to the set of its
conversations that have that turn there, as bits. A node of the trie is a sequence of first turns; its members are the
bits left after intersecting the postings along its path. Depth first, the lowest member not yet in a child names the
next posting, and the intersection of the node's bits with it is a child: as many intersections as there are nodes.
Counts are popcounts, and the members that end at a node are its bits among the conversations of that length.

A node is named by a digest of its path, so that the shards' parts of it are summed wherever they are. What is summed
over subtrees goes back to one shard each: that of the node's smallest member, whose path holds all nodes above. There
a subtree is a range of the depth-first numbering, and sums are differences of running sums. The shards' sums of a node
are added up again. No task sees more than a shard, and a node of very many members is one row for each shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sluice.llm.blocks import Blocks
from sluice.llm.common import staged

#: Turns of a shard; a conversation is never cut.
SHARD_TURNS = 16_384
ROOT = hashlib.blake2b(b"", digest_size=16).digest()
NODE = "shard long, node binary, parent binary, start long, stop long, depth long, n long, conv_id long, n_bytes long, ends string"


def turn_digest(role: Column, text: Column) -> Column:
    """Names a turn: equal for equal role and text only. Null counts as empty."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


def numbered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, position from 1, turn (its digest), n_bytes of every row, without the texts.

    A conversation's rows are ordered by ``turn``, null first, and rows of one turn by their digest. Rows without a
    conv_id belong to no conversation and are left out.
    """
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("place"), turn_digest(F.col(role), F.col(text)).alias("turn"),
        F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
    ).filter("conv_id IS NOT NULL")
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("place"), "turn")
    return rows.select("conv_id", F.row_number().over(order).alias("position"), F.unhex("turn").alias("turn"), "n_bytes")


def _bits(places: list[int], size: int) -> int:
    """A set of numbers below ``size`` as the bits of an integer."""
    held = bytearray(-(-size // 8))
    for p in places:
        held[p >> 3] |= 1 << (p & 7)
    return int.from_bytes(held, "little")


def _listed(bits: int, ids: np.ndarray) -> str:
    """The members' ids, ascending, with commas."""
    if not bits & (bits - 1):
        return str(ids[bits.bit_length() - 1])
    flags = np.unpackbits(np.frombuffer(bits.to_bytes(-(-len(ids) // 8), "little"), np.uint8), count=len(ids), bitorder="little")
    return ",".join(map(str, ids[flags == 1].tolist()))


def shard_nodes(conv: np.ndarray, position: np.ndarray, turn: list[bytes | None], n_bytes: np.ndarray) -> list[tuple]:
    """The nodes of a shard in depth-first order: (node, parent, start, stop, depth, members, smallest id, bytes of the
    last turn, ids of those that end). ``start`` numbers the nodes; those below have numbers up to ``stop``, not included.

    Rows are sorted by conversation and position; position 0 stands for a conversation itself.
    """
    ids, first, member = np.unique(conv, return_index=True, return_inverse=True)
    where: dict[tuple[int, bytes], list[int]] = {}
    weight: dict[tuple[int, bytes], int] = {}
    for m, p, t, b in zip(member.tolist(), position.tolist(), turn, n_bytes.tolist()):
        if p:
            where.setdefault((p, t), []).append(m)
            weight[p, t] = b
    postings = {k: _bits(v, v[-1] + 1) for k, v in where.items()}
    lengths = np.diff(np.append(first, len(conv))) - 1
    by_length: dict[int, list[int]] = {}
    for m, n in enumerate(lengths.tolist()):
        by_length.setdefault(n, []).append(m)
    ending = {n: _bits(v, len(ids)) for n, v in by_length.items()}
    first = first.tolist()
    out: list[list] = []
    # node bits, its digest, parent's digest, depth, bytes; None closes the node of that number.
    stack: list[tuple] = [((1 << len(ids)) - 1, ROOT, None, 0, 0)]
    while stack:
        top = stack.pop()
        if len(top) == 1:
            out[top[0]][3] = len(out)
            continue
        bits, node, parent, depth, size = top
        ends = bits & ending.get(depth, 0)
        start = len(out)
        out.append([node, parent, start, 0, depth, bits.bit_count(), int(ids[(bits & -bits).bit_length() - 1]), size, _listed(ends, ids) if ends else None])
        stack.append((start,))
        rest = bits & ~ends
        while rest:
            key = depth + 1, turn[first[(rest & -rest).bit_length() - 1] + depth + 1]
            child = rest & postings[key]
            rest ^= child
            stack.append((child, hashlib.blake2b(node + key[1], digest_size=16).digest(), node, depth + 1, weight[key]))
    return [tuple(x) for x in out]


def _nodes(group: pa.Table) -> pa.Table:
    group = group.sort_by([("conv_id", "ascending"), ("position", "ascending")])
    found = shard_nodes(
        group.column("conv_id").to_numpy(), group.column("position").to_numpy(), group.column("turn").to_pylist(), group.column("n_bytes").to_numpy()
    )
    columns = list(zip(*found))
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 6, pa.string()]
    names = ["node", "parent", "start", "stop", "depth", "n", "conv_id", "n_bytes", "ends"]
    table = pa.table({name: pa.array(c, kind) for name, c, kind in zip(names, columns, kinds)})
    return table.add_column(0, "shard", pa.array(np.repeat(group.column("shard")[0].as_py(), table.num_rows)))


def _subtrees(nodes: pa.Table, own: pa.Table) -> pa.Table:
    """For each node of a shard the sums over its subtree of what the shard owns."""
    if not nodes.num_rows:
        return pa.table({"node": pa.array([], pa.binary()), "n_leaves": pa.array([], pa.int64()), "saved_tokens": pa.array([], pa.int64())})
    start, stop, at = nodes.column("start").to_numpy(), nodes.column("stop").to_numpy(), own.column("start").to_numpy()
    sums = []
    for name in ("leaf", "saved"):
        each = np.zeros(len(start) + 1, np.int64)
        each[at + 1] = own.column(name).to_numpy()
        running = np.cumsum(each)
        sums.append(running[stop] - running[start])
    return pa.table({"node": nodes.column("node"), "n_leaves": sums[0], "saved_tokens": sums[1]})


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and shard -> a node's digest over all its lists, which follow each other in the shards' order."""
    node, digest = None, None
    for batch in batches:
        names, out = [], []
        for key, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if key == node:
                digest.update(b"," + ends.encode())
            else:
                if node is not None:
                    names.append(node)
                    out.append(digest.hexdigest())
                node, digest = key, hashlib.sha256(ends.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(out, pa.string())], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()], pa.string())], names=["node", "ends_sha256"])


def local_tries(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of every shard's trie, as ``NODE``; ``ends`` lists the ids of the conversations that end there.

    ``turns`` is a staged table with conv_id, position, turn, n_bytes: positions without gaps from 1, and a row with
    position 0 for every conversation. Shards follow each other in the order of conv_id.
    """
    blocks = Blocks(turns, "conv_id", shard_turns)
    shard = blocks.of(F.col("conv_id"), F.lit((1 << 63) - 1))
    dealt = turns.select(shard.alias("shard"), "conv_id", F.col("position").cast("long").alias("position"), "turn", "n_bytes")
    return dealt.groupBy("shard").applyInArrow(_nodes, NODE)


def prefix_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """node, parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    ``turns`` as for ``local_tries``. A node is a distinct sequence of first turns; its members are the conversations
    that start with it, ``conv_id`` the smallest of them, and the root has all. ``n_leaves`` counts the childless nodes
    of its subtree, ``saved_tokens`` sums over it the bytes of each node's last turn for every member but one.
    ``ends_sha256`` is the digest of the ids of those that end there. No conversations give no nodes.
    """
    local = staged(local_tries(turns, shard_turns))
    nodes = local.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"),
        F.first("n_bytes").alias("n_bytes"), F.min_by("shard", "conv_id").alias("shard"), F.min_by("start", "conv_id").alias("start"),
    )
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = staged(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    own = nodes.select("shard", "start", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n") - 1) * F.col("n_bytes")).alias("saved"))
    own = own.filter("leaf > 0 OR saved > 0")
    sums = local.select("shard", "node", "start", "stop").groupBy("shard").cogroup(own.groupBy("shard"))
    sums = sums.applyInArrow(_subtrees, "node binary, n_leaves long, saved_tokens long")
    sums = sums.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    many = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = local.filter("ends IS NOT NULL").select("node", "shard", "ends").repartition(many, "node").sortWithinPartitions("node", "shard")
    ends = ends.mapInArrow(_end_digests, "node binary, ends_sha256 string")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    met = nodes.join(sums, "node").join(ends, "node", "left").join(above, "parent", "left")
    return met.select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """The table that ``prefix_trie`` takes, of conversations with conv_id, turn, role and text."""
    turns = numbered_turns(conversations)
    heads = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).filter("conv_id IS NOT NULL").distinct()
    return staged(with_heads(turns, heads))


def with_heads(turns: DataFrame, heads: DataFrame) -> DataFrame:
    """Turns and a row of position 0 for every conversation of ``heads``."""
    none = heads.select("conv_id", F.lit(0).alias("position"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("n_bytes"))
    return turns.select("conv_id", "position", "turn", "n_bytes").unionByName(none)


def spliced(turns: DataFrame, heads: DataFrame, most: int = 8) -> DataFrame:
    """Conversations that begin with turns of another one, as the table that ``prefix_trie`` takes.

    ``turns`` is a staged table as ``numbered_turns`` gives it; ``heads`` has conv_id, donor and h (0 to ``most``): a conversation has the
    donor's first h turns (all if fewer, none if there is no such conversation), then its own after its first h.
    """
    given = turns.filter(F.col("position") <= most).join(heads.select(F.col("donor").alias("conv_id")).distinct(), "conv_id", "left_semi")
    given = given.groupBy(F.col("conv_id").alias("donor")).agg(F.sort_array(F.collect_list(F.struct("position", "turn", "n_bytes"))).alias("given"))
    plan = staged(
        heads.join(given, "donor", "left").select("conv_id", "h", F.coalesce(F.slice("given", F.lit(1), F.col("h")), F.expr("CAST(array() AS array<struct<position:int,turn:binary,n_bytes:bigint>>)")).alias("given"))
    )
    first = plan.select("conv_id", F.inline("given"))
    own = turns.join(plan.select("conv_id", "h", F.size("given").alias("have")), "conv_id").filter("position > h")
    own = own.select("conv_id", (F.col("position") - F.col("h") + F.col("have")).alias("position"), "turn", "n_bytes")
    return staged(with_heads(first.unionByName(own), plan))
