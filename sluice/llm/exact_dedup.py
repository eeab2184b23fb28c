"""Exact duplicates by a tree merge of sorted digest runs.

Documents are dealt over ``fanout ** rounds`` leaves by a hash of their id. Each leaf makes one run: a row for each
digest with the number of its documents and the smallest (or largest) id. In round r a run is cut by digit r of the
digest, written to base ``fanout``, and ``fanout`` nodes that differ only in digit r of their number exchange the
pieces: each node merges the ``fanout`` sorted pieces it gets and keeps one row for each digest, with the number and
the winning id so far. After the last round every digest lies in exactly one node. The results go back the same way,
so each leaf learns the winner and the size of its groups.

A group of copies therefore never meets in one task: a node sees at most ``fanout`` rows of a digest in a round,
however many documents hold it. Runs are merged on digest, byte length and a second, independent hash; texts count as
the same only if all three agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sluice.llm.common import parts, rows_of, slices, spare, staged, utf8

KEY = ("digest", "n_bytes", "check")
#: Entries that a leaf should hold, and the number of runs that a node merges in a round.
LEAF_ROWS = 50_000
FANOUT = 16


def normalised(text: bytes) -> bytes:
    """A-Z in lower case and nothing else changed: ``bytes.lower`` touches ASCII letters only."""
    return text.lower()


def digest(text: bytes) -> bytes:
    return hashlib.sha256(normalised(text)).digest()


def digests(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest (SHA-256 of the normalised text), n_bytes and check (a 64-bit hash) of every row. Null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [normalised(x) for x in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([hashlib.sha256(x).digest() for x in texts], pa.binary()),
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.array([xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in texts], pa.int64()),
                ],
                names=["doc_id", *KEY],
            )

    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, digest binary, n_bytes long, check long")


def _digit(column: F.Column, r: int, fanout: int) -> F.Column:
    return F.pmod(F.floor(column / F.lit(fanout**r)).cast("long"), F.lit(fanout))


def _parent(place: F.Column, r: int, fanout: int) -> F.Column:
    """The node that gets a row in round r: digit r of the node's number gives way to the digest's digit."""
    return F.col("node") + (_digit(place, r, fanout) - _digit(F.col("node"), r, fanout)) * F.lit(fanout**r)


RUN = "node long, digest binary, n_bytes long, check long, keep_id long, size long"


def _merging(keep: str):
    """Rows sorted by node and key -> one row for each, with the winning id and the sum of sizes.

    What a node gets are the sorted pieces of several runs, which Spark's sort has merged; equal keys stand next to each
    other, so one row of state is all that goes from batch to batch.
    """
    worst = {"smallest": (1 << 63) - 1, "largest": -(1 << 63)}[keep]
    best = {"smallest": np.minimum, "largest": np.maximum}[keep]

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The batch with equal successive keys merged."""
        if batch.num_rows < 2:
            return batch
        differs = np.zeros(batch.num_rows - 1, bool)
        for name in ("node", *KEY):
            column = batch.column(name)
            differs |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        starts = np.append(0, np.flatnonzero(differs) + 1)
        ids = batch.column("keep_id")
        known = np.add.reduceat(pc.is_valid(ids).to_numpy(zero_copy_only=False).astype(np.int64), starts) > 0
        winners = best.reduceat(pc.fill_null(ids, worst).to_numpy(zero_copy_only=False), starts)
        sizes = np.add.reduceat(batch.column("size").to_numpy(), starts)
        kept = batch.select(["node", *KEY]).take(pa.array(starts))
        return pa.RecordBatch.from_arrays([*kept.columns, pa.array(winners, mask=~known), pa.array(sizes)], names=batch.schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if last is None else pa.Table.from_batches([last, batch.cast(last.schema)]).combine_chunks().to_batches()[0]
            merged = rows(whole)
            last = merged.slice(merged.num_rows - 1)
            yield merged.slice(0, merged.num_rows - 1)
        if last is not None:
            yield last

    return run


def _merged(pieces: DataFrame, nodes: int, keep: str) -> DataFrame:
    """Each node's run: the pieces it gets, sorted and merged. ``pieces`` has the columns of ``RUN``."""
    names = ["node", *KEY, "keep_id", "size"]
    met = pieces.select(*names).repartitionById(nodes, F.col("node").cast("int")).sortWithinPartitions("node", *KEY)
    return met.mapInArrow(_merging(keep), RUN)


def _exchange(runs: DataFrame, place: F.Column, r: int, fanout: int, nodes: int, keep: str) -> DataFrame:
    """One binomial round: nodes that differ in digit r exchange the pieces of their runs and merge what they get."""
    return _merged(runs.withColumn("node", _parent(place, r, fanout)), nodes, keep)


def tree_merge(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest", leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT
) -> DataFrame:
    """doc_id, digest, n_bytes, check, copies, keep_id, size: one row for each id and text, ``copies`` of which there are."""
    found = staged(digests(documents, doc_id, text))
    rounds = 0
    while fanout**rounds < parts(rows_of(found), leaf_rows):
        rounds += 1
    nodes = fanout**rounds
    # The digest's own digits say in which node it ends.
    place = F.pmod(F.conv(F.hex(F.substring("digest", 25, 7)), 16, 10).cast("long"), F.lit(nodes))
    leaf = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(nodes)).alias("leaf")
    entries = staged(found.groupBy(leaf, *KEY, "doc_id").agg(F.count("*").alias("copies")))
    pieces = entries.select(F.col("leaf").alias("node"), *KEY, F.col("doc_id").alias("keep_id"), F.col("copies").alias("size"))
    levels = [staged(_merged(pieces, nodes, keep))]
    for r in range(rounds):
        levels.append(staged(_exchange(levels[-1], place, r, fanout, nodes, keep)))
    # Back down the tree. A group of one row needs no answer.
    answers = levels[-1].filter("size > 1")
    for r in reversed(range(rounds)):
        asked = levels[r].select(F.col("node").alias("below"), _parent(place, r, fanout).alias("node"), *KEY)
        answers = asked.join(answers, ["node", *KEY]).select(F.col("below").alias("node"), *KEY, "keep_id", "size")
    answers = answers.select(F.col("node").alias("leaf"), *KEY, F.col("keep_id").alias("winner"), "size")
    single = F.col("size").isNull()
    return entries.join(answers, ["leaf", *KEY], "left").select(
        "doc_id", *KEY, "copies",
        F.when(single, F.col("doc_id")).otherwise(F.col("winner")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("size"),
    )


def duplicate_groups(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest", leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest: one row for each row of ``documents``, dropped ones too.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. ``keep`` names the id that stays in a
    group, ``smallest`` or ``largest``. Of repeated rows with the id that stays, exactly one is kept. A null id stays
    only in a group without any other id. Other columns are ignored, whatever their names. No rows give no rows.
    """
    merged = tree_merge(documents, doc_id, text, keep, leaf_rows, fanout)
    rows = merged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    kept = (F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return rows.select("doc_id", "keep_id", F.col("size").alias("group_size"), kept.alias("kept"), "digest")


def without_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``documents`` that stay, one of each group of equal texts, with all their columns."""
    merged = staged(tree_merge(documents, doc_id, text, keep))
    own, gone_id, gone_digest, kept, row = (spare(documents, x) for x in ("own_digest", "gone_id", "gone_digest", "kept", "row"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    gone = merged.filter(~stays | (F.col("copies") > 1))
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("digest").alias(gone_digest), stays.alias(kept))
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = pa.array([digest(x) for x in utf8(batch.column(text))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, own])

    tagged = documents.mapInArrow(run, T.StructType([*documents.schema.fields, T.StructField(own, T.BinaryType())]))
    met = tagged.join(gone, (F.col(own) == F.col(gone_digest)) & F.col(doc_id).cast("long").eqNullSafe(F.col(gone_id)), "left")
    rest = met.filter(F.coalesce(kept, F.lit(True)))
    if merged.filter("copies > 1").limit(1).count():
        one = W.partitionBy(doc_id, own).orderBy(F.lit(1))
        rest = rest.withColumn(row, F.row_number().over(one)).filter(F.col(row) == 1)
    return rest.select(*names)
