"""Packing documents into sequences by length patterns fitted with non-negative least squares.

Documents are tokenized and cut once. Their pieces are dealt over shards of about ``SHARD_ROWS`` pieces; a shard sees
only lengths. In a shard the lengths are counted in steps of ``STEP`` tokens, rounded up. The patterns are all ways to
fill a sequence with up to ``MOST_DOCS`` documents; their repeat counts are fitted to the histogram by non-negative
least squares with an active set, whose next pattern is found by running through the patterns by number of documents.
The counts are rounded and filled with pieces, the longest of each step first; what rounding leaves is fitted again.
The rest goes by best fit, longest first, into the room left in those sequences and into new ones.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import parts, rows_of, slices, staged
from sluice.llm.tokens import Encoder

SHARD_ROWS = 1 << 18
STEP = 8
#: Documents of a pattern at most, and the least gain that another pattern is fitted for.
MOST_DOCS, LEAST_GAIN = 8, 1.0
#: Fits of what rounding left, at most, and the most that a fit may leave for another one to follow.
FITS, LEFT_PART = 3, 0.9


def _little_endian(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path, _little_endian, b"".join)


def token_pieces(documents: DataFrame, path: str, end_id: int, length: int = 4096, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids: every document's ids and ``end_id``, cut only where longer than ``length``.

    ``ids`` are little-endian unsigned 32-bit numbers. A null text counts as empty and gives one piece of one id.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(path), _little_endian([end_id])
        for batch in slices(batches, "text"):
            whole = [encoder.encoded(x or "") + end for x in batch.column("text").to_pylist()]
            sizes = np.array([len(x) for x in whole], np.int64) // 4
            pieces = -(-sizes // length)
            row = np.repeat(np.arange(len(whole)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * length
            ids = whole if len(row) == len(whole) else [whole[i][4 * at : 4 * (at + length)] for i, at in zip(row.tolist(), start.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                    pa.array(np.minimum(sizes[row] - start, length)), pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


def best_patterns(worth: np.ndarray, most: int = MOST_DOCS) -> list[tuple[float, np.ndarray]]:
    """Of all patterns of up to ``most`` documents that fill a sequence, for each number of documents that with the largest sum of ``worth``.

    ``worth[s]`` is that of a document of s steps, and a sequence has ``len(worth) - 1`` steps. The patterns are run
    through by their number of documents: the best of k documents with a given sum is one document more than the
    best of k - 1 with the rest.
    """
    steps = len(worth) - 1
    last = np.arange(steps + 1)
    best, chosen = np.where(last == 0, 0.0, -np.inf), []
    out = []
    for level in range(most):
        # Row s, column t: the others have s - t - 1 steps, and the last one t + 1.
        padded = np.concatenate([best[::-1], np.full(steps, -np.inf)])
        found = np.lib.stride_tricks.sliding_window_view(padded, steps)[steps + 1 - last] + worth[None, 1:]
        take = found.argmax(axis=1)
        best = found[last, take]
        chosen.append(take + 1)
        if np.isfinite(best[steps]):
            pattern, left = [], steps
            for k in range(level, -1, -1):
                pattern.append(int(chosen[k][left]))
                left -= pattern[-1]
            out.append((float(best[steps]), np.array(pattern)))
    return out


def fitted(histogram: np.ndarray, most: int = MOST_DOCS) -> list[tuple[np.ndarray, float]]:
    """Patterns and their repeat counts x > 0 with the least squared distance of their documents to the histogram.

    An active set: the patterns along which the distance falls most join it, one for each number of documents, and the
    least squares over the set are solved; where that makes a count negative, the counts move towards the solution
    until one is 0, which leaves the set. It ends when no pattern lowers the distance by ``LEAST_GAIN``.
    """
    goal = histogram.astype(float)
    goal[0] = 0
    found: list[np.ndarray] = []
    columns, x = np.zeros((len(goal), 0)), np.zeros(0)
    for _ in range(len(goal)):
        residual = goal - columns @ x
        known = {tuple(sorted(p.tolist())) for p in found}
        new = [p for gain, p in best_patterns(residual, most) if gain > LEAST_GAIN and tuple(sorted(p.tolist())) not in known]
        if not new:
            break
        found += new
        columns = np.column_stack([columns, *[np.bincount(p, minlength=len(goal)) for p in new]])
        x = np.append(x, np.zeros(len(new)))
        while len(x):
            # The least shift keeps patterns that are sums of others apart.
            gram = columns.T @ columns + 1e-7 * np.eye(len(x))
            solved = np.linalg.solve(gram, columns.T @ goal)
            falls = solved <= 0
            if not falls.any():
                x = solved
                break
            share = np.min(x[falls] / np.maximum(x[falls] - solved[falls], 1e-300))
            x = x + share * (solved - x)
            keep = ~falls | (x > 1e-9)
            if keep.all():
                keep[np.flatnonzero(falls)[np.argmin(x[falls])]] = False
            found, columns, x = [p for p, k in zip(found, keep) if k], columns[:, keep], x[keep]
    return list(zip(found, x.tolist()))


def packed(lengths: np.ndarray, capacity: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each length and its place there. Lengths are from 1 to ``capacity``."""
    sequence, offset, made = by_patterns(lengths, capacity, step)
    return best_fit(lengths, capacity, sequence, offset, made)


def by_patterns(lengths: np.ndarray, capacity: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
    """The sequence and place of the lengths that the fitted patterns take, -1 for the others, and how many sequences there are.

    Repeat counts are rounded. What rounding leaves is a histogram again and is fitted again, while that places a part of it.
    """
    step = max(1, min(step, capacity // 4))
    steps = capacity // step  # a sequence holds that many whole steps
    size = -(-lengths // step)
    sequence, offset = np.full(len(lengths), -1, np.int64), np.zeros(len(lengths), np.int64)
    order = np.lexsort((np.arange(len(lengths)), lengths, size))  # by step, shortest first
    ends = np.searchsorted(size[order], np.arange(steps + 2), "left")
    left = np.diff(ends)  # of each step, its members up to ends[s] + left[s] are free
    made = 0
    for _ in range(FITS):
        before = int(left.sum())
        for pattern, count in sorted(fitted(left), key=lambda x: -x[1]):
            sizes, need = np.unique(pattern, return_counts=True)
            n = int(min(round(count), *(left[s] // k for s, k in zip(sizes, need))))
            if n <= 0:
                continue
            filled = np.zeros(n, np.int64)
            for s, k in zip(sizes, need):
                for _ in range(k):
                    members = order[ends[s] + left[s] - n : ends[s] + left[s]]
                    sequence[members], offset[members] = made + np.arange(n), filled
                    filled += lengths[members]
                    left[s] -= n
            made += n
        if left.sum() > LEFT_PART * before:
            break
    return sequence, offset, made


def best_fit(lengths: np.ndarray, capacity: int, sequence: np.ndarray, offset: np.ndarray, made: int) -> tuple[np.ndarray, np.ndarray]:
    """Places the lengths without a sequence, longest first, where the least room is left, in open sequences or new ones."""
    filled = np.bincount(sequence[sequence >= 0], lengths[sequence >= 0], made).astype(np.int64)
    # Bit r of ``rooms`` tells that a sequence with room r is open.
    at: dict[int, list[int]] = {}
    rooms = 0
    for s, room in enumerate((capacity - filled).tolist()):
        at.setdefault(room, []).append(s)
        rooms |= 1 << room
    rest = np.flatnonzero(sequence < 0)
    for i in rest[np.lexsort((rest, -lengths[rest]))].tolist():
        n = int(lengths[i])
        if above := rooms >> n:
            room = (above & -above).bit_length() - 1 + n
            s = at[room].pop()
            if not at[room]:
                rooms ^= 1 << room
        else:
            room, s = capacity, made
            made += 1
        sequence[i], offset[i] = s, capacity - room
        if room - n:
            at.setdefault(room - n, []).append(s)
            rooms |= 1 << (room - n)
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = 4096, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The staged ``pieces`` (doc_id, piece, start, length and any more) with sequence_id and offset.

    Pieces of a sequence stand without gaps from offset 0. Repeated rows are packed as often as they occur.
    """
    shards = parts(rows_of(pieces), shard_rows)

    def place(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        group = group.drop_columns(["shard"]).sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        sequence, offset = packed(group.column("length").to_numpy(), capacity)
        return group.append_column("sequence_id", pa.array(shard * (1 << 32) + sequence)).append_column("offset", pa.array(offset))

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    # Rows without an id, or with one id, differ in their ids' checksum; equal rows are dealt by their number in the scan.
    salt = F.monotonically_increasing_id() if "ids_crc32" not in pieces.columns else F.col("ids_crc32")
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", salt), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(place, schema)


def best_fit_packing(documents: DataFrame, path: str, end_id: int, capacity: int = 4096, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    ``token_pieces`` gives the ids themselves; only their checksum goes through the packing. A null text counts as
    empty and gives a piece of one id. Other columns are ignored, whatever their names. No rows give no rows.
    """
    cut = token_pieces(documents, path, end_id, capacity, doc_id, text)
    pieces = staged(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return pack(pieces, capacity)
