"""Document fingerprints by winnowing.

Every run of ``gram`` code points of a text is hashed with a rolling polynomial. Of every ``window`` successive hashes
the smallest is chosen, the rightmost of equal ones, and kept with its place in the text. Two texts that share
``gram + window - 1`` successive code points then share a chosen hash, wherever those stand; shared runs of fewer
than ``gram`` code points are never seen. Texts with fewer hashes than a window have their smallest; a text shorter
than ``gram`` is one run by itself; an empty text has an empty fingerprint.

A fingerprint is a string of ten hexadecimal digits for each chosen hash: the hash in eight, lowest byte first, and in
two how many code points it stands behind the one before, or behind the text's start. ``unpacked`` gives them back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.blocks import Blocks
from sluice.llm.common import SLICE_BYTES, slices

GRAM, WINDOW = 16, 32
#: Documents of a block, which one task reads in the order of their ids.
BLOCK_DOCS = 4096
BASE = 0x9E3779B97F4A7C15
#: Not a code point: fills up texts that are shorter than a run.
FILLER = 0x110000
#: Code points that are worked on at a time.
PART = 1 << 19


def rolled(points: np.ndarray, gram: int) -> np.ndarray:
    """The polynomial hash of each run of ``gram`` code points, mixed to 32 bits.

    Runs are put together from runs of half their length, so the work is in the logarithm of ``gram``.
    """
    total, have = None, 0
    power, width = points.astype(np.uint64) + np.uint64(1), 1
    left = gram
    while left:
        if left & 1:  # the runs so far, followed by one of ``width``
            n = len(points) - have - width + 1
            total = power[:n] if total is None else total[:n] * np.uint64(pow(BASE, width, 1 << 64)) + power[have : have + n]
            have += width
        left >>= 1
        if left:
            n = len(points) - 2 * width + 1
            power = power[:n] * np.uint64(pow(BASE, width, 1 << 64)) + power[width : width + n]
            width *= 2
    x = total
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x >> np.uint64(32)


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """The smallest of each ``window`` successive values, by doubling."""
    width = 1
    while 2 * width <= window:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = window - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def winnowed(texts: list[str], gram: int = GRAM, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its chosen hashes (32 bits) and their places, in the order of the text.

    Texts are worked on together, and a long one in parts that overlap, about ``PART`` code points at a time.
    """
    if not 0 < gram or not 0 < window < 256:
        raise ValueError("a window has 1 to 255 hashes of runs of at least one code point")
    out: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in texts]
    waiting: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def work() -> None:
        for (i, at, _), (hashes, places) in zip(waiting, _chosen([p for *_, p in waiting], gram, window)):
            places += at
            if out[i] and out[i][-1][1][-1] == places[0]:  # chosen by the last window before, too
                hashes, places = hashes[1:], places[1:]
            if len(places):
                out[i].append((hashes, places))

    for i, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if 0 < len(points) < gram:
            points = np.append(points, np.full(gram - len(points), FILLER, np.uint32))
        for at in range(0, max(len(points) - gram - window + 2, min(len(points), 1)), PART):
            waiting.append((i, at, points[at : at + PART + gram + window - 2]))
            size += len(waiting[-1][2])
            if size > PART:
                work()
                waiting, size = [], 0
    if waiting:
        work()
    none = (np.empty(0, np.uint32), np.empty(0, np.int64))
    return [found[0] if len(found) == 1 else tuple(map(np.concatenate, zip(*found))) if found else none for found in out]


def _chosen(points: list[np.ndarray], gram: int, window: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The chosen hashes and places of texts that have a run each."""
    everything = np.concatenate(points)
    # Below the hash stands the distance from the end of all texts: of equal hashes, the rightmost is the smallest.
    hashes = rolled(everything, gram)
    keys = hashes << np.uint64(32) | np.arange(len(hashes), 0, -1).astype(np.uint64)
    best = _least(keys, window) if len(keys) >= window else keys[:0]
    out, start = [], 0
    for p in points:
        grams = len(p) - gram + 1
        if grams >= window:
            own = best[start : start + grams - window + 1]
            own = own[np.append(True, own[1:] != own[:-1])]
        else:
            own = keys[start : start + grams].min(keepdims=True)
        places = len(hashes) - (own & np.uint64(0xFFFFFFFF)).astype(np.int64) - start
        out.append(((own >> np.uint64(32)).astype(np.uint32), places))
        start += len(p)
    return out


def packed(hashes: np.ndarray, places: np.ndarray) -> str:
    """A fingerprint as a string."""
    out = np.empty((len(hashes), 5), np.uint8)
    out[:, :4] = hashes.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[:, 4] = np.diff(places, prepend=0)
    return out.tobytes().hex()


def unpacked(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of a fingerprint."""
    rows = np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, 5)
    return np.ascontiguousarray(rows[:, :4]).view("<u4").ravel(), np.cumsum(rows[:, 4], dtype=np.int64)


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Distinct hashes in both of all in either; 1 for two empty ones."""
    left, right = set(left.tolist()), set(right.tolist())
    both = len(left & right)
    return both / (len(left) + len(right) - both) if left or right else 1.0


def matches(left: str, right: str) -> list[tuple[int, int]]:
    """The places (in the left text, in the right one) of all equal hashes of two fingerprints.

    Every passage of ``gram + window - 1`` code points that both texts hold has such a place within it in each.
    """
    places: dict[int, list[int]] = {}
    for h, p in zip(*(x.tolist() for x in unpacked(right))):
        places.setdefault(h, []).append(p)
    return [(p, q) for h, p in zip(*(x.tolist() for x in unpacked(left))) for q in places.get(h, ())]


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, fingerprint of every row, without a shuffle. A null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            marks = [packed(*x) for x in winnowed(texts, gram, window)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(marks, pa.string())], names=["doc_id", "n_chars", "fingerprint"]
            )

    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def edited(text: str, after: str) -> str:
    """The text whose last quarter of code points gives way to as many first ones of the text after it, or all of them."""
    part = len(text) // 4
    return text[: len(text) - part] + after[:part]


def _compared(gram: int, window: int):
    """Rows sorted by block and order, each block followed by the row after it -> the rows with what is said of the next.

    A row waits for the next one that differs from it. Equal rows are one document, so their answer is made once.
    """

    def answers(rows: list[tuple[int | None, str, int]], after: str) -> pa.RecordBatch:
        """(id, text, how often) of successive documents of a block, and the text after the last."""
        texts = [t for _, t, _ in rows]
        turned = [edited(t, x) for t, x in zip(texts, [*texts[1:], after])]
        found = winnowed([*texts, after, *turned], gram, window)
        own, other = found[: len(texts) + 1], found[len(texts) + 1 :]
        times = np.array([n for *_, n in rows])
        columns = [
            pa.array([i for i, *_ in rows], pa.int64()),
            pa.array(map(len, texts), pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in turned], pa.string()),
            pa.array([packed(*x) for x in own[:-1]], pa.string()),
            pa.array([packed(*x) for x in other], pa.string()),
            pa.array([likeness(x[0], y[0]) for x, y in zip(own, other)], pa.float64()),
            pa.array([likeness(x[0], y[0]) for x, y in zip(own, own[1:])], pa.float64()),
        ]
        batch = pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
        return batch if (times == 1).all() else batch.take(pa.array(np.repeat(np.arange(len(rows)), times)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str, int]] = []
        of, size, last = None, 0, None
        for batch in slices(batches, "text"):
            for block, key, copy, text in zip(*(batch.column(c).to_pylist() for c in ("block", "doc_id", "after", "text"))):
                text = text or ""
                if block != of:
                    held, of, size, last = [], block, 0, None
                if copy:  # the first row behind the block; its repeats have nothing to follow
                    if held:
                        yield answers(held, text)
                        held = []
                elif last == (key, text):
                    held[-1] = (key, text, held[-1][2] + 1)
                else:
                    if size > SLICE_BYTES:
                        yield answers(held, text)
                        held, size = [], 0
                    held.append((key, text, 1))
                    size, last = size + len(text), (key, text)

    return run


def next_compared(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The next document is that with the next larger id, after the last the first. Rows with one id are ordered by a
    hash of the text, rows without an id come last; rows equal in both are one document and give equal rows. A null
    text counts as empty. Other columns are ignored, whatever their names. No rows give no rows; a single document
    follows itself.

    Documents are dealt over blocks of successive ids. Each block's first document also goes to the block before it, so
    that whole texts are shuffled once and no task needs another's. A block is streamed in order.
    """
    rank = F.xxhash64(F.coalesce("text", F.lit("")))
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    blocks = Blocks(source, "doc_id", block_docs)
    rows = source.withColumn("rank", rank).withColumn("block", blocks.of(F.col("doc_id"), F.col("rank")))
    place = [F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("rank")]
    found = rows.groupBy("block").agg(F.min(F.struct(*place)).alias("first")).orderBy("block").collect()
    firsts = {(r.first["doc_id"], r.first["rank"]): found[i - 1].block for i, r in enumerate(found)}
    ids = {i for i, _ in firsts}
    numbered = {(i, h): b for (i, h), b in firsts.items() if i is not None}
    unnumbered = {h: b for (i, h), b in firsts.items() if i is None}

    @F.arrow_udf("long")
    def before(key: pa.Array, rank: pa.Array) -> pa.Array:
        """The block before that which the row is the first of, or else null."""
        out: list[int | None] = [None] * len(key)
        for i, k in enumerate(key.to_pylist()):
            if k in ids:
                h = rank[i].as_py()
                out[i] = unnumbered.get(h) if k is None else numbered.get((k, h))
        return pa.array(out, pa.int64())

    own = F.struct(F.col("block"), F.lit(0).alias("after"))
    sent = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("before").alias("block"), F.lit(1).alias("after"))))
    dealt = rows.withColumn("before", before(F.col("doc_id"), F.col("rank"))).select("doc_id", "text", "rank", F.inline(sent))
    many = max(1, len(found))
    order = ["block", "after", F.col("doc_id").isNull(), "doc_id", "rank"]
    met = dealt.repartitionById(many, F.col("block").cast("int")).sortWithinPartitions(*order).select("block", "doc_id", "after", "text")
    return met.mapInArrow(
        _compared(gram, window),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
