"""Line dedup with a sharded minimal perfect hash.

Documents are dealt over chunks by a hash of their id and text. A chunk's lines give one entry for each distinct key: 128 bits
of hash, the smallest and the largest id and the number of documents that hold it. Entries of all chunks are summed
for each key, keys are dealt over shards by hash, and every shard builds a minimal perfect hash over its keys. It
numbers the keys from 0 without gaps, so a shard is three plain arrays: fingerprint, number of documents, smallest id.
Each chunk then probes the arrays with its own distinct keys, once for each key however many documents hold it, and
the answers go back to the chunk, where the lines are dropped. Lines are never joined.

A common line is one entry for each chunk before anything is shuffled by key, so no task sees more than that of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import parts, rows_of, slices, staged, utf8

#: Documents of a chunk, and bytes of their texts, about.
CHUNK_DOCS, CHUNK_BYTES = 1024, 1 << 24
SHARD_ENTRIES = 200_000
MARGIN = b" \t\n\x0b\x0c\r"
LEAST = 10
#: The place of a document without an id: after all others.
NO_ID = (1 << 63) - 1


def line_keys(text: bytes) -> list[bytes | None]:
    """The key of each line: both ends stripped and A-Z in lower case; None for a key of fewer than ``LEAST`` code points."""
    keys = [line.strip(MARGIN) for line in text.lower().split(b"\n")]
    return [k if len(k) >= 4 * LEAST or len(k) >= LEAST and len(k.decode()) >= LEAST else None for k in keys]


def hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit halves of each key's hash."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">i8").astype(np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _mixed(high: np.ndarray, low: np.ndarray, level: int) -> np.ndarray:
    x = high.view(np.uint64) ^ (low.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level * 0xD1B54A32D192ED03 % (1 << 64)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Numbers distinct keys from 0 without gaps. Each level keeps a bit for every place that exactly one key takes;
    keys that meet try the next level. A key's number is the number of bits before its own."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.ranks = [np.cumsum(x, dtype=np.int64) for x in levels]

    @classmethod
    def over(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        levels = []
        while len(high):
            places = _mixed(high, low, len(levels)) % np.uint64(2 * len(high))
            held = np.bincount(places.astype(np.int64), minlength=2 * len(high))
            levels.append(held == 1)
            meets = held[places.astype(np.int64)] > 1
            high, low = high[meets], low[meets]
        return cls(levels)

    def numbers(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The key's number, for keys it was built over; any number or -1 for others."""
        found = np.full(len(high), -1, np.int64)
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            rest = np.flatnonzero(found < 0)
            places = (_mixed(high[rest], low[rest], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[places]
            found[rest[hit]] = self.before[level] + rank[places[hit]] - 1
        return found

    def packed(self) -> list[bytes]:
        return [len(x).to_bytes(8, "little") + np.packbits(x).tobytes() for x in self.levels]

    @classmethod
    def unpacked(cls, levels: list[bytes]) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(x, np.uint8, offset=8), count=int.from_bytes(x[:8], "little")).astype(bool) for x in levels])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        keys, rows = [], []
        for row, text in enumerate(utf8(batch.column("text"))):
            own = dict.fromkeys(line_keys(text))
            own.pop(None, None)
            keys += own
            rows += [row] * len(own)
        high, low = hashes(keys)
        yield pa.RecordBatch.from_arrays(
            [batch.column("chunk").take(rows), batch.column("doc_id").take(rows), pa.array(high), pa.array(low)] if rows
            else [batch.column("chunk").slice(0, 0), batch.column("doc_id").slice(0, 0), pa.array(high), pa.array(low)],
            names=["chunk", "doc_id", "high", "low"],
        )


def _arrays(keys: pa.Table) -> pa.Table:
    """A shard: its perfect hash, and what stands at each key's number."""
    high, low = keys.column("high").to_numpy(), keys.column("low").to_numpy()
    index = PerfectHash.over(high, low)
    place = np.argsort(index.numbers(high, low))
    return pa.table(
        {
            "shard": keys.column("shard").slice(0, 1),
            "levels": pa.array([index.packed()], pa.list_(pa.binary())),
            "fingerprints": pa.array([low[place].tobytes()], pa.binary()),
            "counts": pa.array([keys.column("docs").to_numpy()[place].tobytes()], pa.binary()),
            "firsts": pa.array([keys.column("first").to_numpy()[place].tobytes()], pa.binary()),
        }
    )


def _probe(asked: pa.Table, arrays: pa.Table) -> pa.Table:
    """The asked keys that at least two documents hold, with the smallest id among those."""
    high, low = asked.column("high").to_numpy(), asked.column("low").to_numpy()
    if not len(high) or not arrays.num_rows:
        return pa.table({"chunk": pa.array([], pa.int64()), "high": pa.array([], pa.int64()), "low": pa.array([], pa.int64()), "first": pa.array([], pa.int64())})
    shard = arrays.slice(0, 1).to_pylist()[0]
    fingerprints, counts, firsts = (np.frombuffer(shard[x], np.int64) for x in ("fingerprints", "counts", "firsts"))
    number = PerfectHash.unpacked(shard["levels"]).numbers(high, low)
    shared = (number >= 0) & (fingerprints[number] == low) & (counts[number] > 1)
    return pa.table({"chunk": asked.column("chunk").filter(pa.array(shared)), "high": high[shared], "low": low[shared], "first": firsts[number[shared]]})


def _apply(documents: pa.Table, answers: pa.Table) -> pa.Table:
    """A chunk's documents without the lines that an earlier document holds."""
    first = dict(zip(zip(answers.column("high").to_pylist(), answers.column("low").to_pylist()), answers.column("first").to_pylist()))
    out: dict[str, list] = {"doc_id": [], "n_lines": [], "n_dropped": [], "text": []}
    for batch in slices(iter(documents.combine_chunks().to_batches()), "text"):
        for key, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
            keys, lines = line_keys(text), text.split(b"\n")
            own = [k for k in dict.fromkeys(keys) if k is not None]
            high, low = hashes(own)
            place = NO_ID if key is None else key
            gone = {k for k, h in zip(own, zip(high.tolist(), low.tolist())) if first.get(h, place) < place}
            kept = [line for line, k in zip(lines, keys) if k not in gone] if gone else lines
            out["doc_id"].append(key)
            out["n_lines"].append(len(lines))
            out["n_dropped"].append(len(lines) - len(kept))
            out["text"].append(b"\n".join(kept).decode())
    return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "n_lines": pa.array(out["n_lines"], pa.int64()), "n_dropped": pa.array(out["n_dropped"], pa.int64()), "text": pa.array(out["text"], pa.string())})


def line_dedup(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_docs: int = CHUNK_DOCS, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text of the lines that stay, for every row of ``documents``.

    A line whose key has at least ten code points and stands in at least two documents stays only in the document with
    the smallest id, there as often as it stands. A null or empty text is one empty line. Rows with the same id are
    one document; rows without an id are one that comes after all others. Other columns are ignored, whatever their
    names. No rows give no rows.
    """
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = source.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    chunks = max(parts(size.rows, chunk_docs), parts(size.bytes, CHUNK_BYTES))
    # By the text, too: rows without an id, or with one id, may be very many. Their parts meet again in each key's ids.
    source = source.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    lines = source.mapInArrow(_entries, "chunk long, doc_id long, high long, low long")
    place = F.coalesce("doc_id", F.lit(NO_ID))
    entries = staged(lines.groupBy("chunk", "high", "low").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("docs")))
    shard = F.pmod("high", F.lit(parts(rows_of(entries), shard_entries))).alias("shard")
    summed = entries.groupBy("high", "low").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("docs").alias("docs"))
    keys = summed.select(shard, "high", "low", "first", F.when(F.col("first") == F.col("last"), 1).otherwise(F.col("docs")).cast("long").alias("docs"))
    arrays = keys.groupBy("shard").applyInArrow(_arrays, "shard long, levels array<binary>, fingerprints binary, counts binary, firsts binary")
    asked = entries.select(shard, "chunk", "high", "low")
    answers = asked.groupBy("shard").cogroup(arrays.groupBy("shard")).applyInArrow(_probe, "chunk long, high long, low long, first long")
    return source.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_apply, "doc_id long, n_lines long, n_dropped long, text string")
