"""N-gram Jaccard join: subsets for small sets, inverted lists for large ones.

Documents with equal shingle sets are one class; a class is named by the hash of its set. Two sets of n and m shingles
link when they share at least ``overlap(n, m)``, which is never less than three quarters of either.

*Small sets.* Sets of up to ``boundary`` shingles are listed under each of their subsets of the sizes that a link needs.
In the list of a subset of size o, sets of n and m shingles link when o >= overlap(n, m), so all links of the list
connect its members with its smallest set. The boundary is the one with the least estimated cost over the histogram of
sizes: a set costs its number of subsets on the one side, and its prefix times the measured mean length of lists on the
other.

*Large sets.* Two linked sets share a shingle in the prefixes of n - ceil(3n/4) + 1 shingles under any common order.
First, sets that can't link are found with the order of hashes: of their first n - ceil(3n/4) + n/8 shingles two linked sets
share an eighth of the smaller one's number, so a set that shares fewer with the first shingles of all others is out. This exchange moves packed
arrays, not rows. Among the sets that are left, shingles of one set only come first and the others follow by hash; only
shared shingles of the prefix go into inverted lists. A list is scanned in size classes whose members differ by less than 4/3:
each member is paired with its class's leader and that of the class below, which is linear in the list. Pairs are
verified exactly on the sets, and links joined to components. Lists that still hold several components are scanned
again with other leaders, and at last block by block with the sets themselves: pairs across components that size,
position and a bound on the difference from the sets' bits allow are verified in the task, and only links that join
components leave it. So no link between components is lost, and no list of pairs is ever made: what a task hands on is
never more than its members. A group of near copies is one component by then, and its pairs are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import SLICE_BYTES, parts, rows_of, slices, staged, utf8
from sluice.llm.components import components
from sluice.llm.shingles import set_hash, shingle_sets

#: Linked at 75 of 100 and more.
PART, WHOLE = 75, 100
#: Sizes for which subsets are considered.
SMALL = 12
#: Shingles in a block of the packed exchange, and bits of the filter of documents.
BLOCK, FILTER_BITS = 1 << 21, 1 << 24
NO_ID = (1 << 63) - 1
#: Sets, and shingles of them, in a block of a list whose pairs are compared; words of the bits that tell a block's centre.
BLOCK_SETS, BLOCK_SHINGLES, CENTRE_WORDS = 4096, 1 << 21, 16
#: The low bits of a shingle that stand for it within a block.
LOW = np.uint64((1 << 40) - 1)


def overlap(n: int, m: int) -> int:
    """Shared shingles that a link of sets of n and m shingles needs."""
    return -(-PART * (n + m) // (PART + WHOLE))


def alone(n: int) -> int:
    """Shingles of a set of n that a linked set may lack."""
    return n - -(-PART * n // WHOLE)


def asked(n: int) -> int:
    """Of their first alone(n) + asked(n) and alone(m) + asked(m) shingles, two linked sets share the smaller asked number."""
    return max(1, n // 8)


def subset_sizes(n: int, boundary: int) -> list[int]:
    return sorted({overlap(n, m) for m in range(1, boundary + 1) if overlap(n, m) <= min(n, m)})


def boundary(histogram: dict[int, int], mean_list: float, most: int = SMALL) -> int:
    """The size up to which sets are listed by subsets, 0 to ``most``, at the least estimated cost."""

    def cost(b: int) -> float:
        by_subsets = sum(histogram.get(n, 0) * sum(math.comb(n, o) for o in subset_sizes(n, b)) for n in range(1, b + 1))
        by_lists = sum(histogram.get(n, 0) * (alone(n) + 1) * (1 + mean_list) for n in range(smallest_large(b), most + 1))
        return by_subsets + by_lists

    return min(range(most + 1), key=lambda b: (cost(b), b))


def smallest_large(b: int) -> int:
    """The smallest set that may link with one of more than b shingles."""
    return min(n for n in range(1, b + 2) if overlap(n, b + 1) <= n)


def parity(found: np.ndarray) -> bytes:
    """Bits of a set: each shingle turns one of at least 2n bits, a power of two. Folded in halves by exclusive or, they
    are the bits of that smaller size. Sets that differ in d shingles differ in at most d bits."""
    size = max(64, 1 << (2 * len(found) - 1).bit_length())
    return np.packbits(np.bincount((found & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1, bitorder="little").tobytes()


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Rows of 64-bit words, folded to ``words`` of them."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def differing(n: int, m: int) -> int:
    """Shingles in one of two linked sets only, at most."""
    return n + m - 2 * overlap(n, m)


def _documents(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = shingle_sets(utf8(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([set_hash(s) for s in sets], pa.int64()),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array([s.view(np.int64) if 0 < len(s) <= SMALL else None for s in sets], pa.list_(pa.int64())),
            ],
            names=["doc_id", "key", "n", "shingles"],
        )


def _packed(blocks: int, least: int):
    """Slices of documents -> the first shingles of their sets, packed by block; and a row with the slice's sets."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", 2 * SLICE_BYTES):
            for start in range(0, batch.num_rows, 1 << 15):
                sets = {set_hash(s): s for s in shingle_sets(utf8(batch.column("text").slice(start, 1 << 15))) if len(s) >= least}
                if not sets:
                    continue
                name = task << 32 | number
                number += 1
                firsts = [s[: alone(len(s)) + asked(len(s))] for s in sets.values()]
                tokens = np.concatenate(firsts)
                owner = np.repeat(np.arange(len(firsts), dtype=np.uint16), [len(f) for f in firsts])
                block = ((tokens >> np.uint64(44)) % np.uint64(blocks)).astype(np.int64)
                by = np.argsort(block, kind="stable")
                low = tokens[by] & LOW
                low4, low1, owner = low.astype(np.uint32), (low >> np.uint64(32)).astype(np.uint8), owner[by]
                at, first = np.unique(block[by], return_index=True)
                ends = [*first[1:].tolist(), len(by)]
                data = [low4[i:j].tobytes() + low1[i:j].tobytes() + owner[i:j].tobytes() for i, j in zip(first.tolist(), ends)]
                header = np.array(list(sets), np.int64).tobytes() + np.array([len(s) for s in sets.values()], np.int32).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*at.tolist(), -1 - xxhash.xxh3_64_intdigest(header) % blocks], pa.int64()),
                        pa.array([name] * (len(data) + 1), pa.int64()),
                        pa.array([len(sets)] * (len(data) + 1), pa.int32()),
                        pa.array([*data, header], pa.binary()),
                    ],
                    names=["block", "slice", "docs", "data"],
                )

    return pack


def _shared(group: pa.Table) -> pa.Table:
    """A block: for each slice, how many shingles of each of its sets another set holds too, in 16 bits or, where one
    needs them, 32. Other rows pass."""
    if group.column("block")[0].as_py() < 0:
        return group.select(["slice", "docs", "data"]).append_column("header", pa.array([True] * group.num_rows))
    data, docs = [x.as_py() for x in group.column("data")], group.column("docs").to_pylist()
    counts = [len(x) // 7 for x in data]
    low = np.concatenate([np.frombuffer(x, np.uint32, n) for x, n in zip(data, counts)]).astype(np.uint64)
    low |= np.concatenate([np.frombuffer(x, np.uint8, n, 4 * n) for x, n in zip(data, counts)]).astype(np.uint64) << np.uint64(32)
    order = np.argsort(low)
    same = low[order][1:] == low[order][:-1]
    held = np.zeros(len(low), bool)
    held[order] = np.append(same, False) | np.append(False, same)
    out, start = [], 0
    for x, n, d in zip(data, counts, docs):
        owner = np.frombuffer(x, np.uint16, n, 5 * n)
        shared = np.bincount(owner[held[start : start + n]], minlength=d)
        out.append(shared.astype(np.uint16 if shared.max() < 1 << 16 else np.uint32).tobytes())
        start += n
    return pa.table({"slice": group.column("slice"), "docs": group.column("docs"), "data": pa.array(out, pa.binary()), "header": pa.array([False] * len(out))})


def _possible(group: pa.Table) -> pa.Table:
    """A slice: its sets that share enough of their first shingles."""
    docs, header, total = group.column("docs")[0].as_py(), b"", 0
    for data, is_header in zip(group.column("data").to_pylist(), group.column("header").to_pylist()):
        if is_header:
            header = data
        else:
            total = total + np.frombuffer(data, f"u{len(data) // docs}").astype(np.int64)
    keys, n = np.frombuffer(header, np.int64, docs), np.frombuffer(header, np.int32, docs, 8 * docs)
    least = -(-PART * n // WHOLE)  # the smallest set that may link with it
    enough = total >= np.maximum(1, least // 8)
    return pa.table({"key": keys[enough], "n": n[enough]})


def _possible_classes(documents: DataFrame, meta: DataFrame, least: int) -> DataFrame:
    total = meta.filter(F.col("n") >= least).agg(F.sum(F.col("n") * 3 / 8)).first()[0] or 0
    packed = documents.mapInArrow(_packed(parts(int(total), BLOCK), least), "block long, slice long, docs int, data binary")
    counted = packed.groupBy("block").applyInArrow(_shared, "slice long, docs int, data binary, header boolean")
    return counted.groupBy("slice").applyInArrow(_possible, "key long, n int").distinct()


def _fetched(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, n, shingles, bits of the wanted classes, from the documents that stand for them.

    A filter of ``FILTER_BITS`` bits, whatever the number of documents, tells most other documents before their
    sets are made; the join decides.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = wanted.withColumn("bit", bit).groupBy(F.expr("bit DIV 32").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 AS int)))").alias("bits"))
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    for row in words.collect():
        table[row.word] = row.bits
    held = documents.sparkSession.sparkContext.broadcast(table)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bits = batch.column("bit").to_numpy()
            batch = batch.filter(pa.array((held.value[bits >> 5] >> (bits & 31).astype(np.uint32)) & 1 == 1))
            sets = shingle_sets(utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_hash(s) for s in sets], pa.int64()), *(pa.array([f(s) for s in sets], pa.binary()) for f in (np.ndarray.tobytes, parity))],
                names=["key", "shingles", "bits"],
            )

    place = documents.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    found = place.withColumn("bit", bit).mapInArrow(fetch, "key long, shingles binary, bits binary")
    return found.join(wanted.select("key", "n"), "key", "left_semi").dropDuplicates(["key"]).select(
        "key", (F.octet_length("shingles") / 8).cast("int").alias("n"), "shingles", "bits"
    )


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "shingles"):
        sets = [np.frombuffer(x, np.int64) for x in utf8(batch.column("shingles"))]
        sizes = [len(s) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64)),
                pa.array(np.repeat(batch.column("key").to_numpy(), sizes)),
                pa.array(np.repeat(np.array(sizes, np.int32), sizes)),
            ],
            names=["token", "key", "n"],
        )


def _twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token, those whose token another row has. One row waits for the next batch."""
    last, was = None, False  # the row held back, and whether the row before it has its token
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch.slice(0) if last is None else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
        token = batch.column("token").to_numpy()
        same = token[1:] == token[:-1]
        shared = np.append(same, False) | np.append(was, same)
        last, was = batch.slice(batch.num_rows - 1), bool(shared[-1])
        yield batch.slice(0, batch.num_rows - 1).filter(pa.array(shared[:-1]))
    if last is not None and was:
        yield last


def _whole(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows, cut so that equal values of a column stand in one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy()
        cut = int(np.searchsorted(values, values[-1]))
        if held and cut == 0 and held[-1].column(column)[0].as_py() == values[0]:
            held.append(batch)
            continue
        yield from _joined([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    yield from _joined(held)


def _joined(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if sum(x.num_rows for x in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each set's shared shingles, sorted, those of its prefix, and the place of each in the set's order."""
    for batch in _whole(batches, "key"):
        keys, n = batch.column("key").to_numpy(), batch.column("n").to_numpy()
        _, first, inverse, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        place = n - count[inverse] + np.arange(len(keys)) - first[inverse]
        inside = place <= n - -(-PART * n // WHOLE)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place.astype(np.int32))], names=[*batch.schema.names, "place"]).filter(pa.array(inside))


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by token, class and lot -> each member with its class's first member, and with that of the class below.

    The leaders are carried from batch to batch, so a list may be of any length.
    """
    token, kind, leader, below = None, None, None, None  # leaders: (key, n, component)
    for batch in batches:
        out: list[tuple[int, int]] = []
        columns = [batch.column(x).to_pylist() for x in ("token", "class", "key", "n", "component")]
        for t, c, key, n, part in zip(*columns):
            if t != token or c != kind:
                below = leader if t == token and c == kind + 1 else None
                token, kind, leader = t, c, (key, n, part)
            elif part != leader[2]:
                out.append((leader[0], key))
            if below and part != below[2] and overlap(n, below[1]) <= min(n, below[1]):
                out.append((below[0], key))
        yield _pairs([np.array(out, np.int64).reshape(-1, 2)])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by pair of blocks -> those members that may link with a member of another component, by size, place and,
    where they are there, bits. No pair leaves the task.
    """
    for batch in _whole(batches, "pair"):
        good = np.zeros(batch.num_rows, bool)
        for start, stop, members in _lists(batch):
            good[start:stop] = members.open()
        yield batch.filter(pa.array(good)).select(["pair", "token", "key", "n", "place", "component", "chunk"])


def _lists(batch: pa.RecordBatch) -> Iterator[tuple[int, int, _Members]]:
    """The lists, or pairs of blocks of lists, in a batch of sorted rows that hold several components."""
    columns = [batch.column(x).to_numpy() for x in ("token", "key", "n", "place", "component", "chunk")]
    pair, token, part = batch.column("pair").to_numpy(), columns[0], columns[4]
    bits = [np.frombuffer(x, np.uint64) for x in batch.column("bits").to_pylist()] if "bits" in batch.schema.names else []
    starts = np.append(np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (token[1:] != token[:-1]))), len(pair)).tolist()
    for start, stop in zip(starts, starts[1:]):
        if stop - start > 1 and (part[start:stop] != part[start]).any():
            yield start, stop, _Members(*(c[start:stop] for c in columns), bits[start:stop])


class _Members:
    """The members of one block of a list, or of two that meet: sizes, places in the list's order, components and bits."""

    def __init__(self, token: np.ndarray, key: np.ndarray, n: np.ndarray, place: np.ndarray, part: np.ndarray, chunk: np.ndarray, bits: list[np.ndarray]):
        self.token, self.key, self.n, self.part, self.chunk, self.bits = int(token[0]), key, n.astype(np.int64), part, chunk, bits
        self.left = self.n - place
        self._prepare()

    def _prepare(self) -> None:
        self.words = np.array([len(x) for x in self.bits])
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.within = self.chunk.min() == self.chunk.max()

    def _possible(self, i: int, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of j that size, place, component and bits allow to link with i, and what they need to share."""
        low, high = np.minimum(self.n[i], self.n[j]), np.maximum(self.n[i], self.n[j])
        needs = -(-PART * (low + high) // (PART + WHOLE))
        good = (self.part[j] != self.part[i]) & (needs <= low) & (np.minimum(self.left[i], self.left[j]) >= needs)
        if not self.within:
            good &= self.chunk[j] != self.chunk[i]
        j, needs = j[good], needs[good]
        if len(j) and self.bits:
            good = self._near(i, j, self.n[i] + self.n[j] - 2 * needs)
            j, needs = j[good], needs[good]
        return j, needs

    def _near(self, i: int, others: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Those of the others whose bits differ from set i's in ``most`` at most."""
        good = np.zeros(len(others), bool)
        widths = np.minimum(self.words[others], self.words[i])
        for width in np.unique(widths).tolist():
            if width not in self.folded:
                rows = np.flatnonzero(self.words >= width)
                place = np.full(len(self.words), -1)
                place[rows] = np.arange(len(rows))
                self.folded[width] = place, np.stack([_folded(self.bits[j], width) for j in rows])
            place, rows = self.folded[width]
            at = np.flatnonzero(widths == width)
            apart = np.bitwise_count(rows[place[others[at]]] ^ rows[place[i]]).sum(axis=1, dtype=np.int64)
            good[at] = apart <= most[at]
        return good

    def open(self) -> np.ndarray:
        found = np.zeros(len(self.n), bool)
        for i in range(len(self.n) - 1):
            j, _ = self._possible(i, np.arange(i + 1, len(self.n)))
            if len(j):
                found[i] = True
                found[j] = True
        return found


class _Block(_Members):
    """Members with their sets."""

    def __init__(self, members: _Members, sets: list[np.ndarray]):
        # Those near what most have come first: where one set links with all others, it soon joins them.
        width = min(CENTRE_WORDS, *(len(x) for x in members.bits))
        short = np.unpackbits(np.stack([_folded(x, width) for x in members.bits]).view(np.uint8), axis=1)
        by = np.argsort((short != (2 * short.sum(axis=0, dtype=np.int64) > len(short))).sum(axis=1), kind="stable")
        self.key, self.n, self.chunk, self.left = members.key[by], members.n[by], members.chunk[by], members.left[by]
        self.sets, self.bits = [np.sort(sets[i]) for i in by], [members.bits[i] for i in by]
        self.before = np.array([np.searchsorted(x, members.token) for x in self.sets])
        self.part = np.unique(members.part[by], return_inverse=True)[1]
        self._prepare()

    def _held(self, i: int, others: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How many of the first ``upto`` shingles of each other set are in set i."""
        parts = [self.sets[j][:u] for j, u in zip(others.tolist(), upto.tolist())]
        values, own = np.concatenate([*parts, self.sets[i][:0]]), self.sets[i]
        hit = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
        return np.bincount(np.repeat(np.arange(len(parts)), upto)[hit], minlength=len(parts))

    def links(self) -> list[tuple[int, int]]:
        """A forest: links that join all components of the block which its pairs connect.

        A pair is looked at in the list of its smallest common shingle only, and not if it is connected already.
        """
        out = []
        for i in range(len(self.key) - 1):
            j, needs = self._possible(i, np.arange(i + 1, len(self.key)))
            if len(j):
                first = self._held(i, j, self.before[j]) == 0
                j, needs = j[first], needs[first]
            if len(j):
                for k in j[self._held(i, j, self.n[j]) >= needs].tolist():
                    if self.part[k] != self.part[i]:
                        out.append((int(self.key[i]), int(self.key[k])))
                        self.part[self.part == self.part[k]] = self.part[i]
        return out


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by pair of blocks -> the links that connect the components of each, never more than its members."""
    for batch in _whole(batches, "pair"):
        sets = batch.column("shingles").to_pylist()
        found = []
        for start, stop, members in _lists(batch):
            found += _Block(members, [np.frombuffer(x, np.int64) for x in sets[start:stop]]).links()
        yield _pairs([np.array(found, np.int64).reshape(-1, 2)])


def _pairs(found: list) -> pa.RecordBatch:
    both = np.concatenate([np.empty((0, 2), np.int64), *found])
    rows = np.unique(np.sort(both, axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["a", "b"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that their bits allow."""
    for batch in batches:
        good = []
        for x, y, n, m in zip(*(batch.column(c).to_pylist() for c in ("left", "right", "n", "m"))):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            width = min(len(x), len(y))
            good.append(int(np.bitwise_count(_folded(x, width) ^ _folded(y, width)).sum()) <= differing(n, m))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
        good = []
        for x, y in zip(left, right):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            good.append(len(np.intersect1d(x, y, assume_unique=True)) >= overlap(len(x), len(y)))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link: first by their bits, a thirtieth of the sets, then exactly by the sets.

    Pairs are written before they are joined: Spark then knows when they are few enough not to shuffle the sets.
    """

    def sides(column: str) -> tuple[DataFrame, DataFrame]:
        left = sets.select(F.col("key").alias("a"), F.col(column).alias("left"), "n")
        return left, sets.select(F.col("key").alias("b"), F.col(column).alias("right"), F.col("n").alias("m"))

    for column, check in (("bits", _near), ("shingles", _verified)):
        left, right = sides(column)
        pairs = staged(pairs).join(left, "a").join(right, "b").mapInArrow(check, "a long, b long")
    return pairs


def _subset_pairs(small: DataFrame, most: int) -> DataFrame:
    """Pairs of a subset's list: its smallest set with every other one that it links with."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, shingles in zip(batch.column("key").to_pylist(), batch.column("shingles").to_pylist()):
                found = sorted(shingles)
                for o in subset_sizes(len(found), most):
                    out += [(o, xxhash.xxh3_64_intdigest(np.array(s, np.int64).tobytes()) - (1 << 63), key, len(found)) for s in combinations(found, o)]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int32()))], names=["o", "subset", "key", "n"])

    lists = staged(small.filter(F.col("n") <= most).select("key", "shingles").mapInArrow(listed, "o int, subset long, key long, n int"))
    first = lists.groupBy("o", "subset").agg(F.min(F.struct("n", "key")).alias("first"))
    pairs = lists.join(first, ["o", "subset"]).filter(F.col("key") != F.col("first.key"))
    linked = F.col("o") * (PART + WHOLE) >= PART * (F.col("n") + F.col("first.n"))
    return pairs.filter(linked).select(F.least("key", "first.key").alias("a"), F.greatest("key", "first.key").alias("b")).distinct()


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``documents``: five-word shingles, linked at a Jaccard of 0.75.

    ``component_id`` is the smallest doc_id reachable by links, the row's own included. A text that is null or has no
    word has no shingles and links with nothing. Rows with equal sets link, repeated rows too. Rows without an id
    stand after all others: their component has no id only if no member has one. Other columns are ignored, whatever
    their names. No rows give no rows.
    """
    source = _documents(documents, doc_id, text)
    meta = staged(source.mapInArrow(_sizes, "doc_id long, key long, n int, shingles array<long>"))
    place = F.coalesce("doc_id", F.lit(NO_ID))
    classes = staged(meta.filter("n > 0").groupBy("key", "n").agg(F.min(place).alias("doc_id")))
    small = staged(meta.filter("shingles IS NOT NULL").select("key", "n", "shingles").dropDuplicates(["key"]))
    histogram = {r.n: r["count"] for r in small.groupBy("n").count().collect()}
    listed = small.select(F.explode("shingles").alias("token")).groupBy("token").count().agg(F.avg("count")).first()[0] or 1.0
    limit = boundary(histogram, listed)

    possible = staged(_possible_classes(source, meta, smallest_large(limit)))
    sets = staged(_fetched(source, possible.join(classes, ["key", "n"])))
    tokens = sets.mapInArrow(_exploded, "token long, key long, n int")
    many = parts(sets.agg(F.sum("n")).first()[0] or 0, 1 << 20, least=12)
    common = tokens.repartition(many, "token").sortWithinPartitions("token").mapInArrow(_twice, "token long, key long, n int")
    prefixes = common.repartition(many, "key").sortWithinPartitions("key", "token").mapInArrow(_prefixes, "token long, key long, n int, place int")
    band = F.floor(F.log(F.col("n") + 0.001) / math.log(WHOLE / PART)).cast("int").alias("class")
    lists = staged(prefixes.select("token", "key", "n", "place", band))

    links = verified(_stars_of(lists.withColumn("component", F.col("key")), many, 0), sets)
    links = staged(links.unionByName(_subset_pairs(small, limit)).distinct())
    for salt in (1, None):
        named = lists.join(components(links), "key", "left").withColumn("component", F.coalesce("component", "key"))
        found = _across_of(named, sets, many) if salt is None else verified(_stars_of(named, many, salt), sets)
        links = staged(links.unionByName(found).distinct())

    named = classes.join(components(links), "key", "left").withColumn("component", F.coalesce("component", "key"))
    named = staged(named.select("key", "component", "doc_id"))
    first = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    answer = staged(named.join(first, "component").select("key", "component_id"))
    found = meta.filter("n > 0").select("doc_id", "key", "n").join(answer, "key", "left")
    named_id = F.when(F.col("component_id") == NO_ID, None).otherwise(F.col("component_id")).alias("component_id")
    empty = meta.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), named_id).unionByName(empty)


def _open(named: DataFrame) -> DataFrame:
    """The lists that hold more than one component, with their sizes."""
    lists = named.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"), F.sum("n").alias("held")
    )
    return lists.filter("low < high").select("token", "members", "held")


def _stars_of(named: DataFrame, many: int, salt: int) -> DataFrame:
    lot = F.xxhash64("key", F.lit(salt)).alias("lot")
    rows = named.join(_open(named).select("token"), "token", "left_semi").select("token", "class", lot, "key", "n", "component")
    rows = rows.repartition(many, "token").sortWithinPartitions("token", "class", "lot")
    return rows.select("token", "class", "key", "n", "component").mapInArrow(_stars, "a long, b long").distinct()


def _across_of(named: DataFrame, sets: DataFrame, lists: int) -> DataFrame:
    """The links that join the components left in the open lists.

    A list is cut into blocks by a hash of the set, and every two blocks meet in a task of their own, so that neither
    a long list nor one of long sets is one task's. Sets are verified there, and a task hands on a forest of links.
    """
    cuts = F.greatest(F.ceil(F.col("members") / BLOCK_SETS), F.ceil(F.col("held") / BLOCK_SHINGLES)).cast("int")
    rows = named.join(_open(named), "token").withColumn("cuts", cuts).withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("cuts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    pair = F.xxhash64("token", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("pair")
    rows = rows.select(pair, "token", "key", "n", "place", "component", "chunk")
    # By size and place alone, then with the bits, a thirtieth of the sets, and the sets only where a link may be.
    members = "pair long, token long, key long, n int, place int, component long, chunk int"
    names = [c.split()[0] for c in members.split(", ")]

    def dealt(df: DataFrame, many: int) -> DataFrame:
        return df.repartition(many, "pair").sortWithinPartitions("pair", "token", "key")

    def kept(df: DataFrame, *added: str) -> DataFrame:
        return staged(df.select(*names, *added).mapInArrow(_candidates, members))

    def of(rows: DataFrame, known: DataFrame) -> DataFrame:
        """The sets of the rows, written: the table of their keys is small enough, most times, not to shuffle all others."""
        return staged(known.join(staged(rows.select("key").distinct()), "key", "left_semi"))

    rows = kept(dealt(rows, lists))
    known = of(rows, sets.select("key", "shingles", "bits"))
    rows = kept(dealt(rows.join(known.select("key", "bits"), "key"), parts(rows_of(rows), 16 * BLOCK_SETS, least=12)), "bits")
    met = dealt(rows.join(of(rows, known), "key"), parts(rows_of(rows), BLOCK_SETS, least=12))
    return met.select(*names, "shingles", "bits").mapInArrow(_across, "a long, b long").distinct()
