"""What each filter of a chain removes under every order, by counting paths through the lattice of filter subsets.

Every row gets a bit mask of the filters it fails. Rows are counted by part and mask, so that a part leaves at most
2^k cells however many rows it has, and all later work is on cells. A state of the lattice is the set of filters
applied so far; an edge applies one more. An edge removes the rows that pass the whole state and fail its filter.
The number of orders that reach a state is counted forward over the edges, the number that leaves it backward; their
product is the number of orders that run through an edge. A filter's Shapley sum is its edges' removals weighted with
that number, and the steps of a single order are the edges on its way.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import slices, staged, utf8

#: More filters than this have too many states to send with the plan, and more than this too many orders to list.
MOST_FILTERS, MOST_LISTED = 10, 7
UPPER, MARKS = bytes(range(0x41, 0x5B)), b"#$%&*|"


def few_words(text: bytes, words: list[bytes]) -> bool:
    return len(words) < 100


def repetitive(text: bytes, words: list[bytes]) -> bool:
    return 100 * len(set(words)) < 80 * len(words)


def shouting(text: bytes, words: list[bytes]) -> bool:
    capitals = len(text) - len(text.translate(None, UPPER))
    return capitals > 0 and 100 * capitals > 10 * len(text.decode())


def marked(text: bytes, words: list[bytes]) -> bool:
    return len(text.translate(None, MARKS)) < len(text)


#: A filter of single texts gets the UTF-8 bytes and the words between white space, and tells whether the text fails.
Filter = Callable[[bytes, list[bytes]], bool]
FILTERS: dict[str, Filter] = {"A": few_words, "B": repetitive, "C": shouting, "D": marked}
COPY = "E"


class Lattice:
    """The states and edges of the subset lattice of ``filters``, with the orders that run through each edge.

    ``before`` lists pairs of filters of which the first has to come before the second in every order.
    """

    def __init__(self, filters: Iterable[str], before: Iterable[tuple[str, str]] = ()):
        self.filters = list(filters)
        k = len(self.filters)
        if not 0 < k <= MOST_FILTERS or len(set(self.filters)) < k:
            raise ValueError(f"1 to {MOST_FILTERS} different filters are needed, not {self.filters}")
        self.needs = [0] * k
        for first, second in before:
            self.needs[self.filters.index(second)] |= 1 << self.filters.index(first)
        steps = [(s, f, s | 1 << f) for s in range(1 << k) for f in range(k) if not s >> f & 1 and not self.needs[f] & ~s]
        self.reaching, self.leaving = [0] * (1 << k), [0] * (1 << k)
        self.reaching[0] = self.leaving[-1] = 1
        for s, _, t in steps:  # an edge leads to a larger number
            self.reaching[t] += self.reaching[s]
        for s, _, t in reversed(steps):
            self.leaving[s] += self.leaving[t]
        self.orders = self.leaving[0]
        if not self.orders:
            raise ValueError("no order of the filters is allowed")
        #: state, filter, orders through the edge; edges that no order uses are left out.
        self.edges = [(s, f, n) for s, f, t in steps if (n := self.reaching[s] * self.leaving[t])]

    def listed(self) -> list[tuple[str, ...]]:
        """All allowed orders. Only for few filters."""
        if len(self.filters) > MOST_LISTED:
            raise ValueError(f"the orders of more than {MOST_LISTED} filters are not listed; give those wanted")
        place = {f: i for i, f in enumerate(self.filters)}

        def allowed(order: tuple[str, ...]) -> bool:
            done = 0
            for f in order:
                if self.needs[place[f]] & ~done:
                    return False
                done |= 1 << place[f]
            return True

        return [order for order in permutations(self.filters) if allowed(order)]

    def steps(self, orders: Iterable[Iterable[str]]) -> list[tuple[str, int, int, int]]:
        """order, step from 1, state before it, filter: the edges of the given orders."""
        place, out = {f: i for i, f in enumerate(self.filters)}, []
        for order in orders:
            state = 0
            for step, f in enumerate(order, 1):
                out.append(("".join(order), step, state, place[f]))
                state |= 1 << place[f]
        return out


def _judged(filters: list[Filter]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            digests, masks = [], []
            for text in utf8(batch.column("text")):
                words = text.split()  # bytes are split at the characters 9-13 and 32
                digests.append(hashlib.sha256(text).digest())
                masks.append(sum(1 << i for i, fails in enumerate(filters) if fails(text, words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())],
                names=["doc_id", "part", "digest", "mask"],
            )

    return run


def text_cells(
    documents: DataFrame, labels: DataFrame, marks: dict[str, Column], part: str = "lang", doc_id: str = "doc_id", text: str = "text",
    filters: dict[str, Filter] | None = None,
) -> DataFrame:
    """part, mask, n and a count for each of ``marks``: the documents of a part that fail exactly the filters of ``mask``.

    Bit i is the i-th of ``filters``; the bit after them is ``COPY``: a smaller doc_id has the identical text. ``marks``
    are conditions on the label rows; a document has a mark if any label row of its id has it. A null text counts as
    empty, a null part as the empty string. A row without an id has no labels and no smaller id, so it is never a copy.
    Repeated rows count as often as they occur. Other columns are ignored, whatever their names.

    Texts leave the first task as digests. Rows are counted by id and text before they meet the labels, then by text
    and mask before the smallest id of a text is looked up, so that neither a group of copies nor an id of very many
    rows meets in one task.
    """
    filters = FILTERS if filters is None else filters
    source = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).cast("string").alias("text")
    )
    judged = source.mapInArrow(_judged(list(filters.values())), "doc_id long, part string, digest binary, mask int")
    rows = judged.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    names = [f"mark{i}" for i in range(len(marks))]
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), *[F.coalesce(c, F.lit(False)).cast("int").alias(m) for m, c in zip(names, marks.values())])
    known = known.filter("label_id IS NOT NULL").groupBy("label_id").agg(*[F.max(m).alias(m) for m in names]).withColumn("place", F.lit(0))
    # Rows without an id match nothing; a number of their own deals them over the tasks.
    apart = F.when(F.col("doc_id").isNull(), F.xxhash64("digest").bitwiseOR(F.lit(1))).otherwise(0)
    met = rows.withColumn("apart", apart).join(known, (F.col("doc_id") == F.col("label_id")) & (F.col("apart") == F.col("place")), "left")
    met = met.select("doc_id", "digest", "part", "mask", "n", *[F.coalesce(m, F.lit(0)).alias(m) for m in names])
    has_id = F.col("doc_id").isNotNull()
    groups = staged(
        met.groupBy("digest", "part", "mask", *names).agg(
            F.sum("n").alias("n"),
            F.sum(F.when(has_id, F.col("n")).otherwise(0)).alias("numbered"),
            F.min("doc_id").alias("first"),
            F.min_by("n", "doc_id").alias("at_first"),
        )
    )
    firsts = groups.groupBy("digest").agg(F.min("first").alias("smallest"))
    met = groups.join(firsts, "digest")
    copies = F.col("numbered") - F.when(F.col("first") == F.col("smallest"), F.col("at_first")).otherwise(0)
    counted = met.groupBy("part", "mask", *names).agg(F.sum(copies).alias("copies"), F.sum(F.col("n") - copies).alias("firsts"))
    both = F.inline(
        F.array(
            F.struct((F.col("mask").bitwiseOR(1 << len(filters))).alias("cell"), F.col("copies").alias("count")),
            F.struct(F.col("mask").alias("cell"), F.col("firsts").alias("count")),
        )
    )
    cells = counted.select("part", *names, both)
    of_mark = [F.sum(F.when(F.col(m) == 1, F.col("count")).otherwise(0)).alias(name) for m, name in zip(names, marks)]
    return cells.groupBy("part", F.col("cell").alias("mask")).agg(F.sum("count").alias("n"), *of_mark)


def edge_counts(cells: DataFrame, lattice: Lattice, counts: Iterable[str] = ()) -> DataFrame:
    """part, state, filter, paths, kept, removed, redundant, unique_fails and ``<count>_lost`` of every edge of every part.

    ``cells`` has part, mask, n and ``counts``, one row or several for a mask. An edge that removes nothing has zeros.
    """
    counts = list(counts)
    listed = json.dumps([{"state": s, "filter": f, "paths": n} for s, f, n in lattice.edges])
    edges = F.from_json(F.lit(listed), "array<struct<state:int,filter:int,paths:bigint>>")  # one constant of the plan
    met = cells.select("part", "mask", "n", *counts, F.inline(edges))
    bit = F.expr("shiftleft(1, filter)")
    fails = F.col("mask").bitwiseAND(bit) != 0
    passes = F.col("mask").bitwiseAND(F.col("state")) == 0

    def total(condition: Column, column: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    return met.groupBy("part", "state", "filter", "paths").agg(
        total(passes & ~fails).alias("kept"), total(passes & fails).alias("removed"), total(~passes & fails).alias("redundant"),
        total(F.col("mask") == bit).alias("unique_fails"), *[total(passes & fails, c).alias(f"{c}_lost") for c in counts],
    )


def shapley(edges: DataFrame) -> DataFrame:
    """part, filter, shapley: what the filter removes, summed over all orders. Divided by their number, its Shapley value."""
    return edges.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("paths")).alias("shapley"))


def order_audit(cells: DataFrame, lattice: Lattice, counts: Iterable[str] = (), orders: Iterable[Iterable[str]] | None = None) -> DataFrame:
    """part, filter_order, step, filter, the counts of the step's edge and the filter's Shapley sum, for all allowed
    orders or those given. The joined tables are of the lattice, not of the rows. No cells give no rows."""
    counts = list(counts)
    spark = cells.sparkSession
    edges = staged(edge_counts(cells, lattice, counts))
    steps = lattice.steps(lattice.listed() if orders is None else orders)
    ways = spark.createDataFrame(steps, "filter_order string, step int, state int, filter int")
    of_filter = shapley(edges)
    found = edges.join(F.broadcast(ways), ["state", "filter"]).join(of_filter, ["part", "filter"])
    letter = reduce(lambda x, i: x.when(F.col("filter") == i, lattice.filters[i]), range(len(lattice.filters)), F)
    numbers = ["kept", "removed", "redundant", "unique_fails", *[f"{c}_lost" for c in counts], "shapley"]
    return found.select("part", "filter_order", "step", letter.alias("filter"), *numbers)


def filter_audit(documents: DataFrame, labels: DataFrame, part: str = "lang", before: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """The audit of ``FILTERS`` and ``COPY`` over whole texts, with the good and toxic documents that each step loses.

    ``labels`` has doc_id, quality and toxic. For null, empty and repeated rows see ``text_cells``. No documents give no rows.
    """
    marks = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    cells = text_cells(documents, labels, marks, part)
    return order_audit(staged(cells), Lattice([*FILTERS, COPY], before), list(marks))
