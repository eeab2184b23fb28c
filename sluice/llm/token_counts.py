"""Token counts by a two-tier lookup on the map side.

A first pass counts the words between spaces of all documents, in at most ``SAMPLED_TASKS`` tasks, and hands on the most
frequent of each. The most frequent of all, with their lengths in tokens, make a compact table that is broadcast: at most
``FREQUENT`` entries of at most ``LONGEST`` characters, whatever the size of the corpus. The second pass, over all documents
again, looks words up there and encodes the others through a bounded cache in each Python worker. The table only saves work:
a word that is not in it is encoded all the same. Neither the words nor their counts are shuffled. Texts that
``Encoder.spaced`` does not split look up no words in the second pass, so the first counts none in them.

Memory is bounded by the rule of Misra and Gries: a task that holds more than ``COUNTED`` words takes a count off all that
leaves at most ``FREQUENT`` of them, so a word loses less than one in ``FREQUENT`` of the task's words. A word of the allowed
length that makes up more than 1 / ``HANDED_ON`` + 1 / ``FREQUENT`` of all words does so in some task as well, is among those
that it hands on, and so reaches the driver, wherever in the table it stands.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import slices
from sluice.llm.tokens import Encoder

FREQUENT = 1 << 16
LONGEST = 32
#: Tasks of the first pass, which bound what reaches the driver (no text is left out), and the words that each holds and hands on.
SAMPLED_TASKS, COUNTED, HANDED_ON = 256, 1 << 18, 1 << 12


@lru_cache(maxsize=4)
def _encoder(path: str, pieces: tuple[str, ...] | None = None, lengths: tuple[int, ...] | None = None) -> Encoder:
    return Encoder(path, len, sum, dict(zip(pieces or (), lengths or ())))


def lightened(seen: Counter, most: int) -> Counter:
    """At most ``most`` of the counted words: all lose the count of the next one, and those without any left make room."""
    if len(seen) <= most:
        return seen
    next_one = sorted(seen.values(), reverse=True)[most]
    return Counter({p: n - next_one for p, n in seen.items() if n > next_one})


def frequent_lengths(documents: DataFrame, path: str, text: str = "text", most: int = FREQUENT) -> tuple[tuple[str, ...], tuple[int, ...]]:
    """The most frequent words of all documents, ties by word, and the number of tokens of each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = _encoder(path), Counter()
        for batch in slices(batches, "text"):
            for x in batch.column("text").to_pylist():
                seen.update(encoder.spaced(x) or () if x else ())
            if len(seen) > COUNTED:
                seen = lightened(seen, FREQUENT)
        top = [(p, n) for p, n in seen.most_common(HANDED_ON) if len(p) <= LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([[p for p, _ in top]], pa.list_(pa.string())), pa.array([[n for _, n in top]], pa.list_(pa.int64()))], names=["pieces", "n"])

    source = documents.select(F.col(text).cast("string").alias("text")).coalesce(SAMPLED_TASKS)
    seen = Counter()
    for r in source.mapInArrow(count, "pieces array<string>, n array<long>").collect():
        seen.update(dict(zip(r.pieces, r.n)))
    pieces = tuple(sorted(seen, key=lambda p: (-seen[p], p))[:most])
    encoder = _encoder(path)
    return pieces, tuple(encoder.words[p] for p in pieces)


def token_counts(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, with the tokenizer file at ``path``, without special tokens.

    Null counts as empty: 0 bytes and 0 tokens. Special strings in a text are handled as the library's default.
    Repeated rows give repeated results; other columns are ignored, whatever their names. No rows give no rows.
    """
    table = documents.sparkSession.sparkContext.broadcast(frequent_lengths(documents, path, text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, *table.value)
        for batch in slices(batches, "text"):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            tokens = [encoder.encoded(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x.encode()) for x in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
