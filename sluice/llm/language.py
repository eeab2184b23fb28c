"""Language identification by rank-order profiles.

A text's letters are lower-cased, every run of other characters becomes one blank, and n-grams of one to three
characters are counted that don't run across a blank. Counts are ranked: an n-gram's rank is one more than the number
of n-grams that are more frequent, so equal counts share a rank and no order among them has to be made up. A
language's profile holds its ``SIZE`` most frequent n-grams over all learning texts. A document is given the language
whose profile its own n-grams of rank up to ``SIZE`` are least out of place in; an n-gram that a profile lacks
counts as ``SIZE`` places.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import slices

SIZE = 400
UNKNOWN = "und"
BLANK = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: 2 for a letter, 1 for a mark that belongs to letters, 0 for anything else."""
    kinds = (unicodedata.category(chr(c))[0] for c in range(0x110000))
    return np.fromiter((2 if k == "L" else 1 if k == "M" else 0 for k in kinds), np.uint8, 0x110000)


def grams(text: str) -> np.ndarray:
    """The n-grams of a text, as numbers made of the characters' code points; none for a text without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    kinds = _letters()[codes]
    if not (kinds == 2).any():
        return np.empty(0, np.int64)
    codes = np.concatenate([[BLANK], np.where(kinds > 0, codes, BLANK), [BLANK]])
    codes = codes[np.concatenate([[True], (codes[1:] != BLANK) | (codes[:-1] != BLANK)])]
    held = codes != BLANK
    pairs = codes[:-1] << 21 | codes[1:]
    triples = pairs[:-1] << 21 | codes[2:]
    return np.concatenate([codes[held], pairs, triples[held[1:-1]]])


def ranked(text: str, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """The text's n-grams of rank up to ``size`` and their ranks."""
    return _ranked(grams(text), size)


def _ranked(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    found, n = np.unique(codes, return_counts=True)
    more = len(n) - np.searchsorted(np.sort(n), n, "right")
    top = more < size
    return found[top], more[top] + 1


def profiles(documents: DataFrame, lang: str = "lang", text: str = "text", size: int = SIZE) -> DataFrame:
    """lang, gram, rank: the ``size`` most frequent n-grams of each language over all rows with a language; ties by gram."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            by_lang: dict[str, list[np.ndarray]] = {}
            for name, x in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_lang.setdefault(name, []).append(grams(x or ""))
            for name, found in by_lang.items():
                codes, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"]
                )

    learn = documents.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).filter("lang IS NOT NULL")
    counts = learn.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size).select("lang", "gram", "rank")


class Profiles:
    """The ranks of all languages' n-grams as one table: a row for each n-gram, a column for each language."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = SIZE):
        self.size = size
        self.names = sorted({lang for lang, _, _ in rows})
        self.grams = np.unique(np.array([g for _, g, _ in rows], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), 0, np.int64)
        for lang, g, rank in rows:
            self.ranks[np.searchsorted(self.grams, g), self.names.index(lang)] = rank

    def closest(self, text: str) -> tuple[str, float]:
        """The language with the least distance (ties: the first by name), and 1 - distance / the most it can be."""
        return self.measured(text)[:2]

    def measured(self, text: str) -> tuple[str, float, int]:
        """The same, and the text's length class: by powers of four of its number of n-grams."""
        codes = grams(text)
        found, rank = _ranked(codes, self.size)
        length = len(codes).bit_length() // 2
        if not len(found) or not self.names:
            return UNKNOWN, 0.0, length
        at = np.searchsorted(self.grams, found)
        known = np.append(self.grams, -1)[at] == found
        theirs = self.ranks[np.where(known, at, len(self.grams))]
        places = np.where(theirs > 0, np.minimum(np.abs(theirs - rank[:, None]), self.size), self.size)
        distance = places.sum(axis=0)
        best = int(distance.argmin())
        return self.names[best], 1.0 - float(distance[best]) / (self.size * len(found)), length


def fitted(documents: DataFrame, lang: str = "lang", text: str = "text", size: int = SIZE, most: int = 1000) -> Profiles:
    """The profiles on the driver: ``size`` rows for each language, and it is an error if there are over ``most``."""
    rows = [(r.lang, r.gram, r.rank) for r in profiles(documents, lang, text, size).limit(size * most + 1).collect()]
    if len(rows) > size * most:
        raise ValueError(f"more than {most} languages")
    return Profiles(rows, size)


def beginning(text: str) -> str | None:
    """One of the text's beginnings of 8, 32, 128 and so on characters, picked by the text's crc32; None if it has none."""
    n = max(len(text) - 1, 0).bit_length() // 2 - 1  # of the lengths 2 ** 3, 2 ** 5, ..., those under len(text)
    return text[: 8 << 2 * (zlib.crc32(text.encode("utf-8", "surrogatepass")) % n)] if n > 0 else None


def predicted(documents: DataFrame, found: Profiles, text: str = "text", language: str = "lang_pred", score: str = "score", length: str | None = None, start: str | None = None) -> DataFrame:
    """All columns and rows of ``documents`` with the predicted language and its score from 0 to 1.

    A text that is null or has no letter is ``und`` with score 0. Columns named like the new ones are replaced.
    ``length`` names a column for the length class, if wanted, and ``start`` one for the length class and score of one of
    the text's beginnings (null without one, or where it has no letter).
    """
    table = documents.sparkSession.sparkContext.broadcast(found)
    new = {language: "string", score: "double", **({length: "int"} if length else {}), **({start: "struct<length:int,score:double>"} if start else {})}
    kept = documents.drop(*new)

    def begun(x: str) -> dict | None:
        first = beginning(x)
        name, value, classed = table.value.measured(first) if first else (UNKNOWN, 0.0, 0)
        return None if name == UNKNOWN else {"length": classed, "score": value}

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = [x or "" for x in batch.column(text).to_pylist()]
            best = [table.value.measured(x) for x in texts]
            columns = [pa.array([x[i] for x in best], t) for i, t in enumerate((pa.string(), pa.float64(), pa.int32()))][: 3 if length else 2]
            if start:
                columns.append(pa.array([begun(x) for x in texts], pa.struct([("length", pa.int32()), ("score", pa.float64())])))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *new])

    return kept.mapInArrow(predict, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), *(f"{k} {v}" for k, v in new.items())]))


#: Scores are counted in steps of one by this, so that a quantile is exact and depends on no order of rows.
SCORE_STEPS = 4096


def least_scores(judged: DataFrame, score: str, length: str, start: str, lang: str = "lang", share: float = 0.05) -> dict[int, float]:
    """By length class, the score that all but ``share`` of the labelled texts reach, in the language where that is least.

    ``judged`` are labelled rows as ``predicted`` returns them. Every text counts whole and with one of its beginnings, so
    that short classes are known too. Scores of long texts rise as they fill the profile; a class gets no more than the
    class below it. Scores are cut to steps of 1 / ``SCORE_STEPS``; those of 0 tell nothing and don't count.
    """
    whole = F.struct(F.col(length).alias("length"), F.col(score).alias("score"))
    scores = judged.select(F.col(lang).cast("string").alias("lang"), F.explode(F.array(whole, F.col(start))).alias("x")).filter("lang IS NOT NULL AND x.score > 0")
    steps = scores.groupBy("lang", "x.length", F.floor(F.col("x.score") * SCORE_STEPS).alias("step")).agg(F.count("*").alias("n"))
    rising = W.partitionBy("lang", "length").orderBy("step")
    reached = F.sum("n").over(rising) >= share * F.sum("n").over(W.partitionBy("lang", "length"))
    usual = steps.withColumn("reached", reached).filter("reached").groupBy("lang", "length").agg(F.min("step").alias("step"))
    least: dict[int, float] = {}
    for r in usual.groupBy("length").agg(F.min("step").alias("step")).orderBy("length").collect():
        least[r.length] = min([r.step / SCORE_STEPS, *least.values()])
    return least


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows kept from learning: crc32 of the id as text leaves remainder 2 by 4. A row without an id is not one."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
