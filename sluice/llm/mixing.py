"""Mixing sources to target weights by temperature, with DataFrame functions only.

A source's weight is its share of all tokens to the power a, normalised. At a = 1 the corpus is as it is, at a = 0
every source weighs the same. The exponent is bisected until the weights' entropy meets a target, or until no source is
repeated more often than allowed; of both, the larger exponent counts. Five levels of the bisection are evaluated by one
aggregate over the table of sources, so only sums come to the driver, however many sources there are.

The weights are realised by block permutations under a budget. A source's documents are dealt over blocks of about
``BLOCK_DOCS`` by hash. For a source that is used r times its blocks are taken floor(r) times whole, in another order each
time, and once more in part: each block has a budget of the remaining fraction of its tokens and gives its documents in
a permuted order while the middle of the next one is within it. A block is a bounded group, so a source that holds
a third of all rows is many groups.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import staged

BLOCK_DOCS = 4096
LEVELS, PASSES = 5, 8
#: Parts that the rows of a source are dealt over where the table of sources is too large to broadcast.
SALTS = 32
#: What the operator adds to the documents' columns; a column with such a name is replaced.
ADDED = ("n_tokens", "weight", "epoch", "block", "place")


def n_tokens(text: F.Column) -> F.Column:
    """Words, and one for the end of the document; a null text has the end only."""
    return (F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1).cast("long")


def _name(source: F.Column) -> F.Column:
    """A key for a source, null too."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _evaluated(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent the sum of the powers, and the entropy of the weights in nats."""
    power = [F.pow(F.col("share"), F.lit(a)) for a in exponents]
    row = shares.agg(*(F.sum(p) for p in power), *(F.sum(p * F.log("share")) for p in power)).first()
    k = len(exponents)
    return [(row[i], math.log(row[i]) - a * row[k + i] / row[i]) for i, a in enumerate(exponents)]


def exponent(totals: DataFrame, entropy: float | None, repeats: float | None, budget: float | None = None) -> float:
    """The smallest exponent from 0 to 1 that meets what is asked.

    ``totals`` has a row for each source with its ``tokens``. ``entropy`` is the part of the way from the corpus's own
    entropy to that of equal weights; the exponent meets it from above. ``repeats`` is the most that a source may be
    used, with ``budget`` tokens in all or, without one, with the budget that uses every source once at least.
    """
    least, most, total, count = totals.agg(F.min("tokens"), F.max("tokens"), F.sum("tokens"), F.count("*")).first()
    if not count or least == most:
        return 1.0
    shares = totals.select((F.col("tokens") / F.lit(float(total))).alias("share"))
    (_, flat), (_, own) = _evaluated(shares, [0.0, 1.0])
    goal = None if entropy is None else own + entropy * (flat - own)

    def bisected(good) -> float:
        """The border between exponents that are not good, below, and good ones; 1 is taken as good."""
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            steps = [low + (high - low) * i / 2**LEVELS for i in range(1, 2**LEVELS)]
            marks = [good(a, *found) for a, found in zip(steps, _evaluated(shares, steps))]
            # The path of the bisection through the evaluated points.
            left, right = 0, 2**LEVELS
            while right - left > 1:
                middle = (left + right) // 2
                left, right = (left, middle) if marks[middle - 1] else (middle, right)
            bounds = [low, *steps, high]
            low, high = bounds[left], bounds[right]
        return round(high, 9)

    p_least, p_most = least / total, most / total
    found = [0.0]
    if goal is not None:
        found.append(bisected(lambda a, z, h: h <= goal))
    if repeats is not None and budget is None:
        # The smallest source's use against the largest one's, which is used once.
        found.append(bisected(lambda a, z, h: (p_least / p_most) ** (a - 1.0) <= max(repeats, 1.0)))
    elif repeats is not None:
        found.append(bisected(lambda a, z, h: budget / total * p_least ** (a - 1.0) / z <= repeats))
    return max(found) if len(found) > 1 else 1.0


def source_weights(totals: DataFrame, entropy: float | None = None, repeats: float | None = None, budget: float | None = None) -> DataFrame:
    """The sources (name, docs, tokens) with the weight of each and how often it is used."""
    a = exponent(totals, entropy, repeats, budget)
    total, most = totals.agg(F.sum("tokens"), F.max("tokens")).first()
    total, most = float(total or 1), float(most or 1)
    z = _evaluated(totals.select((F.col("tokens") / F.lit(total)).alias("share")), [a])[0][0] if totals.limit(1).count() else 1.0
    share = F.col("tokens") / F.lit(total)
    weight = F.pow(share, F.lit(a)) / F.lit(z)
    # Without a budget the largest source, which has the least weight for its share, is used once.
    spent = budget if budget is not None else total * z * (most / total) ** (1.0 - a)
    used = F.lit(float(spent)) * weight / F.col("tokens")
    limited = used if repeats is None else F.least(used, F.lit(float(repeats)))
    return totals.select("name", "docs", "tokens", F.round(weight, 12).alias("weight"), F.round(limited, 9).alias("used"))


def temperature_mix(
    documents: DataFrame,
    entropy: float | None = 0.5,
    repeats: float | None = 4.0,
    budget: float | None = None,
    whole: bool = False,
    seed: int = 0,
    block_docs: int = BLOCK_DOCS,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """The mixed documents: a row for each use of a document, with its columns, n_tokens, weight, epoch, block and place.

    ``entropy`` and ``repeats`` are as in ``exponent``; no source is used more than ``repeats`` times even if the budget
    is not met then. ``budget`` is the number of tokens of the mix; None stands for the number the corpus has or, with
    ``whole``, for the least that uses every source once at least, so that no document is left out. ``epoch`` counts a
    document's uses from 1, blocks of an epoch come in the order of ``block``, and ``place`` is the place within one.

    A null source is a source. A null text has one token. Repeated rows are documents of their own. A document without
    an id is mixed as any other: documents are dealt by id and text, so that many rows without one, or with one id, don't
    make one large block. No rows give no rows.
    """
    kept = [c for c in documents.columns if c.lower() not in ADDED and (keep_text or c != text)]
    # The documents' own columns travel as one, so none of their names can clash.
    rows = documents.select(
        F.struct(*kept).alias("row"), F.col(doc_id).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("mark"), _name(F.col(source)).alias("name"),
        n_tokens(F.col(text).cast("string")).alias("n_tokens"),
    )
    totals = staged(rows.groupBy("name").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens")))
    if budget is None and not whole:
        budget = float(totals.agg(F.sum("tokens")).first()[0] or 0)
    weights = source_weights(totals, entropy, repeats, budget)
    salted = staged(weights.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("id", "mark", F.lit(seed)), F.lit(SALTS)).cast("int")).join(salted, ["name", "salt"])
    part = F.pmod(F.xxhash64("id", "mark", F.lit(seed), F.lit("block")), F.ceil(F.col("docs") / F.lit(block_docs)))
    dealt = dealt.withColumn("part", part)

    group = W.partitionBy("name", "part")
    order = group.orderBy(F.xxhash64("id", "mark", F.lit(seed), F.floor("used") + 1), "id", "n_tokens")
    before = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    share = F.col("used") - F.floor("used")
    within = before + F.col("n_tokens") / 2 <= share * F.sum("n_tokens").over(group)
    uses = F.floor("used").cast("int") + F.when((share > 0) & within, 1).otherwise(0)
    taken = dealt.withColumn("uses", uses).filter("uses > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("uses"))))
    permuted = W.partitionBy("name", "part", "epoch").orderBy(F.xxhash64("id", "mark", F.lit(seed), "epoch"), "id", "n_tokens")
    block = F.xxhash64("name", "part", F.lit(seed), "epoch")
    return taken.select("row.*", "n_tokens", "weight", "epoch", block.alias("block"), F.row_number().over(permuted).alias("place"))
