"""URL filter with host and path rules and a weighted vocabulary.

A rule decides where one fits, the longest first. Elsewhere an Aho-Corasick automaton finds the vocabulary's terms in
host and path. A term counts where no letter or digit stands at either side. One strict term or ``SOFT`` distinct
soft terms block the url.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary of our own: a strict term blocks by itself, soft ones together.
STRICT = ("casino", "escort", "jackpot", "malware", "phishing", "porn", "sportsbook", "spam", "viagra", "warez", "xxx")
SOFT_TERMS = (
    "adult", "ads", "bet", "bets", "betting", "bonus", "cheap", "click", "crack", "deal", "dating", "discount", "download",
    "farm", "free", "loan", "loans", "nude", "offer", "pharma", "pill", "pills", "poker", "popup", "prize", "sex", "slots",
    "sponsor", "torrent", "track", "tracker", "win", "winner",
)
SOFT = 2

Rule = tuple[str, str, str]
#: (host, path, verdict)
RULES: tuple[Rule, ...] = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host with A-Z in lower case, and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    slash = rest.find("/", 0, end)
    cut = end if slash < 0 else slash
    return rest[:cut].encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"), rest[cut:end]


def fitting(host: str, path: str, rules: Sequence[Rule]) -> Rule | None:
    """The longest rule whose host is this one or above it and whose path this one begins with; of equals the longer host."""
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0])), default=None)


@lru_cache(maxsize=4)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for term in {*strict, *soft}:
        automaton.add_word(term, (term, term in strict))
    if len(automaton):
        automaton.make_automaton()
    return automaton


def term_hits(text: str, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[int, int]:
    """The numbers of distinct strict and soft terms that stand between other characters than letters and digits."""
    automaton, lowered = _automaton(strict, soft), text.lower()
    found = set()
    for end, (term, hard) in automaton.iter(lowered) if len(automaton) else ():
        start = end + 1 - len(term)
        if not (start and lowered[start - 1].isalnum()) and not (end + 1 < len(lowered) and lowered[end + 1].isalnum()):
            found.add((term, hard))
    n = sum(hard for _, hard in found)
    return n, len(found) - n


def judged_urls(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    rules: Sequence[Rule] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT_TERMS,
    least_soft: int = SOFT,
) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_hits for every row of ``pages``.

    Without ``://``, or for a null url, host and path are empty and no term is found: such a url is allowed. Terms are
    looked for in host and path whatever the rule says. Repeated rows give repeated results; other columns are ignored,
    whatever their names. No rows give no rows.
    """
    rules, strict, soft = tuple(rules), tuple(strict), tuple(soft)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.column("url").to_pylist():
                host, path = host_and_path(x)
                rule = fitting(host, path, rules)
                hard, mild = term_hits(host + path, strict, soft)
                verdict = rule[2] if rule else "block" if hard or mild >= least_soft else "allow"
                rows.append((host, path, rule[0] + rule[1] if rule else None, verdict, hard, mild))
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                names=["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits"],
            )

    source = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"))
    return source.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string, strict_hits int, soft_hits int")
