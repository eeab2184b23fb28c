"""The registered queries against their SQL, and the pipeline against brute force."""

from __future__ import annotations

import glob
import math
import os
import random
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from compare import differences
from test_llm_dedup import joined_brute, lower

import __spark_entry__ as entry
import corpus_pipeline
from sluice.llm import queries as llm
from sluice.llm.language import UNKNOWN, fitted, held_out, least_scores, predicted

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names if n.split("_")[0][2:].isdigit()] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in entry.queries() and set(llm.STATEMENTS) <= set(llm.QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "jaccard_join", "temperature_mix", "best_fit_packing"]


@pytest.mark.parametrize("name", llm.STATEMENTS)
def test_query_equals_statement(spark, connection, name):
    assert differences(llm.QUERIES[name](spark, SF), connection, llm.STATEMENTS[name]) == []


def test_statements_of_every_kind_of_row(spark, connection, tmp_path):
    """The same statements over rows that the given tables lack."""
    documents = spark.createDataFrame(
        [(1, None), (2, ""), (3, "A\nlong enough line\n b"), (4, "x\n LONG enough line \t"), (5, "a\nlong ENOUGH line\n b"), (6, "a\nlong enough line\n b")], "doc_id long, text string"
    )
    pages = spark.createDataFrame(
        [(1, None), (2, "nothing"), (3, "http://www.EXAMPLE.com/en/1"), (4, "http://a.example.com/en/?x"), (5, "a://b.net/es/"), (6, "x://casino.org"), (7, "x://a.org/free/win"), (8, "x://freewin.org"), (9, "x://h?a/b://c"), (10, "x://a.org/écasino"), (11, "x://a.org/casino٣"), (12, "x://a.org/é/casino–x"), (13, "x://a.org/_casino_")],
        "page_id long, url string",
    )
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    own = duckdb.connect()
    for name in ("documents", "pages"):
        own.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name in ("op2_url_filter", "op8_line_dedup", "op9_exact_dedup"):
        assert differences(llm.QUERIES[name](spark, str(tmp_path)), own, llm.STATEMENTS[name]) == []


def test_join_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = llm.op10_jaccard_join(spark, SF).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == joined_brute(rows)


def test_contract_columns(spark):
    expected = {
        "op1_vamana": "query_id rank vec_id score", "op3_html_text": "page_id url text n_chars", "op5_language": "doc_id held_out lang_pred score",
        "op6_token_counts": "doc_id n_bytes n_tokens over_limit", "op7_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    }
    for name, columns in expected.items():
        assert set(columns.split()) <= set(llm.QUERIES[name](spark, SF).columns), name
    assert dict(llm.op1_vamana(spark, SF).dtypes)["rank"] == "int"
    flags = {r.doc_id: r.held_out for r in llm.op5_language(spark, SF).collect()}
    assert all(flag == (zlib.crc32(str(i).encode()) % 4 == 2) for i, flag in flags.items())


def limits_brute(rows, profiles):
    """The language stage's limits by length class: sorted scores instead of counted steps."""
    seen = defaultdict(list)
    for r in rows:
        if r.lang is None or zlib.crc32(str(r.doc_id).encode()) % 4 == 2:
            continue
        starts = [n for n in (2 ** k for k in range(3, 30, 2)) if n < len(r.text or "")]
        cut = starts[zlib.crc32(r.text.encode()) % len(starts)] if starts else 0
        for x in (r.text or "", (r.text or "")[:cut]):
            name, score, length = profiles.measured(x)
            if name != UNKNOWN and score > 0:
                seen[length, r.lang].append(math.floor(score * 4096) / 4096)
    limits, bound = {}, 1.0
    for length in sorted({n for n, _ in seen}):
        usual = [sorted(found)[max(math.ceil(0.05 * len(found)), 1) - 1] for (n, _), found in seen.items() if n == length]
        bound = min(bound, *usual)
        limits[length] = max(corpus_pipeline.LEAST_SCORE, corpus_pipeline.LEAST_PART * bound)
    return limits


def test_pipeline_equals_brute_force(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    profiles = fitted(documents.filter(~held_out()))
    every = documents.orderBy("doc_id").collect()
    limits = limits_brute(every, profiles)
    rows = {}
    for r in every:
        lang, score, length = profiles.measured(r.text or "")
        least = max((n for n in limits if n <= length), default=None)
        if lang != UNKNOWN and score >= limits.get(least, corpus_pipeline.LEAST_SCORE):
            rows[lower(r.text)] = (r.doc_id, r.text, r.source)  # the largest id comes last
    kept = sorted(rows.values())
    component = {d: c for d, _, c in joined_brute([(d, t) for d, t, _ in kept])}
    kept = [r for r in kept if component[r[0]] == r[0]]
    found = corpus_pipeline.run(spark, SF).collect()
    uses = Counter(r.doc_id for r in found if r.piece == 0)
    assert set(uses) == {d for d, _, _ in kept} and max(uses.values()) <= 2
    tokens = defaultdict(int)
    for d, t, s in kept:
        tokens[s] += len(t.split()) + 1
    largest = max(tokens, key=tokens.get)
    assert all(uses[d] == 1 for d, _, s in kept if s == largest)
    held = defaultdict(int)
    for r in found:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= llm.SEQUENCE


def test_language_stage_rejects_what_no_labelled_text_is_like(spark):
    pick = random.Random(3)
    noise = [" ".join("".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=pick.randint(2, 9))) for _ in range(n)) for n in (12, 50, 200, 3000)]
    other = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı",
        "Все люди рождаются свободными", "12 . 34",
    ]
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    clean = [r.text for r in documents.filter("lang IS NOT NULL").orderBy("doc_id").limit(60).collect()]
    short = [x[:n] for x in clean for n in (40, 150, 600)] + ["All human beings are born free and equal in dignity and rights."]
    rows = [(10**6 + i, x, None, "s", len(x)) for i, x in enumerate(noise + other + short)]
    planted = documents.unionByName(spark.createDataFrame(rows, documents.schema))
    kept = {r.doc_id for r in corpus_pipeline.language(spark, planted, SF).select("doc_id").collect()}
    bad = len(noise + other)
    assert [x for i, x, *_ in rows[:bad] if i in kept] == [] and [x for i, x, *_ in rows[bad:] if i not in kept] == []
    letters = documents.filter("lang IS NOT NULL AND text RLIKE '[A-Za-z]'").select("doc_id").collect()
    assert kept >= {r.doc_id for r in letters}


def test_language_limits_equal_brute_force(spark):
    table = "doc_id long, text string, lang string, score string, start int"
    rows = [(r.doc_id, r.text, r.lang, "s", 1) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(10**6 + i, x, lang, None, None) for i, (x, lang) in enumerate([(None, "en"), ("", "en"), ("...", "de"), ("a", "en"), ("né", None), ("x" * 33, "fr"), ("la " * 90_000, "es")])]
    documents = spark.createDataFrame(rows, table)
    learn = documents.filter(~held_out())
    profiles = fitted(learn)
    for parts in (1, 7):
        judged = predicted(learn.drop("score", "start").repartition(parts), profiles, length="n", start="first")
        found = {n: max(corpus_pipeline.LEAST_SCORE, corpus_pipeline.LEAST_PART * x) for n, x in least_scores(judged, "score", "n", "first").items()}
        assert found == limits_brute(documents.collect(), profiles) and len(found) > 4
    assert least_scores(judged.limit(0), "score", "n", "first") == {}
    assert corpus_pipeline.language(spark, documents, SF).columns == documents.columns
    assert corpus_pipeline.language(spark, documents.limit(0), SF).count() == 0


def test_entry_without_this_part(monkeypatch):
    """The entry points work when the part and the pipeline are deleted, and only then hide a missing module."""
    import importlib

    for name in ("corpus_pipeline", "sluice.llm", "sluice.llm.queries"):
        monkeypatch.setitem(sys.modules, name, None)
    again = importlib.reload(entry)
    try:
        assert "pipeline" not in again.queries() and "funnel_publish" in again.queries()
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
