"""Tokens, packing, language, urls, pages, mixing and the index against libraries and brute force."""

from __future__ import annotations

import html
import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import html_text as pages
from sluice.llm import token_counts as token_module
from sluice.llm import vamana
from sluice.llm.language import SIZE, UNKNOWN, Profiles, fitted, grams, held_out, predicted, ranked
from sluice.llm.mixing import exponent, temperature_mix
from sluice.llm.packing import best_fit_packing, best_patterns, by_patterns, pack, packed, token_pieces
from sluice.llm.packing import fitted as fit_patterns
from sluice.llm.token_counts import token_counts
from sluice.llm.tokens import Encoder, Pieces
from sluice.llm.url_filter import RULES, fitting, host_and_path, judged_urls, term_hits

SF = "/root/testdata/sf0.001"
FILES = {name: public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json")}
LIBRARY = {name: Tokenizer.from_file(path) for name, path in FILES.items()}
ODD = ["don't  stop\n\n\n x\t y éİ <|endoftext|> hi", "x\xa0y", "ǅ é e\u0301", "日本語 text—“q”… €5 Привет Ёж", "a\n b", "foo\n ", "\r\n12 345½²", "", " ", "I'LL 'S", "🙂 ok", "ﬁ ß ẞ"]


def chained(parts):
    return list(itertools.chain.from_iterable(parts))


@pytest.mark.parametrize("name", FILES)
def test_encoder_equals_the_library(name):
    encoder = Encoder(FILES[name], list, chained)

    @settings(max_examples=300, deadline=None)
    @given(st.one_of(st.sampled_from(ODD), st.text(max_size=30), st.text(alphabet=" \n\t'sStéÉ1½.!aZ—", max_size=25)))
    def same(text):
        assert encoder.encoded(text) == LIBRARY[name].encode(text, add_special_tokens=False).ids

    same()


def test_token_counts(spark):
    rows = [*enumerate(ODD), (100, None), (101, "word " * 20_000), (102, "a b"), (102, "a b"), (None, "no id")]
    table = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, n_tokens int, piece string, n int")
    found = Counter(tuple(r) for r in token_counts(table, FILES["byte_bpe_50k.json"]).collect())
    tokens = [len(LIBRARY["byte_bpe_50k.json"].encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    assert found == Counter((i, len((t or "").encode()), n, n > 512) for (i, t), n in zip(rows, tokens))
    assert token_counts(table.limit(0), FILES["byte_bpe_50k.json"]).count() == 0


def test_token_counts_shuffle_nothing_and_sample_the_table(spark, monkeypatch):
    path = FILES["byte_bpe_50k.json"]
    table = spark.createDataFrame([(i, " ".join([f"w{i} common words that w{i % 7} return,"] * 40)) for i in range(300)], "doc_id long, text string").repartition(5)
    assert "Exchange" not in token_counts(spark.read.parquet(f"{SF}/documents.parquet"), path)._jdf.queryExecution().executedPlan().toString()
    pieces, lengths = token_module.frequent_lengths(table, path, most=5)
    assert len(pieces) == 5 and {"common", "words", "that", "return,"} <= set(pieces)
    whole = sorted(token_counts(table, path).collect())
    assert [r.n_tokens for r in whole] == [len(LIBRARY["byte_bpe_50k.json"].encode(r.text, add_special_tokens=False).ids) for r in table.orderBy("doc_id").collect()]
    monkeypatch.setattr(token_module, "SAMPLED_TASKS", 1)
    monkeypatch.setattr(token_module, "HANDED_ON", 2)
    assert len(token_module.frequent_lengths(table, path)[0]) == 2 and sorted(token_counts(table, path).collect()) == whole


def test_frequent_words_are_counted_in_all_documents(spark, monkeypatch):
    path = FILES["byte_bpe_50k.json"]
    late = spark.range(0, 70, 1, 70).selectExpr("if(id < 64, repeat('early ', 30) || 'end', repeat('late ', 4000) || 'end') AS text")
    assert token_module.frequent_lengths(late, path, most=3)[0] == ("late", "early", "end")
    long = spark.range(0, 3, 1, 1).selectExpr("if(id = 0, repeat('first ', 800000) || 'end', repeat('behind ', 500000) || 'end') AS text")
    assert token_module.frequent_lengths(long, path, most=3)[0] == ("behind", "first", "end")
    # A word that comes back among new ones stays, whatever the order and however little room there is.
    rare = spark.range(0, 2000, 1, 3).selectExpr("'a' || id || ' b' || id || ' often c' || id || ' d' || id || ' e' AS text")
    monkeypatch.setattr(token_module, "slices", lambda batches, text: (b.slice(i, 1) for b in batches for i in range(b.num_rows)))
    monkeypatch.setattr(token_module, "COUNTED", 16)
    monkeypatch.setattr(token_module, "FREQUENT", 8)
    monkeypatch.setattr(token_module, "HANDED_ON", 8)
    pieces, lengths = token_module.frequent_lengths(rare, path, most=2)
    assert pieces == ("e", "often") and lengths == tuple(len(LIBRARY["byte_bpe_50k.json"].encode(" " + p, add_special_tokens=False).ids) for p in pieces)


@pytest.mark.parametrize("seed", range(5))
def test_lightened_counts_miss_less_than_one_word_in_as_many_as_are_kept(seed):
    generator, most = random.Random(seed), 7
    words = [f"w{int(generator.paretovariate(0.4))}" for _ in range(5000)] + [f"x{i}" for i in range(3000)]
    generator.shuffle(words)
    seen, exact = Counter(), Counter(words)
    for i in range(0, len(words), 20):
        seen.update(words[i:i + 20])
        seen = token_module.lightened(seen, most)
        assert len(seen) <= most
    assert all(0 <= n - seen[p] <= len(words) / (most + 1) for p, n in exact.items())
    assert {p for p, n in exact.items() if n > len(words) / (most + 1)} <= set(seen)


@pytest.mark.parametrize("name", FILES)
def test_a_full_cache_forgets_only_what_is_not_met_again(name):
    encoder = Encoder(FILES[name], len, sum, {"the": 1})
    encoder.words.most = encoder.pieces.most = 4
    pick = random.Random(5)
    for _ in range(50):
        text = "x " + " ".join(pick.choice(["the", "a", "b1,", "don't", "cat.", "zyx", "日本", "é—q", f"n{pick.random()}"]) for _ in range(30))
        assert encoder.encoded(text) == len(LIBRARY[name].encode(text, add_special_tokens=False).ids)
        assert len(encoder.words) <= 6 and len(encoder.words.older) <= 6 and encoder.words["the"] == 1
    encoded, words = [], Pieces(lambda x: encoded.append(x) or len(x), most=3)
    for x in "abcadaeafaga":
        words[x]
    assert encoded == list("abcdefg")  # "a" is met again and again


def test_pieces_give_the_texts_back(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").unionByName(spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, text string"), allowMissingColumns=True)
    cut = defaultdict(list)
    for r in token_pieces(documents, FILES["word_bpe_49k.json"], 1, length=256).orderBy("doc_id", "piece").collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == len(cut[r.doc_id]) and r.length == len(ids) <= 256
        cut[r.doc_id] += ids
    for r in documents.collect():
        assert cut[r.doc_id] == [*LIBRARY["word_bpe_49k.json"].encode(r.text or "", add_special_tokens=False).ids, 1]


def test_packing_is_gapless_and_tight(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").withColumn("shard", F.lit("x")).withColumn("offset", F.lit(3))
    twice = table.unionByName(table.limit(5))
    rows = best_fit_packing(twice, FILES["word_bpe_49k.json"], 1, 1024).collect()
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        ends = list(itertools.accumulate((n for _, n in sorted(pieces)), initial=0))
        assert [at for at, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 1024
    assert len(held) <= 1.02 * sum(r.length for r in rows) / 1024 + 1
    ids = np.array([*LIBRARY["word_bpe_49k.json"].encode(table.first().text, add_special_tokens=False).ids, 1], "<u4")[:1024]
    assert zlib.crc32(ids.tobytes()) in {r.ids_crc32 for r in rows if r.doc_id == table.first().doc_id}
    assert best_fit_packing(table.limit(0), FILES["word_bpe_49k.json"], 1).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(4, 200).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=80))))
def test_any_lengths_are_packed(case):
    capacity, lengths = case
    sequence, offset = packed(np.array(lengths, np.int64), capacity)
    for s in set(sequence.tolist()):
        own = sorted((offset[i], lengths[i]) for i in np.flatnonzero(sequence == s))
        ends = list(itertools.accumulate((n for _, n in own), initial=0))
        assert [at for at, _ in own] == ends[:-1] and ends[-1] <= capacity
    assert len(set(sequence.tolist())) <= 1.7 * sum(lengths) / capacity + 2


def test_best_patterns_equal_all_patterns():
    pick = random.Random(2)
    for steps in (4, 9, 12):
        worth = np.array([0.0, *(pick.uniform(-2, 3) for _ in range(steps))])
        found = best_patterns(worth, 4)
        for k in range(1, 5):
            every = [p for p in itertools.combinations_with_replacement(range(1, steps + 1), k) if sum(p) == steps]
            gain, pattern = next((g, p) for g, p in found if len(p) == k)
            assert gain == pytest.approx(max(sum(worth[list(p)]) for p in every)) == pytest.approx(worth[pattern].sum())
            assert pattern.sum() == steps


def test_fit_has_the_least_distance():
    """Against all patterns: none lowers the distance, and those that are used don't change it."""
    pick = np.random.default_rng(4)
    histogram = np.array([0, *pick.integers(0, 400, 16)])
    found = fit_patterns(histogram, 6)
    made = sum(x * np.bincount(p, minlength=17) for p, x in found)
    residual = histogram - made
    for k in range(1, 7):
        for p in itertools.combinations_with_replacement(range(1, 17), k):
            if sum(p) == 16:
                assert residual[list(p)].sum() <= 1.01
    assert all(x > 0 and p.sum() == 16 for p, x in found) and len(found) <= 16
    assert all(abs(residual[p].sum()) < 0.01 for p, _ in found)


def test_most_pieces_come_from_patterns():
    pick = np.random.default_rng(1)
    lengths = np.clip(pick.lognormal(6.6, 0.9, 20_000).astype(np.int64), 1, 4096)
    sequence, offset, made = by_patterns(lengths, 4096)
    assert (sequence >= 0).mean() > 0.95 and np.bincount(sequence[sequence >= 0], lengths[sequence >= 0], made).max() <= 4096
    assert len(set(packed(lengths, 4096)[0].tolist())) <= 1.006 * lengths.sum() / 4096 + 1


def test_rows_without_an_id_are_dealt_over_shards(spark, monkeypatch):
    monkeypatch.setattr("sluice.llm.packing.SHARD_ROWS", 100)
    documents = spark.range(400).selectExpr("cast(null as long) doc_id", "concat('text number ', id) text").unionByName(spark.range(200).selectExpr("7 doc_id", "concat('other ', id) text"))
    rows = pack(token_pieces(documents, FILES["word_bpe_49k.json"], 1, 64).selectExpr("doc_id", "piece", "start", "length", "crc32(ids) ids_crc32").cache(), 64, 100).collect()
    shards = Counter(r.sequence_id >> 32 for r in rows)
    assert sum(shards.values()) == 600 and max(shards.values()) < 200


def slow_ranks(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    counts = Counter(g for w in words for k in (1, 2, 3) for p in [w if k == 1 else f" {w} "] for g in (p[i : i + k] for i in range(len(p) - k + 1)) if g.strip())
    return {g: 1 + sum(v > n for v in counts.values()) for g, n in counts.items() if sum(v > n for v in counts.values()) < SIZE}


@pytest.mark.parametrize("text", ["The cat, the hat!", "à É 12 x", "a", "...", "x1y", "Ünder wörld über"])
def test_ranks_equal_brute_force(text):
    expected = slow_ranks(text)
    codes = {sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)): r for g, r in expected.items()}
    found, rank = ranked(text)
    assert dict(zip(found.tolist(), rank.tolist())) == codes


def test_language_on_held_out_rows(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = fitted(documents.filter(~held_out()))
    judged = predicted(documents.filter(held_out()), found).collect()
    assert sum(r.lang == r.lang_pred for r in judged) >= 0.98 * len(judged) > 100
    assert all(0 <= r.score <= 1 for r in judged)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in judged)


def test_language_of_odd_rows(spark):
    rows = [(1, None, None), (2, "", "en"), (3, "12 . ,", "en"), (4, "the cat and the hat " * 20_000, "en"), (5, "der Hund und die Katze", "de"), (None, "und der die das", None), (5, "the the", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("old"))
    found = predicted(table, fitted(table), score="score").collect()
    assert [(r.doc_id, r.lang_pred) for r in found] == [(1, UNKNOWN), (2, UNKNOWN), (3, UNKNOWN), (4, "en"), (5, "de"), (None, "de"), (5, "en")]
    assert [r.score for r in found][:3] == [0, 0, 0]
    assert Profiles([]).closest("text") == (UNKNOWN, 0.0)
    assert predicted(table.limit(0), fitted(table.limit(0))).count() == 0
    assert len(grams("123")) == 0


def test_urls():
    assert host_and_path("HTTP://A.Example.COM/En/x?q#f") == ("a.example.com", "/En/x")
    assert [host_and_path(x) for x in (None, "", "no mark", "x://", "x://h?a/b", "x://É.com#/")] == [("", ""), ("", ""), ("", ""), ("", ""), ("h", ""), ("É.com", "")]
    assert fitting("m.example.com", "/en/1", RULES)[2] == "block" and fitting("www.example.com", "/en/1", RULES)[2] == "allow"
    assert fitting("a.www.example.com", "/en/1", RULES)[2] == "allow" and fitting("notexample.com", "/en/", RULES)[0] == "com"
    assert fitting("x.net", "/en/", RULES) is None and fitting("com", "", RULES) is None
    assert term_hits("casino.org/free-win", ("casino",), ("free", "win")) == (1, 2)
    assert term_hits("casinos.org/freely xwin", ("casino",), ("free", "win")) == (0, 0)
    assert term_hits("free/free", ("casino",), ("free", "win")) == (0, 1)
    assert term_hits("a-win-win-win", (), ()) == (0, 0)


def test_judged_urls(spark):
    rows = [(1, "https://casino.org/a", "h"), (2, None, None), (2, None, None), (3, "http://x.net/fr/casino", ""), (4, "http://cheap-pills.org/" + "a" * 100_000, ""), (5, "http://cheap.org", ""), (None, "nothing", "")]
    table = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    found = sorted(((r.page_id or 0, r.rule, r.verdict) for r in judged_urls(table).collect()), key=str)
    assert found == sorted([(1, None, "block"), (2, None, "allow"), (2, None, "allow"), (3, "net/fr/", "block"), (4, None, "block"), (5, None, "allow"), (0, None, "allow")], key=str)
    assert judged_urls(table.limit(0)).count() == 0


PAGE = """<html><body><header><h1>Site</h1></header><div id='menu'><a href=x>Home</a></div><div class="post-{n} body"><h2>T &amp; Q</h2>
<p>Hello, world   this&nbsp;is <b>text &lt;b&gt;.<br>More<div class="share">Share</div><ul><li>one<li>two</ul><form>Sub</form><script>var t="</p>";</script>
tail<p>end</div><aside>Side, side, side</aside><div id="comments"><p>Nice, very, long, comment, here, yes</div><div class="cookie-notice">Cookies</div><footer>f</footer>"""
TEXT = "T & Q\n\nHello, world this is text <b>. More\n\none\n\ntwo\n\ntail\n\nend"


def test_page_text():
    assert pages.Page(PAGE.format(n=17)).best()[0] == "/html/body/div.body.post-N"
    assert pages.extracted(PAGE.format(n=3), None) == TEXT
    assert pages.extracted("only text & more", None) == "only text & more"
    assert pages.extracted("<p>a<p>b<table><tr><td>c<td>d", None) == "a\n\nb\n\nc\n\nd"
    assert pages.extracted("<!-- x --><<p>", None) in ("<", "<<p>", "")
    assert pages.extracted("<nav>menu</nav>", None) == ""


def test_pages_of_a_host_share_a_path(spark):
    short = '<html><body><div class="body post-9"><p>s</div><div class="extra"><p>A longer text, with words, that scores more than the article does.</div>'
    rows = [(n, f"http://H.org/{n}", PAGE.format(n=n)) for n in range(5)] + [(7, "http://h.org/7", short), (8, "http://other.org", short), (9, None, None), (9, None, None), (10, "http://h.org", ""), (None, "h", "<p>" + "x " * 200_000)]
    table = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, path string, host int")
    found = {r.page_id: r for r in pages.html_text(table).collect()}
    assert [found[n].text for n in range(5)] == [TEXT] * 5 and found[7].text == "s" and found[8].text.startswith("A longer")
    assert found[9].text == "" and found[10].n_chars == 0 and found[None].n_chars == 399_999
    assert pages.html_text(table).count() == len(rows) and pages.html_text(table.limit(0)).count() == 0


def test_template_pages(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    for r in pages.html_text(table).join(table, "page_id").collect():
        inside = r.html.split("<article>")[1].split("</article>")[0]
        inside = html.unescape(re.sub("<[^>]*>", "", inside))
        assert "".join(r.text.split()) == "".join(inside.split())


LONG = "<p>" + "A sentence of the body, with words and commas, that goes on. " * 40 + "</p>"
LINKS = "<div class=list>" + "<a href=x>Another story of this site</a> " * 200 + "</div>"
#: Between body and its end; each text of ``whole`` belongs to the article.
NESTED = [
    "<article><h1>Title</h1><p>Lead.</p><div class=content>{}</div></article>",
    "<article><header><h1>Title</h1></header><section>Lead. {}</section><section>Last.</section></article>",
    "<article><div class=top><h1>Title</h1></div><div class=intro>Lead.</div><div class=content>{}</div><div class=end>Last.</div></article>",
    "<main><h1>Title</h1><div class=text><div class=content>{}</div></div><div class=end>Last.</div></main>",
    "<main><h1>Title</h1><article><div class=content>{}</div></article></main>",
    "<div class=post><h1><a href=y>Title</a></h1><div class=inner><div class=content>{}</div><div class=end>Last.</div></div></div>",
    "<h1>Title</h1><div class=content>{}</div>",
    "<div class=intro><h1>Title</h1>Lead.</div><div class=content>{}</div><div class=end>Last.</div>",
]


@pytest.mark.parametrize("page", NESTED)
def test_whole_article_around_its_inner_part(page):
    text = pages.extracted(f"<html><body>{page.format(LONG)}</body></html>", None)
    assert text.count("A sentence") == 40
    assert [x in text for x in ("Title", "Lead.", "Last.")] == [x in page for x in ("Title", "Lead.", "Last.")]
    assert text == pages.extracted("<html><body><nav>N</nav>" + page.format(LONG), None)


def test_links_beside_the_article_stay_out():
    for page in (f"<div class=post><h1>Title</h1><div class=content>{LONG}</div></div>{LINKS}", f"<main><article><h1>Title</h1>{LONG}</article>{LINKS}</main>"):
        text = pages.extracted(f"<html><body>{page}</body></html>", None)
        assert text.startswith("Title") and "Another" not in text and text.count("A sentence") == 40


#: Pages whose article stands in an element that would be dropped; a title, a long body and maybe furniture.
WRAPPED = [
    "<html><head><title>T</title><body><article><h1>Title</h1>{}</article>",
    "<html><head><title>T</title><article><h1>Title</h1>{}</article>",
    "<html><head><meta charset=x><link href=y>Title {}",
    "<html><head><title>T</title></head><body><form id=aspnetForm><div class=page><h1>Title</h1>{}</div></form>",
    "<body><form role=form><article><h1>Title</h1>{}</article></form>",
    "<body><article><h1>Title</h1>{}</article><form><p>Your, long, comment, here</p></form>",
    "<body><div class='content has-sidebar'><h1>Title</h1>{}</div><div class=sidebar>Furniture</div>",
    "<body><div class='page with-banner'><article><h1>Title</h1>{}</article></div>",
    "<body><div class=ad-free><article><h1>Title</h1>{}</article></div>",
    "<body><div id=sidebar-layout><main><h1>Title</h1>{}</main><div class=sidebar>Furniture</div></div>",
    "<body><div class='banner wrap'><h1>Title</h1>{}<div class=ad>Furniture</div></div><div>Small print here</div>",
    "<body><article><div class=post-header><h1>Title</h1></div>{}</article>",
    "<body><article><div class='header'><h1>Title</h1></div><form>{}</form></article>",
    "<body><div class=post><header class=entry-header><h1>Title</h1></header>{}</div>",
    "<body><main><header><h1>Title</h1></header>{}</main>",
]


@pytest.mark.parametrize("page", WRAPPED)
def test_wrapped_articles_are_not_dropped(page):
    text = pages.extracted(page.format(LONG), None)
    assert text.split()[0] == "Title" and text.count("A sentence") == 40 and "Furniture" not in text and "Your" not in text


def test_what_stands_beside_the_article_is_dropped():
    short = "<p>The article, a short one, in a sentence or two.</p>"
    for beside in ("<div id=comments><article class=comment>{}</article></div>", "<div class=related><article>{}</article></div>", "<div class=cookie-notice>{}</div>"):
        for page in (f"<div class=post><h1>Title</h1>{short}{beside.format(LONG)}</div>", f"<article><h1>Title</h1>{short}</article>{beside.format(LONG)}"):
            assert pages.extracted(f"<html><body>{page}", None) == "Title\n\nThe article, a short one, in a sentence or two."
    for form in ("<form>{}</form>", "<div class=sidebar>{}</div>"):
        assert pages.extracted(f"<article>{short}</article>{form.format(LONG)}", None).endswith("two.")
    assert pages.extracted("<head><noscript><img src=x></noscript><title>T</title></head><p>text", None) == "text"
    assert pages.extracted("<p>text</p><head><p>more", None) == "text\n\nmore"


def test_pages_of_a_host_vote_for_the_whole_article(spark):
    rows = [(n, "http://h.org/", f"<html><body>{NESTED[2].format(LONG)}</body></html>") for n in range(3)]
    for r in pages.html_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        assert r.text.startswith("Title\n\nLead.") and r.text.endswith("Last.")


def mixed_tokens(rows):
    used = Counter()
    for r in rows:
        used[r.source] += r.n_tokens
    return used


def corpus(spark, seed=0):
    pick = random.Random(seed)
    sizes = {"big": 3000, "mid": 600, "small": 150, None: 60}
    rows = [(i, "w " * pick.randint(0, 30), s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, name string, docs int")


def test_mix_meets_entropy_and_budget(spark):
    table = corpus(spark)
    own = Counter()
    for r in table.collect():
        own[r.source] += len(r.text.split()) + 1
    share = {s: n / sum(own.values()) for s, n in own.items()}
    rows = temperature_mix(table, entropy=0.5, repeats=None, block_docs=64).collect()
    weights = {r.source: r.weight for r in rows}
    entropy = lambda w: -sum(x * math.log(x) for x in w.values())
    assert abs(sum(weights.values()) - 1) < 1e-6
    assert abs(entropy(weights) - (entropy(share) + math.log(4)) / 2) < 1e-6
    used = mixed_tokens(rows)
    for s, w in weights.items():
        assert abs(used[s] - w * sum(own.values())) < 0.05 * w * sum(own.values()) + 40
    assert table.columns == [c for c in temperature_mix(table).columns if c in table.columns]


def test_mix_limits_repeats(spark):
    table = corpus(spark, 1)
    rows = temperature_mix(table, entropy=1.0, repeats=3.0).collect()
    assert max(Counter(r.doc_id for r in rows).values()) <= 3
    whole = Counter(r.doc_id for r in temperature_mix(table, entropy=None, repeats=1.5, whole=True).collect())
    assert set(whole) == {r.doc_id for r in table.collect()} and max(whole.values()) == 2
    assert all(whole[r.doc_id] == 1 for r in table.collect() if r.source == "big")


def test_mix_places_are_permutations(spark):
    rows = temperature_mix(corpus(spark, 2), entropy=1.0, repeats=2.5, block_docs=50).collect()
    blocks = defaultdict(list)
    for r in rows:
        blocks[r.source, r.epoch, r.block].append(r.place)
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in blocks.values()) and max(map(len, blocks.values())) < 150
    again = temperature_mix(corpus(spark, 2), entropy=1.0, repeats=2.5, block_docs=50).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "x", None), (None, "x", None), (2, "w " * 100_000, "b"), (3, "", "c")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("epoch", F.lit("old")).withColumn("row", F.lit(1))
    assert Counter(r.source for r in temperature_mix(table, entropy=None, repeats=1.0, whole=True).collect()) == {"a": 2, None: 2, "b": 1, "c": 1}
    assert temperature_mix(table.limit(0)).count() == 0
    one = table.filter("source = 'a'")
    assert temperature_mix(one).count() == 2


def test_exponent(spark):
    totals = spark.createDataFrame([("a", 900.0), ("b", 100.0)], "name string, tokens double")
    assert exponent(totals, 0.0, None) == pytest.approx(1, abs=1e-6) and exponent(totals, 1.0, None) == pytest.approx(0, abs=1e-3)
    a = exponent(totals, None, 3.0)
    assert 9 ** (1 - a) == pytest.approx(3.0)
    a = exponent(totals, None, 2.0, budget=1000.0)
    assert 0.1 ** (a - 1) / (0.9**a + 0.1**a) == pytest.approx(2.0, abs=1e-5)


def nearest_brute(rows, queries, k):
    x = {i: np.array(v, float) for i, v in rows}
    out = {}
    for q in queries:
        near = sorted((float(np.sqrt(((x[i] - x[q]) ** 2).sum())), i) for i in x if i != q and len(x[i]) == len(x[q]))
        out[q] = near[:k]
    return out


def test_index_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    index, shards = vamana.graph_index(vectors, shard_rows=2048)
    found = defaultdict(list)
    for r in vamana.search(index, shards, vectors.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.score, r.vec_id))
    true = nearest_brute(rows, list(found), 10)
    assert len(found) == -(-len(rows) // 50) and all(f == sorted(f) and len(f) == 10 for f in found.values())
    recall = np.mean([len({i for _, i in found[q]} & {i for _, i in true[q]}) / 10 for q in found])
    assert recall >= 0.9
    exact = {(q, i): s for q in found for s, i in true[q]}
    assert all(abs(exact[q, i] - s) < 1e-12 for q, f in found.items() for s, i in f if (q, i) in exact)


def test_index_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (3, [0.0, 2.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (11, [0.5, 0.5])]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, shard int, dim string")
    found = [(r.query_id, r.rank, r.vec_id, r.score) for r in vamana.nearest(table, table, k=3).orderBy("query_id", "rank").collect()]
    assert [x[2] for x in found if x[0] == 0] == [1, 2, 11] and [x[2] for x in found if x[0] == 1] == [0, 2, 11]
    assert [x[2] for x in found if x[0] == 3] == [11, 0, 1] and not {x[0] for x in found} & {4, 5, 6, 7, 8, 9, 10, None}
    assert found[0] == (0, 1, 1, 0.0)
    assert vamana.nearest(table.limit(0), table).count() == 0


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 1.0] if i % 3 == 0 else [float(i), float(i * i % 17 + 2)]) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = vamana.nearest(table, table.filter("vec_id = 300")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(3 * i, 0.0) for i in range(10)]


@pytest.mark.parametrize("offset", [0.0, 3e3, 1e4, 1e12])
def test_index_recall_of_vectors_with_an_offset(offset):
    """A graph of one shard, built and searched on centred vectors; an offset or a huge vector moves no neighbour."""
    random_rows = np.random.default_rng(3)
    x = random_rows.normal(size=(2000, 32)) + offset
    x[17] *= 1e20
    middle, scale = vamana._centred(x)
    own = vamana._scaled(x, middle, scale)
    edges, entry = vamana.build(own)
    queries = np.arange(0, 2000, 100)
    found, _ = vamana.beam_search(own, np.einsum("ij,ij->i", own, own), edges, entry, own[queries], 128)
    hits = 0
    for q, row in zip(queries.tolist(), found):
        with np.errstate(over="ignore"):
            far = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        hits += len(set(np.argsort(far)[:10].tolist()) & set(row.tolist()))
    assert hits >= 0.9 * 10 * len(queries)


def test_index_of_several_shards_equals_brute_force(spark):
    random_rows = np.random.default_rng(5)
    rows = [(i, (random_rows.normal(size=8) + 5000).tolist()) for i in range(600)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index, shards = vamana.graph_index(vectors, shard_rows=100)
    found = vamana.search(index, shards, vectors.filter("vec_id % 50 = 0"))
    true = nearest_brute(rows, range(0, 600, 50), 10)
    got = defaultdict(list)
    for r in found.collect():
        got[r.query_id].append(r.vec_id)
    assert sum(len(set(got[q]) & {i for _, i in true[q]}) for q in got) >= 0.9 * 10 * len(got) and len(got) == 12


def test_mix_of_rows_without_an_id_makes_no_large_block(spark):
    rows = [(None if i % 3 else 7, f"text {i}", "a") for i in range(900)] + [(i, f"other {i}", "b") for i in range(50)]
    mixed = temperature_mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), entropy=None, repeats=2.0, whole=True, block_docs=50).collect()
    assert {r.text for r in mixed} == {t for _, t, _ in rows}
    assert max(Counter((r.source, r.epoch, r.block) for r in mixed).values()) < 120


def test_exponent_of_many_sources_meets_the_limit(spark):
    totals = spark.createDataFrame([(f"s{i}", 10.0 ** (i % 5 + 1)) for i in range(20)], "name string, tokens double")
    a = exponent(totals, None, 2.0)
    assert (1e-4) ** (a - 1) == pytest.approx(2.0, rel=1e-6) and exponent(totals, None, 1e9) == 0.0


@pytest.mark.parametrize("opening", ["<b>x ", "<div class='k1 k2'>y ", "<section><p>z "])
def test_pages_nested_very_deeply(opening):
    """Elements keep their own part of the path only, so the work grows with the page."""
    n = 30_000
    tracemalloc.start()
    text = pages.extracted(f"<html><body>{opening * n}", None)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(text.split()) == n and most < 150e6
