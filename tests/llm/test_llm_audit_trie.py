"""The filter audit, winnowing fingerprints and the conversation trie against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest
from compare import differences
from pyspark.sql import functions as F

from sluice.llm import queries as llm
from sluice.llm.blocks import Blocks
from sluice.llm.filter_audit import FILTERS, Lattice, edge_counts, filter_audit, order_audit, shapley
from sluice.llm.prefix_trie import conversation_turns, prefix_trie
from sluice.llm.winnowing import edited, fingerprints, likeness, matches, next_compared, packed, rolled, unpacked, winnowed

SF = "/root/testdata/sf0.001"

# --- op11


def audit_brute(rows, labels):
    """(part, order, step) -> kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    firsts: dict[str, int] = {}
    for i, t, _ in rows:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    fails = []
    for i, t, _ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t)}
        own |= {"D": bool(re.search("[#$%&*|]", t)), "E": i is not None and firsts[t] < i}
        fails.append({f for f, bad in own.items() if bad})
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, x in labels if x == 1} - {None}
    out, sums = {}, Counter()
    for part in {p or "" for *_, p in rows}:
        of = [(i, f) for (i, _, p), f in zip(rows, fails) if (p or "") == part]
        for order in permutations("ABCDE"):
            left, gone = of, []
            for step, f in enumerate(order, 1):
                now = [x for x in left if f in x[1]]
                redundant = sum(f in x[1] for x in gone)
                left, gone = [x for x in left if f not in x[1]], gone + now
                unique = sum(x[1] == {f} for x in of)
                out[part, "".join(order), step] = [len(left), len(now), redundant, unique, sum(x[0] in good for x in now), sum(x[0] in toxic for x in now)]
                sums[part, f] += len(now)
    return {k: (*v, sums[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows(seed: int, n: int):
    pick = random.Random(seed)
    long = " ".join(f"w{i}" for i in range(120))
    pool = [None, "", "a", "SHOUT", "x|y", long, long + " #", long.upper(), "same " * 150, "ÉÀ " * 40, "\x0b\x0c", "a b"]
    return [(i, pick.choice(pool), pick.choice(["en", "de", None, ""])) for i in pick.sample(range(5 * n), n)]


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, 1, 2, 3) for i, t, p in rows], "doc_id long, text string, lang string, mask int, n int, digest int")
    marks = spark.createDataFrame([(*x, "y") for x in labels], "doc_id long, quality int, toxic int, part string")
    return filter_audit(docs, marks)


def test_audit_equals_brute_force(spark):
    rows = [*audit_rows(1, 60), (None, "a", "en"), (None, "only", None), (9000, "a", "en"), (9000, "a", "en"), (9000, "a", "de"), (-5, "a", "de")]
    labels = [(i, i % 2, (i // 2) % 2) for i, *_ in rows if i is not None and i % 3] + [(9000, 0, 1), (9000, 1, 0), (9000, None, None), (None, 1, 1), (77777, 1, 1)]
    found = audited(spark, rows, labels).collect()
    own = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found}
    assert own == audit_brute(rows, labels) and len(found) == len(own) == 600 * 3


def test_audit_of_nothing_and_without_labels(spark):
    assert audited(spark, [], []).count() == 0
    found = audited(spark, [(1, None, None)], []).collect()
    assert len(found) == 600 and {r.part for r in found} == {""}
    assert {(r.filter, r.shapley) for r in found} == {("A", 120), *((f, 0) for f in "BCDE")}


def test_copies_of_a_third_of_all_rows(spark):
    rows = [(i, "copy" if i % 3 == 0 else f"text {i}", "en") for i in range(900)]
    found = audited(spark, rows, []).filter("filter_order = 'EABCD' AND step = 1").first()
    assert (found.removed, found.kept) == (299, 601)


def test_lattice_counts_paths():
    lattice = Lattice("abcd")
    assert lattice.orders == 24 and len(lattice.edges) == 4 * 8
    for state, _, paths in lattice.edges:
        n = state.bit_count()
        assert paths == math.factorial(n) * math.factorial(3 - n)
    tied = Lattice("abcd", [("a", "b"), ("b", "c")])
    orders = [o for o in permutations("abcd") if o.index("a") < o.index("b") < o.index("c")]
    assert tied.orders == len(orders) and tied.listed() == orders
    through = Counter((sum(1 << "abcd".index(f) for f in o[:i]), "abcd".index(o[i])) for o in orders for i in range(4))
    assert {(s, f): n for s, f, n in tied.edges} == dict(through)
    with pytest.raises(ValueError):
        Lattice("ab", [("a", "b"), ("b", "a")])
    with pytest.raises(ValueError):
        Lattice("abcdefgh").listed()


def test_audit_with_fixed_places_and_more_filters(spark):
    """Any cells: orders that are not allowed don't count, and given orders of many filters need no list of all."""
    pick = random.Random(4)
    rows = [(pick.choice("xy"), pick.randrange(8), pick.randrange(1, 9), pick.randrange(3)) for _ in range(40)]
    cells = spark.createDataFrame(rows, "part string, mask int, n long, good long")
    lattice = Lattice("abc", [("c", "a")])
    sums = {(r.part, r.filter): r.shapley for r in shapley(edge_counts(cells, lattice)).collect()}
    expected = Counter({(p, f): 0 for p in "xy" for f in range(3)})
    for order in lattice.listed():
        for part, mask, n, _ in rows:
            first = next((f for f in order if mask >> "abc".index(f) & 1), None)
            if first:
                expected[part, "abc".index(first)] += n
    assert sums == expected
    wide = Lattice("abcdefghij")
    found = order_audit(cells, wide, ["good"], ["jihgfedcba"]).collect()
    assert len(found) == 20 and sum(r.removed for r in found) + sum(r.kept for r in found if r.step == 10) == sum(r[2] for r in rows)


# --- op12


def winnowed_brute(text: str, gram: int, window: int, hashes) -> list[tuple[int, int]]:
    own = hashes(text)
    found = []
    for at in range(max(1, len(own) - window + 1) if own else 0):
        low = min(own[at : at + window])
        place = max(i for i in range(at, min(len(own), at + window)) if own[i] == low)
        if not found or found[-1][1] != place:
            found.append((low, place))
    return found


@pytest.mark.parametrize(("gram", "window"), [(16, 32), (5, 4), (1, 1), (3, 255), (7, 6)])
def test_winnowing_equals_brute_force(monkeypatch, gram, window):
    pick = random.Random(gram)
    texts = ["", "a", "ab", "é" * 50, "ab" * 200, "x" * 15, "x" * 16, "x" * 17] + ["".join(pick.choices("abcé€😀", k=n)) for n in (1, 5, 20, 47, 48, 300, 1000)]

    def hashes(text):
        points = [ord(c) for c in text]
        if points:
            points += [0x110000] * (gram - len(points))
        return [int(rolled(np.array(points[i : i + gram], np.uint32), gram)[0]) for i in range(len(points) - gram + 1)]

    expected = [winnowed_brute(t, gram, window, hashes) for t in texts]
    for part in (1 << 19, 100, 7):
        monkeypatch.setattr("sluice.llm.winnowing.PART", part)
        found = [list(zip(h.tolist(), p.tolist())) for h, p in winnowed(texts, gram, window)]
        assert found == expected
    if window < 255 or gram > 1:
        for h, p in winnowed(texts, gram, window):
            again = unpacked(packed(h, p))
            assert (again[0] == h).all() and (again[1] == p).all()


def test_shared_passages_are_found_in_both():
    pick = random.Random(8)
    for n in (47, 60, 200):
        passage = "".join(pick.choices("abcdefgh ", k=n))
        left, right = ("".join(pick.choices("abcdefgh ", k=k)) for k in (700, 333))
        left, right = left[:100] + passage + left[100:], right[:300] + passage + right[300:]
        (a, p), (b, q) = winnowed([left, right])
        inside = [(x, y) for x, y in matches(packed(a, p), packed(b, q)) if 100 <= x <= 100 + n - 16 and 300 <= y <= 300 + n - 16]
        assert inside and all(x - 100 == y - 300 for x, y in inside)


def compared_brute(rows):
    order = sorted({(i is None, i or 0, t or "") for i, t in rows})
    after = {x: order[(k + 1) % len(order)][2] for k, x in enumerate(order)}
    out = []
    for i, t in rows:
        t = t or ""
        e = edited(t, after[i is None, i or 0, t])
        f, g, x = (winnowed([s])[0] for s in (t, e, after[i is None, i or 0, t]))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), packed(*f), packed(*g), likeness(f[0], g[0]), likeness(f[0], x[0])))
    return Counter(out)


@pytest.mark.parametrize("block", [4096, 7, 1])
def test_comparison_with_the_next_document(spark, block):
    pick = random.Random(2)
    rows = [(i, pick.choice([None, "", "a", "short text", "é😀" * 90]) if i % 4 == 0 else "".join(pick.choices("abc ", k=pick.randint(0, 400)))) for i in pick.sample(range(-200, 900), 80)]
    rows += [(None, "last of all"), (1000, "twice"), (1000, "twice"), (1000, "twice")]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, block int, rank int, after int").repartition(5)
    found = Counter(map(tuple, next_compared(docs, block_docs=block).collect()))
    assert found == compared_brute(rows)


def test_an_id_of_most_rows_is_dealt_over_blocks(spark):
    """Rows of one id, and rows without one, follow each other by the hash of their texts."""
    rows = [(7 if i % 3 else None, f"text number {i} " * 9) for i in range(120)] + [(1, "one"), (9, "nine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ranked = docs.withColumn("rank", F.xxhash64("text"))
    hashes = {(r.doc_id, r.text): r.rank for r in ranked.collect()}
    order = sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, hashes[x]))
    blocks = Blocks(ranked, "doc_id", 10)
    of = {(r.doc_id, r.text): r.block for r in ranked.withColumn("block", blocks.of(F.col("doc_id"), F.col("rank"))).collect()}
    placed = [of[x] for x in order]
    assert placed == sorted(placed) and max(Counter(placed).values()) <= 24 and max(placed) < blocks.number
    found = {(r.doc_id, r.fingerprint): r.edited_sha256 for r in next_compared(docs, block_docs=10).collect()}
    for x, y in zip(order, [*order[1:], order[0]]):
        assert found[x[0], packed(*winnowed([x[1]])[0])] == hashlib.sha256(edited(x[1], y[1]).encode()).hexdigest()


def test_ids_beyond_53_bits(spark):
    ids = [(1 << 62) + i for i in range(50)] + [None]
    docs = spark.createDataFrame([(i, f"{i}" * 20) for i in ids], "doc_id long, text string")
    assert Counter(map(tuple, next_compared(docs, block_docs=5).collect())) == compared_brute([(i, f"{i}" * 20) for i in ids])


def test_fingerprints_of_few(spark):
    schema = "doc_id long, text string"
    assert next_compared(spark.createDataFrame([], schema)).count() == fingerprints(spark.createDataFrame([], schema)).count() == 0
    own = next_compared(spark.createDataFrame([(1, "alone with itself, a text of some length for winnowing")], schema)).first()
    assert own.near_next == 1.0 and own.n_chars == 54
    long = "".join(random.Random(1).choices("abcdef ", k=2_000_000))
    docs = spark.createDataFrame([(1, long), (2, None), (3, long)], schema)
    found = {r.doc_id: r for r in fingerprints(docs).collect()}
    assert found[1].fingerprint == found[3].fingerprint and found[2].fingerprint == "" and found[1].n_chars == 2_000_000
    assert found[1].fingerprint == packed(*winnowed([long])[0])


def test_query_of_fingerprints_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = llm.op12_winnowing(spark, SF).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert Counter(map(tuple, found.collect())) == compared_brute(rows)


# --- op13


def trie_brute(sequences: dict[int, list[tuple[str, str]]]):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(sequences.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(x[:-1] for x in members if x)
    out = []
    for x, ids in members.items():
        below = [y for y in members if y[: len(x)] == x]
        out.append(
            (
                ids[0], len(x), members[x[:-1]][0] if x else None, len(ids), children[x], sum(not children[y] for y in below),
                sum((len(members[y]) - 1) * len(y[-1][1].encode()) for y in below if y), hashlib.sha256(",".join(map(str, ends[x])).encode()).hexdigest(),
            )
        )
    return Counter(out)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rows_of_sequences(sequences):
    return [(c, k, r, t, "x", 1) for c, turns in sequences.items() for k, (r, t) in enumerate(turns)]


SCHEMA = "conv_id long, turn long, role string, text string, node string, shard int"


@pytest.mark.parametrize("shard", [16_384, 40, 3])
def test_trie_equals_brute_force(spark, shard):
    pick = random.Random(6)
    sequences = {c: [(pick.choice(["user", ""]), pick.choice(["", "é", "hello", "b"])) for _ in range(pick.randint(1, 7))] for c in pick.sample(range(-50, 500), 90)}
    long = [("user", f"turn {i}") for i in range(300)]
    sequences |= {1000: long, 1001: long[:200], 1002: long[:100] + [("user", "other")] * 120, (1 << 62) + 1: long}
    found = prefix_trie(conversation_turns(spark.createDataFrame(rows_of_sequences(sequences), SCHEMA)), shard).select(*COLUMNS)
    assert Counter(map(tuple, found.collect())) == trie_brute(sequences)


def test_one_conversation_of_most(spark):
    """Copies of one conversation over many shards: its nodes are summed, its list of ids is whole."""
    sequences = {c: [("user", "hi"), ("assistant", "hello")] + ([] if c % 3 else [("user", str(c))]) for c in range(400)}
    found = prefix_trie(conversation_turns(spark.createDataFrame(rows_of_sequences(sequences), SCHEMA)), 60).select(*COLUMNS)
    assert Counter(map(tuple, found.collect())) == trie_brute(sequences)


def test_trie_of_little(spark):
    assert prefix_trie(conversation_turns(spark.createDataFrame([], SCHEMA))).count() == 0
    odd = [(1, None, None, None, "x", 1), (1, 0, "", "", "x", 1), (2, 5, None, "", "x", 1), (None, 1, "a", "b", "x", 1), (3, 1, "a:", "b", "x", 1), (4, 1, "a", ":b", "x", 1)]
    found = prefix_trie(conversation_turns(spark.createDataFrame(odd, SCHEMA))).select(*COLUMNS)
    assert Counter(map(tuple, found.collect())) == trie_brute({1: [("", ""), ("", "")], 2: [("", "")], 3: [("a:", "b")], 4: [("a", ":b")]})


def rebuilt(rows):
    own = defaultdict(list)
    for c, k, r, t, *_ in sorted((x for x in rows if x[0] is not None), key=lambda x: (x[0], x[1] is not None, x[1] or 0)):
        own[c].append((r or "", t or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    return out


def test_query_of_conversations_equals_brute_force_and_statement(spark, tmp_path):
    pick = random.Random(9)
    rows = [(c, k if k else None, pick.choice(["user", None]), pick.choice([None, "", "ü", "a", "b"]), "x", 1) for c in pick.sample(range(-40, 200), 70) for k in range(pick.randint(1, 12))]
    rows += [(None, 1, "user", "nobody's", "x", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    found = llm.op13_prefix_trie(spark, str(tmp_path))
    assert Counter(map(tuple, found.select(*COLUMNS).collect())) == trie_brute(rebuilt(rows))
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert differences(found, connection, llm.STATEMENTS["op13_prefix_trie"]) == []


def test_audit_statement_of_every_kind_of_row(spark, tmp_path):
    rows = [*audit_rows(3, 50), (None, "a", "en"), (7000, "a", None), (7000, "a", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(rows[0][0], 1, 0), (rows[1][0], None, 1), (7000, 1, 1), (7000, 0, 0), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    connection = duckdb.connect()
    for name in ("documents", "labels"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert differences(llm.op11_filter_audit(spark, str(tmp_path)), connection, llm.STATEMENTS["op11_filter_audit"]) == []
    assert set(FILTERS) == set("ABCD")
