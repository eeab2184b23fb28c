"""Exact dedup, line dedup and the Jaccard join against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import exact_dedup, jaccard
from sluice.llm import line_dedup as line_dedup_module
from sluice.llm.components import components
from sluice.llm.exact_dedup import duplicate_groups, without_duplicates
from sluice.llm.jaccard import _folded, boundary, near_duplicates, overlap, parity, subset_sizes
from sluice.llm.line_dedup import PerfectHash, line_dedup

#: Columns whose names clash with those the operators use inside.
CLASH = "doc_id long, text string, key long, digest string, n int, chunk int, node int, size int, _digest int, shingles int, block int, component int"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, *[7] * 1, "x", *[7] * 8) for i, t in rows], CLASH)


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def some_texts(seed: int, n: int) -> list[tuple[int, str | None]]:
    pick = random.Random(seed)
    pool = [None, "", " ", "a", "A", "É", "é", "x\ny", "X\nY", "word " * 3000, *(" ".join(pick.choices("abcdefg", k=pick.randint(1, 30))) for _ in range(15))]
    return [(i, pick.choice(pool)) for i in pick.sample(range(10 * n), n)]


def exact_brute(rows, best):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out, kept = [], set()
    for t, ids in groups.items():
        real = [i for i in ids if i is not None]
        keep = best(real) if real else None
        for i in ids:
            stays = i == keep and (t not in kept)
            kept |= {t} if stays else set()
            out.append((i, keep, len(ids), stays, hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize(("keep", "best", "leaf", "fanout"), [("largest", max, 50_000, 16), ("smallest", min, 10, 2), ("largest", max, 5, 3)])
def test_tree_merge_equals_brute_force(spark, keep, best, leaf, fanout):
    rows = [*some_texts(3, 120), (None, "a"), (None, "only here"), (None, "ONLY here"), (5000, "twice"), (5000, "twice"), (5001, "TWICE")]
    found = duplicate_groups(clashing(spark, rows), keep=keep, leaf_rows=leaf, fanout=fanout).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in found) == exact_brute(rows, best)


def test_exact_dedup_of_nothing(spark):
    assert duplicate_groups(clashing(spark, [])).count() == 0
    assert without_duplicates(clashing(spark, [])).count() == 0


def test_rows_that_stay_keep_their_columns(spark):
    rows = [(1, "Same"), (2, "same"), (3, "other"), (3, "other"), (4, None), (5, ""), (None, "sAme")]
    left = without_duplicates(clashing(spark, rows), keep="largest")
    assert left.columns == [c.split()[0] for c in CLASH.split(", ")]
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(2, "same"), (3, "other"), (5, "")]


def test_one_group_of_most_rows(spark):
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(600)]
    found = {r.doc_id: r for r in duplicate_groups(clashing(spark, rows), leaf_rows=20, fanout=4).collect()}
    assert found[1].group_size == 400 and found[599].keep_id == 1 and found[1].kept and not found[2].kept and found[3].group_size == 1


def lines_brute(rows):
    def key(line):
        k = lower(line.strip(" \t\n\x0b\x0c\r"))
        return k if len(k) >= 10 else None

    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(float("inf") if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        own = float("inf") if i is None else i
        kept = [x for x in lines if key(x) is None or len(held[key(x)]) < 2 or min(held[key(x)]) == own]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize(("chunk", "entries"), [(1024, 200_000), (7, 20)])
def test_line_dedup_equals_brute_force(spark, chunk, entries):
    pick = random.Random(8)
    pool = ["A common line here", "  a COMMON line here\t", "short", "", "éééééééééé", "ÉÉÉÉÉÉÉÉÉÉ", "ééééééééé", "a line of some length \r", *(f"line number {i} of the pool" for i in range(40))]
    rows = [(i, "\n".join(pick.choices(pool, k=pick.randint(1, 9)))) for i in pick.sample(range(999), 90)]
    rows += [(None, "a common line here\nof its own line"), (None, None), (2000, ""), (2001, "twice the same line"), (2001, "twice the same line"), (2002, "long " * 50_000)]
    found = line_dedup(clashing(spark, rows), chunk_docs=chunk, shard_entries=entries).collect()
    assert Counter(tuple(r) for r in found) == lines_brute(rows)
    assert line_dedup(clashing(spark, [])).count() == 0


def test_perfect_hash_numbers_keys_without_gaps():
    random_keys = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, (2, 5000))
    index = PerfectHash.unpacked(PerfectHash.over(*random_keys).packed())
    assert sorted(index.numbers(*random_keys).tolist()) == list(range(5000))
    assert PerfectHash.over(*random_keys[:, :0]).levels == []


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def joined_brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), float("inf")), float("inf") if d is None else d)
    return Counter((d, len(s), None if smallest[find(i)] == float("inf") else smallest[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_equals_brute_force(spark, seed):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows: list[tuple[int | None, str | None]] = [(i, None) for i in range(2)] + [(2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one"), (None, "lonely words")]
    passage = " ".join(pick.choices(words, k=40))
    for base in range(25):
        text = pick.choices(words, k=pick.choice([5, 6, 7, 8, 9, 11, 12, 13, 14, 15, 16, 18, 20, 40, 120]))
        for _ in range(pick.choice([1, 2, 3, 8])):
            copy = list(text)
            for _ in range(pick.choice([0, 0, 1, 1, 2])):  # changes that may or may not break the link
                copy[pick.choice([0, -1, pick.randrange(len(copy))])] = pick.choice(words)
            copy = copy[: len(copy) - pick.choice([0, 0, 0, 1, 2])] + ([] if pick.random() < 0.8 else passage.split())
            rows.append((len(rows) + 100 * pick.randint(0, 9), pick.choice([" ", "  ", "\n", "\t"]).join(copy).upper() if pick.random() < 0.3 else " ".join(copy)))
    rows += [(5000 + i, passage + " " + " ".join(pick.choices(words, k=60))) for i in range(20)]
    rows += [rows[-1], rows[-1]]
    found = near_duplicates(clashing(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == joined_brute(rows)


def test_chains_of_near_copies_are_one_component(spark):
    words = [f"t{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(100)]
    found = near_duplicates(clashing(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == joined_brute(rows)
    assert {r.component_id for r in found} == {0}


def test_very_long_near_copies_link(spark):
    """Of 200,000 shingles the copies share 75,000 first ones in one block, more than 16 bits count."""
    words = [f"w{i}" for i in range(200_004)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "other"])), (3, " ".join(words[:100])), (4, " ".join(words[1:102]))]
    found = near_duplicates(clashing(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == joined_brute(rows)
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 3, 4: 3}


def test_jaccard_join_of_nothing(spark):
    assert near_duplicates(clashing(spark, [])).count() == 0


def test_overlap_and_subsets():
    for n in range(1, 60):
        for m in range(1, 60):
            least = next((o for o in range(min(n, m) + 1) if 100 * o >= 75 * (n + m - o)), None)
            assert (least if least is not None else min(n, m) + 1) == min(overlap(n, m), min(n, m) + 1)
    assert subset_sizes(4, 12) == [3, 4] and subset_sizes(1, 12) == [1]
    assert boundary({}, 1.0) == 0
    assert boundary({1: 1000, 2: 1000}, 50.0) >= 2


@pytest.mark.parametrize("share", [200_000, 60, 7])
def test_components_equal_union_find(spark, share):
    pick = random.Random(4)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5000, 6000 + i) for i in range(100)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    found = {r.key: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(30), share).collect()}
    alone = {a for a, b in links if a == b}
    assert all(found.get(x, x) == find(x) for x in root) and set(found) >= {x for x in root if x not in alone}


def test_bits_bound_the_difference():
    pick = np.random.default_rng(3)
    for n, m, both in [(1, 1, 1), (30, 33, 25), (32, 33, 30), (500, 600, 450), (1000, 1100, 990), (3, 200, 1)]:
        tokens = pick.integers(0, 1 << 63, n + m - both).astype(np.uint64)
        x, y = (np.frombuffer(parity(np.sort(s)), np.uint64) for s in (tokens[:n], tokens[n - both :]))
        width = min(len(x), len(y))
        assert np.bitwise_count(_folded(x, width) ^ _folded(y, width)).sum() <= n + m - 2 * both
        assert (_folded(x, len(x)) == x).all() and len(x) * 64 >= 2 * n


def near_but_unlinked(n: int, seed: int = 5) -> list[tuple[int, str]]:
    """Texts that share most shingles with one origin, but not enough with each other; the origin is not among them."""
    pick = random.Random(seed)
    origin = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):
        words = list(origin)
        for at in (pick.randrange(4, 60), pick.randrange(60, 116)):
            words[at] = f"x{i}-{at}"
        rows.append((i, " ".join(words)))
    return rows


def test_pairs_of_a_list_stay_in_its_tasks(spark, monkeypatch):
    """What the last pass hands on is linear in the documents: links that join components, and none if there are none."""
    made = []
    plain = jaccard._across_of

    def counted(*lists):
        found = jaccard.staged(plain(*lists))
        made.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "_across_of", counted)
    for n in (100, 300):
        rows = near_but_unlinked(n)
        found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == joined_brute(rows)
    assert all(m <= n for m, n in zip(made, (100, 300)))


@pytest.mark.parametrize(("sets", "shingles"), [(16, 1 << 21), (4096, 4000), (4096, 1 << 21)])
def test_blocks_of_a_list_lose_no_link(spark, monkeypatch, sets, shingles):
    """Chains of near copies with a common passage, in lists that are cut into many blocks."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", sets)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", shingles)
    pick = random.Random(sets + shingles)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for c in range(12):
        words = [f"c{c}-{i}" for i in range(50)]
        for k in range(15):
            at = pick.randrange(len(words) - 3)
            words = words[:at] + [f"n{c}-{k}"] + words[at + pick.choice([0, 1, 2]) :]
            rows.append((len(rows), " ".join(passage + words if k % 2 else words[:25] + passage + words[25:])))
    pick.shuffle(rows)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == joined_brute(rows)


def test_runs_are_sorted_and_merged(spark):
    """Each round sorts what its nodes get and merges it in one pass, in three rounds here."""
    rows = [(i, f"text {i % 40}") for i in range(300)]
    table = clashing(spark, rows)
    pieces = exact_dedup.digests(table).selectExpr("doc_id % 4 node", "digest", "n_bytes", "check", "doc_id keep_id", "1L size")
    merged = exact_dedup._merged(pieces, 4, "smallest")
    lines = merged._jdf.queryExecution().executedPlan().toString().splitlines()
    merge = next(i for i, x in enumerate(lines) if "_merging" in x or "MapInArrow run" in x)
    assert any("Sort [node" in x for x in lines[merge : merge + 3])
    found = {(r.node, r.digest): (r.keep_id, r.size) for r in merged.collect()}
    expected = defaultdict(list)
    for i, t in rows:
        expected[i % 4, hashlib.sha256(t.encode()).digest()].append(i)
    assert found == {k: (min(v), len(v)) for k, v in expected.items()}
    for keep, best in (("smallest", min), ("largest", max)):
        deep = duplicate_groups(table, keep=keep, leaf_rows=5, fanout=4).collect()  # 60 leaves: three rounds
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in deep) == exact_brute(rows, best)


def test_merging_across_batches():
    """Groups that go over the ends of batches, ids that are missing, and groups without any."""
    rows = [(0, b"a", 1, 1, None, 2), (0, b"a", 1, 1, 5, 1), (0, b"a", 1, 1, 3, 1), (0, b"b", 1, 1, None, 1), (0, b"b", 1, 1, None, 4), (1, b"b", 1, 1, -7, 1), (1, b"b", 1, 2, 9, 1), (1, b"b", 2, 2, 9, 1)]
    schema = pa.schema([("node", pa.int64()), ("digest", pa.binary()), ("n_bytes", pa.int64()), ("check", pa.int64()), ("keep_id", pa.int64()), ("size", pa.int64())])
    table = pa.table(list(map(list, zip(*rows))), schema=schema)
    for keep, first in (("smallest", 3), ("largest", 5)):
        for size in (1, 2, 3, 8):
            out = pa.Table.from_batches(exact_dedup._merging(keep)(iter(table.to_batches(max_chunksize=size)))).to_pylist()
            assert [tuple(r.values()) for r in out] == [(0, b"a", 1, 1, first, 4), (0, b"b", 1, 1, None, 5), (1, b"b", 1, 1, -7, 1), (1, b"b", 1, 2, 9, 1), (1, b"b", 2, 2, 9, 1)]
    assert list(exact_dedup._merging("smallest")(iter([]))) == []


def test_lines_of_rows_without_an_id_are_dealt_over_chunks(spark, monkeypatch):
    rows = [(None if i % 3 else 7, f"a line that many share\nits own line number {i}\nanother one of {i % 50}") for i in range(240)] + [(3, "a line that many share"), (900, "long " * 3000)]
    monkeypatch.setattr(line_dedup_module, "CHUNK_BYTES", 2000)
    assert Counter(tuple(r) for r in line_dedup(clashing(spark, rows), chunk_docs=20).collect()) == lines_brute(rows)
