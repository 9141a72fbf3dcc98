"""Decontamination, SimHash near-dedup and suffix dedup against brute force."""

import hashlib
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm_cases import ROWS, SF, SHARED, edge_docs, no_docs, small  # noqa: F401

import harness
from staffwise.llm import decontamination, shared, simhash, suffix_dedup
from staffwise.llm.components import component_labels
from staffwise.llm.queries import ORACLE, QUERIES


# ------------------------------------------------------- decontamination


def expected_hits(rows, items, window):
    out = {}
    for key, text in rows:
        own = decontamination.words(text)
        hit, found = set(), set()
        for name, item in items:
            w = decontamination.words(item)
            k = min(window, len(w))
            for i in range(len(w) - k + 1) if w else ():
                for j in range(len(own) - k + 1):
                    if own[j : j + k] == w[i : i + k]:
                        hit |= set(range(j, j + k))
                        found.add(name)
        out[key] = (len(own), len(hit), sorted(found))
    return out


ITEMS = [("1", SHARED.upper()), ("2", "nothing else"), ("3", ""), ("4", None), ("5", "no such words at all in any text whatsoever here"), ("10", SHARED[20:90]), ("7", "word5 and word6 and word7 and word8 and word9 and word10")]


@pytest.mark.parametrize("window, limit", [(10, 1 << 20), (3, 1 << 20), (10, 150)])
def test_decontamination_edges(spark, edge_docs, window, limit):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = edge_docs.drop("text_key", "id")
    found = decontamination.match_benchmark(docs, items, window, max_item_bytes=limit)
    got = sorted((r.n_words, sum(e - s for s, e in zip(r.hit_starts, r.hit_ends)), sorted(r["items"])) for r in found.collect())
    want = expected_hits([(i, r[1]) for i, r in enumerate(ROWS)], ITEMS, window)
    assert got == sorted(want.values())
    assert any(n for _, n, _ in got)


def test_decontamination_keeps_clean_and_columns(spark, edge_docs, no_docs):
    items = spark.createDataFrame([("1", SHARED)], "item_id string, text string")
    kept = decontamination.decontaminate(edge_docs, items)
    assert kept.columns == [c for c in edge_docs.columns]
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 1, 2, 3, 5, 8, 10]
    assert decontamination.decontaminate(no_docs, items).count() == 0
    assert decontamination.decontaminate(edge_docs, items.limit(0)).count() == len(ROWS)


def test_longest_match_is_reported(spark):
    docs = spark.createDataFrame([(1, "zero " + SHARED), (2, " ".join(SHARED.split()[:12]) + " stop")], "doc_id long, text string")
    items = spark.createDataFrame([(1, SHARED)], "item_id long, text string")
    found = {r.doc_id: r.longest_match for r in decontamination.match_benchmark(docs, items).collect()}
    assert found == {1: len(SHARED.split()), 2: 12}


def test_suffix_order_is_lexicographic():
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 3, 400).astype(np.int32)
    tokens[-1] = 0
    at = np.flatnonzero(tokens)

    def suffix(i):
        end = i
        while tokens[end]:
            end += 1
        return tuple(tokens[i:end].tolist())

    for bits in (2, 20, 31):
        order = decontamination.suffix_order(tokens, at, bits, 400)
        assert [suffix(i) for i in order] == sorted(suffix(i) for i in at)


# --------------------------------------------------------------- simhash


def slow_fingerprint(text):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def expected_components(pairs):
    prints = {f for _, f in pairs}
    parent = {f: f for f in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= 4:
            parent[root(a)] = root(b)
    least = {}
    for i, f in pairs:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return sorted((str(i), f"{f:016x}", str(least.get(root(f)))) for i, f in pairs)


def test_simhash_small_table(spark, small):
    rows = QUERIES["op5_simhash_components"](spark, SF).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == expected_components([(i, slow_fingerprint(t)) for i, t in small])


def test_simhash_edges(edge_docs, no_docs):
    rows = simhash.simhash_components(edge_docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == expected_components([(r[0], slow_fingerprint(r[1])) for r in ROWS])
    kept = simhash.near_dedup(edge_docs)
    assert kept.columns == edge_docs.columns
    # 1, 2 and 3 have no words; 4, 6 and 7 have the same words; rows without an id stay
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "4", "5", "8", "9", "10", "None", "None"])
    assert simhash.simhash_components(no_docs).count() == 0 and simhash.near_dedup(no_docs).count() == 0


@pytest.mark.parametrize("max_bits", [1, 4, 6])
def test_links_lose_no_component(spark, max_bits):
    """A dense cloud around one fingerprint and random others: components equal those of all pairs."""
    rng = np.random.default_rng(max_bits)
    centre = int(rng.integers(0, 1 << 62))
    cloud = {centre}
    for _ in range(150):
        x = centre
        for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
            x ^= 1 << int(b)
        cloud.add(x)
    prints = sorted(cloud | {int(x) for x in rng.integers(0, 1 << 63, 150, dtype=np.uint64)})
    table = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(prints)], "doc_id long, fp long")
    labels = {r.node: r.label for r in component_labels(simhash.fingerprint_links(table, max_bits)).collect()}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    parent = {x: x for x in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(signed, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {x: labels.get(x, x) for x in signed} == {x: root(x) for x in signed}


def test_near_dedup_tells_rows_of_one_id_apart(spark):
    one, two = "the quick brown fox jumps over the lazy dog and runs away", "seven wizards brew a potion of strange herbs in the old mill"
    three = "numbers of the ledger were added twice by a tired clerk on monday"
    four, five = "rain fell on the harbour all night while ships lay still", "every child of the village learned to carve small birds"
    docs = spark.createDataFrame([(1, one), (2, two), (2, one), (3, two), (3, three), (3, three), (5, four), (5, five), (7, None)], "doc_id long, text string").repartition(3)
    assert sorted((r.doc_id, r.text or "") for r in simhash.near_dedup(docs).collect()) == [(1, one), (2, two), (3, three), (5, five), (5, four), (7, "")]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, x) for x in range(201, 260)] + [(5, 5)]
    labels = {r.node: r.label for r in component_labels(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert labels == {i: 0 for i in range(101)} | {i: 200 for i in range(200, 260)}


# ---------------------------------------------------------- suffix dedup


def expected_ranges(rows):
    seen, out = {}, []
    for i, text in sorted(((i, t) for i, t, *_ in rows), key=lambda r: (r[0] is None, r[0] or 0)):
        b = (text or "").encode()
        gone, mine = bytearray(len(b)), []
        for p in range(len(b) - 49) if i is not None else ():
            s = b[p : p + 50]
            if seen.get(s, i) < i:
                gone[p : p + 50] = b"\1" * 50
            mine.append(s)
        for s in mine:
            seen[s] = min(i, seen.get(s, i))
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


def ranges(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_suffix_dedup_small_table(spark, small):
    assert ranges(QUERIES["op4_bucket_pointer_dedup"](spark, SF)) == expected_ranges(small)


def test_suffix_dedup_edges(edge_docs, no_docs):
    assert ranges(suffix_dedup.repeated_ranges(edge_docs)) == expected_ranges(ROWS)
    assert suffix_dedup.repeated_ranges(no_docs).count() == 0


@pytest.mark.parametrize("share", [suffix_dedup.HOT_SHARE, 0.9])
def test_suffix_dedup_random_overlaps(spark, monkeypatch, share):
    """Texts cut from a few sources overlap at any offset; hot and ordinary anchors give the same."""
    rng = np.random.default_rng(5)
    sources = ["".join(rng.choice(list("abé \n"), 400)) for _ in range(4)] + ["ab" * 150, "z" * 300]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(int(rng.integers(1, 5))):
            s = sources[int(rng.integers(0, len(sources)))]
            a = int(rng.integers(0, len(s)))
            parts.append(s[a : a + int(rng.integers(1, 160))])
        rows.append((int(rng.integers(-20, 40)) * 1000 + i, "".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(suffix_dedup.hot_anchors, "__defaults__", (suffix_dedup.SAMPLE_DOCS, share))
    assert ranges(suffix_dedup.repeated_ranges(docs)) == expected_ranges(rows)


def test_bucket_refinement_finds_equal_strings():
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 99, 3000).astype(np.uint8)
    raw[1000:1300] = raw[200:500]
    ends = np.repeat([1100, 3000], [1100, 1900])
    at, bucket = suffix_dedup.bucket_refined(raw, ends)
    strings = {}
    for p in range(3000):
        if p + 50 <= ends[p]:
            strings.setdefault(bytes(raw[p : p + 50]), []).append(p)
    groups = {}
    for p, b in zip(at.tolist(), bucket.tolist()):
        groups.setdefault(b, []).append(p)
    assert sorted(groups.values()) == sorted(v for v in strings.values() if len(v) > 1)


# -------------------------------------------------------------- SQL twins


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_sql(spark, name):
    r = harness.compare(spark, name, QUERIES[name], ORACLE[name], SF, harness.duck(SF))
    assert r["columns_match"] and r["hash_match"], r


def test_shared_folder_comes_from_the_session(spark):
    assert shared.shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
