"""Phrase collocations against plain Python counts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import ROWS, SF, edge_docs, no_docs  # noqa: F401

import harness
from staffwise.llm import collocations as co
from staffwise.llm import shared
from staffwise.llm.queries import ORACLE, QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, min_count, top, longest=4):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = set()
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if a >= min_count}
        longer = Counter()
        for p, a in frequent.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], a)
        found = []
        for p, a in frequent.items():
            if len(p) > 1 and 100 * longer[p] < 80 * a:
                score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def rows_of(df):
    rows = [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made_rows(count=400):
    random.seed(5)
    words = ["New", "york", "CITY", "of", "the", "größe", "漢字", "ﬀ", "İ", "a\x00b", "x"]
    rows = []
    for i in range(count):
        text = "".join(random.choice(words) + random.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", "! "]) for _ in range(i % 23))
        rows.append((text, random.choice(["en", "en", "en", "de", None])))
    rows += [("hot phrase of four words", "en")] * 200 + [(None, "none"), ("", "none"), (" \t.", None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").repartition(4)


@pytest.mark.parametrize("min_count, top", [(1, 10_000), (2, 7), (60, 3)])
def test_edges_against_brute_force(edge_docs, min_count, top):
    assert rows_of(co.collocations(edge_docs, min_count, top=top)) == expected([(text, lang) for _, text, lang, _ in ROWS], min_count, top)


@pytest.mark.parametrize("block_bytes", [60, 1 << 20])
def test_words_breaks_and_hot_phrase(spark, block_bytes):
    rows = made_rows()
    assert rows_of(co.collocations(frame(spark, rows), 5, block_bytes=block_bytes)) == expected(rows, 5, 2000)


def test_colliding_fingerprints_are_told_apart(spark):
    rows = made_rows(150)
    assert rows_of(co.collocations(frame(spark, rows), 3, fingerprint_bits=3)) == expected(rows, 3, 2000)


def test_full_counter_table_drops_nothing(spark):
    random.seed(9)
    rows = [(" ".join(f"w{random.randrange(4000)}" for _ in range(60)), "en") for _ in range(600)]
    assert rows_of(co.collocations(frame(spark, rows), 2, max_bits=14)) == expected(rows, 2, 2000)


def test_rare_pairs_do_not_fill_the_table_of_longer_phrases():
    random.seed(4)
    texts = [" ".join(f"w{random.randrange(4000)}" for _ in range(60)) + ". so they said again" for _ in range(600)]
    batch = pa.RecordBatch.from_pydict({"lang": pa.array(["en"] * 600), "text": pa.array(texts), "row_no": pa.array(range(600), pa.int64())})
    miner, bitmaps = co.Miner(25, 4, 14), {}
    for sizes in (range(1, 3), range(3, 5)):
        (chunk,) = [b for b in miner.merge(miner.count(iter([batch]), sizes, dict(bitmaps))) if b.column("chunk")[0].as_py() == 0]
        bitmaps |= dict.fromkeys(sizes, np.frombuffer(chunk.column("data")[0].as_py(), np.uint8))
    found = Counter()
    for rows in miner.occurrences(iter([batch]), bitmaps):
        for n, times in zip(rows.column("n").to_pylist(), rows.column("count").to_pylist()):
            found[n, times >= 25] += 1
    assert found[3, True] == 2 and found[4, True] == 1 and found[3, False] + found[4, False] == 0


@pytest.mark.parametrize("min_count", [200, 300])
def test_wide_and_narrow_counters_saturate(spark, min_count):
    rows = [("a b a b c " * 40, "en")] * 9 + [("a b c d", "en")] * 20
    assert rows_of(co.collocations(frame(spark, rows), min_count)) == expected(rows, min_count, 2000)


def test_small_splits_share_tasks(spark):
    texts = spark.range(100).repartition(100)
    cores = spark.sparkContext.defaultParallelism
    assert co.gathered(texts, 1 << 20).rdd.getNumPartitions() == min(100, 2 * cores)
    assert co.gathered(texts, 100 * co.TASK_BYTES).rdd.getNumPartitions() == 100


def test_counters_of_tasks_are_not_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_path", lambda _, label: f"{tmp_path}/{label}-{len(list(tmp_path.iterdir()))}")
    random.seed(6)
    rows = [(" ".join(f"w{random.randrange(9000)}" for _ in range(300)), "en") for _ in range(600)]
    co.collocations(frame(spark, rows).repartition(40), 2)
    stored = Counter()
    for file in tmp_path.glob("*/*.parquet"):
        stored[file.parent.name.rsplit("-", 1)[0]] += file.stat().st_size
    size = sum(len(text) for text, _ in rows)
    assert stored["phrase-counters"] < size / 8, (size, stored)
    assert all(".zstd." in file.name for file in tmp_path.glob("phrase-texts-*/*.parquet"))


def test_long_text_in_parts(spark):
    random.seed(2)
    long = "".join(random.choice(["one", "two", "three"]) + random.choice([" ", " ", ". "]) for _ in range(5000))
    rows = [("short one two", "en"), (long, "en"), (None, "en"), (" ".join(["endless"] * 300), "en")]
    assert rows_of(co.collocations(frame(spark, rows), 30, block_bytes=100)) == expected(rows, 30, 2000)


def test_parts_cover_texts():
    texts = [b"", b"a b. c d. e f.", b"no break at all", b".", b"x. " * 20]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    parts, text = co.short_rows(raw, offsets, 6)
    assert parts[0] == 0 and parts[-1] == len(raw) and len(text) == len(parts) - 1
    for i, t in enumerate(texts):
        mine = [raw[parts[j] : parts[j + 1]].tobytes() for j in np.flatnonzero(text == i)]
        assert b"".join(mine) == t
        assert all(len(m) <= 6 for m in mine) or b"." not in t


def test_spans_equal_direct_hashes():
    p = co.Polynomial(7)
    values = np.random.default_rng(1).integers(0, 1 << 64, 50, np.uint64)
    got = p.spans(values, np.arange(45), np.arange(45) + 5)
    want = [sum(int(v) * pow(p.base, j, 1 << 64) for j, v in enumerate(values[i : i + 5])) % (1 << 64) for i in range(45)]
    assert got.tolist() == want


def test_wrong_pointer_is_an_error():
    at = [[{"n": 2, "fp": 1, "checked": 2, "f": 9}]]
    kind = pa.list_(pa.struct([("n", pa.int32()), ("fp", pa.int64()), ("checked", pa.int32()), ("f", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(["two words"]), pa.array(at, kind)], ["lang", "text", "at"])
    with pytest.raises(ValueError, match="differ"):
        list(co.Miner(2, 4, 14).materialised(iter([batch])))


def test_pointed_texts_keeps_all_that_are_pointed_to(spark, monkeypatch):
    monkeypatch.setattr(co, "ROW_BITS", 16)
    texts = spark.range(0, 3 << 33, 1 << 20).withColumnRenamed("id", "row_no")
    frequent = texts.where("row_no % 3 = 0")
    kept = {r.row_no for r in co.pointed_texts(texts, frequent).collect()}
    pointed = {r.row_no for r in frequent.collect()}
    assert pointed <= kept and len(kept) < texts.count() * 0.6


def test_empty_table(no_docs):
    assert co.collocations(no_docs).count() == 0


def test_query_equals_sql(spark):
    name = "op12_collocations"
    found = harness.compare(spark, name, QUERIES[name], ORACLE[name], SF, harness.duck(SF))
    assert found["columns_match"] and found["hash_match"], found
