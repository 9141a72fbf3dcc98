"""Exact dedup, LPT sharding and Pareto mixing against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from llm_cases import ROWS, SF, edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from staffwise.llm import exact_dedup, mixing, sharding
from staffwise.llm.queries import QUERIES

WHITE = re.compile(r"[\x20\x09-\x0D]")


def expected_dedup(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[hashlib.sha256(WHITE.sub("", text or "").encode()).hexdigest()].append((doc_id, text or ""))
    out = []
    for digest, group in groups.items():
        keep = min(group, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0]
        out += [(doc_id, keep, len(group), digest) for doc_id, _ in group]
    return Counter(out)


@pytest.mark.parametrize("share", [exact_dedup.HEAVY_SHARE, 0.5, 1e-9])
def test_exact_dedup_edges(edge_docs, share):
    rows = exact_dedup.exact_dedup(edge_docs, heavy_share=share).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == expected_dedup(ROWS)
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert set(kept.values()) == {1}  # a repeated row keeps one
    assert len(kept) == len({r.text_sha256 for r in rows})


def test_exact_dedup_heavy_group_is_broadcast(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot  text").otherwise(F.col("id").cast("string")).alias("text"))
    rows = exact_dedup.digest_table(docs, "doc_id", "text")
    hot = exact_dedup.winners_of(rows, exact_dedup.frequent_digests(rows), 50).collect()
    assert [(r.group_size, r.keep_id) for r in hot] == [(1667, 0)]
    found = exact_dedup.exact_dedup(docs)
    assert found.where("kept").count() == 5000 - 1666


@pytest.mark.parametrize("share", [1e-9, 0.9])
def test_exact_dedup_takes_the_least_id(spark, share):
    docs = spark.createDataFrame([(-(1 << 63), "same"), ((1 << 63) - 1, "same"), (None, "same")], "doc_id long, text string")
    found = exact_dedup.exact_dedup(docs, heavy_share=share).collect()
    assert {(r.keep_id, r.group_size) for r in found} == {(-(1 << 63), 3)} and [r.doc_id for r in found if r.kept] == [-(1 << 63)]


def test_exact_dedup_empty(no_docs):
    assert exact_dedup.exact_dedup(no_docs).count() == 0


def test_schedule_is_longest_first():
    placed = dict(sharding.schedule([("a", 7), ("b", 5), ("c", 4), ("d", 3), ("e", 3)], 2))
    load = Counter()
    for key, size in [("a", 7), ("b", 5), ("c", 4), ("d", 3), ("e", 3)]:
        load[placed[key]] += size
    assert sorted(load.values()) == [10, 12]


@pytest.mark.parametrize("fine, bundles", [(64, 256), (1, 1), (2, 3)])
def test_shards_keep_groups_and_number_rows(edge_docs, fine, bundles):
    rows = sharding.shard_lpt(edge_docs, 4, fine=fine, bundles=bundles).collect()
    want = Counter((doc_id, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for doc_id, t, *_ in ROWS)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    by_group, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        by_group[r.group].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in by_group.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_is_even_and_exact_lpt_on_small_table(spark):
    rows = QUERIES["op9_lpt_sharding"](spark, SF).collect()
    groups, load = Counter(), Counter()
    shard_of = {}
    text = {d.doc_id: d.text for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in rows:
        groups[text[r.doc_id]] += r["size"]
        load[r.shard] += r["size"]
        assert shard_of.setdefault(text[r.doc_id], r.shard) == r.shard
    bound = max(max(groups.values()), sum(load.values()) / 40 * 4 / 3)
    assert set(load) == set(range(40)) and max(load.values()) <= bound
    assert {r.law for r in rows} == {"bytes"} and all(r.grown_shard is None for r in rows)


def test_sharding_empty(no_docs):
    assert sharding.shard_lpt(no_docs, 4).count() == 0


def test_targets_stop_and_share_again():
    assert mixing.targets([10, 10, 10], [5, 2, 1], 3) == pytest.approx([18.75, 7.5, 3.75])
    assert mixing.targets([1, 100, 0], [5, 2, 1], 3) == pytest.approx([3, 98, 0])
    assert mixing.targets([], [], 3) == []


def test_mix_on_small_table(spark):
    found = QUERIES["op1_pareto_mix"](spark, SF)
    rows = {r.doc_id: r for r in found.collect()}
    again = {r.doc_id: r for r in found.collect()}
    assert rows == again and rows == {r.doc_id: r for r in QUERIES["op1_pareto_mix"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    size = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs}
    of = defaultdict(list)
    for d in docs:
        of[d.source].append(d.doc_id)
    names = sorted(of, key=lambda s: (s is None, s))
    want = mixing.targets([sum(size[i] for i in of[s]) for s in names], [mixing.WEIGHTS[k % 3] for k in range(len(names))])
    for s, t in zip(names, want):
        taken = sum(rows[i].taken for i in of[s])
        longest = max(size[i] for i in of[s])
        assert abs(taken - t) <= longest
        for i in of[s]:
            r = rows[i]
            assert r["size"] == size[i] and r.target == pytest.approx(t) and r.taken == r.copies * r["size"] <= 3 * r["size"]
            assert r.copies >= int(t / sum(size[j] for j in of[s]) + 1e-9)  # the certain copies


def test_mix_takes_the_smallest_ranks(spark):
    """One source at half its words: what is taken is the head of the Pareto ranking, but for the last one."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.when(F.col("id") < 300, "a").otherwise("b").alias("source"))
    rows = mixing.pareto_mix(docs, weights=(1, 3), buckets=16).collect()
    taken = {r.doc_id for r in rows if r.doc_id < 300 and r.copies == 1}
    u = {r.id: r.u for r in spark.range(300).select("id", mixing.uniform(F.col("id"), mixing.SEED).alias("u")).collect()}
    assert taken == set(sorted(u, key=u.get)[: len(taken)]) and len(taken) * 2 == pytest.approx(rows[0].target, abs=2)


def test_mix_goes_on_behind_a_document_that_does_not_fit(spark):
    """One text of 40 % of a source's words beside short ones, at a target of 0.4 times the source."""
    short = [(i, "a b c d e f", "a") for i in range(1000)]
    docs = spark.createDataFrame([*short, (5000, "w " * 4000, "a"), (6000, "x " * 10000, "b")], "doc_id long, text string, source string").repartition(2)
    for seed in range(4):
        rows = [r for r in mixing.pareto_mix(docs, weights=(1, 4), seed=seed, buckets=16).collect() if r.doc_id < 6000]
        assert rows[0].target == 4000 and abs(sum(r.taken for r in rows) - 4000) <= 3


def test_unequal_probabilities_favour_weight(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"), (F.col("id") % 2 * 2 + 1).alias("worth")
    )
    rows = mixing.pareto_mix(docs, weights=(1, 2), weight_col="worth").where("doc_id < 2000").collect()
    heavy, light = (sum(r.copies for r in rows if r.doc_id % 2 == k) for k in (1, 0))
    assert heavy > 2 * light > 0
    assert sum(r.taken for r in rows) == pytest.approx(rows[0].target, abs=3)


def test_mix_edges(edge_docs, no_docs):
    rows = mixing.pareto_mix(edge_docs).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert mixing.mixed(edge_docs).columns == edge_docs.columns
    assert mixing.mixed(edge_docs).count() == sum(r.copies for r in rows)
    assert mixing.pareto_mix(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0
