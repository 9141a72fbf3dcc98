"""Source divergence against plain Python integers."""

import random
import re
from collections import Counter, defaultdict

import pytest
from llm_cases import ROWS, SF, edge_docs, no_docs  # noqa: F401

import harness
from staffwise.llm import source_divergence as sd
from staffwise.llm.queries import ORACLE, QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def expected(rows, min_df, top):
    docs = [(lang or "", source or "", Counter(terms_of(text))) for _, text, lang, source in rows]
    df, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, vector in docs:
        groups[lang].add(source)
        for t, n in vector.items():
            df[lang, t] += 1
            counts[lang, source][t] += n
            counts[lang, None][t] += n
    out = set()
    for lang, sources in groups.items():
        kept = [t for (of, t), n in df.items() if of == lang and n >= min_df]

        def shares(source):
            total = sum(counts[lang, source][t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[lang, source][t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(s) for s in [*sources, None]}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - p[None][t], t) for t in kept if counts[lang, s][t] > 0 and p[s][t] > p[None][t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ordered)}
    return out


def rows_of(df):
    rows = [(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("min_df, block_rows", [(1, 10), (2, 1000), (50, 7)])
def test_edges_against_brute_force(edge_docs, min_df, block_rows):
    found = rows_of(sd.source_divergence(edge_docs, min_df, 3, block_rows=block_rows))
    assert found == expected(ROWS, min_df, 3) and found


def test_hot_source_and_many_sources(spark, monkeypatch):
    monkeypatch.setattr(sd, "SLICE_CELLS", 100)  # a few terms at a time
    random.seed(3)
    words = ["Alpha", "beta", "ГАММА", "δέλτα", "épsilon", "zeta", "eta", "Theta", "ﬀ", "𝒳"]
    rows = []
    for i in range(600):
        source = "hot" if i % 3 else f"s{i % 40}"
        rows.append((i, " ".join(random.choices(words, k=i % 17)) + ".", random.choice(["en", "xx", None]), source))
    rows += [(i, None, "silent", f"s{i % 3}") for i in range(9)] + [(i, "", "silent", None) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    assert rows_of(sd.source_divergence(docs, 30, 4, block_rows=20)) == expected(rows, 30, 4)


def test_vectors_are_exact(edge_docs):
    found = Counter((r.lang, r.source, tuple(sorted(zip(r.terms, r.counts)))) for r in sd.count_vectors(edge_docs).collect())
    assert found == Counter((lang or "", source or "", tuple(sorted(Counter(terms_of(text)).items()))) for _, text, lang, source in ROWS)


def test_shares_of_huge_counts_are_exact(spark):
    from pyspark.sql import functions as F

    n, total, size = 10**17 + 7, 3 * 10**17 + 1, 10**12
    got = spark.range(1).select(sd.share(F.lit(n), F.lit(total), F.lit(size)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * size)


def test_empty_table(no_docs):
    assert sd.source_divergence(no_docs).count() == 0


def test_query_equals_sql(spark):
    name = "op11_source_divergence"
    found = harness.compare(spark, name, QUERIES[name], ORACLE[name], SF, harness.duck(SF))
    assert found["columns_match"] and found["hash_match"], found
