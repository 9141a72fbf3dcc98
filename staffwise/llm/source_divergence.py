"""Source divergence audit: how far each source's word use is from the others of its language.

1. Count vectors. Each document becomes an exact sparse vector: its distinct
   terms and their counts, built in numpy a block of texts at a time.
2. Group sums. The vectors are added up per (language, source), partially in
   every task; each sum keeps the number of documents that hold the term.
3. Vocabulary. As ``CountVectorizer`` with ``minDF`` and the largest integer as
   ``vocabSize`` would, each language keeps the terms in at least ``min_df`` of
   its documents. Spark ML's own estimator brings its vocabulary to the driver
   and broadcasts it, which without a ``vocabSize`` has no bound; here the
   vocabulary is a table, and restricting the sums to it by a join equals the
   sum of the restricted vectors.
4. Smoothed shares are integers: p = 1 + floor(10^9 * (count + 5) / (N + 5 * V)),
   computed as decimals.
5. Pairs. The terms of a language are dealt by hash into blocks; a block lays
   its sparse sums over each source's share of an absent term and adds up the
   absolute differences of all pairs of sources, a slice of terms at a time.
   Only one number per pair and block is shuffled.

A hot source or language is pre-aggregated per task; blocks are sized by
stored rows, and a term has one row per source in its block.

Defined results: null text, lang and source count as empty; a group without
terms is a group with all counts 0; repeated rows and repeated ids are
documents of their own (ids are not read); a language without kept terms has
pairs of value 0 and no terms. Extra columns are ignored. Empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffwise.llm.shared import BLOCK_BYTES, stored
from staffwise.llm.words import Words, byte_class, text_blocks

MIN_DF = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
LETTERS = byte_class(bytes(range(65, 91)) + bytes(range(97, 123)))
#: Stored rows per block of the pair evaluation, and cells that it works on at a time.
BLOCK_ROWS = 250_000
SLICE_CELLS = 1 << 22
VECTORS = "lang string, source string, terms array<string>, counts array<int>"


def count_vectors(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: lang, source, its distinct terms and how often each occurs."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, raw, offsets in text_blocks(batch, "text", BLOCK_BYTES):
                words = Words(raw, offsets, LETTERS)
                size = max(1, len(words.dictionary))
                entry, count = np.unique(words.row * size + words.code, return_counts=True)
                ends = np.searchsorted(entry, np.arange(end - start + 1) * size).astype(np.int32)
                terms = words.dictionary.cast(pa.large_string()).cast(pa.string()).take(pa.array(entry % size))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("lang").slice(start, end - start), batch.column("source").slice(start, end - start),
                        pa.ListArray.from_arrays(pa.array(ends), terms), pa.ListArray.from_arrays(pa.array(ends), pa.array(count, pa.int32())),
                    ],
                    ["lang", "source", "terms", "counts"],
                )

    named = [F.coalesce(F.col(c), F.lit("")).alias(name) for name, c in (("lang", lang_col), ("source", source_col), ("text", text_col))]
    return docs.select(*named).mapInArrow(vectors, VECTORS)


def group_sums(vectors: DataFrame) -> DataFrame:
    """(lang, source, term): occurrences, and documents that hold it."""
    entries = vectors.select("lang", "source", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("n"))))
    return entries.groupBy("lang", "source", "term").agg(F.sum("n").alias("count"), F.count("*").alias("n_docs"))


def vocabulary(sums: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """(lang, term, lang_count) of the terms in at least ``min_df`` documents of their language."""
    terms = sums.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("count").alias("lang_count"))
    return terms.where(F.col("n_docs") >= min_df).drop("n_docs")


def share(count: Column, total: Column, size: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * size)), exact."""
    above = (count + SMOOTHING).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = total.cast("decimal(28,0)") + size.cast("decimal(20,0)") * F.lit(SMOOTHING).cast("decimal(2,0)")
    return F.call_function("div", above, below) + 1


def group_shares(docs_groups: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per language (lang, size, lang_total) and per occurring group (lang, source, size, total, absent: the share
    of a term that the group lacks)."""
    langs = kept.select("lang", "term", "lang_count").distinct().groupBy("lang").agg(
        F.count("*").alias("size"), F.sum("lang_count").alias("lang_total")
    )
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = (
        docs_groups.join(langs.select("lang", "size"), "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .na.fill(0, ["size", "total"])
    )
    absent = F.when(F.col("size") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("size")))
    return langs, groups.withColumn("absent", absent)


def pair_distances(shares: DataFrame, groups: DataFrame, blocks: int) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of different sources of a language."""

    def distances(key, left: pa.Table, right: pa.Table) -> pa.Table:
        names = right.column("source").to_pylist()
        order = sorted(range(len(names)), key=lambda i: names[i])
        names = [names[i] for i in order]
        absent = np.asarray(right.column("absent").combine_chunks().fill_null(0)).astype(np.int64)[order]
        place = {name: i for i, name in enumerate(names)}
        total = np.zeros((len(names), len(names)), np.int64)
        if left.num_rows:
            source = left.column("source").combine_chunks().dictionary_encode()
            at = np.array([place[name] for name in source.dictionary.to_pylist()])[np.asarray(source.indices)]
            term = np.asarray(left.column("term").combine_chunks().dictionary_encode().indices)
            by_term = np.argsort(term, kind="stable")
            at, term, p = at[by_term], term[by_term], np.asarray(left.column("p").combine_chunks()).astype(np.int64)[by_term]
            width = max(1, SLICE_CELLS // len(names))
            for low in range(0, int(term[-1]) + 1, width):
                here = slice(*np.searchsorted(term, (low, low + width)))
                cells = np.repeat(absent[:, None], min(width, int(term[-1]) + 1 - low), axis=1)
                cells[at[here], term[here] - low] = p[here]
                for i in range(len(names) - 1):
                    total[i, i + 1 :] += np.abs(cells[i + 1 :] - cells[i]).sum(axis=1)
        one, two = np.triu_indices(len(names), 1)
        names = pa.array(names, pa.string())
        return pa.table({"lang": pa.array([key[0].as_py()] * len(one), pa.string()), "one": names.take(pa.array(one)), "two": names.take(pa.array(two)), "part": total[one, two]})

    everywhere = groups.select("lang", "source", "absent", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    dealt = shares.select("lang", "source", "term", "p", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"))
    parts = dealt.groupBy("lang", "block").cogroup(everywhere.groupBy("lang", "block")).applyInArrow(
        distances, "lang string, one string, two string, part long"
    )
    sums = parts.groupBy("lang", "one", "two").agg(F.sum("part").cast("long").alias("value"))
    ways = F.array(*[F.struct(F.col(a).alias("source"), F.col(b).alias("item")) for a, b in (("one", "two"), ("two", "one"))])
    return sums.select("lang", F.inline(ways), "value")


def source_divergence(
    docs: DataFrame, min_df: int = MIN_DF, top_terms: int = TOP_TERMS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """lang, source, part (``pair``: the other sources by distance; ``term``: the source's most typical terms),
    item, value, rank."""
    sums = stored(group_sums(count_vectors(docs, text_col, lang_col, source_col)), "divergence-sums")
    kept = stored(sums.drop("n_docs").join(vocabulary(sums, min_df), ["lang", "term"]), "divergence-kept")
    named = [F.coalesce(F.col(c), F.lit("")).alias(name) for name, c in (("lang", lang_col), ("source", source_col))]
    langs, groups = group_shares(docs.select(*named).distinct(), kept)
    groups = stored(groups, "divergence-groups")
    shares = (
        kept.join(groups.select("lang", "source", "size", "total"), ["lang", "source"])
        .join(langs.select("lang", "lang_total"), "lang")
        .withColumn("p", share(F.col("count"), F.col("total"), F.col("size")))
        .withColumn("q", share(F.col("lang_count"), F.col("lang_total"), F.col("size")))
    )
    blocks = 1 + kept.count() // block_rows
    pairs = pair_distances(shares, groups, blocks)
    terms = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda part, rows: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    return ranked("pair", pairs).unionByName(ranked("term", terms).where(F.col("rank") <= top_terms))
