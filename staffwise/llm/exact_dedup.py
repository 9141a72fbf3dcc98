"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

Two texts are equal when they are identical after white space is deleted. One
pass reduces every row to (id, length, digest) and stores that small table.

1. A Misra-Gries summary (Spark's frequent-items sketch, ``approx_top_k_*``)
   over the digests names the candidates; summaries are merged in two levels.
   Its size is fixed by ``tracked``.
2. Candidates are counted exactly, and those with a share of at least
   ``heavy_share`` of the rows become winners: at most ``tracked`` rows with
   group size and kept row, so broadcasting them is bounded.
3. Rows of winners are settled on the map side by that broadcast; the others
   go through one ordinary shuffle on the digest, where no group can hold more
   than about ``heavy_share`` of the rows.

Defined results: null text counts as empty; equal lengths keep the smallest
id, a null id comes last; a row repeated with the same id is a copy like any
other, of which one row is kept. Extra columns are ignored. Empty in, empty out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffwise.llm.shared import stored

WHITE_SPACE = " \t\n\x0b\x0c\r"
TRACKED = 4096
HEAVY_SHARE = 4 / TRACKED


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def digest_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One small row per document: id, code points of the original text, digest, row number."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("n_chars"),
        F.sha2(normalised(text), 256).alias("digest"),
        F.monotonically_increasing_id().alias("row_no"),
    )


def frequent_digests(rows: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """Misra-Gries candidates: every digest above an error bound of about 3.5 / tracked of the rows."""
    part = F.pmod(F.shiftright("row_no", 33), F.lit(64))  # the writing task's number
    summaries = rows.groupBy(part.alias("part")).agg(F.expr(f"approx_top_k_accumulate(digest, {tracked})").alias("summary"))
    # grouped by a constant: a global aggregate would also merge the typeless summaries of empty partitions
    merged = summaries.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(summary, {tracked})").alias("summary"))
    top = merged.select(F.explode(F.expr(f"approx_top_k_estimate(summary, {tracked // 2})")).alias("top"))
    return top.select(F.col("top.item").alias("digest")).where("digest is not null")


def winners_of(rows: DataFrame, candidates: DataFrame, least: int) -> DataFrame:
    """Exact size and kept row of each candidate that has at least ``least`` rows."""
    best = F.min(F.struct((-F.col("n_chars")).alias("neg_chars"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no")).alias("best")
    return (
        rows.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), best)
        .where(F.col("group_size") >= least)
        .select("digest", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row_no").alias("keep_row"))
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED, heavy_share: float = HEAVY_SHARE
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stored(digest_table(docs, id_col, text_col), "exact-digests")
    least = max(2, int(rows.count() * heavy_share))
    winners = stored(winners_of(rows, frequent_digests(rows, tracked), least), "exact-winners")

    heavy = rows.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    order = group.orderBy(F.desc("n_chars"), F.asc_nulls_last("doc_id"), "row_no")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "*",
        F.count("*").over(group).alias("group_size"),
        F.first("doc_id").over(order).alias("keep_id"),
        F.first("row_no").over(order).alias("keep_row"),
    )
    return heavy.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), F.col("digest").alias("text_sha256")
    )
