"""Profiling of a raw table: overview, dictionary, missing values, summary
statistics, quality checks and a sample (six report DataFrames).

Plan shape (for a table with C columns and N rows)
-------------------------------------------------
* One value histogram: the table is unpivoted to (column, value) -- an
  Expand of N x C cells -- and counted per (column, value) with partial
  aggregation in every task. Counts, missing values, type flags, distinct
  values, the most frequent value, min/max and the (two-pass, stable) mean
  and standard deviation all derive from the histogram, so per-value work
  runs once per distinct value. A value holding a third of all cells is
  one counter; no group is ever collected.
* What the histogram is joined with (means, largest counts, quantile
  windows) has one row per column or target and is broadcast; the histogram
  itself is never shuffled by its few column names.
* Exact quartiles (pandas' linear interpolation) from the same histogram, by
  one algorithm at every size: ``CUT_ROUNDS`` times a target's window is cut
  at ``CUTS`` approximate ranks of its distinct values, the pieces are
  counted exactly, and the window narrows to the piece with the target rank;
  then the values left inside are ranked. ``method="approx"`` uses a bounded
  ``percentile_approx`` sketch instead.
* Duplicate rows: group by all columns with partial aggregation.

All functions are lazy. Those that need the histogram or the duplicate count
take them as arguments, so a report computes each once (``report_inputs``).

Types follow pandas' CSV inference: NA words are NULL; a column whose every
non-null value is a number is numeric ('int64' when all values are integers
and none is missing, else 'float64'; a column without values is 'float64'), a
column of True / False words without a missing value is 'bool', any other is
'object'.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staffwise.functions import missing_severity

# The words pandas' CSV reader treats as missing by default.
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# Quartiles of the summary statistics.
QUARTILES = [0.25, 0.5, 0.75]
INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
# What pandas' CSV reader takes for a number, and its words for truth values.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?inf(inity)?\s*$"
TRUE_WORDS = ["True", "TRUE", "true"]
FALSE_WORDS = ["False", "FALSE", "false"]
DEFAULT_ACCURACY = 10_000
# A quantile window is cut into so many pieces, so many times: what is ranked
# at the end is about 1 / CUTS ** CUT_ROUNDS of a column's distinct values.
CUTS = 256
CUT_ROUNDS = 2


def null_if_na(text: Column) -> Column:
    """The text, or NULL for one of pandas' NA words."""
    return F.when(~text.isin(NA_WORDS), text)


def null_na_words(df: DataFrame) -> DataFrame:
    """Every column as string with pandas' NA words turned into NULL."""
    return df.select(*[null_if_na(F.col(c).cast("string")).alias(c) for c in df.columns])


def _long(df: DataFrame) -> DataFrame:
    """Unpivot to (position, column_name, s), NA words as NULL. The words are
    looked up after the unpivot: one expression, however many columns."""
    cells = F.posexplode(F.array(*[F.col(c).cast("string") for c in df.columns])).alias("position", "s")
    names = F.array(*[F.lit(c) for c in df.columns])
    return df.select(cells).select("position", F.get(names, "position").alias("column_name"), null_if_na(F.col("s")).alias("s"))


def value_histogram(raw: DataFrame) -> DataFrame:
    """(position, column_name, s, cnt): count of every distinct text value
    per column, NULL (missing) included as its own value.

    The only pass over the data: the unpivot is followed by a hash
    aggregation with partial aggregation in every task, so the shuffle
    carries at most one row per (column, value) per task, and a value that
    holds a third of all cells is just one counter.
    """
    return _long(raw).groupBy("position", "column_name", "s").agg(
        F.count(F.lit(1)).alias("cnt")
    )


def parsed_number(text: Column) -> Column:
    """The value of a text that pandas reads as a number, else NULL (the
    double parser alone would also take '1d' and '2f', and '1e400' as infinite)."""
    finite = text.try_cast("double")
    infinite = F.when(F.trim(text).startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(text.rlike(NUMBER_PATTERN) & (F.abs(finite) < float("inf")), finite).when(text.rlike(INFINITY_PATTERN), infinite)


def _typed_hist(hist: DataFrame) -> DataFrame:
    return hist.withColumn("v", parsed_number(F.col("s")))


def column_stats(raw: DataFrame, hist: Optional[DataFrame] = None) -> DataFrame:
    """One row per column: position, name, pandas-like type, counts,
    distinct values, most frequent value and the numeric moments.

    Sums and extremes are one hash aggregate over the histogram; distinct
    numbers and the most frequent text are aggregates of their own. Mean and
    sample standard deviation use the two-pass formula (stable).
    """
    h = _typed_hist(hist if hist is not None else value_histogram(raw))
    present, cnt, zero = F.col("s").isNotNull(), F.col("cnt"), F.lit(0).cast("long")

    def cells(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, cnt)), zero)

    stats = h.groupBy("position", "column_name").agg(
        F.sum(cnt).alias("rows"),
        cells(present).alias("count"),
        cells(~present).alias("missing_count"),
        cells(present & F.col("v").isNull()).alias("bad"),
        cells(present & ~F.col("s").rlike(INT_PATTERN)).alias("nonint"),
        cells(F.col("s").isin(TRUE_WORDS)).alias("n_true"),
        cells(F.col("s").isin(FALSE_WORDS)).alias("n_false"),
        F.count("s").alias("unique_text"),
        F.max(F.when(present, cnt)).alias("most"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        (F.sum(F.col("v") * cnt) / F.sum(F.when(F.col("v").isNotNull(), cnt))).alias("mean"),
        cells(F.col("v").isNotNull()).alias("vn"),
    )
    numbers = h.where("v is not null").groupBy("column_name", "v").agg(F.sum("cnt").alias("cnt"))
    spread = (
        numbers.join(F.broadcast(stats.select("column_name", "mean")), "column_name")
        .groupBy("column_name")
        .agg(F.sum(cnt * (F.col("v") - F.col("mean")) ** 2).alias("ss"), F.count(F.lit(1)).alias("unique_number"))
    )
    tops = (
        h.where(present)
        .join(F.broadcast(stats.select("column_name", "most")), "column_name")
        .where(F.col("cnt") == F.col("most"))
        .groupBy("column_name")
        .agg(F.min("s").alias("top_text"))
    )
    out = stats.join(F.broadcast(spread), "column_name", "left").join(F.broadcast(tops), "column_name", "left")
    std = F.when(F.col("vn") > 1, F.sqrt(F.col("ss") / (F.col("vn") - 1)))
    truth = (F.col("n_true") + F.col("n_false") == F.col("count")) & (F.col("missing_count") == 0) & (F.col("count") > 0)
    dtype = (
        F.when(truth, F.lit("bool"))
        .when((F.col("bad") == 0) & (F.col("missing_count") == 0) & (F.col("nonint") == 0) & (F.col("count") > 0), F.lit("int64"))
        .when(F.col("bad") == 0, F.lit("float64"))
        .otherwise(F.lit("object"))
    )
    both = F.when((F.col("n_true") > 0) & (F.col("n_false") > 0), F.lit(2)).otherwise(F.lit(1)).cast("long")
    more_true = F.col("n_true") > F.col("n_false")
    return out.select(
        "position", "column_name", "rows", "count", "missing_count",
        dtype.alias("data_type"),
        F.when(truth, both).otherwise(F.col("unique_text")).alias("unique_text"),
        F.coalesce("unique_number", zero).alias("unique_number"),
        F.when(truth, F.when(more_true, F.lit("True")).otherwise(F.lit("False"))).otherwise(F.col("top_text")).alias("top"),
        F.when(truth, F.greatest("n_true", "n_false")).otherwise(F.col("most")).alias("freq"),
        "mean", std.alias("std"), "min", "max",
    )


def is_categorical(data_type: Column) -> Column:
    return data_type.isin("object", "bool")


def approx_quantiles(values: DataFrame, probs: Sequence[float] = QUARTILES,
                     accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Sketch quantiles (one pass, bounded memory per group). ``values``:
    (column_name, v). Result: (column_name, q, value)."""
    probs = [float(p) for p in probs]
    q = values.groupBy("column_name").agg(F.percentile_approx("v", probs, accuracy).alias("arr"))
    rows = [F.struct(F.lit(p).alias("q"), F.element_at("arr", i + 1).alias("value")) for i, p in enumerate(probs)]
    return q.select("column_name", F.inline(F.array(*rows)))


def exact_quantiles(values: DataFrame, probs: Sequence[float] = QUARTILES, cuts: int = CUTS, rounds: int = CUT_ROUNDS) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas/numpy 'linear').

    ``values`` has (column_name, v) and optionally ``cnt`` (a histogram: each
    row stands for cnt equal values); v must be non-null. Result:
    (column_name, q, value).

    Each target rank q * (n - 1) starts with all values of its column as its
    window. A round cuts the window at ``cuts`` - 1 approximate ranks of its
    distinct values, sums the counts of the pieces exactly and keeps the
    piece (or the neighbouring pieces) with the rank; whatever the sketch
    chose as cuts, the sums make the result exact. What is left is ranked by
    a window function. Infinities order like any value.
    """
    hist = values if "cnt" in values.columns else values.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("cnt"))
    hist = hist.select("column_name", "v", F.col("cnt").cast("long").alias("cnt"))
    target = ["column_name", "q", "pos", "r_lo", "r_hi"]
    pos = F.col("q") * (F.col("n") - 1)
    windows = (
        hist.groupBy("column_name")
        .agg(F.sum("cnt").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .withColumn("q", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .select("column_name", "q", pos.alias("pos"), F.floor(pos).alias("r_lo"), F.ceil(pos).alias("r_hi"), "lo", "hi", F.lit(0).cast("long").alias("below"))
    )

    def inside(w: DataFrame) -> DataFrame:
        return hist.join(F.broadcast(w), "column_name").where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))

    ranks = [(i + 1) / cuts for i in range(cuts - 1)]
    for _ in range(rounds):
        held = inside(windows)
        at = held.groupBy("column_name", "q").agg(F.percentile_approx("v", ranks, 4 * cuts).alias("cut"))
        piece = F.size(F.filter("cut", lambda c: c < F.col("v")))
        pieces = (
            held.join(F.broadcast(at), ["column_name", "q"])
            .groupBy(*target, "below", piece.alias("piece"))
            .agg(F.sum("cnt").alias("cnt"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        )
        upto = Window.partitionBy("column_name", "q").orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        start = F.col("below") + F.sum("cnt").over(upto) - F.col("cnt")
        hit = (F.col("start") <= F.col("r_hi")) & (F.col("start") + F.col("cnt") > F.col("r_lo"))
        windows = (
            pieces.withColumn("start", start).where(hit)
            .groupBy(*target).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("start").alias("below"))
        )
    upto = Window.partitionBy("column_name", "q").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.col("below") + F.sum("cnt").over(upto) - 1
    ranked = inside(windows).withColumn("last", last).withColumn("first", F.col("last") - F.col("cnt") + 1)

    def at_rank(r: str) -> Column:
        return F.max(F.when((F.col("first") <= F.col(r)) & (F.col(r) <= F.col("last")), F.col("v")))

    picked = ranked.groupBy(*target).agg(at_rank("r_lo").alias("v_lo"), at_rank("r_hi").alias("v_hi"))
    part = F.col("pos") - F.col("r_lo")
    value = F.when(part == 0, F.col("v_lo")).otherwise(F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * part)
    return picked.select("column_name", "q", value.alias("value"))


def _quartile_columns(q: DataFrame) -> DataFrame:
    return q.groupBy("column_name").agg(
        *[F.max(F.when(F.col("q") == p, F.col("value"))).alias(name)
          for p, name in zip(QUARTILES, ["p25", "p50", "p75"])]
    )


def numeric_quartiles(raw: DataFrame, method: str = "exact", hist: Optional[DataFrame] = None,
                      accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """(column_name, p25, p50, p75) over the numeric values of every column;
    exact from the value histogram, or sketched (``method="approx"``)."""
    if method == "approx":
        long = _long(raw).select("column_name", parsed_number(F.col("s")).alias("v")).where("v is not null")
        return _quartile_columns(approx_quantiles(long, QUARTILES, accuracy))
    h = _typed_hist(hist if hist is not None else value_histogram(raw))
    num = h.where(F.col("v").isNotNull()).groupBy("column_name", "v").agg(F.sum("cnt").alias("cnt"))
    return _quartile_columns(exact_quantiles(num, QUARTILES))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows minus distinct rows (NULL equals NULL)."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))
    )


def _missing_pct() -> F.Column:
    """missing / rows * 100 rounded half-up to 2 decimals."""
    from staffwise.functions import round_half_up

    return round_half_up(
        F.when(F.col("rows") > 0, F.col("missing_count") / F.col("rows") * 100.0), 2
    )


def report_inputs(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Value histogram and duplicate count of a table, for the functions below."""
    return value_histogram(raw), duplicate_rows(null_na_words(raw))


def profile_dictionary(raw: DataFrame, hist: Optional[DataFrame] = None) -> DataFrame:
    """Column name, type, missing count and %, distinct values."""
    cs = column_stats(raw, hist)
    unique = F.when(is_categorical(F.col("data_type")), F.col("unique_text")).otherwise(
        F.col("unique_number")
    )
    return cs.select(
        "position",
        "column_name",
        "data_type",
        "missing_count",
        _missing_pct().alias("missing_pct"),
        F.coalesce(unique, F.lit(0)).cast("long").alias("unique_values"),
    )


def profile_missing(raw: DataFrame, hist: Optional[DataFrame] = None) -> DataFrame:
    """Missing values per column with severity, most missing first (ties in
    column order)."""
    cs = column_stats(raw, hist)
    return (
        cs.select("position", "column_name", "missing_count", _missing_pct().alias("missing_pct"))
        .withColumn("severity", missing_severity("missing_pct"))
        .orderBy(F.col("missing_pct").desc(), F.col("position").asc())
    )


def profile_statistics(raw: DataFrame, method: str = "exact", accuracy: int = DEFAULT_ACCURACY, hist: Optional[DataFrame] = None) -> DataFrame:
    """describe(include='all'): count, unique/top/freq for text and truth-value
    columns, mean/std/min/quartiles/max for numeric columns."""
    hist = hist if hist is not None else value_histogram(raw)
    j = column_stats(raw, hist).join(F.broadcast(numeric_quartiles(raw, method, hist, accuracy)), "column_name", "left")
    text = is_categorical(F.col("data_type"))
    return j.select(
        "position", "column_name", "data_type",
        F.col("count").cast("long").alias("count"),
        F.when(text, F.col("unique_text")).cast("long").alias("unique"),
        F.when(text, F.col("top")).alias("top"),
        F.when(text, F.col("freq")).cast("long").alias("freq"),
        *[F.when(~text, F.col(c)).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")],
    )


def profile_overview(raw: DataFrame, dataset_name: str, size_bytes: Optional[DataFrame] = None,
                     hist: Optional[DataFrame] = None, duplicates: Optional[DataFrame] = None) -> DataFrame:
    """(metric, value) rows: name, rows, columns, numeric and categorical
    columns, duplicate rows, missing cells, and input size in MB when a
    one-row ``size_bytes`` DataFrame (column ``bytes``) is given."""
    cs = column_stats(raw, hist)
    duplicates = duplicates if duplicates is not None else duplicate_rows(null_na_words(raw))
    summary = cs.agg(
        F.max("rows").cast("long").alias("rows"),
        F.count(F.lit(1)).alias("columns"),
        F.count_if(~is_categorical(F.col("data_type"))).alias("numeric"),
        F.count_if(is_categorical(F.col("data_type"))).alias("categorical"),
        F.sum("missing_count").cast("long").alias("missing"),
    ).crossJoin(duplicates)  # 1 x 1 rows
    metrics = [
        ("Dataset Name", F.lit(dataset_name)),
        ("Total Rows", F.col("rows").cast("string")),
        ("Total Columns", F.col("columns").cast("string")),
        ("Numeric Columns", F.col("numeric").cast("string")),
        ("Categorical Columns", F.col("categorical").cast("string")),
        ("Duplicate Rows", F.col("duplicate_rows").cast("string")),
        ("Total Missing Cells", F.col("missing").cast("string")),
    ]
    if size_bytes is not None:
        summary = summary.crossJoin(size_bytes)  # 1 x 1 rows
        metrics.append(
            ("Input Size (MB)", F.round(F.col("bytes") / (1024.0 * 1024.0), 2).cast("string"))
        )
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(m).alias("metric"), v.alias("value"))
        for i, (m, v) in enumerate(metrics)
    ]
    return summary.select(F.inline(F.array(*rows)))


def profile_quality(raw: DataFrame, hist: Optional[DataFrame] = None, duplicates: Optional[DataFrame] = None) -> DataFrame:
    """Duplicate-row check followed by one missing-value check per column."""
    cs = column_stats(raw, hist)
    duplicates = duplicates if duplicates is not None else duplicate_rows(null_na_words(raw))
    dup = duplicates.select(
        F.lit(-1).alias("position"),
        F.lit("Duplicate Rows").alias("check"),
        F.col("duplicate_rows").alias("result"),
    )
    miss = cs.select(
        "position",
        F.concat(F.lit("Missing Values - "), F.col("column_name")).alias("check"),
        F.col("missing_count").cast("long").alias("result"),
    )
    return dup.unionByName(miss)


def file_metadata(df: DataFrame) -> Optional[F.Column]:
    """Spark's hidden file metadata of a DataFrame over files, None for one
    that was not read from files. A user's column ``_metadata`` is not taken for it."""
    try:
        meta = df.metadataColumn("_metadata")
        df.select(meta.getField("file_path"))
    except AnalysisException:
        return None
    return meta


def file_position(df: DataFrame) -> F.Column:
    """Sort key of a row's place in its source: file by name, split by its
    start, row by its place in the split (ids only grow inside a task, and a
    split is read by one task). ``df`` must be a scan with row-wise steps on
    top. Without files, the order of the DataFrame's partitions."""
    place = F.monotonically_increasing_id().alias("place")
    meta = file_metadata(df)
    if meta is None:
        return F.struct(place)
    return F.struct(meta.getField("file_path").alias("file"), meta.getField("file_block_start").alias("start"), place)


def profile_sample(raw: DataFrame, n: int = 20, order_by: Optional[Sequence[str]] = None) -> DataFrame:
    """The first n rows as the files have them, or the first n by ``order_by``.

    Either way a per-task top-n: only n rows per task are shuffled. A plain
    ``limit`` would follow the packing of splits into tasks, largest first.
    """
    if order_by:
        return null_na_words(raw).orderBy(*[F.col(k).asc_nulls_first() for k in order_by]).limit(n)
    position = "position"
    while position in {c.lower() for c in raw.columns}:
        position += "_"
    cells = [null_if_na(F.col(f"`{c}`").cast("string")).alias(c) for c in raw.columns]
    return raw.select(*cells, file_position(raw).alias(position)).orderBy(position).limit(n).drop(position)


def input_size_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Bytes of the files at ``path`` (one row), from file metadata alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes"))


def input_size(df: DataFrame) -> DataFrame:
    """Bytes of the files that a DataFrame over files reads (one row, like
    ``input_size_bytes``), from the metadata of its own scan: no data column is
    read and a task sends one row per file. Files without any row are not seen."""
    meta = file_metadata(df)
    if meta is None:
        raise ValueError("input_size needs a DataFrame that was read from files")
    files = df.select(meta.getField("file_path").alias("file"), meta.getField("file_size").alias("size"))
    sizes = files.groupBy("file").agg(F.max("size").alias("size"))
    return sizes.agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("bytes"))
