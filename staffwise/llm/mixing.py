"""Mixing sources to target weights by Pareto order sampling.

Every source has a target number of words. A document of a source with target
t and size n is wanted m = t / n times. It gets floor(m) certain whole copies;
the rest p = m - floor(m) is its inclusion probability for one more copy.
Documents are ranked by Pareto's ranking variable, random odds over inclusion
odds, q = (u / (1 - u)) / (p / (1 - p)), where u is a hash of the id and the
seed. In that order each document is taken that fits into the source's
remaining words; one that is longer than what is left is passed over. The
sample size is fixed in words, so a source's take is near its target whatever
the lengths: when no other fits, the untaken document that best fills what is
left is taken when that brings the total nearer.

``weight_col`` gives unequal probabilities inside a source as well: p is then
scaled by the weight over the source's word-weighted mean weight, and whatever
reaches 1 becomes a certain copy.

No task orders a whole source: q / (1 + q) lies in (0, 1) and is cut into
``buckets`` equal ranges, the words of each range are summed per source, and
only the range that holds the first document that does not fit is ordered row
by row. The same is done again for the documents behind it that are not longer
than what is left, until there are none; what is left shrinks below the length
of the document passed over, so the rounds are few and ever smaller. The
outcome is a plan of one row per source (target, the stretches between stops
with the longest document each takes, best-fitting document). Whether a
document is taken follows from the plan and its own row, so texts are never
shuffled. One row per source and round is collected; the plan is broadcast up
to ``MAX_BROADCAST_SOURCES`` rows and joined otherwise.

Defined results: null text has size 0, as has empty text; a null source is a
source of its own, last in order; equal ranks go by id, a null id first; rows
of equal id, source and size are taken or left together. A document without
words is taken when it ranks before the first stop. A source without words
takes none. At most ``max_copies`` copies of a document are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staffwise.llm.shared import local_frame, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BUCKETS = 4096
MAX_BROADCAST_SOURCES = 100_000
SEED = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], most: float = MAX_COPIES) -> list[float]:
    """Shares of all words by weight; a target stops at ``most`` times its source's size and
    the excess is shared again by weight until none is above."""
    total, found = float(sum(sizes)), [0.0] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s > 0], total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] >= most * sizes[i]]
        if not full:
            for i in open_:
                found[i] = unit * weights[i]
            break
        for i in full:
            found[i] = float(most * sizes[i])
            left -= found[i]
        open_ = [i for i in open_ if i not in set(full)]
    return found


def source_targets(rows: DataFrame, weights: tuple[float, ...], most: float) -> list[dict]:
    """One dict per source: no, of, source_size, target, mean (weight)."""
    mean = F.sum(F.col("weight") * F.col("size")) / F.greatest(F.sum("size"), F.lit(1))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("size"), mean.alias("mean")).collect()  # one row per source
    sizes.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    share = targets([r["size"] for r in sizes], [weights[i % len(weights)] for i in range(len(sizes))], most)
    return [{"no": i, "of": r["source"], "source_size": r["size"], "target": t, "mean": r["mean"]} for i, (r, t) in enumerate(zip(sizes, share))]


PLACE = "struct<rank: double, id: long>"
PLAN = {
    "no": "long", "of": "string", "source_size": "long", "target": "double", "mean": "double", "left": "double",
    "stretches": f"array<struct<after: {PLACE}, stop: {PLACE}, most: double>>", "best_id": "long", "best_size": "long",
}


def plan_frame(spark: SparkSession, sources: list[dict], *columns: str) -> DataFrame:
    names = columns or tuple(PLAN)
    plan = local_frame(spark, [tuple(s.get(c) for c in names) for s in sources], ", ".join(f"{c} {PLAN[c]}" for c in names))
    return F.broadcast(plan) if len(sources) <= MAX_BROADCAST_SOURCES else plan


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the key and the seed alone."""
    return (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def known_id(doc_id: Column) -> Column:
    """An id that compares: null is smallest."""
    return F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63)))


def ranked(rows: DataFrame, plan: DataFrame, max_copies: int, seed: int, buckets: int) -> DataFrame:
    """``rows`` (id, source, weight, ...) with the plan of their source, certain copies, inclusion probability, rank and range."""
    scale = F.when(F.col("mean") > 0, F.col("weight") / F.col("mean")).otherwise(1.0)
    expected = F.least(F.col("target") / F.greatest("source_size", F.lit(1)) * scale, F.lit(float(max_copies)))
    odds = lambda x: x / (1 - x)
    return (
        rows.join(plan, rows["source"].eqNullSafe(plan["of"]), "left")
        .withColumn("expected", expected)
        .withColumn("certain", F.floor(F.col("expected") + 1e-9))
        .withColumn("p", F.greatest(F.col("expected") - F.col("certain"), F.lit(0.0)))
        .withColumn("q", F.when(F.col("p") > 0, odds(uniform(F.col("id"), seed)) / odds(F.col("p"))))
        .withColumn("rank", F.col("q") / (1 + F.col("q")))
        .withColumn("range", F.least(F.floor(F.col("rank") * buckets), F.lit(buckets - 1)).cast("int"))
    )


def place() -> Column:
    return F.struct("rank", known_id(F.col("id")).alias("id"))


def taken_extra() -> Column:
    """Whether the sample takes a ranked row that carries its source's plan."""

    def takes(stretch: Column) -> Column:
        behind = stretch["after"].isNull() | ((place() > stretch["after"]) & (F.col("size") > 0))
        return behind & (stretch["stop"].isNull() | (place() < stretch["stop"])) & (F.col("size") <= stretch["most"])

    return F.coalesce((F.col("p") > 0) & F.exists("stretches", takes), F.lit(False))


def copies_taken() -> Column:
    best = (F.col("p") > 0) & (known_id(F.col("id")) == F.col("best_id")) & (F.col("size") == F.col("best_size"))
    extra = taken_extra() | F.coalesce(best, F.lit(False))
    return (F.col("certain") + extra.cast("int")).cast("long")


def first_stops(spark: SparkSession, rows: DataFrame) -> list[dict]:
    """Per source of ``rows`` (no, rank, id, size, range, left): the first document in rank order that does
    not fit, if any, and the words of those before it; one row per source is collected."""
    sums = rows.groupBy("no", "range").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    upto = Window.partitionBy("no").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("end", F.sum("words").over(upto))
    begin = (F.col("end") - F.col("words")).alias("begin")
    found = sums.groupBy("no").agg(F.max("end").alias("words"), F.min(F.when(F.col("end") > F.col("left"), F.struct("range", begin))).alias("at")).collect()
    stops = [{"no": r["no"], "stop": None, "words": r["words"]} for r in found if r["at"] is None]
    cuts = [(r["no"], r["at"]["range"], r["at"]["begin"]) for r in found if r["at"] is not None]
    if cuts:
        frame = local_frame(spark, cuts, "no long, range int, begin long")
        near = rows.join(F.broadcast(frame) if len(cuts) <= MAX_BROADCAST_SOURCES else frame, ["no", "range"])
        near = near.withColumn("reached", F.col("begin") + F.sum("size").over(Window.partitionBy("no", "range").orderBy("rank", "id")))
        fits = F.col("reached") <= F.col("left")
        last = near.groupBy("no").agg(F.min(F.when(~fits, F.struct("rank", "id"))).alias("stop"), F.coalesce(F.max(F.when(fits, F.col("reached"))), F.first("begin")).alias("words"))
        stops += [{"no": r["no"], "stop": tuple(r["stop"]), "words": r["words"]} for r in last.collect()]
    return stops


def mix_plan(
    docs: DataFrame, weights: tuple[float, ...], max_copies: int, seed: int, weight_col: str | None, id_col: str, text_col: str, source_col: str, buckets: int,
) -> DataFrame:
    """One row per source: no, of, source_size, target, mean (weight), left, stretches (after, stop, most), best_id, best_size."""
    spark = docs.sparkSession
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
            (F.col(weight_col).cast("double") if weight_col else F.lit(1.0)).alias("weight"),
        ),
        "mix-rows",
    )
    sources = source_targets(rows, weights, max_copies)
    every = ranked(rows, plan_frame(spark, sources, "no", "of", "source_size", "target", "mean"), max_copies, seed, buckets)
    sure = {r["no"]: r["sure"] for r in every.groupBy("no").agg(F.sum(F.col("certain") * F.col("size")).alias("sure")).collect()}  # one row per source
    for s in sources:
        s.update(left=s["target"] - (sure.get(s["no"]) or 0), stretches=[])

    # stretch by stretch: up to the first document that does not fit, then those behind it that are not longer than what is left
    open_, after = sources, {}
    left = every.where("p > 0").select("no", "rank", known_id(F.col("id")).alias("id"), "size", "range")
    while open_:
        here = left.join(plan_frame(spark, open_, "no", "left"), "no").where("size <= left")
        stops = first_stops(spark, here)
        for r in stops:
            s = sources[r["no"]]
            s["stretches"].append((after.get(r["no"]), r["stop"], s["left"]))
            s["left"] -= r["words"]
            after[r["no"]] = r["stop"]
        open_ = [sources[r["no"]] for r in stops if r["stop"] is not None]
        if open_:
            ends = [{"no": s["no"], "left": s["left"], "stretches": s["stretches"][-1:]} for s in open_]
            behind = left.join(plan_frame(spark, ends, "no", "left", "stretches"), "no").where(F.struct("rank", "id") > F.col("stretches")[0]["stop"])
            left = stored(behind.where("size > 0 and size <= left").drop("left", "stretches"), "mix-left")

    # the untaken document that best fills what is left; equal rows count together
    spare = ranked(rows, plan_frame(spark, sources), max_copies, seed, buckets)
    spare = spare.where((F.col("p") > 0) & ~taken_extra() & (F.col("size") > 0) & (F.col("size") < 2 * F.col("left")))
    spare = spare.groupBy("no", "rank", known_id(F.col("id")).alias("id"), "size").agg(F.sum("size").alias("together"), F.first("left").alias("left"))
    off = F.abs(F.col("left") - F.col("together"))
    best = spare.where(off < F.col("left")).groupBy("no").agg(F.min(F.struct(off.alias("off"), "rank", "id", "size")).alias("best"))
    for r in best.collect():  # one row per source
        sources[r["no"]].update(best_id=r["best"]["id"], best_size=r["best"]["size"])
    return plan_frame(spark, sources)


def with_copies(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED, weight_col: str | None = None,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", buckets: int = BUCKETS,
) -> DataFrame:
    """doc (a struct of all columns of ``docs``), size, copies, source_size and target of each document."""
    plan = mix_plan(docs, weights, max_copies, seed, weight_col, id_col, text_col, source_col, buckets)
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), (F.col(weight_col).cast("double") if weight_col else F.lit(1.0)).alias("weight"),
    )
    found = ranked(rows, plan, max_copies, seed, buckets)
    return found.select("doc", "size", copies_taken().alias("copies"), "source_size", "target")


def pareto_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight_col: str | None = None, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words), copies."""
    kept = [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")]
    kept += [F.col(weight_col).cast("double").alias("weight")] if weight_col else []
    found = with_copies(docs.select(*kept), weight_col="weight" if weight_col else None, **options)
    return found.select("doc.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, same columns."""
    found = with_copies(docs, **options).where("copies > 0")
    return found.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
