"""Profiling: exact quartiles under forced narrowing, pandas-like types."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from staffwise.operators import profiling as P


@pytest.fixture(scope="module")
def values(spark):
    li = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    return (
        li.select(F.lit("price").alias("column_name"), F.col("l_extendedprice").alias("v"))
        .unionByName(li.select(F.lit("qty").alias("column_name"), F.col("l_quantity").alias("v")))
        .unionByName(
            # one value holds a third of the rows
            li.select(F.lit("skew").alias("column_name"),
                      F.when(F.col("l_orderkey") % 3 == 0, F.lit(7.0)).otherwise(F.col("l_discount")).alias("v"))
        )
        .unionByName(li.limit(1).select(F.lit("single").alias("column_name"), F.col("l_tax").alias("v")))
    )


@pytest.mark.parametrize("cuts, rounds", [(256, 2), (2, 1), (3, 4)])
def test_exact_quantiles_equal_spark_percentile(spark, values, cuts, rounds):
    exact = {
        r.column_name: r.p
        for r in values.groupBy("column_name").agg(F.percentile("v", P.QUARTILES).alias("p")).collect()
    }
    got = P.exact_quantiles(values, P.QUARTILES, cuts, rounds).collect()
    assert len(got) == 4 * len(P.QUARTILES)
    for r in got:
        assert r.value == pytest.approx(exact[r.column_name][P.QUARTILES.index(r.q)], abs=1e-9), r


def test_quantiles_with_infinities(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(201)] + [("a", float("inf"))] * 3 + [("a", float("-inf"))] * 3, "column_name string, v double")
    got = {r.q: r.value for r in P.exact_quantiles(df, P.QUARTILES, 4, 3).collect()}
    assert got == {0.25: 48.5, 0.5: 100.0, 0.75: 151.5}


PANDAS_CSV = """i,f,text,suffix,flag,maybe,empty,big,na
1,1.5,a,1d,True,True,,inf,N/A
2,,b,2f,FALSE,,,-3,3
3,1e3,a,1d,true,False,,1e400,
4,.5,NA,7,TRUE,True,,2.,nan
"""


def test_types_and_describe_equal_pandas(spark, workdir):
    import math

    import pandas as pd

    from staffwise.sources import readers

    path = f"{workdir}/types.csv"
    with open(path, "w", encoding="latin-1") as f:
        f.write(PANDAS_CSV)
    frame = pd.read_csv(path)
    raw = readers.read_bronze_csv(spark, path)
    got = {r.column_name: r for r in P.profile_statistics(raw).collect()}
    assert {c: got[c].data_type for c in frame.columns} == {c: str(t) for c, t in frame.dtypes.items()}
    described = frame.describe(include="all")
    for c in frame.columns:
        assert got[c]["count"] == described[c]["count"], c
        if got[c].data_type in ("object", "bool"):
            assert got[c].unique == described[c]["unique"] and got[c].freq == described[c]["freq"]
            assert c == "big" or got[c].top == str(described[c]["top"])  # ties: ours is the smallest
        elif c not in ("empty", "big"):
            for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
                assert got[c][ours] == pytest.approx(described[c][theirs]) or math.isnan(described[c][theirs]), (c, ours)
    unique = {r.column_name: r.unique_values for r in P.profile_dictionary(raw).collect()}
    assert unique == {c: frame[c].nunique() for c in frame.columns}
    missing = {r.column_name: r.missing_count for r in P.profile_missing(raw).collect()}
    assert missing == {c: int(frame[c].isna().sum()) for c in frame.columns}


def test_na_words_equal_pandas(spark):
    from pandas._libs.parsers import STR_NA_VALUES

    from staffwise.plans import oracle

    assert set(P.NA_WORDS) == set(STR_NA_VALUES) == set(oracle.NA_WORDS)


def test_types_follow_pandas_inference(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "a", "N/A", "7"), ("2", "NA", "b", "3", None), ("3", "2", "1", "", "8")],
        "i string, f string, o string, na string, gap string",
    )
    types = {r.column_name: r.data_type for r in P.column_stats(df).collect()}
    assert types == {"i": "int64", "f": "float64", "o": "object", "na": "float64", "gap": "float64"}
    miss = {r.column_name: r.missing_count for r in P.column_stats(df).collect()}
    assert miss == {"i": 0, "f": 1, "o": 0, "na": 2, "gap": 1}


def test_top_value_ties_take_smallest_and_duplicates(spark):
    df = spark.createDataFrame([("b", "1"), ("a", "1"), ("b", "1"), ("a", "1")], "s string, t string")
    st = {r.column_name: r for r in P.profile_statistics(df).collect()}
    assert (st["s"].top, st["s"].freq, st["s"].unique) == ("a", 2, 2)
    assert st["t"].mean == 1.0 and st["t"].p50 == 1.0 and st["t"].top is None
    assert P.duplicate_rows(df).first()[0] == 2
    sample = P.profile_sample(df, 3, order_by=df.columns).collect()
    assert [tuple(r) for r in sample] == [("a", "1"), ("a", "1"), ("b", "1")]
    assert [tuple(r) for r in P.profile_sample(df.coalesce(1), 3).collect()] == [("b", "1"), ("a", "1"), ("b", "1")]  # as in the file


def test_approx_method_close_to_exact(spark):
    from staffwise.sources import fixtures as fx

    raw = fx.fx_pbj_raw(spark, SF0001).select("MDScensus", "Hrs_RN", "WorkDate")
    exact = {r.column_name: r for r in P.profile_statistics(raw).collect()}
    approx = {r.column_name: r for r in P.profile_statistics(raw, method="approx").collect()}
    for col in ("MDScensus", "Hrs_RN"):
        for q in ("p25", "p50", "p75"):
            assert approx[col][q] == pytest.approx(exact[col][q], abs=1.0)
    assert approx["WorkDate"].p50 is None  # text column: no quartiles


def test_raw_csv_with_quotes_and_line_breaks_equals_pandas(spark, workdir):
    import pandas as pd

    from staffwise.sources import readers

    path = f"{workdir}/quotes.csv"
    text = 'Größe,na.me,c\n"q,""x""",y,1\n"two\nlines",’z,2\n"a\r\nb","""",3\n plain , p ,4\n'
    with open(path, "wb") as f:
        f.write(text.encode("cp1252"))
    want = pd.read_csv(path, encoding="cp1252", dtype=str)
    raw = readers.read_bronze_cp1252(spark, path)
    assert raw.columns == list(want.columns)
    assert [tuple(r) for r in P.profile_sample(raw).collect()] == [tuple(r) for r in want.itertuples(index=False)]


def test_sample_follows_the_files(spark, workdir):
    # the second part is the larger one: a plain limit starts there
    path = f"{workdir}/parts"
    spark.range(100).selectExpr("cast(id as string) id", "'x' _metadata", "id position").coalesce(1).write.parquet(path)
    spark.range(100, 9000).selectExpr("cast(id as string) id", "'y' _metadata", "id position").coalesce(1).write.parquet(f"{workdir}/more")
    first = glob.glob(f"{path}/part-*")[0]
    folder = f"{workdir}/folder"
    os.makedirs(folder)
    shutil.copy(first, f"{folder}/part-00000.parquet")
    shutil.copy(glob.glob(f"{workdir}/more/part-*")[0], f"{folder}/part-00001.parquet")
    df = spark.read.parquet(folder)
    got = P.profile_sample(df, 20)
    assert got.columns == ["id", "_metadata", "position"]
    assert [r.id for r in got.collect()] == [str(i) for i in range(20)]
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()
    # a column named like the metadata is the user's; the size is that of both files
    assert got.first()["_metadata"] == "x"
    sizes = sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.startswith("part"))
    assert P.input_size(df).first()["bytes"] == sizes == P.input_size_bytes(spark, folder).first()["bytes"]


def test_sample_of_a_split_file_and_of_no_file(spark, workdir):
    path = f"{workdir}/lines.csv"
    with open(path, "w") as f:
        f.write("id\n" + "".join(f"{i:06d}\n" for i in range(60_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = spark.read.option("header", True).csv(path)
        assert df.rdd.getNumPartitions() > 4
        assert [r.id for r in P.profile_sample(df, 5000).collect()] == [f"{i:06d}" for i in range(5000)]
        assert P.input_size(df).first()["bytes"] == os.path.getsize(path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with pytest.raises(ValueError, match="read from files"):
        P.input_size(spark.range(3))
    assert [r.id for r in P.profile_sample(spark.range(100).repartition(1).sortWithinPartitions("id"), 3).collect()] == ["0", "1", "2"]
