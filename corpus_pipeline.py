"""The corpus pipeline: language ID, SimHash near-dedup, benchmark decontamination, mixing, token files.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. Every stage but the last keeps the columns of documents.
``run`` writes each stage's rows as Parquet to the shared folder and reads
them back as the next one's documents.

- language: documents of undetermined or evenly mixed language go;
- near_duplicates: of each group of linked fingerprints the document with the
  smallest id stays (rows of one id with different texts are told apart);
- decontamination: documents that hold a window of a benchmark item go;
- mixing: a document appears as often as the mix takes it (0 to 3 times);
- token_files: ids of all rows in Huffman-coded blocks, one result row per row.

Null texts, empty texts, repeated rows and empty tables go through; each
operator's docstring says how. Other columns of ``docs`` are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staffwise.llm.decontamination import decontaminate
from staffwise.llm.langid import keep_identified
from staffwise.llm.mixing import mixed
from staffwise.llm.queries import tokenizer_path
from staffwise.llm.shared import documents, stored
from staffwise.llm.simhash import near_dedup
from staffwise.llm.token_files import token_files


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files(docs, tokenizer_path())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", tokens),
]

#: SQL can express neither the learned language nor the tokenizer: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
