"""Inputs that the tests of the subpackage share."""

import pytest

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside; as extra columns of the input they must not matter.
CLASHING = [
    "id", "size", "digest", "row_no", "group", "bundle", "bucket", "shard", "rank", "weight", "of", "range", "fp", "label", "events",
    "items", "n_words", "lang_pred", "quality_score", "spans", "near", "text_key", "ids", "copies", "doc", "_stays", "component_id",
    "hit_starts", "hit_ends", "longest_match", "lang_score", "lang_spans", "c0", "c1",
]
LONG = " ".join(f"word{i % 97} and" for i in range(20_000))
SHARED = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion of seven herbs in the old mill"
ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \t\n", None, "b"),
    (4, f"One text here. {SHARED} and nothing else.", "en", "a"),
    (5, LONG, "en", "a"),
    (6, f"One text here. {SHARED} and nothing else.", "fr", "b"),
    (6, f"One text here. {SHARED} and nothing else.", "fr", "b"),
    (7, f"One  text here. {SHARED} and nothing else.", "en", "c"),
    (8, "Ünïcode ist überall: naïve café, 漢字, и ещё слова.", "de", "b"),
    (None, "A row without an id.", "fr", "c"),
    (None, "Another row without an id, longer than the other.", None, None),
    (9, f"prefix {SHARED} suffix", "en", "a"),
    (10, "x", "en", "c"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *("clash" for _ in CLASHING)) for r in ROWS], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    """(doc_id, text) of the small table, as Python rows."""
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
