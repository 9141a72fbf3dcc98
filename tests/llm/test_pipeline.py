"""The corpus pipeline, stage by stage, against brute-force versions on the small table."""

import zlib

import numpy as np
import pytest
from llm_cases import CLASHING, SF, edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F
from test_matching import expected_components, expected_hits, slow_fingerprint

import corpus_pipeline
from staffwise.llm import langid, mixing
from staffwise.llm.queries import tokenizer_path
from staffwise.llm.shared import documents, stored


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = documents(spark, SF), {}
    out["documents"] = docs
    for name, f in corpus_pipeline.STAGES:
        docs = stored(f(spark, docs, SF), f"test-{name}")
        out[name] = docs
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_stay(stages):
    columns = stages["documents"].columns
    assert all(stages[n].columns == columns for n in ("language", "near_duplicates", "decontamination", "mixing"))


def test_language_stage(stages):
    docs = stages["documents"]
    found = langid.identify(docs, langid.learn(docs)).collect()
    want = {r.doc_id for r in found if r.lang_pred != "und" and r.lang_score >= 0.3}
    assert set(texts(stages["language"])) == want and len(want) >= 0.95 * len(found)


def test_near_duplicate_stage(stages):
    before = texts(stages["language"])
    components = expected_components([(i, slow_fingerprint(t)) for i, t in before.items()])
    assert {str(i) for i in texts(stages["near_duplicates"])} == {component for _, _, component in components}


def test_decontamination_stage(spark, stages):
    before = texts(stages["near_duplicates"])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {}
    for name, item in items:
        from staffwise.llm.decontamination import words

        w = words(item)
        for i in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[i : i + 10]), name)
    sizes = {len(w) for w in windows}

    def dirty(text):
        own = words(text)
        return any(tuple(own[i : i + k]) in windows for k in sizes for i in range(len(own) - k + 1))

    want = {i for i, t in before.items() if not dirty(t)}
    assert set(texts(stages["decontamination"])) == want and len(want) < len(before)
    one = next(iter(set(before) - want))
    assert expected_hits([(one, before[one])], items, 10)[one][1] > 0


def test_mixing_stage(stages):
    before = stages["decontamination"]
    copies = {r.doc_id: r.copies for r in mixing.pareto_mix(before).collect()}
    got = {r.doc_id: r.n for r in stages["mixing"].groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == {i: n for i, n in copies.items() if n} and max(got.values()) <= 3


def test_token_stage(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = stages["mixing"].select("doc_id", "text").collect()
    want = []
    for r in rows:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    found = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in stages["token_files"].collect())
    assert sorted((d, n, c) for _, d, n, c in found) == sorted(want)
    assert [s for s, *_ in found] == np.cumsum([0] + [n for _, _, n, _ in found])[:-1].tolist()
    assert [d for _, d, *_ in found] == sorted(d for d, *_ in want)


@pytest.mark.parametrize("name, f", corpus_pipeline.STAGES)
def test_stages_take_edges(spark, edge_docs, no_docs, name, f):
    got = f(spark, edge_docs, SF)
    assert got.count() >= 0 and f(spark, no_docs, SF).count() == 0
    if name != "token_files":
        assert got.dtypes == edge_docs.dtypes  # also of columns that bear the name of an added one
        assert all(r[c] == "clash" for r in got.collect() for c in CLASHING)
