"""What tasks and plans take of an executor's memory beside its heap."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from staffwise.llm import mixing, shared, token_files

PLACES = [
    {"no": 0, "of": None, "source_size": 9, "target": 4.5, "mean": 1.0, "left": 2, "stretches": [(None, (0.25, 7), 4.5), ((0.25, 7), None, 2.0)], "best_id": -(1 << 63), "best_size": 2},
    {"no": 1, "of": "ß", "source_size": 0, "target": 0.0, "mean": None, "left": 0.0, "stretches": []},
]


@pytest.mark.parametrize("sources", [PLACES, []])
def test_plans_need_no_python_workers(spark, sources):
    plan = mixing.plan_frame(spark, sources)
    assert "ExistingRDD" not in plan._jdf.queryExecution().executedPlan().toString()
    want = spark.createDataFrame([tuple(float(s[c]) if c == "left" else s.get(c) for c in mixing.PLAN) for s in sources], ", ".join(f"{c} {t}" for c, t in mixing.PLAN.items()))
    assert plan.schema == want.schema and plan.collect() == want.collect()


def test_tokenising_needs_little_beside_the_batch():
    rng = np.random.default_rng(5)
    words = np.array(["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in rng.integers(2, 9, 3000)])
    texts = pa.array([" ".join(words[rng.integers(0, len(words), 400)]) for _ in range(3500)])
    assert texts.nbytes > 7 << 20
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), texts], names=["doc_id", "text"])
    tracemalloc.start()  # numpy's arrays are seen, Arrow's are not
    try:
        rows = sum(out.num_rows for out in token_files._tokenise(public_tokenizers.path("word_bpe_49k.json"), 2)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(texts) + 1 and peak < 60 << 20, peak


def test_tasks_hand_freed_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(shared, "release_memory", lambda: calls.append(1))
    batches = [pa.RecordBatch.from_arrays([pa.array([bytes(shared.RELEASE_BYTES // 2)])], names=["x"])] * 5
    run = shared.releasing(lambda rows: (b for b in rows if b.num_rows))
    assert sum(b.num_rows for b in run(iter(batches))) == 5 and len(calls) == 3  # after two batches, four, and at the end
    assert list(run(iter([]))) == [] and len(calls) == 4


def test_memory_is_released_on_any_system(monkeypatch):
    shared.release_memory()
    monkeypatch.setattr(shared.ctypes, "CDLL", lambda name: object())
    shared.release_memory()
