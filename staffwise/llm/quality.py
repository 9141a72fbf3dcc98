"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE_WORDS`` words that cover its whole
text. A passage is described by the shares of its bytes in classes (each ASCII
sign, capitals, digits, other), hashed byte pairs, word lengths and how its
words repeat, and encoded as h = tanh(W x + b). Gated attention weighs the
passages of a bag, a_k = softmax_k(w . (tanh(V h_k) * sigmoid(U h_k))), and
the score is sigmoid(c . sum_k a_k h_k + d). Encoder, attention and scorer are
learned together from document labels alone, by Adam on the log loss.

Learning takes a bounded sample: at most about ``TRAIN_DOCS`` labelled, not
held-out documents by a hash of the id, each with its whole text. Executors
describe their passages; the driver fits some thousand parameters. Scoring is
one pass over all documents without a shuffle.

Defined results: null, empty and blank texts are a bag of one passage of
zeros; rows without a label, or with a null id, are not learned from; several
labels of a document are each learned from; without any training row every
score is 0.5. Repeated rows get equal scores. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staffwise.llm.langid import held_out
from staffwise.llm.shared import in_sample, row_blocks, string_array, text_buffer

PASSAGE_WORDS = 64
TRAIN_DOCS = 5000
PAIR_BUCKETS = 96
HIDDEN = 24
ATTENTION = 16
EPOCHS = 30
BATCH = 64
RATE = 3e-3
DECAY = 1e-4
SEED = 7
THRESHOLD = 0.7

_BYTES = np.arange(256)
SPACE = ((_BYTES >= 0x09) & (_BYTES <= 0x0D)) | (_BYTES == 0x20)
#: Class of a byte: every ASCII sign its own, then lower case, capitals, digits, white space, control, non-ASCII.
_SIGNS = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
CLASSES = len(_SIGNS) + 6
CLASS_OF = np.full(256, len(_SIGNS) + 4, np.int64)
CLASS_OF[_SIGNS] = np.arange(len(_SIGNS))
CLASS_OF[0x61:0x7B], CLASS_OF[0x41:0x5B], CLASS_OF[0x30:0x3A] = len(_SIGNS), len(_SIGNS) + 1, len(_SIGNS) + 2
CLASS_OF[SPACE], CLASS_OF[0x80:] = len(_SIGNS) + 3, len(_SIGNS) + 5
WORD_FEATURES = 6
FEATURES = CLASSES + PAIR_BUCKETS + WORD_FEATURES


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of features per passage, and the n + 1 offsets of the passages of each text."""
    raw, offsets = text_buffer(column)
    rows = len(offsets) - 1
    inside = ~SPACE[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < len(raw)]
    first[begins] = inside[begins]
    last[begins[begins > 0] - 1] = inside[begins[begins > 0] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    n_words = np.bincount(row, minlength=rows)
    n_passages = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    bag = np.concatenate(([0], np.cumsum(n_passages)))
    in_row = np.arange(len(starts)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
    of_word = bag[row] + in_row // PASSAGE_WORDS
    total = int(bag[-1])
    # a passage begins with its first word, the first of a text with the text
    begin = np.repeat(offsets[:-1], n_passages)
    lead = np.flatnonzero((in_row % PASSAGE_WORDS == 0) & (in_row > 0))
    begin[of_word[lead]] = starts[lead]
    size = np.diff(np.append(begin, len(raw)))
    of_byte = np.repeat(np.arange(total), size)

    out = np.zeros((total, FEATURES), np.float32)
    length = np.maximum(size, 1)[:, None]
    classes = np.bincount(of_byte * CLASSES + CLASS_OF[raw], minlength=total * CLASSES).reshape(total, CLASSES)
    out[:, :CLASSES] = np.sqrt(classes / length)
    if len(raw) > 1:
        pair = ((raw[:-1].astype(np.uint32) << np.uint32(8) | raw[1:]) * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.int64) % PAIR_BUCKETS
        within = np.ones(len(raw), bool)
        within[offsets[1:-1][offsets[1:-1] > 0] - 1] = False  # a pair does not reach into the next text
        within = within[:-1]
        pairs = np.bincount(of_byte[:-1][within] * PAIR_BUCKETS + pair[within], minlength=total * PAIR_BUCKETS).reshape(total, PAIR_BUCKETS)
        out[:, CLASSES : CLASSES + PAIR_BUCKETS] = np.sqrt(pairs / length)
    if len(starts):
        kept = np.concatenate(([0], np.cumsum(inside)))
        which = string_array(raw[inside], np.append(kept[starts], kept[-1])).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        count = np.bincount(of_word, minlength=total)
        per_word = np.maximum(count, 1)
        same = np.zeros(len(which), bool)
        same[1:] = (which[1:] == which[:-1]) & (of_word[1:] == of_word[:-1])
        second = np.zeros(len(which), bool)
        second[2:] = (which[2:] == which[:-2]) & (of_word[2:] == of_word[:-2])
        distinct = np.unique(of_word * (int(which.max()) + 1) + which) // (int(which.max()) + 1)
        extra = out[:, CLASSES + PAIR_BUCKETS :]
        extra[:, 0] = np.bincount(of_word, weights=same, minlength=total) / per_word
        extra[:, 1] = np.bincount(distinct, minlength=total) / per_word
        extra[:, 2] = np.bincount(of_word, weights=ends - starts, minlength=total) / per_word / 10
        extra[:, 3] = count / PASSAGE_WORDS
        extra[:, 4] = np.bincount(of_word, weights=(ends - starts) <= 2, minlength=total) / per_word
        extra[:, 5] = np.bincount(of_word, weights=second, minlength=total) / per_word
    return out, bag


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(m: dict[str, np.ndarray], x: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
    """Scores of the bags, with what the gradient needs."""
    x = (x - m["mean"]) / m["scale"]
    h = np.tanh(x @ m["W"] + m["b"])
    gate_t, gate_s = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    gated = gate_t * gate_s
    e = gated @ m["w"]
    size = np.diff(bag)
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, bag[:-1]), size))
    a = e / np.repeat(np.add.reduceat(e, bag[:-1]), size)
    z = np.add.reduceat(a[:, None] * h, bag[:-1])
    return {"x": x, "h": h, "t": gate_t, "s": gate_s, "g": gated, "a": a, "z": z, "score": _sigmoid(z @ m["c"] + m["d"])}


def gradients(m: dict[str, np.ndarray], f: dict[str, np.ndarray], bag: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    size = np.diff(bag)
    d_logit = (f["score"] - label) / len(label)
    d_z = np.repeat(d_logit[:, None] * m["c"][None, :], size, axis=0)
    d_a = (d_z * f["h"]).sum(axis=1)
    d_e = f["a"] * (d_a - np.repeat(np.add.reduceat(f["a"] * d_a, bag[:-1]), size))
    d_g = d_e[:, None] * m["w"][None, :]
    d_t, d_s = d_g * f["s"] * (1 - f["t"] ** 2), d_g * f["t"] * f["s"] * (1 - f["s"])
    d_h = f["a"][:, None] * d_z + d_t @ m["V"].T + d_s @ m["U"].T
    d_pre = d_h * (1 - f["h"] ** 2)
    return {
        "W": f["x"].T @ d_pre, "b": d_pre.sum(axis=0), "V": f["h"].T @ d_t, "U": f["h"].T @ d_s,
        "w": f["g"].T @ d_e, "c": f["z"].T @ d_logit, "d": np.array(d_logit.sum()),
    }


def untrained(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def spread(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    return {
        "mean": np.zeros(FEATURES), "scale": np.ones(FEATURES), "W": spread(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": spread(HIDDEN, ATTENTION),
        "U": spread(HIDDEN, ATTENTION), "w": spread(ATTENTION), "c": np.zeros(HIDDEN), "d": np.array(0.0),
    }


def fit(x: np.ndarray, bag: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Adam on the log loss; the same rows in the same order give the same model."""
    rng = np.random.default_rng(seed)
    m = untrained(rng)
    if not len(label):
        return m
    m["mean"], m["scale"] = x.mean(axis=0), x.std(axis=0) + 1e-3
    rate = label.mean()
    m["d"] = np.array(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    names = ["W", "b", "V", "U", "w", "c", "d"]
    first, second, step = {k: np.zeros_like(m[k]) for k in names}, {k: np.zeros_like(m[k]) for k in names}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(label))
        for lo in range(0, len(order), BATCH):
            docs = order[lo : lo + BATCH]
            rows = np.concatenate([np.arange(bag[i], bag[i + 1]) for i in docs])
            own = np.concatenate(([0], np.cumsum(np.diff(bag)[docs])))
            g = gradients(m, forward(m, x[rows], own), own, label[docs])
            step += 1
            for k in names:
                grad = g[k] + DECAY * m[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                now = RATE * (1 - 0.9 * epoch / epochs)
                m[k] = m[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return m


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2)
        for lo, hi in row_blocks(text_buffer(texts)[1]):
            x, bag = passages(texts.slice(lo, hi - lo))
            packed = [x[a:b].astype("<f2").tobytes() for a, b in zip(bag[:-1], bag[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(packed, pa.binary())], names=["id", "label", "x"]
            )


def learn(
    docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> dict[str, np.ndarray]:
    """The model from a bounded sample of the labelled documents that are not held out."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
    known = known.where(F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    n = known.count()
    part = min(1.0, train_docs / max(n, 1))
    sample = known.where(in_sample(F.xxhash64("id", F.lit("quality")), part))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(sample), "id").select("id", "label", "text")  # the sample has about train_docs rows of two numbers
    found = rows.mapInArrow(_describe, "id long, label double, x binary").orderBy("id", "label").toArrow()
    bags = [np.frombuffer(b, "<f2").astype(np.float32).reshape(-1, FEATURES) for b in found.column("x").to_pylist()]
    if n and not bags and sample.isEmpty():
        raise RuntimeError(f"none of {n} labels is in the training sample of about {train_docs}")
    x = np.concatenate(bags) if bags else np.zeros((0, FEATURES), np.float32)
    bag = np.concatenate(([0], np.cumsum([len(b) for b in bags]))).astype(np.int64)
    return fit(x, bag, found.column("label").to_numpy())


def score_block(m: dict[str, np.ndarray], column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Score of each text and the number of its most attended passage."""
    x, bag = passages(column)
    f = forward(m, x.astype(np.float64), bag)
    most = np.repeat(np.maximum.reduceat(f["a"], bag[:-1]), np.diff(bag))
    top = np.flatnonzero(f["a"] >= most)
    of = np.searchsorted(bag, top, "right") - 1
    _, one = np.unique(of, return_index=True)
    return np.round(f["score"], 9), top[one] - bag[:-1]


def _score(shared, text_index: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(text_index)
            for lo, hi in row_blocks(text_buffer(texts)[1]):
                score, top = score_block(m, texts.slice(lo, hi - lo))
                kept = [batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(score, pa.float64()), pa.array(top, pa.int64())], names=names)

    return run


ADDED = "quality_score double, top_passage long"


def score(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``docs`` with quality_score and top_passage (columns of these names are replaced)."""
    added = StructType.fromDDL(ADDED)
    docs = docs.drop(*added.names)
    schema = StructType([*docs.schema.fields, *added.fields])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers
    return docs.mapInArrow(_score(shared, docs.columns.index(text_col), schema.names), schema)
