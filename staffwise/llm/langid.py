"""Language identification: script ranges, per-word scores and a Viterbi pass with a switching penalty.

Learning. From a bounded sample of labelled, not held-out documents (at most
about ``TRAIN_DOCS``, taken by a hash of the id; whole texts) tasks count
hashed byte trigrams and words per language, and words per script. The model
is a table of log probabilities of fixed size.

Labelling. A text is cut into words (runs of letters). The script of a word,
found from code point ranges, narrows its candidates to the languages seen in
that script; a script that was never seen leaves all of them. The word's score
under each candidate comes from the table. A Viterbi pass over the words, in
which a change of language costs ``PENALTY``, labels every word, so a mixed
text gets spans. The language with most letters is the document's; its share
of the letters is the score. All documents of a block are passed at once, one
word of each per step.

Defined results: null texts and texts without a letter are ``und`` with score
0 and no spans, as is everything when there is nothing to learn from (labelled
documents of which the sample holds none are an error); ties go to the
first language by name; repeated rows get equal results. A null id is never
held out. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staffwise.llm.shared import HELD_OUT_REMAINDER, in_sample, numbered, releasing, row_blocks, string_array, text_buffer
from staffwise.llm.token_files import lowered

UNDETERMINED = "und"
TRAIN_DOCS = 8000
BUCKETS = 1 << 15
SMOOTHING = 0.5
PENALTY = 8.0
#: Share of a language's training words in a script that makes it a candidate there.
SCRIPT_SHARE = 0.001
LANGUAGE_BLOCK_BYTES = 2 << 20

#: First and last code point of ranges of scripts (Unicode blocks).
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FFFF)],
}
_RANGES = sorted((a, b, i) for i, spans in enumerate(SCRIPTS.values()) for a, b in spans)
_FIRST, _LAST, _SCRIPT = (np.array(x, np.int64) for x in zip(*_RANGES))
OTHER_SCRIPT = len(SCRIPTS)

_BYTES = np.arange(256)
WORD_BYTE = ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)  # of lowered text
ASCII_LETTER = ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT_REMAINDER, F.lit(False))


def scripts_of(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The script of each word: that of its first character."""
    b = np.concatenate((raw, np.zeros(4, np.uint8))).astype(np.int64)
    at = offsets[:-1]
    lead, one, two, three = b[at], b[at + 1] & 63, b[at + 2] & 63, b[at + 3] & 63
    point = np.where(
        lead < 0x80, lead,
        np.where(lead < 0xE0, (lead & 31) << 6 | one, np.where(lead < 0xF0, (lead & 15) << 12 | one << 6 | two, (lead & 7) << 18 | one << 12 | two << 6 | three)),
    )
    slot = np.maximum(np.searchsorted(_FIRST, point, "right") - 1, 0)
    return np.where((point >= _FIRST[slot]) & (point <= _LAST[slot]), _SCRIPT[slot], OTHER_SCRIPT)


class Words:
    """The words of a block of texts: distinct words once, and where each occurs."""

    def __init__(self, column: pa.Array):
        data, offsets = text_buffer(column)
        low, _ = lowered(data)
        inside = WORD_BYTE[low]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = offsets[:-1][offsets[:-1] < len(low)]
        first[begins] = inside[begins]
        starts = np.flatnonzero(first)
        kept = np.concatenate(([0], np.cumsum(inside)))  # word bytes before each byte
        ends = np.append(kept[starts], kept[-1])
        self.row = np.searchsorted(offsets, starts, "right") - 1
        self.size = np.bincount(self.row, minlength=len(offsets) - 1)
        coded = string_array(low[inside], ends).dictionary_encode()
        self.which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.raw, self.offsets = text_buffer(coded.dictionary.cast(pa.large_string())) if len(coded.dictionary) else (low[:0], np.zeros(1, np.int64))
        letters = np.diff(np.concatenate(([0], np.cumsum((self.raw & 0xC0) != 0x80)))[self.offsets])
        self.letters, self.script = letters, scripts_of(self.raw, self.offsets)
        letter = np.concatenate(([0], np.cumsum(ASCII_LETTER[low])))
        self.has_letter = letter[offsets[1:]] > letter[offsets[:-1]]
        for i in np.flatnonzero(~self.has_letter & (self.size > 0)).tolist():
            self.has_letter[i] = any(map(str.isalpha, column[i].as_py()))

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the features of the distinct words, and the number of the word of each."""
        n = len(self.offsets) - 1
        size = np.diff(self.offsets)
        word = np.repeat(np.arange(n), size)
        padded = np.zeros(len(self.raw) + 2 * n, np.uint64)  # a zero byte on either side of a word
        at = np.arange(len(self.raw)) + 2 * word + 1
        padded[at] = self.raw
        gram = padded[at - 1] * np.uint64(0x9E3779B1) + padded[at] * np.uint64(0x85EBCA77) + padded[at + 1] * np.uint64(0xC2B2AE3D)
        power = np.uint64(0x100000001B3) ** (np.arange(len(self.raw)) - np.repeat(self.offsets[:-1], size)).astype(np.uint64)
        whole = np.add.reduceat(self.raw * power, self.offsets[:-1]) + np.uint64(0x51ED270B) if n else np.zeros(0, np.uint64)
        hashes = np.concatenate((gram, whole))
        hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (hashes >> np.uint64(40)).astype(np.int64) % BUCKETS, np.concatenate((word, np.arange(n)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1)
        for lo, hi in row_blocks(text_buffer(texts)[1]):
            words = Words(texts.slice(lo, hi - lo))
            bucket, word = words.features()
            own = np.array(langs[lo:hi], object)[words.row] if len(words.row) else np.zeros(0, object)
            for lang in set(langs[lo:hi]):
                n = np.bincount(words.which[own == lang], minlength=len(words.offsets) - 1)
                total = grams.setdefault(lang, np.zeros(BUCKETS + OTHER_SCRIPT + 1))
                total[:BUCKETS] += np.bincount(bucket, weights=n[word], minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(words.script, weights=n, minlength=OTHER_SCRIPT + 1)
    for lang, total in grams.items():
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(slot), pa.string()), pa.array(slot, pa.int32()), pa.array(total[slot].astype(np.int64), pa.int64())], names=["lang", "slot", "n"]
        )


class Model:
    """langs by name; table: log probability of a bucket per language; allowed: candidates per script; prior."""

    def __init__(self, counts: dict[str, dict[int, int]]):
        self.langs = sorted(counts)
        full = np.zeros((len(self.langs), BUCKETS + OTHER_SCRIPT + 1))
        for i, lang in enumerate(self.langs):
            for slot, n in counts[lang].items():
                full[i, slot] = n
        grams, scripts = full[:, :BUCKETS], full[:, BUCKETS:]
        self.table = np.log((grams + SMOOTHING) / (grams.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)).T.astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.allowed = (share >= SCRIPT_SHARE).T  # (script, language)
        self.seen = self.allowed.any(axis=1)
        self.allowed[~self.seen] = True
        self.prior = np.log(np.maximum(scripts.sum(axis=1), 1) / max(scripts.sum(), 1))

    @classmethod
    def of(cls, state: dict) -> "Model":
        """The model from its attributes, which is what a broadcast carries."""
        model = cls.__new__(cls)
        vars(model).update(state)
        return model


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts of a bounded sample; what is collected is at most a row per language and slot."""
    known = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id"))
    )
    n = known.select("lang").count()
    part = min(1.0, train_docs / max(n, 1))
    sample = known.where(in_sample(F.xxhash64("id", F.lit("train")), part))
    rows = sample.select("lang", "text").mapInArrow(releasing(_count), "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).collect()
    counts: dict[str, dict[int, int]] = {}
    for r in rows:
        counts.setdefault(r["lang"], {})[r["slot"]] = r["n"]
    if n and not counts and sample.isEmpty():
        raise RuntimeError(f"none of {n} labelled documents is in the training sample of about {train_docs}")
    return Model(counts)


def word_scores(model: Model, words: Words) -> np.ndarray:
    """Score of every distinct word under every language; others than the script's candidates are ruled out."""
    n = len(words.offsets) - 1
    bucket, word = words.features()
    scores = np.zeros((n, len(model.langs)), np.float32)
    for i in range(len(model.langs)):
        scores[:, i] = np.bincount(word, weights=model.table[bucket, i], minlength=n)
    scores[~model.seen[words.script]] = 0
    return np.where(model.allowed[words.script], scores, np.float32(-1e4)).astype(np.float32)


def viterbi(scores: np.ndarray, which: np.ndarray, size: np.ndarray, prior: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best label of every word. scores: of distinct words; which: the distinct word at each place; size: words per text."""
    total, kinds = len(which), scores.shape[1]
    first = np.cumsum(size) - size
    order = np.argsort(-size, kind="stable")
    longest = int(size.max(initial=0))
    live = np.searchsorted(-size[order], -np.arange(longest), "left")  # texts with more than t words
    begin = first[order]
    number = np.min_scalar_type(max(kinds - 1, 0))  # holds every label
    switched, source = np.zeros((total, kinds), bool), np.zeros(total, number)
    value = np.repeat(prior[None, :].astype(np.float64), len(size), axis=0)
    for t in range(longest):
        k = int(live[t])
        at = begin[:k] + t
        now = value[:k]
        if t:
            best = now.argmax(axis=1)
            source[at] = best
            other = now[np.arange(k), best][:, None] - penalty
            switched[at] = other > now
            now = np.maximum(now, other)
        value[:k] = now + scores[which[at]]
    label = np.zeros(total, number)
    state = value.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        k = int(live[t])
        at = begin[:k] + t
        now = state[:k]
        label[at] = now
        if t:
            state[:k] = np.where(switched[at, now], source[at], now)
    return label


SPANS = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())]))


def label_block(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray, pa.Array]:
    """Language, score and spans of each text."""
    words, n, kinds = Words(column), len(column), len(model.langs)
    if not kinds or not len(words.which):
        # letters outside all words cannot be; without a model nothing is told apart
        return [UNDETERMINED] * n, np.zeros(n), pa.array([[]] * n, SPANS)
    label = viterbi(word_scores(model, words), words.which, words.size, model.prior)
    letters = np.bincount(words.row * kinds + label, weights=words.letters[words.which], minlength=n * kinds).reshape(n, kinds)
    best, all_ = letters.argmax(axis=1), letters.sum(axis=1)
    told = words.has_letter & (all_ > 0)
    score = np.where(told, letters[np.arange(n), best] / np.maximum(all_, 1), 0.0)
    langs = [model.langs[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), told.tolist())]
    new = np.flatnonzero(np.concatenate(([True], (words.row[1:] != words.row[:-1]) | (label[1:] != label[:-1]))))
    length = np.diff(np.append(new, len(label)))
    keep = told[words.row[new]]
    new, length = new[keep], length[keep]
    first = (np.cumsum(words.size) - words.size)[words.row[new]]
    spans = pa.StructArray.from_arrays(
        [pa.array(model.langs, pa.string()).take(pa.array(label[new].astype(np.int64))), pa.array(new - first, pa.int64()), pa.array(length, pa.int64())],
        fields=list(SPANS.value_type),
    )
    ends = np.concatenate(([0], np.cumsum(np.bincount(words.row[new], minlength=n))))
    return langs, score, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)


def _label(shared, text_index: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.of(shared.value)
        for batch in batches:
            texts = batch.column(text_index)
            for lo, hi in row_blocks(text_buffer(texts)[1], LANGUAGE_BLOCK_BYTES):
                langs, score, spans = label_block(model, texts.slice(lo, hi - lo))
                kept = [batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(langs, pa.string()), pa.array(score, pa.float64()), spans], names=names)

    return run


ADDED = "lang_pred string, lang_score double, lang_spans array<struct<lang: string, first_word: bigint, n_words: bigint>>"


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, lang_score and lang_spans (columns of these names are replaced)."""
    added = StructType.fromDDL(ADDED)
    docs = docs.drop(*added.names)
    schema = StructType([*docs.schema.fields, *added.fields])
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # fixed size per language
    return docs.mapInArrow(releasing(_label(shared, docs.columns.index(text_col), schema.names)), schema)


def keep_identified(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """``docs`` without texts of undetermined language or of which no language has ``least`` of the letters; same columns."""
    plain, own = numbered(docs)
    found = identify(plain, learn(docs), f"c{docs.columns.index('text')}")
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("lang_score") >= least)).select(*own)
