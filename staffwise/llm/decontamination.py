"""Benchmark decontamination with suffix arrays over the training documents.

Training documents are cut into shards (blocks of rows inside a task). Each
shard gets a word-level suffix array; every suffix of every test item is
binary-searched in it, word by word and all suffixes at once, which yields the
longest verbatim match of each test suffix and the places where it stands. A
window of ``window`` consecutive item words (a shorter item is one window)
that a document holds makes the covered document words hits.

A word that no test item has cannot be part of a match, so the array keeps the
positions that lie in runs of test words long enough for the shortest window;
a suffix ends where its run ends. That drops no match.

The test items are the small side: they are broadcast up to
``MAX_ITEM_BYTES``; a larger test set is searched in blocks of items, one pass
each, and the hits of the passes are merged per document.

Words are compared by 64-bit hash first; each hit is then checked against the
words themselves, so a hash collision cannot make a hit.

Defined results: null and empty texts have no words and no hits; items without
words have no windows; repeated items are reported each; a repeated row gets
the same result each time; item ids may be null (shown as an empty string).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from staffwise.llm.shared import numbered, releasing, row_blocks, runs, text_buffer

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = "".join(chr(c) for c in range(65, 91))
LOWER = UPPER.lower()
ASCII_LOWER = str.maketrans(UPPER, LOWER)
WINDOW = 10
MAX_ITEM_BYTES = 64 << 20

#: Byte classes: 0-9, a-z and every byte of a non-ASCII character are word bytes once A-Z is lowered.
_BYTES = np.arange(256)
WORD_BYTE = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
LOWER_BYTE = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
HASH_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

OUTPUT = "n_words long, hit_starts array<long>, hit_ends array<long>, items array<string>, longest_match long"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(ASCII_LOWER))


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of the lowered block ``raw``, and the row it is in."""
    inside = WORD_BYTE[raw]
    if len(raw) == 0:
        return (np.zeros(0, np.int64),) * 3
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < len(raw)]
    first[begins] = inside[begins]  # a row's first byte starts a word though the row before ended in one
    last[begins[begins > 0] - 1] = inside[begins[begins > 0] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order-dependent 64-bit hash of each word: words of one length are hashed together."""
    out = (ends - starts).astype(np.uint64)
    length = ends - starts
    order = np.argsort(length, kind="stable")
    begin = starts[order]
    active = np.searchsorted(length[order], np.arange(int(length.max(initial=0)) + 1), "left")
    value = out[order]
    for k in range(int(length.max(initial=0))):
        live = slice(int(active[k + 1]) if k + 1 < len(active) else 0, None)
        value[live] = (value[live] ^ raw[begin[live] + k]) * HASH_BASE
        value[live] ^= value[live] >> np.uint64(29)
    out[order] = value
    return out


class TestSet:
    """Test items as arrays: the hashes of their words, all suffixes, and the windows as words."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        self.window = window
        self.items = [(name, w) for name, w in items if w]
        self.ids = [name for name, _ in self.items]
        vocabulary = sorted({x for _, w in self.items for x in w})
        raw = np.frombuffer("".join(vocabulary).encode(), np.uint8)
        lengths = np.array([len(x.encode()) for x in vocabulary], np.int64)
        ends = np.cumsum(lengths)
        hashes = word_hashes(raw, ends - lengths, ends) if vocabulary else np.zeros(0, np.uint64)
        self.hashes = np.unique(hashes)
        code = dict(zip(vocabulary, (np.searchsorted(self.hashes, hashes) + 1).tolist()))
        self.tokens = np.array([code[x] for _, w in self.items for x in [*w]] + [0], np.int32)
        size = np.array([len(w) for _, w in self.items], np.int64)
        self.item_of = np.repeat(np.arange(len(size)), size)
        end = np.cumsum(size)
        self.left = (end[self.item_of] - np.arange(len(self.item_of))) if len(size) else np.zeros(0, np.int64)
        self.need = np.minimum(size, window)[self.item_of] if len(size) else np.zeros(0, np.int64)
        self.least = int(np.minimum(size, window).min()) if len(size) else 0
        self.depth = int(size.max()) if len(size) else 0


def suffix_order(tokens: np.ndarray, at: np.ndarray, bits: int, depth: int) -> np.ndarray:
    """Positions ``at`` sorted by the suffixes that start there, by prefix doubling on packed words."""
    per_key = max(1, 62 // bits)
    padded = np.concatenate((tokens, np.zeros(per_key, tokens.dtype)))
    key, open_ = np.zeros(len(tokens), np.int64), np.ones(len(tokens), bool)
    for k in range(per_key):
        open_ &= padded[k : k + len(tokens)] > 0  # nothing behind the end of the run counts
        key = (key << bits) | np.where(open_, padded[k : k + len(tokens)], 0)
    rank = np.zeros(len(tokens) + 1, np.int64)
    distinct, rank_at = np.unique(key[at], return_inverse=True)
    rank[at] = rank_at + 1
    covered = per_key
    while covered < depth and len(distinct) < len(at):
        # a suffix whose run ends within `covered` words has rank 0 at its later offset
        later = np.minimum(at + covered, len(tokens))
        pair = rank[at] * (len(at) + 2) + np.where(run_left(tokens, at, covered), rank[later], 0)
        distinct, rank_at = np.unique(pair, return_inverse=True)
        rank[at] = rank_at + 1
        covered *= 2
    return at[np.argsort(rank[at], kind="stable")]


def run_left(tokens: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Whether the run of test words around each position goes on for more than ``length`` words."""
    breaks = np.flatnonzero(tokens == 0)
    where = np.searchsorted(breaks, at)
    end = np.append(breaks, len(tokens))[where]
    return end - at > length


def search(test: TestSet, tokens: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every test suffix: words of its longest match, and the range of ``order`` that holds its window."""
    n = len(test.item_of)
    low, high = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    longest, from_, to = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    live = np.arange(n)
    padded = np.append(tokens, 0)

    def bound(k: int, side: str) -> np.ndarray:
        lo, hi = low[live].copy(), high[live].copy()
        want = test.tokens[live + k]
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            have = padded[np.minimum(order[np.minimum(mid, len(order) - 1)] + k, len(tokens))]
            right = open_ & ((have < want) if side == "left" else (have <= want))
            lo, hi = np.where(right, mid + 1, lo), np.where(open_ & ~right, mid, hi)
        return lo

    for k in range(test.depth):
        live = live[test.left[live] > k]
        if not len(live) or not len(order):
            break
        lo, hi = bound(k, "left"), bound(k, "right")
        found = hi > lo
        low[live], high[live] = lo, hi
        live = live[found]
        longest[live] = k + 1
        full = live[test.need[live] == k + 1]
        from_[full], to[full] = low[full], high[full]
    return longest, from_, to


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... for count[i] values, one after the other."""
    total = int(count.sum())
    return np.repeat(start - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(total) if total else np.zeros(0, np.int64)


def match_block(test: TestSet, column: pa.Array) -> dict[str, list]:
    """Word counts, hit word spans and matching items of each row of a shard."""
    data, offsets = text_buffer(column)
    raw, rows = LOWER_BYTE[data], len(offsets) - 1
    starts, ends, row = word_spans(raw, offsets)
    n_words = np.bincount(row, minlength=rows)
    out = {"n_words": n_words.tolist(), "hit_starts": [[] for _ in range(rows)], "hit_ends": [[] for _ in range(rows)]}
    out |= {"items": [[] for _ in range(rows)], "longest_match": [0] * rows}
    if not len(starts) or not len(test.hashes):
        return out
    hashes = word_hashes(raw, starts, ends)
    place = np.minimum(np.searchsorted(test.hashes, hashes), len(test.hashes) - 1)
    known = test.hashes[place] == hashes
    # positions with a break after each row
    shift = np.arange(len(starts)) + row
    tokens = np.zeros(len(starts) + rows, np.int32)
    tokens[shift] = np.where(known, place + 1, 0)
    run_from, run_to = runs(tokens > 0)
    keep = run_to - run_from >= test.least
    at = spread(run_from[keep], (run_to - run_from)[keep])
    if not len(at):
        return out
    order = suffix_order(tokens, at, max(1, int(len(test.hashes) + 1).bit_length()), test.depth)
    longest, from_, to = search(test, tokens, order)
    count = to - from_
    where = order[spread(from_, count)]  # token position of each window found
    suffix = np.repeat(np.arange(len(count)), count)
    word_at = np.zeros(len(tokens), np.int64)
    word_at[shift] = np.arange(len(starts))
    first_word = np.concatenate(([0], np.cumsum(n_words)))
    by_row = np.argsort(row[word_at[where]], kind="stable")
    where, suffix = where[by_row], suffix[by_row]
    hit_row = row[word_at[where]]
    for k, (lo, hi) in zip(*_groups(hit_row)):
        r = int(k)
        mine = words(column[r].as_py())
        marked, items, best = np.zeros(len(mine), bool), set(), 0
        for token, s in zip(where[lo:hi].tolist(), suffix[lo:hi].tolist()):
            w, need, item = int(word_at[token] - first_word[r]), int(test.need[s]), int(test.item_of[s])
            at_item = int(s - np.searchsorted(test.item_of, item))
            if mine[w : w + need] == test.items[item][1][at_item : at_item + need]:  # the words themselves
                marked[w : w + need] = True
                items.add(item)
                best = max(best, int(longest[s]))
        a, b = runs(marked)
        out["hit_starts"][r], out["hit_ends"][r] = a.tolist(), b.tolist()
        out["items"][r] = [test.ids[i] for i in sorted(items)]
        out["longest_match"][r] = best
    return out


def _groups(sorted_values: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    values, begin = np.unique(sorted_values, return_index=True)
    return values, list(zip(begin.tolist(), [*begin[1:].tolist(), len(sorted_values)]))


def _matcher(shared, text_index: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = TestSet(*shared.value)
        for batch in batches:
            column = batch.column(text_index)
            _, offsets = text_buffer(column)
            for lo, hi in row_blocks(offsets):
                found = match_block(test, column.slice(lo, hi - lo))
                kept = [batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns)]
                added = [pa.array(found[f.name], f.type) for f in list(schema)[batch.num_columns :]]
                yield pa.RecordBatch.from_arrays([*kept, *added], names=schema.names)

    return run


def merged_spans(starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """The union of half-open spans."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [a for a, _ in out], [b for _, b in out]


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple[str, list[str]]]]:
    """The test items in blocks whose texts have about ``limit`` bytes at most; their sizes are summed before any is fetched."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * total // limit)) if total > limit else 1
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k)
        yield [(r["id"], words(r["text"])) for r in part.collect()]


def match_benchmark(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    max_item_bytes: int = MAX_ITEM_BYTES,
) -> DataFrame:
    """``docs`` with n_words, hit_starts and hit_ends (word spans), items and longest_match.

    Columns of ``docs`` that bear one of these names are replaced.
    """
    spark = docs.sparkSession
    added = [c.split()[0] for c in OUTPUT.split(", ")]
    docs = docs.drop(*added)
    found = None
    for block in item_blocks(benchmark, item_id_col, item_text_col, max_item_bytes):
        shared = spark.sparkContext.broadcast((block, window))
        schema = StructType([*docs.schema.fields, *StructType.fromDDL(OUTPUT).fields])
        one = docs.mapInArrow(releasing(_matcher(shared, docs.columns.index(text_col), to_arrow_schema(schema))), schema)
        if found is None:
            found = one
        else:
            found = _merge(found, one, added)
    return found


def _merge(left: DataFrame, right: DataFrame, added: list[str]) -> DataFrame:
    """Hits of two passes over the same documents: rows are met by all their columns, equal rows have equal hits."""
    own = [c for c in left.columns if c not in added]
    key = F.sha2(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}), 256)
    hits = right.where(F.size("items") > 0).select(
        key.alias("_key"), F.col("hit_starts").alias("_s"), F.col("hit_ends").alias("_e"), F.col("items").alias("_i"), F.col("longest_match").alias("_l")
    ).dropDuplicates(["_key"])
    joined = left.withColumn("_key", key).join(hits, "_key", "left")
    none, no_items = F.array().cast("array<long>"), F.array().cast("array<string>")
    spans = F.udf(lambda a, b: merged_spans(a, b), "struct<s: array<long>, e: array<long>>")
    joined = joined.withColumn("_u", spans(F.concat("hit_starts", F.coalesce("_s", none)), F.concat("hit_ends", F.coalesce("_e", none))))
    return joined.select(
        *own, "n_words", F.col("_u.s").alias("hit_starts"), F.col("_u.e").alias("hit_ends"),
        F.concat("items", F.coalesce("_i", no_items)).alias("items"), F.greatest("longest_match", F.coalesce("_l", F.lit(0))).alias("longest_match"),
    )


def hit_words() -> Column:
    return F.aggregate(
        F.zip_with("hit_starts", "hit_ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda total, x: total + x
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a window of a test item; same columns."""
    plain, own = numbered(docs)
    marked = match_benchmark(plain, benchmark, window, f"c{docs.columns.index(text_col)}")
    return marked.where(F.size("items") == 0).select(*own)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
