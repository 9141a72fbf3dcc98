"""Suffix-array dedup: byte strings of ``LENGTH`` = 50 that a document with a smaller id has too.

Sorting all suffixes of a corpus in one place does not scale, and it need not:
only equal strings have to meet. The work is split by q-gram buckets and the
buckets that need it are refined by bucket pointers.

1. Anchors. Every 50-byte string has a leading q-gram: of its 16-byte grams
   the one with the smallest hash, the first of equals. Neighbouring strings
   share it, so a document is covered by runs of strings with one anchor
   (about one in 18 bytes). Equal strings have equal anchors at equal places.
2. Buckets. A run goes to the bucket of its anchor as (anchor, hash of the
   run's bytes, id, place). In a bucket, a run whose bytes a smaller id has is
   removed whole. Equal runs inside a task are settled before the shuffle: the
   smallest id is sent, the others are removed there.
3. Refinement. An anchor with several different runs is left with one run per
   content. Their bytes are fetched, and a task refines each q-gram bucket by
   bucket pointers: positions are bucketed by their first 8 bytes, then sorted
   by (own bucket, bucket 8 further), which gives buckets of 16 bytes; those
   new buckets serve the next round at offset 16, and a last one at 18 gives
   50. Buckets of one position are settled and drop out of later rounds. A
   string whose bucket holds a smaller id is removed.

Whatever is shuffled is packed: a task gathers what goes to one bucket and
sends it as one row (numbers in byte planes, texts compressed with zstd).
Buckets are as many as the text asks for (``BUCKET_TEXT`` bytes each), so a
bucket fits a task at every size.

An anchor of a large share of the documents (a common line) would fill one
bucket at the line's edges. Such anchors are found in a bounded sample of
documents; their runs are sent string by string, each under its own hash, so
they spread out and meet only equal strings. Any list of them gives the same
result.

Defined results: null text is empty; texts shorter than 50 bytes lose nothing;
rows with a null id are in no order: they remove nothing and lose nothing. An
id names one text: a repeated row counts as the same document and gets the
same result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffwise.llm.shared import in_sample, row_blocks, stored, text_buffer

LENGTH = 50
GRAM = 16
WINDOW = LENGTH - GRAM + 1
BLOCK_BYTES = 2 << 20
#: Text bytes per bucket; a bucket is worked on in one task.
BUCKET_TEXT = 8 << 20
LEAST_BUCKETS = 64
#: Runs that a task gathers before it settles equal ones and sends the rest.
GATHERED = 1_000_000
SAMPLE_DOCS = 5000
HOT_SHARE = 0.002
#: Bytes sent of the anchor (beside its bucket) and of the hash of the run's content.
ANCHOR_BYTES, CONTENT_BYTES = 4, 5
#: Refining takes some 100 bytes of memory for a byte of text, so its buckets are finer.
FINER = 4

_rng = np.random.default_rng(50)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def at_every_byte(raw: np.ndarray, n: int) -> np.ndarray:
    """The 8 bytes at each of the first ``n`` positions as one number; ``raw`` has n + 7 bytes at least."""
    return np.ndarray((n,), "<u8", np.ascontiguousarray(raw).data, strides=(1,)).copy()


def anchored_runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First string, number of strings and anchor hash of every run of a block of texts."""
    n = len(raw) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = len(raw) - GRAM + 1
    value = at_every_byte(raw, grams + 8)
    code = mix(value[:grams] * BASE ^ mix(value[8 : 8 + grams]))
    bits = np.uint64(max(22, int(len(raw)).bit_length()))
    place = np.uint64((1 << int(bits)) - 1)
    least = (code & ~place) | np.arange(grams, dtype=np.uint64)  # the first of equal hashes wins
    width = 1
    while 2 * width <= WINDOW:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if width < WINDOW:
        least = np.minimum(least[: len(least) - (WINDOW - width)], least[WINDOW - width :])
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    start = np.flatnonzero(row[:n] == row[LENGTH - 1 :])
    anchor = (least[start] & place).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)))) if len(start) else start
    return start[new], np.diff(np.append(new, len(start))), code[anchor[new]]


class Hashes:
    """Hashes of any byte ranges of a block, from one running sum."""

    def __init__(self, raw: np.ndarray):
        power = np.full(len(raw), BASE, np.uint64)
        power[:1] = 1
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_CODE[raw] * np.cumprod(power, dtype=np.uint64), dtype=np.uint64)))
        back = np.full(len(raw), INVERSE, np.uint64)
        back[:1] = 1
        self.back = np.cumprod(back, dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def split_hot(start: np.ndarray, size: np.ndarray, anchor: np.ndarray, hashes: Hashes, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs with hot anchors become single strings under their own hash; then the hash of every run's bytes is added."""
    if len(hot) and len(anchor):
        is_hot = hot[np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)] == anchor
        n = size[is_hot]
        single = np.repeat(start[is_hot] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        own = mix(hashes.of(single, single + LENGTH) + BASE)  # other bits than the hash of the content
        start, size, anchor = (np.concatenate(x) for x in ((start[~is_hot], single), (size[~is_hot], np.ones(len(single), np.int64)), (anchor[~is_hot], own)))
    return start, size, anchor, hashes.of(start, start + size - 1 + LENGTH)


def _planes(values: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes of each value, all first bytes first."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def packed(columns: list[np.ndarray], raw: bytes = b"", compress: bool = True) -> bytes:
    """Columns of whole numbers, each in as many byte planes as it needs, and raw bytes."""
    widths = [1 if not len(c) else 8 if c.min() < 0 else max(1, -(-int(c.max()).bit_length() // 8)) for c in columns]
    body = b"".join(_planes(c, w) for c, w in zip(columns, widths)) + raw
    head = np.array([len(columns), len(columns[0]), len(body), compress, *widths], "<i8").tobytes()
    return head + (pa.compress(body, "zstd", asbytes=True) if compress else body)


def unpacked(blob: bytes) -> tuple[list[np.ndarray], bytes]:
    n_columns, n, size, compress = np.frombuffer(blob, "<i8", 4).tolist()
    widths = np.frombuffer(blob, "<i8", n_columns, 32).tolist()
    body = blob[32 + 8 * n_columns :]
    body = pa.decompress(body, size, "zstd", asbytes=True) if compress else body
    columns, at = [], 0
    for w in widths:
        out = np.zeros((n, 8), np.uint8)
        out[:, :w] = np.frombuffer(body, np.uint8, n * w, at).reshape(w, n).T
        columns.append(out.reshape(-1).view("<i8"))
        at += n * w
    return columns, body[at:]


def all_unpacked(blobs: list[bytes], columns: int) -> list[np.ndarray]:
    """The columns of several blobs, one blob after the other."""
    parts = [unpacked(b)[0] for b in blobs]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(columns)]


def by_place(to: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value of ``to`` with the rows that have it."""
    order = np.argsort(to, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], np.diff(to[order]) != 0, [True]))) if len(order) else np.zeros(1, np.int64)
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(to[order[lo]]), order[lo:hi]


def place_of(doc: np.ndarray, places: int) -> np.ndarray:
    """The place where a document's text and ranges meet."""
    return (mix(doc.view(np.uint64)) % np.uint64(places)).astype(np.int64)


def first_of(keys: tuple[np.ndarray, ...], doc: np.ndarray) -> np.ndarray:
    """The smallest document of each row's group of equal keys."""
    order = np.lexsort((doc, *keys))
    new = np.zeros(len(doc), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    group = np.cumsum(new) - 1
    out = np.empty(len(doc), np.int64)
    out[order] = doc[order][np.flatnonzero(new)][group]
    return out


SENT = "place int, kind int, payload binary"
_SENT = pa.schema([("place", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])
RUNS, GONE, MIXED, TEXTS, PIECES = range(5)


def _rows(kind: int, items: list[tuple[int, bytes]]) -> pa.RecordBatch:
    names = pa.array([p for p, _ in items], pa.int32())
    return pa.RecordBatch.from_arrays([names, pa.array([kind] * len(items), pa.int32()), pa.array([b for _, b in items], pa.binary())], schema=_SENT)


def _ranges(kind: int, doc: np.ndarray, start: np.ndarray, end: np.ndarray, places: int) -> pa.RecordBatch:
    """Ranges sent to the places of their documents."""
    return _rows(kind, [(p, packed([doc[own], start[own], (end - start)[own]])) for p, own in by_place(place_of(doc, places))])


def _send(hot_list, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs to the buckets of their anchors; what the task settles itself goes to a bucket as well, to be passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = hot_list.value
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            anchor, content, doc, start, size = (np.concatenate(x) for x in zip(*held))
            held.clear()
            again = doc > first_of((anchor, content), doc)
            if again.any():
                yield _ranges(GONE, *merged_ranges(doc[again], start[again], start[again] + size[again] - 1 + LENGTH), buckets)
            anchor, content, doc, start, size = (x[~again] for x in (anchor, content, doc, start, size))
            order = np.lexsort((start, doc))
            anchor, content, doc, start, size = (x[order] for x in (anchor, content, doc, start, size))
            to = ((anchor >> np.uint64(8 * ANCHOR_BYTES)) % np.uint64(buckets)).astype(np.int64)
            low = [(x & np.uint64((1 << 8 * n) - 1)).view(np.int64) for x, n in ((anchor, ANCHOR_BYTES), (content, CONTENT_BYTES))]
            blobs = []
            for place, own in by_place(to):
                first = doc[own[0]]
                step = np.diff(doc[own], prepend=first)
                blobs.append((place, packed([low[0][own], low[1][own], step, start[own], size[own]], np.int64(first).tobytes(), compress=False)))
            yield _rows(RUNS, blobs)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi in row_blocks(text_buffer(batch.column(1))[1], BLOCK_BYTES):
                raw, offsets = text_buffer(batch.column(1).slice(lo, hi - lo))
                start, size, anchor = anchored_runs(raw, offsets)
                if not len(start):
                    continue
                start, size, anchor, content = split_hot(start, size, anchor, Hashes(raw), hot)
                row = np.searchsorted(offsets, start, "right") - 1
                held.append((anchor, content, ids[lo:hi][row].astype(np.int64), start - offsets[row], size))
                if sum(len(h[0]) for h in held) >= GATHERED:
                    yield from flush()
        if held:
            yield from flush()

    return run


def merged_ranges(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of ranges per document; touching ranges become one."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    # running maximum of the ends within a document: shift each document above the one before
    rank = np.concatenate(([0], np.cumsum(doc[1:] != doc[:-1])))
    lift = rank * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + lift)
    new = np.concatenate(([True], start[1:] + lift[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last] - lift[last]


def _settle(places: int) -> Callable[[pa.Table], pa.Table]:
    """A bucket's runs to removed ranges and to the runs that are to be refined."""

    def settle(table: pa.Table) -> pa.Table:
        kinds, payloads, place = table.column("kind").to_pylist(), table.column("payload").to_pylist(), table.column("place")[0].as_py()
        out = [_rows(GONE, [(place, b) for k, b in zip(kinds, payloads) if k == GONE])]
        parts = []
        for k, blob in zip(kinds, payloads):
            if k == RUNS:
                (anchor, content, step, start, size), first = unpacked(blob)
                parts.append((anchor, content, np.frombuffer(first, np.int64)[0] + np.cumsum(step), start, size))
        if not parts:
            return pa.Table.from_batches(out)
        anchor, content, doc, start, size = (np.concatenate(x) for x in zip(*parts))
        del parts, payloads
        order = np.argsort(anchor, kind="stable")
        new = np.concatenate(([True], anchor[order][1:] != anchor[order][:-1]))
        group = np.cumsum(new) - 1
        keep = order[np.bincount(group)[group] > 1]
        anchor, content, doc, start, size = (x[keep] for x in (anchor, content, doc, start, size))
        gone = doc > first_of((anchor, content), doc)
        out.append(_ranges(GONE, *merged_ranges(doc[gone], start[gone], start[gone] + size[gone] - 1 + LENGTH), places))
        # one document's run stands for each content; they are refined where another document's run differs
        anchor, doc, start, size = (x[~gone] for x in (anchor, doc, start, size))
        mixed = first_of((anchor,), doc) < -first_of((anchor,), -doc)
        anchor, doc, start, size = (x[mixed] for x in (anchor, doc, start, size))
        blobs = [
            (p, packed([doc[own], start[own], size[own] - 1 + LENGTH, anchor[own], np.full(len(own), place)]))
            for p, own in by_place(place_of(doc, places))
        ]
        return pa.Table.from_batches([*out, _rows(MIXED, blobs)])

    return settle


def _send_texts(places: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            raw, offsets = text_buffer(batch.column(1))
            size = np.diff(offsets)
            blobs = []
            for place, own in by_place(place_of(ids, places)):
                texts = b"".join(raw[a:b].tobytes() for a, b in zip(offsets[own].tolist(), offsets[own + 1].tolist()))
                blobs.append((place, packed([ids[own], size[own]], texts)))
            yield _rows(TEXTS, blobs)

    return run


def _texts(table: pa.Table) -> Iterator[tuple[int, bytes]]:
    """(doc_id, text) of a place, in the order of the ids."""
    found = []
    for kind, blob in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist()):
        if kind == TEXTS:
            (ids, size), texts = unpacked(blob)
            end = np.cumsum(size)
            found += [(doc, texts[e - n : e]) for doc, n, e in zip(ids.tolist(), size.tolist(), end.tolist())]
    return iter(sorted(found, key=lambda r: r[0]))


def _blobs(table: pa.Table, kind: int) -> list[bytes]:
    return [b for k, b in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist()) if k == kind]


def _pieces(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """The bytes of a place's runs to be refined, sent to the (finer) buckets of their anchors."""

    def pieces(table: pa.Table) -> pa.Table:
        doc, start, size, anchor, bucket = all_unpacked(_blobs(table, MIXED), 5)
        order = np.argsort(doc, kind="stable")
        doc, start, size, anchor, bucket = (x[order] for x in (doc, start, size, anchor, bucket))
        raw: list[bytes] = [b""] * len(doc)
        last = None
        for own, text in _texts(table):
            if own != last:
                for i in range(int(np.searchsorted(doc, own, "left")), int(np.searchsorted(doc, own, "right"))):
                    raw[i] = text[start[i] : start[i] + size[i]]
            last = own
        to = (mix((anchor ^ (bucket << 32)).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        blobs = [(p, packed([doc[own], start[own], size[own]], b"".join(raw[i] for i in own.tolist()))) for p, own in by_place(to)]
        return pa.Table.from_batches([_rows(PIECES, blobs)])

    return pieces


def bucket_refined(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions with an equal 50-byte string elsewhere in ``raw``, and the bucket of each.

    ``ends``: the end of the piece that each position is in. Initial buckets
    are 8-grams; each round sorts by the bucket ``offset`` further.
    """
    n = len(raw)
    at = np.flatnonzero(np.arange(n) + 8 <= ends)
    pointer = np.full(n, -1, np.int64)
    if not len(at):
        return at, at
    value = at_every_byte(np.concatenate((raw, np.zeros(8, np.uint8))), n)
    length, key = 8, value[at]
    for step in (8, 16, 18, 0):
        _, bucket, count = np.unique(key, return_inverse=True, return_counts=True)
        shared = count[bucket] > 1  # a bucket of one is settled: no longer string at it can be shared
        pointer[:] = -1
        at, bucket = at[shared], bucket[shared]
        pointer[at] = bucket
        if not step:
            break
        ahead = at + step
        inside = ahead + length <= ends[at]
        at, ahead = at[inside], ahead[inside]
        there = pointer[ahead]
        at, there = at[there >= 0], there[there >= 0]
        key = pointer[at] * np.int64(n + 1) + there
        length += step
    return at, pointer[at]


def _refine(places: int) -> Callable[[pa.Table], pa.Table]:
    """Removed ranges among the runs of a bucket's anchors."""

    def refine(table: pa.Table) -> pa.Table:
        parts = [unpacked(b) for b in _blobs(table, PIECES)]
        doc, start, size = (np.concatenate([p[0][i] for p in parts]) for i in range(3))
        raw = np.frombuffer(b"".join(p[1] for p in parts), np.uint8)
        end = np.cumsum(size)
        piece = np.repeat(np.arange(len(size)), size)
        at, bucket = bucket_refined(raw, end[piece])
        own = piece[at]
        gone = doc[own] > first_of((bucket,), doc[own])
        from_ = start[own] + at - (end - size)[own]
        return pa.Table.from_batches([_ranges(GONE, *merged_ranges(doc[own][gone], from_[gone], from_[gone] + LENGTH), places)])

    return refine


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_starts array<long>, span_ends array<long>"
_RESULT = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2


def _cut(table: pa.Table) -> pa.Table:
    """The results of a place's documents."""
    doc, start, size = all_unpacked(_blobs(table, GONE), 3)
    doc, start, end = merged_ranges(doc, start, start + size)
    out: list[list] = [[] for _ in _RESULT]
    for own, raw in _texts(table):
        lo, hi = np.searchsorted(doc, own, "left"), np.searchsorted(doc, own, "right")
        starts, ends = start[lo:hi], end[lo:hi]
        kept = [raw[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(raw)])]
        values = (own, len(raw), int((ends - starts).sum()), len(starts), hashlib.sha256(b"".join(kept)).hexdigest(), starts.tolist(), ends.tolist())
        for column, value in zip(out, values):
            column.append(value)
    return pa.Table.from_arrays([pa.array(v, k) for v, k in zip(out, _RESULT)], names=[c.split()[0] for c in RESULT.split(", ")])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct anchors of each document."""
    for batch in batches:
        for lo, hi in row_blocks(text_buffer(batch.column(0))[1], BLOCK_BYTES):
            raw, offsets = text_buffer(batch.column(0).slice(lo, hi - lo))
            start, _, anchor = anchored_runs(raw, offsets)
            row = np.searchsorted(offsets, start, "right") - 1
            order = np.lexsort((anchor, row))
            row, anchor = row[order], anchor[order]
            new = np.concatenate(([True], (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])))[: len(row)]
            yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64), pa.int64())], names=["anchor"])


def hot_anchors(rows: DataFrame, n: int, sample_docs: int = SAMPLE_DOCS, share: float = HOT_SHARE) -> np.ndarray:
    """Anchors in at least ``share`` of a sample of about ``sample_docs`` documents; at most some thousand values."""
    part = min(1.0, sample_docs / max(n, 1))
    sample = rows.where(in_sample(F.xxhash64("doc_id", F.lit("sample")), part)).select("text")
    least = max(3, int(share * min(n, sample_docs)))
    found = sample.mapInArrow(_anchors, "anchor long").groupBy("anchor").count().where(F.col("count") >= least).select("anchor")
    return np.sort(np.array([r["anchor"] for r in found.collect()], np.int64).view(np.uint64))


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, span_starts, span_ends."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    known = rows.where("doc_id is not null")
    n, size = known.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    places = max(LEAST_BUCKETS, -(-size // BUCKET_TEXT))
    hot = spark.sparkContext.broadcast(hot_anchors(known, n))
    sent = known.mapInArrow(_send(hot, places), SENT)
    settled = stored(sent.groupBy("place").applyInArrow(_settle(places), SENT), "repeats")
    texts = known.mapInArrow(_send_texts(places), SENT)
    pieces = settled.where(F.col("kind") == MIXED).unionByName(texts).groupBy("place").applyInArrow(_pieces(places * FINER), SENT)
    refined = stored(pieces.groupBy("place").applyInArrow(_refine(places), SENT), "repeats-refined")
    gone = settled.where(F.col("kind") == GONE).unionByName(refined)
    cut = gone.unionByName(texts).groupBy("place").applyInArrow(_cut, RESULT)
    none, zero = F.array().cast("array<long>"), F.lit(0).cast("long")
    whole = rows.where("doc_id is null").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), none.alias("span_starts"), none.alias("span_ends"),
    )
    return cut.unionByName(whole)
