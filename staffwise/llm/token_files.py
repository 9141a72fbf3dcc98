"""Token ids in Huffman-coded binary blocks.

1. Tokenise. A task cuts its texts where the tokenizer's own pre-tokenizer cuts
   for certain (behind white space, between a letter and other ASCII signs),
   encodes every distinct piece once with the tokenizers library, and puts the
   ids of the pieces together. A text that spells out a special token is
   encoded whole. The end id follows each document. The ids are stored, and a
   row per task with its counts of ids.
2. Count. The tasks' counts are added up; the counts (one per id of the
   vocabulary) give code lengths limited to ``max_bits`` by package-merge, and
   lengths alone define the canonical code.
3. Write. Documents are ranged and sorted by id; a task packs its documents
   into blocks of about ``BLOCK_TOKENS`` ids. A block is a row of a Parquet
   table: ids and lengths of its documents, ids before it in its part, the
   packed bits, and the bit offset of every ``STRIDE``-th id. The code lengths
   are a second table beside it. Spark's writer commits both, so a lost
   executor leaves no half-written file.
4. Read. Blocks are decoded independently: all checkpoints of a block start at
   once and each step looks up one id per checkpoint in the code table.

What the driver holds is bounded by the vocabulary (counts, code lengths) and
by the number of written parts (ids before each part).

Defined results: null text is empty; an empty document has the end id alone;
documents of equal id are neighbours in any order; a null id sorts first.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffwise.llm.shared import local_frame, releasing, row_blocks, shared_path, string_array, text_buffer

END_ID = 2
MAX_BITS = 18
BLOCK_TOKENS = 1 << 16
STRIDE = 128
PIECE_BLOCK_BYTES = 2 << 20
#: Distinct pieces whose ids a task keeps, in two halves: when the newer one is full, the older one goes,
#: so pieces in use stay. Longer pieces are not kept, which bounds the bytes.
CACHED_PIECES = 400_000
CACHED_BYTES = 64

#: Documents have ids and no counts, a task's last row has counts and no ids.
IDS = "doc_id long, ids binary, counts array<struct<id: long, n: long>>"
IDS_NAMES = ["doc_id", "ids", "counts"]
BLOCKS = "part int, block int, first_token long, doc_ids array<long>, n_tokens array<long>, checkpoints array<long>, payload binary"

# ------------------------------------------------------------ tokenise

_B = np.arange(256)
LETTER = ((_B >= 0x61) & (_B <= 0x7A)) | ((_B >= 0x41) & (_B <= 0x5A))
SPACE = ((_B >= 0x09) & (_B <= 0x0D)) | (_B == 0x20)
SIGN = (_B < 0x80) & ~LETTER & ~SPACE & (_B != 0x27)  # an apostrophe may belong to the letters behind it
#: Bytes of texts of lower-case letters a-z and U+00DF to U+00FF (but the division sign).
PLAIN = bytes([*range(0x61, 0x7B), 0xC3, *range(0x9F, 0xB7), *range(0xB8, 0xC0)])
LOWER = np.where((_B >= 0x41) & (_B <= 0x5A), _B + 32, _B).astype(np.uint8)


def lowered(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``raw`` with A-Z and the capital letters U+00C0 to U+00DE in lower case, and which bytes are plain letters."""
    out, letter = LOWER[raw], LETTER[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    second = raw[lead + 1]
    plain = (second != 0x97) & (second != 0xB7)  # the signs of multiplication and division
    lead, second = lead[plain], second[plain]
    letter[lead] = letter[lead + 1] = True
    capital = lead[second <= 0x9E]
    out[capital + 1] += 0x20
    return out, letter


def piece_offsets(raw: np.ndarray, letter: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets of pieces that can be encoded apart; white space stays with the piece before it."""
    space, sign = SPACE[raw], SIGN[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = (space[:-1] & ~space[1:]) | (letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])
    cut[offsets] = True
    return np.flatnonzero(cut)


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class Pieces:
    """Ids of pieces, each encoded once per task while the cache holds it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [s.content.encode() for s in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet = byte_alphabet()
        self.cache: dict[bytes, bytes] = {}  # ids as packed 32-bit numbers
        self.older: dict[bytes, bytes] = {}

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: bytes) -> bytes:
        """Ids of a piece without white space that the newer half of the cache does not hold."""
        found = self.older.get(text)
        if found is None:
            if text.isalpha():  # ASCII letters: normaliser and pre-tokenizer leave them as they are
                ids = [t.id for t in self.model.tokenize(text.decode())]
            elif not text.translate(None, PLAIN):  # so they do here, but for the byte alphabet
                ids = [t.id for t in self.model.tokenize("".join(map(self.alphabet.__getitem__, text)))]
            else:
                ids = self.encode(text.decode())
            found = array("I", ids).tobytes()
        if len(text) <= CACHED_BYTES:
            if len(self.cache) >= CACHED_PIECES // 2:
                self.older, self.cache = self.cache, {}
            self.cache[text] = found
        return found

    def clear(self) -> None:
        self.cache, self.older = {}, {}

    def block(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows back to back, without end ids, and the n + 1 offsets of the rows."""
        raw, offsets = text_buffer(column)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        low, letter = lowered(raw)
        cuts = piece_offsets(low, letter, offsets)
        kept = ~SPACE[raw]  # white space is at the ends of pieces only and has no ids
        ends = np.cumsum(np.add.reduceat(kept, cuts[:-1], dtype=np.int64))
        coded = string_array(low[kept], np.concatenate(([0], ends))).dictionary_encode()
        cached, own = self.cache.get, self.ids  # should the halves change meanwhile: a block's pieces are distinct
        known = [own(p) if (found := cached(p)) is None else found for p in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat = np.frombuffer(b"".join(known), np.uint32)
        which = coded.indices.to_numpy(zero_copy_only=False)
        count = sizes[which]
        ends = np.cumsum(count)
        begin = (np.cumsum(sizes) - sizes)[which]
        ids = flat[np.repeat(begin - (ends - count), count) + np.arange(int(ends[-1]))]
        first = np.append(np.concatenate(([0], ends))[np.searchsorted(cuts, offsets[:-1])], ends[-1])
        return ids, first.astype(np.int64)

    def rows(self, column: pa.Array) -> list[np.ndarray]:
        ids, first = self.block(column)
        out = [ids[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        raw = text_buffer(column)[0].tobytes()
        if any(s in raw for s in self.special):  # special tokens are found before any cutting: such rows are encoded whole
            for i, text in enumerate(column.to_pylist()):
                if text and any(s.decode() in text for s in self.special):
                    out[i] = np.array(self.encode(text), np.uint32)
        return out


def _tokenise(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = Pieces(path), np.zeros(0, np.int64)
        kind = pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64())]))
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi in row_blocks(text_buffer(texts)[1], PIECE_BLOCK_BYTES):
                found = [np.append(x, np.uint32(end_id)).astype("<u4") for x in own.rows(texts.slice(lo, hi - lo))]
                seen = np.bincount(np.concatenate(found), minlength=len(total))
                seen[: len(total)] += total
                total = seen
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array([_packed(x) for x in found], pa.binary()), pa.nulls(hi - lo, kind)], names=IDS_NAMES
                )
        own.clear()  # the worker process lives on
        used = np.flatnonzero(total)
        counts = [{"id": i, "n": n} for i, n in zip(used.tolist(), total[used].tolist())]
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts], kind)], names=IDS_NAMES)

    return run


def _packed(ids: np.ndarray) -> bytes:
    """Low bytes, then high bytes (and upper halves if any id needs them): similar bytes lie together for the file's compression."""
    wide = np.frombuffer(ids.astype("<u4").tobytes(), np.uint8).reshape(-1, 4)
    planes = 4 if len(ids) and ids.max() > 0xFFFF else 2
    return bytes([planes]) + wide[:, :planes].T.tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    planes = blob[0]
    body = np.frombuffer(blob, np.uint8, offset=1).reshape(planes, -1)
    out = np.zeros(body.shape[1], np.uint32)
    for k in range(planes):
        out |= body[k].astype(np.uint32) << np.uint32(8 * k)
    return out


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and packed ids of each document, and the tasks' counts of ids, stored in the shared folder."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    path = shared_path(spark, "token-ids")
    rows.mapInArrow(releasing(_tokenise(tokenizer_path, end_id)), IDS).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(IDS).parquet(path)


# ------------------------------------------------------- code lengths


def id_counts(ids: DataFrame) -> DataFrame:
    return ids.where("counts is not null").select(F.inline("counts")).groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Optimal prefix-code lengths of at most ``max_bits`` for positive counts (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    max_bits = max(max_bits, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    level, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate((leaves, pairs))
        by_weight = np.argsort(merged, kind="stable")
        level = merged[by_weight]
        is_leaf.append(by_weight < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(is_leaf):
        chosen = int(leaf[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """A canonical code from ids and code lengths."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = int(self.lengths.max(initial=1))
        # the first code of each length follows the last of the shorter one
        step = np.int64(1) << (self.bits - self.lengths)
        begin = np.cumsum(step) - step
        self.codes = begin >> (self.bits - self.lengths)
        size = int(self.ids.max(initial=0)) + 1
        self.code_of, self.length_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code_of[self.ids], self.length_of[self.ids] = self.codes.astype(np.uint64), self.lengths
        self.begin, self.step = begin, step

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """For every value of the next ``bits`` bits: the id and its code length."""
        used = int(self.step.sum())
        symbol, length = np.zeros(1 << self.bits, np.uint32), np.ones(1 << self.bits, np.int64)
        symbol[:used], length[:used] = np.repeat(self.ids, self.step), np.repeat(self.lengths, self.step)
        return symbol, length

    def encode(self, ids: np.ndarray, stride: int = STRIDE) -> tuple[bytes, np.ndarray]:
        """The packed bits, most significant first, and the bit offset of every ``stride``-th id."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        length = self.length_of[ids]
        end = np.cumsum(length)
        at = end - length
        value = self.code_of[ids] << (64 - (at & 31) - length).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        packed = np.zeros(int(word[-1]) + 2, np.uint64)
        packed[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
        packed[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        return packed.astype(">u4").tobytes()[: (int(end[-1]) + 7) // 8], at[::stride]


def decode_blocks(code: Code, table: tuple[np.ndarray, np.ndarray], payloads: list[bytes], checkpoints: list[np.ndarray], sizes: list[int], stride: int = STRIDE) -> np.ndarray:
    """Ids of several blocks back to back; every checkpoint is a lane and a step decodes one id in each."""
    symbol, length_of = table
    pad = b"\0" * 4
    raw = np.frombuffer(b"".join(p + pad for p in payloads), np.uint8).astype(np.uint32)
    base = np.cumsum([0] + [len(p) + 4 for p in payloads])[:-1] * 8
    bits = np.concatenate([c + b for c, b in zip(checkpoints, base)]) if checkpoints else np.zeros(0, np.int64)
    window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:] if len(raw) >= 4 else np.zeros(0, np.uint32)
    first = np.cumsum([0] + sizes)[:-1]
    lane_first = np.concatenate([f + np.arange(0, n, stride) for f, n in zip(first, sizes)]) if sizes else np.zeros(0, np.int64)
    lane_size = np.concatenate([np.minimum(stride, n - np.arange(0, n, stride)) for n in sizes]) if sizes else np.zeros(0, np.int64)
    order = np.argsort(-lane_size, kind="stable")
    at, to, left = bits[order].astype(np.int64), lane_first[order].astype(np.int64), lane_size[order]
    out, mask = np.zeros(int(sum(sizes)), np.uint32), np.uint32((1 << code.bits) - 1)
    for t in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -t, "left"))  # lanes with more than t ids
        p = at[:live]
        value = (window[p >> 3] >> (32 - code.bits - (p & 7)).astype(np.uint32)) & mask
        out[to[:live] + t] = symbol[value]
        at[:live] = p + length_of[value]
    return out


# ------------------------------------------------------- write and read


def _write_blocks(shared, block_tokens: int, stride: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([
        ("part", pa.int32()), ("block", pa.int32()), ("first_token", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())), ("checkpoints", pa.list_(pa.int64())), ("payload", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = Code(*shared.value), TaskContext.get().partitionId()
        block, first, docs, ids, size = 0, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            payload, checkpoints = code.encode(np.concatenate(ids), stride)
            row = [[part], [block], [first], [docs], [[len(x) for x in ids]], [checkpoints.tolist()], [payload]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for doc, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = _unpacked(blob.as_py())
                if ids and size + len(own) > block_tokens:
                    yield flush()
                    block, first, docs, ids, size = block + 1, first + size, [], [], 0
                docs.append(doc)
                ids.append(own)
                size += len(own)
        if ids:
            yield flush()

    return run


def write_token_files(ids: DataFrame, path: str, max_bits: int = MAX_BITS, block_tokens: int = BLOCK_TOKENS, stride: int = STRIDE) -> None:
    """Writes ``path``/code (id, n_bits) and ``path``/blocks from the rows of ``tokenised``."""
    spark = ids.sparkSession
    counted = sorted((r["id"], r["n"]) for r in id_counts(ids).collect())  # at most one row per id of the vocabulary
    symbols = np.array([i for i, _ in counted], np.int64)
    lengths = code_lengths(np.array([n for _, n in counted], np.int64), max_bits)
    local_frame(spark, list(zip(symbols.tolist(), lengths.tolist())), "id long, n_bits long").coalesce(1).write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast((symbols, lengths))
    ordered = ids.where("counts is null").select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(releasing(_write_blocks(shared, block_tokens, stride)), BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")


def _read_blocks(shared, stride: int, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(*shared.value)
        table = code.table()
        for batch in batches:
            for lo in range(0, batch.num_rows, 16):
                rows = batch.slice(lo, 16).to_pylist()
                sizes = [sum(r["n_tokens"]) for r in rows]
                ids = decode_blocks(code, table, [r["payload"] for r in rows], [np.array(r["checkpoints"], np.int64) for r in rows], sizes, stride)
                out: dict[str, list] = {"part": [], "doc_id": [], "start": [], "n_tokens": [], "ids_crc32": [], "ids": []}
                at = 0
                for r in rows:
                    start = r["first_token"]
                    for doc, n in zip(r["doc_ids"], r["n_tokens"]):
                        own = ids[at : at + n].astype("<u4")
                        out["part"].append(r["part"])
                        out["doc_id"].append(doc)
                        out["start"].append(start)
                        out["n_tokens"].append(n)
                        out["ids_crc32"].append(zlib.crc32(own.tobytes()))
                        out["ids"].append(own.astype(np.int32) if with_ids else None)
                        at, start = at + n, start + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["part"], pa.int32()), *(pa.array(out[c], pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")), pa.array(out["ids"], pa.list_(pa.int32()))],
                    names=list(out),
                )

    return run


def read_token_files(spark: SparkSession, path: str, stride: int = STRIDE, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document, decoded from the files."""
    lengths = spark.read.parquet(f"{path}/code").orderBy("id").collect()  # at most one row per id of the vocabulary
    shared = spark.sparkContext.broadcast((np.array([r["id"] for r in lengths], np.int64), np.array([r["n_bits"] for r in lengths], np.int64)))
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    tokens = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n)
    parts = blocks.groupBy("part").agg(F.sum(tokens).alias("tokens")).orderBy("part").collect()  # one row per written part
    before, total = [], 0
    for r in parts:
        before.append((r["part"], total))
        total += r["tokens"]
    starts = F.broadcast(local_frame(spark, before, "part int, before long"))
    rows = blocks.mapInArrow(releasing(_read_blocks(shared, stride, with_ids)), "part int, doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>")
    found = rows.join(starts, "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "ids")
    return found if with_ids else found.drop("ids")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, max_bits: int = MAX_BITS, path: str | None = None) -> DataFrame:
    """Writes the token files of all documents below ``path`` (default: the shared folder) and reads them back."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "token-files")
    write_token_files(tokenised(docs, tokenizer_path, end_id), path, max_bits)
    return read_token_files(spark, path)
