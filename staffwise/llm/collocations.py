"""Phrase collocation mining by Rabin-Karp fingerprints.

Phrases of two to four words that occur often are scored by how rarely their
parts occur apart. Words are lower-cased, and no phrase crosses a punctuation
mark or a line end.

1. Fingerprints. Words are hashed by prefix polynomials over their bytes,
   n-grams by prefix polynomials over their words' hashes: the hash of any
   n-gram is one difference of prefix sums. Two independent polynomials give a
   fingerprint of 64 bits and a check value of 32 bits.
2. Counters. A first pass adds every word and pair to a table of saturating
   counters addressed by the fingerprint; a second one adds to another table
   the longer n-grams whose pairs all passed the first, so that rare pairs do
   not fill it. A table's size is bounded (``MAX_BITS``), and so is the
   broadcast bitmap of its counters that reach ``min_count``. An n-gram whose
   counter, or a part's counter, stays below cannot be frequent. A table too
   small for a corpus lets more n-grams through; it drops none.
3. Occurrences. A third pass makes, per block of texts, one row per n-gram that
   is left: fingerprint, check value, count, and a pointer to the first text that
   has it. Inside a block equal fingerprints are compared word by word; across
   blocks Spark aggregates fingerprints and check values, in each task and by
   the shuffle, so colliding fingerprints are told apart.
4. Texts. Only phrases that reach ``min_count`` are materialised, from the texts
   that they point to: both polynomials of the words there must give the
   aggregated values. A frequent phrase's first text comes early, so few texts
   are pointed to; a bitmap of fixed size (``ROW_BITS``) keeps most others out of
   the shuffle, and lets none of the pointed ones out.
5. Scores, containment and ranks are joins and windows over the phrase table,
   with integers held as decimals where products may pass 64 bits.

A frequent phrase is one row per task in the shuffle, and a table of counters is
sent by each task: a task takes ``TASK_BYTES`` of texts, however small the
scan's splits are. Texts longer than a block are cut between pieces, so memory
does not grow with a text (a single piece is never cut).

Defined results: null text counts as empty; null lang is ``und``; repeated rows
and repeated or null ids are texts of their own (ids are not read). Extra
columns are ignored. Empty in, empty out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staffwise.llm.shared import row_blocks, stored, text_buffer
from staffwise.llm.words import Words

MIN_COUNT = 30
LONGEST = 4
TOP = 2000
SCALE = 2_000_000
CONTAINED_PERCENT = 80
#: Counters of a table, as a power of two: at most, and texts of so many bytes per counter at best.
MAX_BITS = 27
BYTES_PER_COUNTER = 20
#: Bytes of texts that one task of a pass takes.
TASK_BYTES = 64 << 20
#: The longest n-grams of the first table; a second one counts the others.
SHORT = 2
PHRASE_BLOCK_BYTES = 2 << 20
CHUNK_BITS = 14
#: Bits of the broadcast map of texts that phrases point to, as a power of two.
ROW_BITS = 26
#: Counters stop at most here, so that sums of two fit 16 bits.
CEILING = 5_000

BREAKS = np.zeros(256, bool)
BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
IN_WORD = ~BREAKS
IN_WORD[list(b" \t")] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Polynomial:
    """Hashes of spans of a sequence, modulo 2^64, from its prefix sums."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.letters = rng.integers(0, 1 << 64, 256, np.uint64)
        self.base = int(rng.integers(0, 1 << 63)) * 2 + 1
        self.inverse = pow(self.base, -1, 1 << 64)

    @staticmethod
    def powers(base: int, n: int) -> np.ndarray:
        out = np.full(n + 1, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def prefix(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * self.powers(self.base, len(values))[:-1], dtype=np.uint64)))
        return sums, self.powers(self.inverse, len(values))

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums, back = self.prefix(values)
        return (sums[ends] - sums[starts]) * back[starts]

    def strings(self, column: pa.Array) -> np.ndarray:
        raw, offsets = text_buffer(column)
        plain = self.spans(self.letters[raw], offsets[:-1], offsets[1:])
        return mixed(plain + np.diff(offsets).astype(np.uint64))


class Grams:
    """The n-grams of some texts: ``keys(n)`` gives both hashes of the n-gram at every word, ``whole(n)`` whether
    it ends in the piece that it starts in, ``text`` the words of some."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lang: pa.Array, polynomials: tuple[Polynomial, Polynomial], mask: int):
        self.words = words = Words(raw, offsets, IN_WORD)
        self.mask = np.uint64(mask)
        self.piece = np.searchsorted(np.flatnonzero(BREAKS[raw]), words.starts) + words.row
        langs = lang.dictionary_encode()
        self.langs, of_row = langs.dictionary, np.asarray(langs.indices).astype(np.int64)
        self.lang = of_row[words.row]
        self.sums, self.seed = [], []
        for p in polynomials:
            self.sums.append(p.prefix(p.strings(words.dictionary)[words.code]))
            self.seed.append(p.strings(self.langs)[self.lang])

    def __len__(self) -> int:
        return len(self.words.code)

    def keys(self, n: int, which: int, at: np.ndarray | None = None) -> np.ndarray:
        sums, back = self.sums[which]
        at = np.arange(max(0, len(self) - n + 1)) if at is None else at
        out = mixed((sums[at + n] - sums[at]) * back[at] + self.seed[which][at] * np.uint64(2 * n + 1))
        return out >> np.uint64(32) if which else out & self.mask

    def whole(self, n: int) -> np.ndarray:
        return self.piece[n - 1 :] == self.piece[: max(0, len(self) - n + 1)]

    def text(self, n: int, at: np.ndarray) -> pa.Array:
        spelled = self.words.dictionary.cast(pa.large_string())
        parts = [spelled.take(pa.array(self.words.code[at + k])) for k in range(n)]
        return pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())).cast(pa.string())


def short_rows(raw: np.ndarray, offsets: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts, longer ones cut behind breaks into parts of at most ``limit`` bytes (or one piece): new offsets, and
    the text of each part."""
    starts, text = [offsets[:-1]], [np.arange(len(offsets) - 1)]
    for row in np.flatnonzero(np.diff(offsets) > limit):
        cut, end = int(offsets[row]), int(offsets[row + 1])
        breaks = np.flatnonzero(BREAKS[raw[cut:end]]) + cut + 1
        found = []
        while end - cut > limit and breaks.size and breaks[-1] > cut:
            fits = breaks[np.searchsorted(breaks, cut + limit, "right") - 1]
            cut = int(fits if cut < fits <= cut + limit else breaks[np.searchsorted(breaks, cut, "right")])
            found.append(cut)
        starts.append(np.array([c for c in found if c < end], np.int64))
        text.append(np.full(len(starts[-1]), row))
    start, of = np.concatenate(starts), np.concatenate(text)
    order = np.lexsort((start, of))
    return np.append(start[order], offsets[-1]), of[order]


class Miner:
    """What the passes over the texts share; it travels with their tasks."""

    def __init__(self, min_count: int, longest: int, bits: int, fingerprint_bits: int = 64, block_bytes: int = PHRASE_BLOCK_BYTES):
        self.min_count, self.longest, self.bits, self.block_bytes = min_count, longest, bits, block_bytes
        self.cap = min(min_count, CEILING)
        self.kind = np.uint8 if self.cap < 256 else np.uint16
        self.mask = ((1 << fingerprint_bits) - 1) << (64 - fingerprint_bits)  # fewer bits: tests of collisions
        self.polynomials = (Polynomial(1), Polynomial(2))

    def blocks(self, batch: pa.RecordBatch) -> Iterator[tuple[Grams, np.ndarray]]:
        """Grams of each block of a batch, and the batch's row that each of its parts comes from."""
        raw, offsets = text_buffer(batch.column("text"))
        offsets, text = short_rows(raw, offsets, self.block_bytes)
        for start, end in row_blocks(offsets, self.block_bytes):
            lang = batch.column("lang").take(pa.array(text[start:end]))
            here = offsets[start : end + 1]
            yield Grams(raw[here[0] : here[-1]], here - here[0], lang, self.polynomials, self.mask), text[start:end]

    def bucket(self, fingerprints: np.ndarray) -> np.ndarray:
        return (fingerprints >> np.uint64(64 - self.bits)).astype(np.int64)

    def passing(self, grams: Grams, bitmaps: dict[int, np.ndarray], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per n up to ``longest``: places and fingerprints of the n-grams that the ``bitmaps`` (by n) of theirs and their parts let through."""
        passed = np.ones(len(grams) + 1, bool)
        for n in range(1, longest + 1):
            room = max(0, len(grams) - n + 1)
            at = np.flatnonzero(grams.whole(n) & passed[:-1][:room] & passed[1:][:room])
            fingerprint = grams.keys(n, 0, at)
            if n in bitmaps:
                bucket = self.bucket(fingerprint)
                passes = (bitmaps[n][bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1 == 1
                at, fingerprint = at[passes], fingerprint[passes]
            passed = np.zeros(len(grams) + 1, bool)
            passed[at] = True
            yield n, at, fingerprint

    def count(self, batches: Iterator[pa.RecordBatch], sizes: range, bitmaps: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Chunks of the task's counters of the n-grams of these ``sizes`` that the ``bitmaps`` of shorter ones let through, and words by language (chunk -1)."""
        counters, words = np.zeros(1 << self.bits, self.kind), Counter()
        for grams, _ in (block for batch in batches for block in self.blocks(batch)):
            names = grams.langs.to_pylist()
            words.update({names[i]: int(n) for i, n in enumerate(np.bincount(grams.lang, minlength=len(names)))})
            for n, _, fingerprint in self.passing(grams, bitmaps, sizes[-1]):
                if n in sizes:
                    some, times = np.unique(self.bucket(fingerprint).astype(np.uint32), return_counts=True)
                    counters[some] = np.minimum(counters[some] + np.minimum(times, self.cap).astype(np.uint16), self.cap)
        for lang, n in words.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([-1], pa.int32()), "data": pa.array([None], pa.binary()), "lang": pa.array([lang], pa.string()), "n": pa.array([n], pa.int64())})
        for chunk, part in enumerate(counters.reshape(-1, 1 << CHUNK_BITS)):
            if part.any():
                data = pa.compress(part.tobytes(), "zstd", asbytes=True)
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "data": pa.array([data], pa.binary()), "lang": pa.array([None], pa.string()), "n": pa.array([0], pa.int64())})

    def merge(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of all tasks added up as they stream in, as bitmaps of the counters that reach ``min_count``; words by language as they are."""
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            told = batch.filter(pc.less(batch.column("chunk"), 0))
            if told.num_rows:
                yield told
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("data").to_pylist()):
                if chunk >= 0:
                    part = np.frombuffer(pa.decompress(data, np.dtype(self.kind).itemsize << CHUNK_BITS, "zstd", asbytes=True), self.kind).astype(np.uint16)
                    sums[chunk] = np.minimum(sums[chunk] + part, self.cap).astype(np.uint16) if chunk in sums else part
        for chunk, total in sums.items():
            bits = np.packbits(total >= self.cap).tobytes()
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "data": pa.array([bits], pa.binary()), "lang": pa.array([None], pa.string()), "n": pa.array([0], pa.int64())})

    def occurrences(self, batches: Iterator[pa.RecordBatch], bitmaps: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        """A row per n-gram and block that may be frequent, with its count and a pointer to the first text that has it."""
        for grams, row_no in ((grams, np.asarray(batch.column("row_no"))[rows]) for batch in batches for grams, rows in self.blocks(batch)):
            words = grams.words
            for n, at, fingerprint in self.passing(grams, bitmaps, self.longest):
                if not len(at):
                    break
                order = np.argsort(fingerprint, kind="stable")
                at, fingerprint = at[order], fingerprint[order]
                other = np.ones(len(at), bool)  # differs from its neighbour: the words decide, not the hash alone
                other[1:] = (fingerprint[1:] != fingerprint[:-1]) | (grams.lang[at[1:]] != grams.lang[at[:-1]])
                for k in range(n):
                    other[1:] |= words.code[at[1:] + k] != words.code[at[:-1] + k]
                first = np.flatnonzero(other)
                at = at[first]
                yield pa.RecordBatch.from_pydict({
                    "lang": grams.langs.take(pa.array(grams.lang[at])), "n": pa.array(np.full(len(at), n), pa.int32()),
                    "fp": pa.array(fingerprint[first].view(np.int64)), "checked": pa.array(grams.keys(n, 1, at).astype(np.uint32).view(np.int32)),
                    "count": pa.array(np.diff(np.append(first, len(other)))), "row_no": pa.array(row_no[words.row[at]]),
                })

    def materialised(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phrases of texts (lang, text) whose words give the fingerprint and the check value of a pointer (``at``:
        n, fp, checked, f) to the text; a pointer without such words is an error."""
        for batch in batches:
            at = batch.column("at")
            size, row = np.asarray(pc.list_value_length(at)), np.asarray(pc.list_parent_indices(at))
            pointer = dict(zip(("n", "fp", "checked", "f"), pc.list_flatten(at).flatten()))
            n = np.asarray(pointer["n"])
            key = pointer_key(np.asarray(pointer["fp"]).view(np.uint64), np.asarray(pointer["checked"]).view(np.uint32).astype(np.uint64), row)
            missing = np.ones(int(size.sum()), bool)
            for grams, rows in self.blocks(batch):
                first, last = np.searchsorted(row, (rows[0], rows[-1] + 1)) if len(rows) else (0, 0)
                for k in np.unique(n[first:last]).tolist():
                    wanted = first + np.flatnonzero(missing[first:last] & (n[first:last] == k))
                    wanted = wanted[np.argsort(key[wanted])]
                    places = np.flatnonzero(grams.whole(k))
                    if not len(wanted) or not len(places):
                        continue
                    own = pointer_key(grams.keys(k, 0, places), grams.keys(k, 1, places), rows[grams.words.row[places]])
                    found = np.minimum(np.searchsorted(key[wanted], own), len(wanted) - 1)
                    hit = np.flatnonzero(key[wanted][found] == own)
                    which, one = np.unique(found[hit], return_index=True)
                    which, place = wanted[which], places[hit[one]]
                    missing[which] = False
                    yield pa.RecordBatch.from_pydict({
                        "lang": grams.langs.take(pa.array(grams.lang[place])), "n": pa.array(np.full(len(which), k), pa.int32()),
                        "phrase": grams.text(k, place), "f": pointer["f"].take(pa.array(which)),
                    })
            if missing.any():
                raise ValueError(f"{int(missing.sum())} phrases differ from the fingerprints they were counted under")


def pointer_key(fingerprint: np.ndarray, checked: np.ndarray, row: np.ndarray) -> np.ndarray:
    """One number for a fingerprint, its check value and a row of a batch."""
    return mixed(fingerprint ^ mixed(checked | (row.astype(np.uint64) << np.uint64(32))))


def pointed_texts(texts: DataFrame, frequent: DataFrame) -> DataFrame:
    """``texts`` without most of those that ``frequent`` does not point to: no shuffle, at most 2^ROW_BITS bits broadcast."""
    number = (F.pmod(F.xxhash64("row_no"), F.lit(1 << ROW_BITS)) + 1).alias("number")
    bit = F.bitmap_bit_position("number")
    marked = frequent.select(number).groupBy(F.bitmap_bucket_number("number").alias("chunk")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    told = texts.select("*", number).withColumns({"chunk": F.bitmap_bucket_number("number"), "bit": bit}).join(F.broadcast(marked), "chunk")
    byte = F.conv(F.hex(F.substr("bits", F.expr("cast(bit div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("long")
    return told.where(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1).select(*texts.columns)


def counter_bitmap(texts: DataFrame, miner: Miner, sizes: range, bitmaps: dict[int, Broadcast]) -> tuple[np.ndarray, DataFrame]:
    """Of the n-grams of these ``sizes`` that pass the ``bitmaps`` of shorter ones: which counters reach ``min_count``
    (2^bits bits, packed); and the words of each language (lang, n)."""
    columns = "chunk int, data binary, lang string, n long"
    chunks = 1 << max(0, miner.bits - CHUNK_BITS)
    counted = texts.select("lang", "text").mapInArrow(lambda batches: miner.count(batches, sizes, {n: b.value for n, b in bitmaps.items()}), columns)
    merged = stored(counted.repartition(min(chunks, 64), "chunk", "lang").mapInArrow(miner.merge, columns), "phrase-counters")
    bitmap = np.zeros((chunks, 1 << (CHUNK_BITS - 3)), np.uint8)
    for row in merged.where("chunk >= 0").select("chunk", "data").toLocalIterator():
        bitmap[row["chunk"]] = np.frombuffer(row["data"], np.uint8)
    return bitmap.reshape(-1), merged.where("chunk < 0").groupBy("lang").agg(F.sum("n").alias("n"))


def gathered(texts: DataFrame, size: int) -> DataFrame:
    """``texts`` of ``size`` bytes in partitions of about ``TASK_BYTES``, but two per core at least where the scan has as many."""
    return texts.coalesce(max(2 * texts.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))


def frequent_phrases(texts: DataFrame, size: int, miner: Miner) -> tuple[DataFrame, DataFrame]:
    """Of ``texts`` (row_no, lang, text; stored) of ``size`` bytes: phrases of 1 to ``longest`` words that occur
    ``min_count`` times or more (lang, n, phrase, f), and the words of each language (lang, n)."""
    context = texts.sparkSession.sparkContext
    parts, bitmaps, words = gathered(texts, size), {}, None
    for sizes in (range(1, min(SHORT, miner.longest) + 1), range(SHORT + 1, miner.longest + 1)):
        if sizes:
            bitmap, told = counter_bitmap(parts, miner, sizes, dict(bitmaps))
            words = words or told
            bitmaps |= dict.fromkeys(sizes, context.broadcast(bitmap))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return miner.occurrences(batches, {n: b.value for n, b in bitmaps.items()})

    found = parts.mapInArrow(occurrences, "lang string, n int, fp long, checked int, count long, row_no long")
    frequent = stored(
        found.groupBy("lang", "n", "fp", "checked").agg(F.sum("count").alias("f"), F.min("row_no").alias("row_no"))
        .where(F.col("f") >= miner.min_count),
        "phrase-pointers",
    )
    pointers = frequent.groupBy("row_no").agg(F.collect_list(F.struct("n", "fp", "checked", "f")).alias("at"))
    told = pointed_texts(texts, frequent).join(pointers, "row_no").select("lang", "text", "at")
    phrases = told.mapInArrow(miner.materialised, "lang string, n int, phrase string, f long")
    return stored(phrases, "phrases"), words


def scored(phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Candidates (lang, phrase, a, l, r, score) with their lowest-scoring cut, those inside frequent longer ones left out."""
    words = F.split("phrase", " ")
    part = lambda start, size: F.array_join(F.slice(words, start, size), " ")
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    cuts = (
        phrases.where("n > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
        .select("lang", "phrase", F.col("f").alias("a"), "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("n") - F.col("k")).alias("right"))
        .join(parts.withColumnsRenamed({"part": "left", "part_f": "l"}), ["lang", "left"])
        .join(parts.withColumnsRenamed({"part": "right", "part_f": "r"}), ["lang", "right"])
    )
    wide = lambda c: c.cast("decimal(28,0)")
    score = F.call_function("div", wide(F.col("a")) * F.lit(SCALE).cast("decimal(10,0)"), wide(F.col("l")) + wide(F.col("r")))
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = F.array(*[
        F.struct(F.lit(size).alias("size"), F.lit(start).alias("start")) for size in range(2, longest) for start in range(1, longest - size + 2)
    ]) if longest > 2 else F.array().cast("array<struct<size:int,start:int>>")
    longer = (
        phrases.where("n > 2").withColumn("at", F.explode(inside))
        .where("at.size < n and at.start + at.size - 1 <= n")
        .select("lang", part(F.col("at.start"), F.col("at.size")).alias("phrase"), "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    )
    held = wide(F.coalesce("longer", F.lit(0).cast("long"))) * 100 >= wide(F.col("a")) * CONTAINED_PERCENT
    return best.join(longer, ["lang", "phrase"], "left").where(~held).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
    fingerprint_bits: int = 64, max_bits: int = MAX_BITS, block_bytes: int = PHRASE_BLOCK_BYTES,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a (occurrences), l and r (of the parts at the
    lowest-scoring cut), n (words of the language), score."""
    texts = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row_no"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ),
        "phrase-texts", compression="zstd",
    )
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(max_bits, max(CHUNK_BITS, int(size // BYTES_PER_COUNTER).bit_length()))
    phrases, words = frequent_phrases(texts, size, Miner(min_count, longest, bits, fingerprint_bits, block_bytes))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(phrases, longest).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
