"""SimHash near-dedup over a byte-position inverted index with count filtering.

A document's fingerprint has a bit set where more than half of its shingles'
XXH64 values have it. Two fingerprints of at most ``max_bits`` = 4 differing
bits differ in at most 4 of their 8 bytes, so they share at least 4 bytes in
place: that is the guaranteed minimum of the count filter. A posting list of a
single (position, byte) would hold 1/256 of all fingerprints, and tallying its
pairs would grow with the square of the input. The index therefore posts a
fingerprint under every set of 4 positions with the bytes there (70 keys): two
fingerprints meet in a list exactly when their tally reaches the minimum, and
lists stay short. Fewer bits allowed, more bytes demanded: the number of
positions in a key is ``8 - max_bits``.

Lists are worked through one after the other in sorted order. Inside a list
every new fingerprint is verified (tally of equal bytes, then bits) against
those not yet reached, and only the links by which it was reached are written:
a list of m fingerprints gives fewer than m links, however close they are.
Fingerprints are distinct before they are indexed, so exact copies, however
many, are one entry.

Components come from alternating stars over the links (``components``).

Defined results: null, empty and blank texts have fingerprint zero and are
linked like any other; texts of fewer words than a shingle are one shingle.
Rows with equal texts, or repeated rows, share fingerprint and component. A
component is named by its smallest id; null ids are in it but don't name it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffwise.llm.components import component_labels
from staffwise.llm.shared import releasing, stored

SHINGLE = 4
MAX_BITS = 4
SEED = 42  # of the shingle hash


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a UTF-8 text."""
    words = text.lower().split()  # A-Z and ASCII white space only, as these are bytes
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(length + 1) - 1
    starts = ends - length
    k = min(shingle, len(words))
    pieces = [joined[a:b] for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(pieces))
    set_bits = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):  # 64 bytes a hash: bounded for very long texts
        bits = np.unpackbits(hashes[lo : lo + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * set_bits > len(hashes)))


def _fingerprints(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.large_binary())
            found = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found.view(np.int64), pa.int64())], names=[*batch.schema.names[:-1], "fp"])

    return run


def posting_keys(max_bits: int):
    """One key per set of 8 - max_bits byte positions: the set's number above the bytes there."""
    byte = [F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255)) for i in range(8)]
    keys = []
    for number, positions in enumerate(combinations(range(8), 8 - max_bits)):
        digest = F.lit(0).cast("long")
        for i in positions:
            digest = F.shiftleft(digest, 8).bitwiseOR(byte[i])
        keys.append(F.struct(F.lit(number).cast("byte").alias("set"), digest.alias("bytes")))
    return F.explode(F.array(*keys))


def _linked(members: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links of a spanning forest over one posting list."""
    left, right, open_ = [], [], members.copy()
    while len(open_):
        frontier, open_ = [open_[0]], open_[1:]
        while frontier and len(open_):
            one = frontier.pop()
            differ = open_ ^ one
            tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = (tally >= 8 - max_bits) & (np.bitwise_count(differ) <= max_bits)
            if near.any():
                found = open_[near]
                left.append(np.full(len(found), one))
                right.append(found)
                frontier.extend(found)
                open_ = open_[~near]
    return left, right


def _links(max_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by (set, bytes, fp) to links; a list may go over several batches."""

    def settle(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        left, right = [], []
        begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(begin, len(key)))
        two = begin[size == 2]
        near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits
        left.append(fp[two][near])
        right.append(fp[two + 1][near])
        for b, n in zip(begin[size > 2].tolist(), size[size > 2].tolist()):
            a, c = _linked(fp[b : b + n], max_bits)
            left += a
            right += c
        u, v = np.concatenate(left), np.concatenate(right)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64), pa.int64()), pa.array(v.view(np.int64), pa.int64())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, waiting = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = (batch.column(0).to_numpy().astype(np.int64) << 56) ^ batch.column(1).to_numpy()
            fp = batch.column(2).to_numpy().view(np.uint64)
            keys.append(key)
            fps.append(fp)
            waiting += len(key)
            last = np.flatnonzero(key != key[-1])
            if len(last):  # all lists but the last are whole
                key, fp = np.concatenate(keys), np.concatenate(fps)
                whole = waiting - (len(batch) - int(last[-1]) - 1)
                yield settle(key[:whole], fp[:whole])
                keys, fps, waiting = [key[whole:]], [fp[whole:]], waiting - whole
        if waiting:
            yield settle(np.concatenate(keys), np.concatenate(fps))

    return run


def fingerprint_links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) that connect every two distinct fingerprints of at most ``max_bits`` differing bits."""
    posted = fingerprints.select("fp").distinct().select(posting_keys(max_bits).alias("key"), "fp")
    posted = posted.select("key.set", "key.bytes", "fp").repartition("set", "bytes").sortWithinPartitions("set", "bytes")
    return posted.mapInArrow(releasing(_links(max_bits)), "u long, v long")


def labelled_prints(rows: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of ``rows`` (the text last), stored, and links between them as (node, label)."""
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    prints = stored(rows.mapInArrow(releasing(_fingerprints(shingle)), f"{kept}, fp long"), "fingerprints")
    return prints, component_labels(fingerprint_links(prints, max_bits))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints, labels = labelled_prints(rows, shingle, max_bits)
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    labelled = first.join(labels, first["fp"] == labels["node"], "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    named = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    of = labelled.select("fp", "label").join(named, "label").select("fp", "component_id")
    return prints.join(of, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id (then fingerprint, then hash of the text); same columns.

    Rows that repeat an id with different texts are told apart by the hash of the text, of equal rows
    one stays; rows with a null id stay, as no id tells them apart.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    prints, labels = labelled_prints(rows, shingle, max_bits)
    first = prints.where("doc_id is not null").groupBy("fp").agg(F.min(F.struct("doc_id", "fp", "text_hash")).alias("first"))
    labelled = first.join(labels, first["fp"] == labels["node"], "left").select("first", F.coalesce("label", "fp").alias("label"))
    stays = labelled.groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("stays"), F.col("first.text_hash").alias("stays_hash"))
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), F.col("doc_id").alias("id"), F.xxhash64(text).alias("hash"))
    kept = keyed.join(stays, (F.col("id") == F.col("stays")) & (F.col("hash") == F.col("stays_hash")), "left_semi").dropDuplicates(["id", "hash"])
    return kept.unionByName(keyed.where("id is null")).select("doc.*")
