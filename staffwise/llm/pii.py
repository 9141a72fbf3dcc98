"""Personal data: patterns for entities, and corpus statistics for the terms that reveal them.

Entities are found by pattern: email, ip, card (Luhn), phone. The terms of a
document that mentions one are all its distinct words outside the entities
themselves, however far from the mention. Equal texts count once, so copies of
one document are no evidence. Over the N different texts the corpus gives

- n(e): texts that mention entity e,
- n(t): texts that hold term t anywhere,
- n(e, t): texts that mention e and hold t outside of entities.

The information that a term gives away about an entity is their pointwise
mutual information log2(n(e, t) N / (n(e) n(t))); what there is to know is the
entity's information content log2(N / n(e)). In every text that mentions the
entity, all occurrences of a term whose share of it reaches ``REMOVE`` are
removed, and of one that reaches ``GENERALISE`` are replaced by its kind of
word. A pair needs ``support`` different texts.

Term counts are summed per task before the shuffle; pair counts are partial
aggregates as well, so an entity in a third of all documents is no hot task.
The pairs of a text are at most its words times its entities. Texts are
shuffled only where they repeat, one of each per task, when the list of the
repeated ones is small enough to be broadcast, else once.

Defined results: null text is empty and has no spans; a repeated row gets
equal spans; an entity in every text carries no information and reveals
nothing. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffwise.llm.decontamination import ASCII_LOWER, LOWER_BYTE, WORD, word_hashes, word_spans
from staffwise.llm.shared import row_blocks, stored, text_buffer

KINDS = ("email", "ip", "card", "phone")
TERM_REMOVED, TERM_GENERALISED = "term_removed", "term_generalised"
LEAST_TERM = 3  # characters
SUPPORT = 3
REMOVE = 0.8
GENERALISE = 0.5
#: Distinct terms whose counts a task holds before it merges them.
MERGE_AT = 2_000_000

EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the characters of a local part before it, back to the last match, and a dotted domain behind it."""
    at, behind = text.find("@"), 0
    while at >= 0:
        start = at
        while start > behind and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            behind = domain.end()
            yield start, behind
        at = text.find("@", max(at + 1, behind))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every entity, by kind, then start; code points, end exclusive."""
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return found
    if "." in text:
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(part.lstrip("0")) < 4 and int(part.lstrip("0") or 0) <= 255 for part in m.groups())]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15]
    return found


def entity_key(kind: str, value: str) -> int:
    value = value.lower() if kind == "email" else value if kind == "ip" else NOT_DIGIT.sub("", value)
    return xxhash.xxh64_intdigest(f"{kind}:{value}") - (1 << 63)


def outside_words(text: str, taken: list[tuple[int, int]]) -> dict[str, list[int]]:
    """Where each word stands that is no part of an entity."""
    places: dict[str, list[int]] = {}
    spans, at, end = sorted(taken), 0, -1
    for m in WORD.finditer(text.translate(ASCII_LOWER)):
        start, stop = m.span()
        while at < len(spans) and spans[at][0] < stop:
            end = max(end, spans[at][1])
            at += 1
        if end <= start:
            places.setdefault(m.group(), []).append(start)
    return {w: starts for w, starts in places.items() if len(w) >= LEAST_TERM and any(map(str.isalpha, w))}


SCAN = (
    "doc_id long, text_key long, spans array<struct<kind: string, start: bigint, end: bigint>>, entities array<bigint>, "
    "words array<struct<term: bigint, size: bigint, starts: array<bigint>>>"
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_WORDS = pa.list_(pa.struct([("term", pa.int64()), ("size", pa.int64()), ("starts", pa.list_(pa.int64()))]))


def text_key(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in row_blocks(text_buffer(batch.column(1))[1]):
            keys, spans, entities, words, terms = [], [], [], [], []
            for value in batch.column(1).slice(lo, hi - lo):
                text = value.as_py() or ""
                found = base_spans(text)
                places = outside_words(text, [(a, b) for _, a, b in found]) if found else {}
                words.append([{"term": len(terms) + i, "size": len(w), "starts": starts} for i, (w, starts) in enumerate(places.items())])
                terms += places
                keys.append(text_key(text))
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                entities.append(sorted({entity_key(k, text[a:b]) for k, a, b in found}))
            coded = [w.encode() for w in terms]
            ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))
            starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else ends
            hashes = word_hashes(np.frombuffer(b"".join(coded), np.uint8), starts, ends).view(np.int64).tolist() if coded else []
            for own in words:
                for w in own:
                    w["term"] = hashes[w["term"]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo), pa.array(keys, pa.int64()), pa.array(spans, _SPANS), pa.array(entities, pa.list_(pa.int64())),
                    pa.array(words, _WORDS),
                ],
                names=["doc_id", "text_key", "spans", "entities", "words"],
            )


def _merged(term: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(np.concatenate(term), return_inverse=True)
    return distinct, np.bincount(at, weights=np.concatenate(n)).astype(np.int64)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that hold each word, summed over the task's texts."""
    terms, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for batch in batches:
        texts = batch.column(0)
        for lo, hi in row_blocks(text_buffer(texts)[1]):
            data, offsets = text_buffer(texts.slice(lo, hi - lo))
            raw = LOWER_BYTE[data]
            starts, ends, row = word_spans(raw, offsets)
            if not len(starts):
                continue
            hashes = word_hashes(raw, starts, ends)
            order = np.lexsort((row, hashes))
            word, of = hashes[order], row[order]
            new = np.concatenate(([True], (word[1:] != word[:-1]) | (of[1:] != of[:-1])))
            distinct, n = np.unique(word[new], return_counts=True)
            terms.append(distinct)
            counts.append(n)
            if sum(map(len, terms)) > MERGE_AT:
                one, total = _merged(terms, counts)
                terms, counts = [one], [total]
                if len(one) > MERGE_AT // 2:
                    yield _counted(one, total)
                    terms, counts = [one[:0]], [total[:0]]
    yield _counted(*_merged(terms, counts))


def _counted(term: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(term.view(np.int64), pa.int64()), pa.array(n, pa.int64())], names=["term", "n"])


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Entities of each document and, where there are any, all its words, stored."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(_scan, SCAN), "pii-scan")


def different_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Each text once; only those that repeat are brought together."""
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    again = stored(rows.groupBy("key").count().where("count > 1").select("key"), "pii-repeated")
    repeated = rows.join(again, "key", "left_semi").dropDuplicates(["key"])
    return rows.join(again, "key", "left_anti").unionByName(repeated).select("text")


def entity_texts(scan: DataFrame) -> DataFrame:
    """text_key, entities and terms of each different text that mentions an entity."""
    return scan.where(F.size("entities") > 0).select("text_key", "entities", F.col("words.term").alias("terms")).dropDuplicates(["text_key"])


def _pairs(texts: DataFrame) -> DataFrame:
    """(text_key, entity, term) of each entity and each word of a text."""
    return texts.select("text_key", F.explode("entities").alias("entity"), "terms").select("text_key", "entity", F.explode("terms").alias("term"))


def revealing_terms(scan: DataFrame, docs: DataFrame, text_col: str = "text", support: int = SUPPORT, remove: float = REMOVE, generalise: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure, kind) of the pairs whose share of the entity's information reaches a threshold."""
    total = scan.select("text_key").distinct().count()
    texts = stored(entity_texts(scan), "pii-texts")
    pairs = _pairs(texts).groupBy("entity", "term").agg(F.count("*").alias("n_pair")).where(F.col("n_pair") >= support)
    entities = stored(texts.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity")), "pii-entities")
    terms = different_texts(docs, text_col).mapInArrow(_term_counts, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_term"))
    found = pairs.join(entities, "entity").join(stored(terms, "pii-words"), "term")
    known = F.log2(F.lit(float(total)) / F.col("n_entity"))
    told = F.log2(F.col("n_pair") * F.lit(float(total)) / (F.col("n_entity") * F.col("n_term")))
    found = found.where(F.col("n_entity") < total).withColumn("disclosure", told / known).where(F.col("disclosure") >= generalise)
    kind = F.when(F.col("disclosure") >= remove, F.lit(TERM_REMOVED)).otherwise(F.lit(TERM_GENERALISED))
    return found.select("entity", "term", "disclosure", kind.alias("kind"))


FOUND = "doc_id long, text_key long, spans array<struct<kind: string, start: bigint, end: bigint>>, terms array<struct<kind: string, start: bigint, end: bigint>>"


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every place of the terms that are told of a document's text."""
    for batch in batches:
        words, told = batch.column(3), batch.column(4)
        marked = []
        for own, hits in zip(words, told):
            kinds = {h["term"]: h["kind"] for h in hits.as_py() or []}
            places = []
            if kinds:
                term = own.values.field("term").to_numpy(zero_copy_only=False)
                for i in np.flatnonzero(np.isin(term, np.fromiter(kinds, np.int64, len(kinds)))).tolist():
                    w = own.values[i].as_py()
                    places += [(kinds[w["term"]], at, at + w["size"]) for at in w["starts"]]
            marked.append([{"kind": k, "start": a, "end": b} for k, a, b in sorted(places)])
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(marked, _SPANS)], names=["doc_id", "text_key", "spans", "terms"])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """One row per document: doc_id, text_key, spans (entities by kind and start), terms (spans of revealing terms)."""
    scan = scanned(docs, id_col, text_col)
    found = stored(revealing_terms(scan, docs, text_col, **thresholds).select("entity", "term", "kind"), "pii-terms")
    hits = _pairs(entity_texts(scan)).join(found, ["entity", "term"]).groupBy("text_key", "term").agg(F.max("kind").alias("kind"))  # removed beats generalised
    hits = stored(hits.groupBy(F.col("text_key").alias("hit_key")).agg(F.collect_list(F.struct("term", "kind")).alias("told")), "pii-hits")
    rows = scan.where(F.size("entities") > 0).join(hits, F.col("text_key") == F.col("hit_key"), "left").select("doc_id", "text_key", "spans", "words", "told")
    none = F.array().cast("array<struct<kind: string, start: bigint, end: bigint>>")
    return rows.mapInArrow(_mark, FOUND).unionByName(scan.where(F.size("entities") == 0).select("doc_id", "text_key", "spans", none.alias("terms")))


def generalised(word: str) -> str:
    """The kind of a word: what is left of it when the word itself may not be told."""
    if any(map(str.isdigit, word)):
        return "[CODE]"
    return "[ACRONYM]" if word.isupper() and len(word) > 1 else "[NAME]" if word[:1].isupper() else "[WORD]"


def sanitised_text(text: str | None, spans: list) -> str | None:
    """The text with entities replaced by their kind, removed terms left out and generalised terms replaced."""
    if text is None:
        return None
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start < at:
            continue
        out.append(text[at:start])
        out.append("" if kind == TERM_REMOVED else generalised(text[start:end]) if kind == TERM_GENERALISED else f"[{kind.upper()}]")
        at = end
    return "".join([*out, text[at:]])


def _rewrite(text_index: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(text_index).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            new = [sanitised_text(t, [(s["kind"], s["start"], s["end"]) for s in own or []]) for t, own in zip(texts, spans)]
            columns = [pa.array(new, pa.string()) if i == text_index else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return run


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """``docs`` with sanitised texts, same columns."""
    found = find_personal_data(docs, id_col, text_col, **thresholds)
    key = F.udf(lambda t: text_key(t or ""), "long")
    spans = found.where(F.size("spans") > 0).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.concat("spans", "terms").alias("_spans"))
    spans = spans.dropDuplicates(["_id", "_key"])
    joined = docs.join(spans, docs[id_col].eqNullSafe(spans["_id"]) & (key(docs[text_col]) == spans["_key"]), "left")
    rows = joined.select(*[docs[c] for c in docs.columns], "_spans")
    return rows.mapInArrow(_rewrite(docs.columns.index(text_col)), docs.schema)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
