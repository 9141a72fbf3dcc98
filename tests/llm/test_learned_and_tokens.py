"""Language ID, quality, personal data and token files against brute force, fixtures and held-out accuracy."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_cases import ROWS, SF, edge_docs, no_docs, small  # noqa: F401
from pyspark.sql import functions as F

from staffwise.llm import langid, pii, quality, token_files
from staffwise.llm.queries import QUERIES, tokenizer_path

# -------------------------------------------------------------- language


def slow_viterbi(scores, which, prior, penalty):
    value, back = None, []
    for w in which:
        if value is None:
            value = list(prior)
            back.append(list(range(len(prior))))
        else:
            best = max(range(len(prior)), key=lambda j: (value[j], -j))
            step = [k if value[k] >= value[best] - penalty else best for k in range(len(prior))]
            value = [max(value[k], value[best] - penalty) for k in range(len(prior))]
            back.append(step)
        value = [v + float(s) for v, s in zip(value, scores[w])]
    state, out = max(range(len(prior)), key=lambda j: (value[j], -j)), []
    for step in reversed(back):
        out.append(state)
        state = step[state]
    return out[::-1]


def test_viterbi_equals_plain_version():
    rng = np.random.default_rng(0)
    scores = rng.normal(0, 5, (40, 3)).astype(np.float32)
    prior = np.log([0.5, 0.3, 0.2])
    size = np.array([7, 0, 1, 30, 12])
    which = rng.integers(0, 40, size.sum())
    got = langid.viterbi(scores, which, size, prior, 6.0)
    at = 0
    for n in size:
        if n:
            assert got[at : at + n].tolist() == slow_viterbi(scores, which[at : at + n], prior, 6.0)
        at += n


def test_three_hundred_languages():
    rng = np.random.default_rng(2)
    scores, size = rng.normal(0, 5, (40, 300)).astype(np.float32), np.array([9, 4])
    prior, which = np.full(300, np.log(1 / 300)), rng.integers(0, 40, 13)
    got = langid.viterbi(scores, which, size, prior, 6.0).tolist()
    assert got == slow_viterbi(scores, which[:9], prior, 6.0) + slow_viterbi(scores, which[9:], prior, 6.0) and max(got) > 255
    names = [f"l{i:03}" for i in range(300)]
    texts = [" ".join([chr(97 + i // 26) * 3 + chr(97 + i % 26) * 3] * 20) for i in range(300)]
    counts = {}
    for out in langid._count([pa.RecordBatch.from_arrays([pa.array(names), pa.array(texts)], names=["lang", "text"])]):
        for lang, slot, n in zip(*(c.to_pylist() for c in out.columns)):
            counts.setdefault(lang, {})[slot] = n
    langs, score, spans = langid.label_block(langid.Model(counts), pa.array(texts))
    assert langs == names and [s[0]["lang"] for s in spans.to_pylist()] == names


def test_language_of_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    rows = QUERIES["op8_viterbi_language"](spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held) > 0


def test_language_spans_and_scripts(spark):
    latin = [(i, t, lang, "s") for i, (t, lang) in enumerate([("the cat sat on the mat with the hat", "en"), ("der hund und die katze sind nicht hier", "de")] * 40)]
    greek = [(100 + i, "και το σπίτι είναι εδώ με την αυλή", "el", "s") for i in range(40)]
    docs = spark.createDataFrame(latin + greek, "doc_id long, text string, lang string, source string")
    model = langid.learn(docs)
    asked = spark.createDataFrame(
        [
            (1, "the cat sat on the mat with the hat der hund und die katze sind nicht hier"), (2, "σπίτι"), (3, "12 34 !!"), (4, None), (5, ""),
            (6, "漢字"), (7, "και το σπίτι the cat sat on the mat with the hat"), (8, "১২"),
        ],
        "doc_id long, text string",
    )
    found = {r.doc_id: r for r in langid.identify(asked, model).collect()}
    assert [(s.lang, s.first_word, s.n_words) for s in found[1].lang_spans] == [("en", 0, 9), ("de", 9, 8)]
    assert found[2].lang_pred == "el" and found[2].lang_score == 1.0
    assert all(found[i].lang_pred == "und" and found[i].lang_score == 0 and found[i].lang_spans == [] for i in (3, 4, 5, 8))
    assert found[6].lang_pred in ("en", "de", "el")  # letters of a script never seen: some learned language
    assert [s.lang for s in found[7].lang_spans] == ["el", "en"]


def test_language_edges(edge_docs, no_docs):
    model = langid.learn(edge_docs)
    found = langid.identify(edge_docs, model)
    assert found.count() == len(ROWS) and found.columns.count("lang_pred") == 1
    assert {r.doc_id: r.lang_pred for r in found.collect() if r.doc_id in (1, 2, 3)} == {1: "und", 2: "und", 3: "und"}
    kept = langid.keep_identified(edge_docs)
    assert kept.columns == edge_docs.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 4, 5, 6, 6, 7, 8, 9, 10]
    assert langid.keep_identified(no_docs).count() == 0
    assert [r.lang_pred for r in langid.identify(edge_docs, langid.learn(no_docs)).collect()] == ["und"] * len(ROWS)


@pytest.mark.parametrize("operator", ["language", "quality"])
def test_samples_of_less_than_a_millionth(spark, operator):
    ids = spark.range(4_000_000).select(F.col("id").alias("doc_id"))
    docs = ids.select("doc_id", F.lit("the cat sat on the mat").alias("text"), F.lit("en").alias("lang"))
    labels = ids.select("doc_id", F.lit(1).alias("quality"))
    if operator == "language":
        assert langid.learn(docs, train_docs=2.9).langs == ["en"]
    else:
        assert quality.learn(docs, labels, train_docs=2.9)["scale"].max() < 1  # fitted
    with pytest.raises(RuntimeError, match="none of"):
        langid.learn(docs, train_docs=1e-6) if operator == "language" else quality.learn(docs, labels, train_docs=1e-6)


# --------------------------------------------------------------- quality


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    m = quality.untrained(rng)
    m["c"] = rng.normal(0, 1, quality.HIDDEN)
    bag, x, label = np.array([0, 3, 4, 9]), rng.normal(0, 1, (9, quality.FEATURES)), np.array([1.0, 0.0, 1.0])

    def loss():
        s = quality.forward(m, x, bag)["score"]
        return -np.mean(label * np.log(s) + (1 - label) * np.log(1 - s))

    g = quality.gradients(m, quality.forward(m, x, bag), bag, label)
    for name in ("W", "V", "U", "w", "c", "b"):
        at = tuple(rng.integers(0, n) for n in m[name].shape)
        old = m[name][at]
        m[name][at] = old + 1e-5
        up = loss()
        m[name][at] = old - 1e-5
        down = loss()
        m[name][at] = old
        assert g[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-8), name


def test_passages_cover_whole_texts():
    texts = [None, "", " ", "one two", "w " * 200 + "end!", "ALL CAPS " * 100]
    x, bag = quality.passages(pa.array(texts, pa.string()))
    assert np.diff(bag).tolist() == [1, 1, 1, 1, 4, 4] and len(x) == bag[-1]
    together = [quality.passages(pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(x, np.concatenate(together), atol=1e-6)


def test_quality_of_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    rows = QUERIES["op3_attention_quality"](spark, d).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows) and len(rows) == 1000
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert sum(label[r.doc_id] == r.predicted for r in held) >= 0.95 * len(held) > 0


def test_quality_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (6, 0), (6, 1), (None, 0), (9, None)], "doc_id long, quality int")
    model = quality.learn(edge_docs, labels)
    found = quality.score(edge_docs, model)
    assert found.count() == len(ROWS) and all(0 <= r.quality_score <= 1 for r in found.collect())
    same = {r.quality_score for r in found.where("doc_id in (4, 6)").collect()}
    assert len(same) == 1
    blank = quality.learn(edge_docs, labels.limit(0))
    assert {r.quality_score for r in quality.score(edge_docs, blank).collect()} == {0.5}
    assert quality.score(no_docs, blank).count() == 0


# --------------------------------------------------------- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def slow_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and slow_luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


@pytest.mark.parametrize("alphabet", ["ab1@.-%_ é", "0123456789 -.+()", "01.2 ", "+1() .-9x", "4 -0"])
def test_base_spans_equal_the_patterns(alphabet):
    rng = np.random.default_rng(len(alphabet))
    for _ in range(3000):
        text = "".join(rng.choice(list(alphabet), int(rng.integers(0, 40))))
        assert pii.base_spans(text) == slow_spans(text), text


def test_long_runs_stay_linear():
    assert pii.base_spans("1" * 300_000 + "a" * 300_000 + "@") == []


def test_personal_data_small_table(spark, small):
    rows = {r.doc_id: r for r in QUERIES["op7_disclosive_terms"](spark, SF).collect()}
    for doc_id, text in small:
        spans = [f"{k}:{a}:{b}" for k, a, b in slow_spans(text)]
        r = rows[doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert r.spans.split(",")[: len(spans)] == (spans or r.spans.split(",")[:0])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in spans) for k in pii.KINDS]


def test_terms_that_reveal_an_entity(spark):
    """A rare project name stands around one address in several letters; common words stand everywhere."""
    mail = "jo@corp.example.com"
    letters = [(i, f"letter {w} about the Zanzibarproject ask {mail} today {w}") for i, w in enumerate(["alpha", "beta", "gamma", "delta"])]
    others = [(100 + i, f"letter about the weather today number {i}") for i in range(200)]
    copies = [(400 + i, "the secretword next to pat@corp.example.com") for i in range(5)]  # one surrounding only: no evidence
    docs = spark.createDataFrame(letters + others + copies, "doc_id long, text string")
    scan = pii.scanned(docs)
    found = pii.revealing_terms(scan, docs).collect()
    assert found and all(0.5 <= r.disclosure <= 1 + 1e-9 for r in found)
    rows = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    for i, text in letters:
        terms = {text[t.start : t.end] for t in rows[i].terms}
        assert "Zanzibarproject" in terms and not terms & {"the", "today", "letter", "about"}
        assert {t.kind for t in rows[i].terms if text[t.start : t.end] == "Zanzibarproject"} == {pii.TERM_REMOVED}
    assert all(not rows[i].terms for i, _ in others + copies)
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "Zanzibar" not in clean[0] and "[EMAIL]" in clean[0] and "today" in clean[0]
    assert clean[100] == others[0][1] and clean[400] == "the secretword next to [EMAIL]"


def test_query_marks_terms_of_an_entity_in_one_text(spark, tmp_path):
    """An address of a single text, a repeated one and one without an entity: the disclosure alone decides."""
    rows = [(1, "the Zanzibarproject of jo@corp.example.com today"), (2, "the secretword next to pat@corp.example.com"), (3, "the secretword next to pat@corp.example.com")]
    rows += [(100 + i, f"the weather of today next to number {i}") for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in QUERIES["op7_disclosive_terms"](spark, str(tmp_path)).collect()}
    for i, term in [(1, "Zanzibarproject"), (2, "secretword"), (3, "secretword")]:
        at = rows[i - 1][1].index(term)
        assert found[i].spans.split(",")[1:] == [f"{pii.TERM_REMOVED}:{at}:{at + len(term)}"]
    assert {found[r[0]].spans for r in rows[3:]} == {""}


def test_terms_far_from_the_mention(spark):
    """A name 3,000 words away from the address is found, counted and marked at every place."""
    filler = "plain weather words " * 1000
    letters = [(i, f"Quixotemill opens {filler} ask jo@corp.example.com about {filler} number{i} Quixotemill") for i in range(4)]
    others = [(100 + i, f"{filler} opens about ask number {i}") for i in range(60)]
    docs = spark.createDataFrame(letters + others, "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    for i, text in letters:
        marked = [(t.kind, text[t.start : t.end]) for t in rows[i].terms]
        assert marked == [(pii.TERM_REMOVED, "Quixotemill")] * 2
    assert not any(rows[i].terms for i, _ in others)


def test_generalised_words():
    assert [pii.generalised(w) for w in ("Oslo", "UNO", "tree", "b12")] == ["[NAME]", "[ACRONYM]", "[WORD]", "[CODE]"]
    spans = [("email", 4, 9), (pii.TERM_GENERALISED, 0, 3), (pii.TERM_REMOVED, 10, 12)]
    assert pii.sanitised_text("abc a@b.c xy z", spans) == "[WORD] [EMAIL]  z"


def test_personal_data_edges(edge_docs, no_docs):
    rows = pii.find_personal_data(edge_docs).collect()
    assert len(rows) == len(ROWS) and all(r.spans == [] and r.terms == [] for r in rows)
    assert pii.sanitise(edge_docs).columns == edge_docs.columns and pii.sanitise(edge_docs).count() == len(ROWS)
    assert pii.find_personal_data(no_docs).count() == 0


# ----------------------------------------------------------- token files


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_pieces_equal_whole_texts(tokenizer):
    odd = [
        None, "", " \t", "It's O'Neil's they're 'tis", "Σ.a ΑΣ ΑΣ. É́e é, ≮ x≮", "a\x0bb\x85c\xa0d　e", "ÀÉÎ×÷ñÑ ß ÿ Ÿ", "<|endoftext|> hi <|ENDOFTEXT|>",
        "漢字, かな. 123abc 4٣5 ½x", "İstanbul .x'd ''s", "\x00a\x1fb\x7fc", "Ａb ﬁ", "ñ" * 300 + "." + "z" * 5000, "́abc .́a", "가각 가", "can’t’s",
    ]
    rng = np.random.default_rng(9)
    odd += ["".join(rng.choice(list("abcXYZéÉñ'’.,!-0139 \n\t́σΣ漢<|≯"), int(rng.integers(1, 60)))) for _ in range(1500)]
    got = token_files.Pieces(tokenizer_path()).rows(pa.array(odd, pa.string()))
    for text, ids in zip(odd, got):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text


@pytest.mark.parametrize("n, bits", [(1, 18), (2, 18), (300, 9), (300, 10), (1000, 18)])
def test_codes_are_complete_limited_and_optimal(n, bits):
    counts = np.random.default_rng(n).zipf(1.3, n).astype(np.int64).clip(max=10**9)
    lengths = token_files.code_lengths(counts, bits)
    assert lengths.max() <= max(bits, int(n - 1).bit_length())
    assert n == 1 or sum(2.0 ** -l for l in lengths) == 1.0
    if bits == 18 and n > 2:
        import heapq

        heap, cost = counts.tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:  # the cost of an unlimited Huffman code
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        assert (counts * lengths).sum() >= cost and (lengths.max() == 18 or (counts * lengths).sum() == cost)


def test_blocks_round_trip():
    rng = np.random.default_rng(4)
    ids = (rng.zipf(1.2, 5000) % 50_000).astype(np.uint32)
    symbols, counts = np.unique(ids, return_counts=True)
    code = token_files.Code(symbols, token_files.code_lengths(counts, 18))
    parts = [ids[:1], ids[1:129], ids[129:4000], ids[4000:]]
    coded = [code.encode(p, 128) for p in parts]
    back = token_files.decode_blocks(code, code.table(), [c[0] for c in coded], [c[1] for c in coded], [len(p) for p in parts], 128)
    assert (back == ids).all()
    assert all(len(c[1]) == -(-len(p) // 128) for c, p in zip(coded, parts))
    assert (token_files._unpacked(token_files._packed(ids)) == ids).all()
    wide = np.array([2, 70_000], np.uint32)
    assert (token_files._unpacked(token_files._packed(wide)) == wide).all()


def test_token_files_small_table(spark, small, tokenizer):
    rows = {r.doc_id: r for r in QUERIES["op10_huffman_token_files"](spark, SF).collect()}
    start = 0
    for doc_id, text in sorted(small):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        r = rows[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files_edges(spark, edge_docs, no_docs, tokenizer, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(token_files.tokenised(edge_docs, tokenizer_path()), path, block_tokens=50, stride=7)
    back = token_files.read_token_files(spark, path, stride=7, with_ids=True).collect()
    want = Counter((r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in ROWS)
    assert Counter((r.doc_id, tuple(r.ids)) for r in back) == want
    ordered = sorted(back, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    assert [r.doc_id or 0 for r in ordered] == sorted(r[0] or 0 for r in ROWS)  # a null id is first
    assert token_files.token_files(no_docs, tokenizer_path()).count() == 0
