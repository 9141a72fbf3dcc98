"""The registered queries of the subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffwise.llm import quality
from staffwise.llm.chat_windows import conversation_digests, format_chats
from staffwise.llm.collocations import collocations
from staffwise.llm.decontamination import hit_words, match_benchmark
from staffwise.llm.exact_dedup import exact_dedup
from staffwise.llm.langid import held_out, identify, learn
from staffwise.llm.mixing import pareto_mix
from staffwise.llm.pii import KINDS, find_personal_data
from staffwise.llm.shared import documents, stored
from staffwise.llm.sharding import shard_lpt
from staffwise.llm.simhash import simhash_components
from staffwise.llm.source_divergence import source_divergence
from staffwise.llm.suffix_dedup import repeated_ranges
from staffwise.llm.token_files import token_files


def op1_pareto_mix(spark: SparkSession, d: str) -> DataFrame:
    return pareto_mix(documents(spark, d)).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_suffix_decontamination(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", "text")
    found = match_benchmark(docs, spark.read.parquet(f"{d}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"),
    )


def op3_attention_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    model = quality.learn(docs, spark.read.parquet(f"{d}/labels.parquet"))
    found = quality.score(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_bucket_pointer_dedup(spark: SparkSession, d: str) -> DataFrame:
    return repeated_ranges(documents(spark, d)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_simhash_components(spark: SparkSession, d: str) -> DataFrame:
    return simhash_components(documents(spark, d))


def op6_heavy_hitter_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup(documents(spark, d))


def op7_disclosive_terms(spark: SparkSession, d: str) -> DataFrame:
    found = find_personal_data(documents(spark, d), support=1)  # the disclosure alone decides, at one text too
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    kinds = F.col("spans.kind")
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(listed("spans"), 256).alias("base_sha256"), listed(F.concat("spans", "terms")).alias("spans")
    )


def op8_viterbi_language(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op9_lpt_sharding(spark: SparkSession, d: str) -> DataFrame:
    return shard_lpt(documents(spark, d), 40).drop("group")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_huffman_token_files(spark: SparkSession, d: str) -> DataFrame:
    return token_files(documents(spark, d), tokenizer_path())


def op11_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    return source_divergence(documents(spark, d))


def op12_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations(documents(spark, d))


def op13_budgeted_windows(spark: SparkSession, d: str) -> DataFrame:
    """The table and a conversation whose texts are control strings: formatted, stored, read back."""
    marked = "</s>[INST] ok [/INST]"
    hostile = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(marked).alias("text"),
    )
    conversations = spark.read.parquet(f"{d}/conversations.parquet").select(*hostile.columns).unionByName(hostile)
    return conversation_digests(stored(format_chats(conversations), "chat-windows"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pareto_mix,
        op2_suffix_decontamination,
        op3_attention_quality,
        op4_bucket_pointer_dedup,
        op5_simhash_components,
        op6_heavy_hitter_dedup,
        op7_disclosive_terms,
        op8_viterbi_language,
        op9_lpt_sharding,
        op10_huffman_token_files,
        op11_source_divergence,
        op12_collocations,
        op13_budgeted_windows,
    )
}

ORACLE: dict[str, str] = {
    "op6_heavy_hitter_dedup": r"""
        WITH t AS (
          SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                 sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
          FROM documents)
        SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)""",
    "op2_suffix_decontamination": r"""
        WITH lowered AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        items AS (
          SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        windows AS (
          SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
          FROM items, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT k FROM windows),
        places AS (
          SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS s
          FROM lowered, sizes, unnest(range(1, len(w) - k + 2)) AS u(i) WHERE len(w) >= k),
        found AS (SELECT doc_id, item_id, i, places.k FROM places JOIN windows USING (k, s)),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + k)) AS u(p) GROUP BY doc_id),
        matched AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
                    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM lowered LEFT JOIN hit USING (doc_id) LEFT JOIN matched USING (doc_id)""",
    "op11_source_divergence": r"""
        WITH t AS (
          SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
        vectors AS (SELECT lang, source, doc, term, count(*) AS n FROM (SELECT lang, source, doc, unnest(words) AS term FROM t) GROUP BY ALL),
        kept AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM vectors GROUP BY ALL HAVING count(*) >= 30),
        langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM kept GROUP BY lang),
        sums AS (SELECT lang, source, term, CAST(sum(vectors.n) AS HUGEINT) AS n FROM vectors JOIN kept USING (lang, term) GROUP BY ALL),
        groups AS (
          SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM t) LEFT JOIN sums USING (lang, source) GROUP BY ALL),
        p AS (
          SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n, 1 + (1000000000 * (coalesce(s.n, 0) + 5)) // (g.total + 5 * l.v) AS p,
                 1 + (1000000000 * (k.n + 5)) // (l.total + 5 * l.v) AS q
          FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
        distances AS (
          SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        found AS (
          SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
          UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found)
        WHERE part = 'pair' OR rank <= 50""",
    "op12_collocations": r"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        langs AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
        phrases AS (
          SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
          FROM split, (VALUES (1), (2), (3), (4)) AS s(k), unnest(range(1, len(w) - k + 2)) AS u(i)
          WHERE len(w) >= k GROUP BY ALL HAVING count(*) >= 30),
        cuts AS (
          SELECT lang, phrase, k, f, c, array_to_string(string_split(phrase, ' ')[1 : c], ' ') AS head,
                 array_to_string(string_split(phrase, ' ')[c + 1 : k], ' ') AS tail
          FROM phrases, unnest(range(1, k)) AS u(c) WHERE k > 1),
        valued AS (
          SELECT cuts.lang, cuts.phrase, cuts.f AS a, c, l.f AS l, r.f AS r, (CAST(2000000 AS HUGEINT) * cuts.f) // (l.f + r.f) AS score
          FROM cuts JOIN phrases l ON l.lang = cuts.lang AND l.phrase = head JOIN phrases r ON r.lang = cuts.lang AND r.phrase = tail),
        lowest AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
        inner_parts AS (
          SELECT lang, array_to_string(string_split(phrase, ' ')[i : i + m - 1], ' ') AS phrase, max(f) AS longer
          FROM phrases, (VALUES (2), (3)) AS s(m), unnest(range(1, k - m + 2)) AS u(i) WHERE m < k GROUP BY ALL),
        kept AS (
          SELECT lowest.* FROM lowest LEFT JOIN inner_parts USING (lang, phrase)
          WHERE CAST(100 AS HUGEINT) * coalesce(longer, 0) < CAST(80 AS HUGEINT) * a)
        SELECT lang, row_number() OVER v AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM kept JOIN langs USING (lang) WINDOW v AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase))
        QUALIFY row_number() OVER v <= 2000""",
    "op13_budgeted_windows": r"""
        WITH c AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        counted AS (
          SELECT *, 4 + len(regexp_extract_all(text, '[^\x20\x09-\x0D]{1,8}')) AS tokens,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS pos,
                 19 + length(replace(replace(replace(replace(replace(role || chr(0) || text, '\', '\\'), '<s>', '<\s>'), '[INST]', '[\INST]'),
                   '[/INST]', '[\/INST]'), '</s>', '<\/s>')) AS chars FROM c),
        summed AS (
          SELECT *, pos = 1 AND role = 'system' AS is_system,
                 max(CASE WHEN pos = 1 AND role = 'system' THEN tokens ELSE 0 END) OVER v AS system_tokens,
                 max(CASE WHEN pos = 1 AND role = 'system' THEN chars ELSE 0 END) OVER v AS system_chars,
                 sum(CASE WHEN pos = 1 AND role = 'system' THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY pos) AS upto
          FROM counted WINDOW v AS (PARTITION BY conv_id)),
        dealt AS (SELECT *, greatest(416 - system_tokens, 128) AS room FROM summed),
        bucketed AS (SELECT *, (upto - tokens) // room AS low, (upto - 1) // room AS high FROM dealt),
        opened AS (
          SELECT *, CASE WHEN pos = 1 OR lag(is_system) OVER v THEN 0
                 WHEN low <> lag(low) OVER v OR high <> lag(high) OVER v THEN 1 ELSE 0 END AS opens
          FROM bucketed WINDOW v AS (PARTITION BY conv_id ORDER BY pos)),
        placed AS (SELECT *, sum(opens) OVER (PARTITION BY conv_id ORDER BY pos) AS place FROM opened),
        ended AS (
          SELECT *, max(upto) OVER (PARTITION BY conv_id, place) AS ends_at, max(place) OVER (PARTITION BY conv_id) AS last_place
          FROM placed),
        formatted AS (
          SELECT conv_id, CAST(sum(chars + CASE WHEN opens = 1 THEN system_chars ELSE 0 END
                 + CASE WHEN NOT is_system AND place < last_place AND ends_at - upto + tokens <= 96 THEN chars ELSE 0 END) AS BIGINT) AS formatted_chars
          FROM ended GROUP BY conv_id),
        told AS (
          SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
                 coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), '') AS loss
          FROM counted GROUP BY conv_id)
        SELECT told.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
        FROM told JOIN formatted ON told.conv_id IS NOT DISTINCT FROM formatted.conv_id""",
}
