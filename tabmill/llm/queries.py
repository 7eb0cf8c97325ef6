"""The operators of this folder as registered queries, and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.llm import binpieces, chat, codewords, collisions, covering, hostrules, lexicon, nbsvm, periods, slots, suffixes, threshold, vbyte
from tabmill.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Ids of the byte vocabulary, the special one included; the id that ends a document.
BYTE_BPE_IDS, END_ID = 50_257, 2
N_SHARDS = 40
#: A conversation whose texts are marks of the template.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one more (-1) whose texts are marks."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat.digest(chat.format_conversations(turns.unionByName(marks)))


def op2_nb_support_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = nbsvm.train(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", nbsvm.is_held_out(F.col("doc_id")).alias("held_out"), nbsvm.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = covering.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vbyte.store_corpus(_table(spark, sf_dir, "documents"), BYTE_BPE, END_ID, BYTE_BPE_IDS)
    return vbyte.read_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_collision_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = binpieces.pack(_table(spark, sf_dir, "documents"), WORD_BPE, END_ID)
    return sequences.select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrules.judge(_table(spark, sf_dir, "documents")).drop("host")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = slots.shard_documents(_table(spark, sf_dir, "documents"), N_SHARDS, scratch_path(spark, "slot-map"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"),
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffixes.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return cleaned.select(
        "row.doc_id", (F.octet_length("kept") + removed).alias("n_bytes"), removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.digest_documents(_table(spark, sf_dir, "documents"), BYTE_BPE)


def _with_periods(docs: DataFrame) -> DataFrame:
    """The documents; of those whose checksum ends in 0 the words from some place on begin again and again."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    step = F.floor(checksum / 10)

    def again(words):
        n = F.greatest(F.size(words), F.lit(1)).cast("long")
        first = step % n
        period = 1 + F.floor((n - first) / (3 + step % 8))
        return F.array_join(F.transform(words, lambda w, i: F.when(i < first, w).otherwise(F.get(words, (first + (i - first) % period).cast("int")))), " ")

    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # the one element of the outer array names the words, so a text is split once
    return docs.select("doc_id", F.when(checksum % 10 == 0, F.transform(F.array(words), again)[0]).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(_with_periods(_table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), F.array_join(line, "").alias("lines"), longest.alias("best"))
    length, period = F.col("best.length"), -F.col("best.col3")
    return best.select(
        "doc_id", "n_runs", (-F.col("best.col2")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codewords.identify(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id 7 divides count for the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return threshold.hard_negatives(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label")))


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_nb_support_vectors": op2_nb_support_vectors,
    "op3_covering_simhash": op3_covering_simhash,
    "op4_token_files": op4_token_files,
    "op5_collision_vectors": op5_collision_vectors,
    "op6_packing": op6_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_sharding": op8_sharding,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_transducer_bpe": op10_transducer_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_language_codes": op12_language_codes,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL = {
    "op1_chat_formatting": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
        ), marked AS (
            SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
                regexp_replace(text, '(\\|</?s>|\[/?INST\])', '\\\1', 'g') AS safe,
                regexp_replace(role, '(\\|</?s>|\[/?INST\])', '\\\1', 'g') AS safe_role
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            sum(length('[INST] ') + length(safe) + length(' [/INST]')
                + CASE WHEN before IS DISTINCT FROM role THEN length('<s>') + length(safe_role) + 1 + length('</s>') ELSE 0 END
            )::BIGINT AS formatted_chars
        FROM marked GROUP BY conv_id""",
    "op7_quality_rules": r"""
        WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
        words AS (
            SELECT doc_id, u.word, u.pos FROM texts,
                LATERAL (SELECT unnest(w) AS word, generate_subscripts(w, 1) AS pos
                         FROM (SELECT regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w)) u
        ), windows AS (
            SELECT doc_id, pos, word || ' ' || lead(word) OVER d || ' ' || lead(word, 2) OVER d AS win
            FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
        ), again AS (
            SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows WHERE win IS NOT NULL) WHERE n > 1
        ), covered AS (
            SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, pos + d AS pos FROM again, (VALUES (0), (1), (2)) t(d)) GROUP BY doc_id
        ), lines AS (
            SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
        ), counted AS (
            SELECT t.doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS n_words,
                length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
            FROM texts t LEFT JOIN covered c USING (doc_id) LEFT JOIN lines USING (doc_id)
        ), failed AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS f1, 10 * n_symbols > n_words AS f2,
                10 * n_dup_lines > 3 * n_lines AS f3, word_chars > 10 * n_words OR word_chars < 3 * n_words AS f4
            FROM counted
        ), rates AS (
            SELECT source, count(*) AS n, unnest([1, 2, 3, 4]) AS rule,
                unnest([sum(f1::INT), sum(f2::INT), sum(f3::INT), sum(f4::INT)]) AS bad
            FROM failed WHERE source IS NOT NULL GROUP BY source
        ), prior AS (
            SELECT rule, avg(bad / n) AS m, var_pop(bad / n) AS v FROM rates GROUP BY rule
        ), verdicts AS (
            SELECT source, max((bad + m * w) / (n + w)) > 0.5 AS rejected
            FROM rates JOIN (SELECT rule, m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 10000 END, 1), 10000) AS w FROM prior) USING (rule)
            GROUP BY source
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 AS base_failed,
            NOT f1 AND NOT coalesce(rejected, false) AS kept
        FROM failed LEFT JOIN verdicts USING (source)""",
    "op13_hard_negatives": """
        WITH whole AS (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
            FROM whole a JOIN whole b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.q) = len(b.q)
        ), positives AS (
            SELECT anchor, other, score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
        )
        SELECT p.anchor AS anchor_id, p.other AS positive_id,
            row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other)::INT AS rank,
            n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
        QUALIFY rank <= 10""",
}
