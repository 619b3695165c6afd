"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm import (
    chat,
    filter_audit,
    licences,
    mixing,
    near_duplicates,
    packing,
    quality,
    repeated_spans,
    suffix_repeats,
    top_scores,
    toxicity,
    vector_links,
    whitening,
)
from lodeworks.llm.common import held_out, table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.array_join("licences", " ").alias("licences"), "sentence_ids", F.array_join("unmatched", " ").alias("unmatched")
    )


def op2_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.link_vectors(table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        "toxic_terms",
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op6_top_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores.top_scores(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.3).cast("int").alias("predicted"),
    )


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], turns.schema)
    return chat.digests(chat.windows(turns.union(planted), BYTE_TOKENIZER))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = repeated_spans.remove_repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_sentences", "n_removed", "text")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "lang", "text", "mix_copy", "mix_key")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_repeats.remove_repeats(table(spark, sf_dir, "documents"), 100)
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("rest", 256).alias("kept_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


OP6_SQL = """
    WITH vectors AS (
        SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    WHERE rank <= 20"""


def _op1_sql() -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def replaced(column: str, steps) -> str:
        for pattern, to in steps:
            pattern, to = pattern.replace("\r", "\\r").replace("\n", "\\n").replace("\t", "\\t"), to.replace("$", "\\")
            column = f"regexp_replace({column}, {quoted(pattern)}, {quoted(to)}, 'g')"
        return column

    cut = licences.CUT.replace("\n", "\\n").replace("\t", "\\t")
    known = ", ".join(f"({n}, {quoted(text)}, {quoted(name)})" for n, (text, name) in enumerate(licences.SENTENCES))
    matched = "' ' || replace(ids, ' ', '  ') || ' '"
    for sequence, licence in licences.RULES:
        matched = f"replace({matched}, ' {sequence.replace(' ', '  ')} ', ' ={licence} ')"
    return f"""
    WITH known(n, sentence, name) AS (VALUES {known}),
    texts AS (SELECT doc_id, lower(text) AS low FROM documents),
    parts AS (
        SELECT doc_id, regexp_split_to_array({replaced("low", licences.UNFOLD)}, {quoted(cut)}) AS parts
        FROM texts WHERE regexp_matches(low, '{licences.TRIGGER}')),
    cut AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM parts),
    split AS (SELECT doc_id, pos, string_split(part, chr(9)) AS raw FROM cut WHERE regexp_matches(part, '{licences.TRIGGER}')),
    pieces AS (SELECT doc_id, pos, unnest(raw) AS piece, generate_subscripts(raw, 1) AS place FROM split),
    plain AS (SELECT doc_id, pos, place, {replaced("piece", licences.NORMALISE)} AS line FROM pieces),
    sentences AS (SELECT doc_id, pos, list(line ORDER BY place) AS lines FROM plain WHERE line <> '' GROUP BY doc_id, pos),
    ends AS (SELECT *, unnest(range(1, len(lines) + 1)) AS j FROM sentences),
    starts AS (
        SELECT *, unnest(range(greatest(1, j - {licences.MOST_LINES - 1}), j + 1)) AS i
        FROM ends WHERE regexp_matches(lines[j], {quoted(licences.LAST)})),
    runs AS (
        SELECT doc_id, pos, j, array_to_string(lines[i:j], ' ') AS run, length(array_to_string(lines[1:j], ' ')) AS stop
        FROM starts WHERE i = 1 OR NOT regexp_matches(lines[i - 1], '\\b({licences.NEGATION})( [a-z0-9.]+)?$')),
    found AS (
        SELECT doc_id, pos, j, stop, n, name, length(sentence) AS size, rtrim(left(run, length(run) - length(sentence)), ' ') AS lead
        FROM runs JOIN known ON ends_with(' ' || run, ' ' || sentence)),
    hits AS (
        SELECT doc_id, pos, j, stop, min_by(name, n) AS name, stop - min_by(size, n) AS start
        FROM found
        WHERE lead = '' OR (regexp_matches(lead, {quoted(licences.LEAD)}) AND NOT regexp_matches(lead, '\\b({licences.NEGATION})\\b'))
        GROUP BY doc_id, pos, j, stop),
    sequences AS (
        SELECT doc_id, string_agg(name, ' ' ORDER BY pos, j) AS ids
        FROM hits h WHERE NOT EXISTS (
            SELECT 1 FROM hits o WHERE o.doc_id = h.doc_id AND o.pos = h.pos AND o.stop > h.stop AND o.start < h.stop)
        GROUP BY doc_id),
    matched AS (SELECT doc_id, ids, string_split_regex(trim({matched}), ' +') AS parts FROM sequences),
    licensed AS (
        SELECT doc_id, string_agg(licence, ' ' ORDER BY place) AS licences
        FROM (SELECT doc_id, licence, min(pos) AS place
              FROM (SELECT doc_id, substr(unnest(parts), 2) AS licence, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos
                    FROM matched) WHERE part LIKE '=%' GROUP BY doc_id, licence)
        GROUP BY doc_id)
    SELECT d.doc_id, coalesce(l.licences, '') AS licences, coalesce(m.ids, '') AS sentence_ids,
           coalesce(array_to_string(list_filter(m.parts, lambda x: x <> '' AND x NOT LIKE '=%'), ' '), '') AS unmatched
    FROM documents d LEFT JOIN matched m ON m.doc_id = d.doc_id LEFT JOIN licensed l ON l.doc_id = d.doc_id"""


OP10_SQL = """
    WITH sources AS (
        SELECT source, count(*) AS n, power(count(*), 0.7) AS weight FROM documents GROUP BY source),
    means AS (
        SELECT source, weight / sum(weight) OVER () * sum(n) OVER () / n AS mean FROM sources),
    terms AS (
        SELECT source, k, exp(-mean + k * ln(mean) - lgamma(k + 1)) AS p
        FROM means, generate_series(0, 200) AS g(k)),
    upto AS (
        SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
    drawn AS (
        SELECT doc_id, source,
               (CAST(('0x' || substr(md5('17:1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 0.5)
                   / 4503599627370496.0 AS u
        FROM documents),
    copies AS (
        SELECT doc_id, count(*) FILTER (WHERE c < u) AS n
        FROM drawn JOIN upto USING (source) GROUP BY doc_id)
    SELECT d.doc_id, d.source, d.lang, d.text, CAST(c.k AS INTEGER) AS mix_copy,
           md5('17:order:' || CAST(d.doc_id AS VARCHAR) || ':' || CAST(c.k AS VARCHAR)) AS mix_key
    FROM documents d JOIN (SELECT doc_id, unnest(generate_series(1, n)) AS k FROM copies) c USING (doc_id)"""

OP11_SQL = r"""
    WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
    marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    failed AS (
        SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
               CAST(len(w) < 100 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INTEGER)
               + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS INTEGER)
               + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
               + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INTEGER) AS fails
        FROM words LEFT JOIN marks USING (doc_id)),
    counted AS (
        SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic
        FROM failed GROUP BY part, fails),
    letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    orders AS (
        SELECT p.l || q.l || r.l || s.l || t.l AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
        FROM letters p, letters q, letters r, letters s, letters t
        WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND (p.bit | q.bit | r.bit | s.bit | t.bit) = 31),
    steps AS (
        SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS own,
               CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS earlier
        FROM orders, generate_series(1, 5) AS g(step)),
    sums AS (
        SELECT part, filter_order, step, own,
               sum(n) FILTER (WHERE (fails & (earlier | own)) = 0) AS kept,
               sum(n) FILTER (WHERE (fails & earlier) = 0 AND (fails & own) > 0) AS removed,
               sum(n) FILTER (WHERE (fails & earlier) > 0 AND (fails & own) > 0) AS redundant,
               sum(n) FILTER (WHERE fails = own) AS unique_fails,
               sum(n_good) FILTER (WHERE (fails & earlier) = 0 AND (fails & own) > 0) AS good_lost,
               sum(n_toxic) FILTER (WHERE (fails & earlier) = 0 AND (fails & own) > 0) AS toxic_lost
        FROM counted, steps GROUP BY part, filter_order, step, own)
    SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
           CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
           CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
           CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
    FROM sums"""

QUERIES = {
    "op1_license_scan": (op1_license_scan, _op1_sql()),
    "op2_embedding_links": (op2_embedding_links, None),
    "op3_toxicity": (op3_toxicity, None),
    "op4_best_fit_packing": (op4_best_fit_packing, None),
    "op5_minhash_near_dedup": (op5_minhash_near_dedup, None),
    "op6_top_scores": (op6_top_scores, OP6_SQL),
    "op7_quality": (op7_quality, None),
    "op8_chat_windows": (op8_chat_windows, None),
    "op9_substring_dedup": (op9_substring_dedup, None),
    "op10_source_mixing": (op10_source_mixing, OP10_SQL),
    "op11_filter_audit": (op11_filter_audit, OP11_SQL),
    "op12_suffix_dedup": (op12_suffix_dedup, None),
    "op13_embedding_whitening": (op13_embedding_whitening, None),
}
