"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm import bpe, centroids, chat, decontaminate, htmltext, langid, linededup, negatives, quality, secrets, simhash, toxicity, warc
from docketry.sources.files import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op2_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.near_duplicate_groups(table(spark, sf_dir, "documents"), "doc_id", "text", words=4, radius=4, carry=["doc_id"])
    return grouped.select("doc_id", simhash.hex_bits(F.col("simhash.bits")).alias("fingerprint"), F.col("simhash.component_id").alias("component_id"))


DECONTAMINATION_SQL = r"""
WITH dw AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents
), iw AS (
    SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark
), win AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM iw WHERE len(w) > 0)
), spot AS (
    SELECT d.doc_id, d.i, s.size, array_to_string(d.w[d.i:d.i + s.size - 1], ' ') AS gram
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM dw WHERE len(w) > 0) d
    CROSS JOIN (SELECT DISTINCT size FROM win) s
    WHERE d.i + s.size - 1 <= len(d.w)
), hit AS (
    SELECT spot.doc_id, spot.i, spot.size, win.item_id FROM spot JOIN win ON spot.gram = win.gram AND spot.size = win.size
), words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM hit) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id
)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op3_benchmark_decontamination", DECONTAMINATION_SQL)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    hit, ids = F.col("contamination.n_hit"), F.col("contamination.item_ids")
    return found.select(
        "doc_id",
        F.col("contamination.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("contamination.n_words"))).alias("contaminated"),
    )


@query("op5_byte_level_bpe")
def byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = bpe.round_trip(table(spark, sf_dir, "documents"), "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, carry=["doc_id"])
    return made.select("doc_id", "tokens.n_tokens", "tokens.ids_sha256", "tokens.decoded_sha256")


QUALITY_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '<null>') AS host, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), grams AS (
    SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS gram FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) >= 8)
), twice AS (
    SELECT doc_id, gram FROM grams GROUP BY doc_id, gram HAVING count(*) > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM grams JOIN twice USING (doc_id, gram)) GROUP BY doc_id
), lines AS (
    SELECT doc_id, host, line,
        list_filter(string_split_regex(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS lw
    FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM d)
), kept_lines AS (
    SELECT doc_id, host, line, array_to_string(lw, ' ') AS norm, len(lw) AS n FROM lines WHERE len(lw) > 0
), dups AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM kept_lines GROUP BY doc_id
), frequent AS (
    SELECT host, norm FROM kept_lines GROUP BY host, norm HAVING count(DISTINCT doc_id) > 100
), gone AS (
    SELECT doc_id, sum(n) AS n FROM kept_lines JOIN frequent USING (host, norm) GROUP BY doc_id
), m AS (
    SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(dups.n, 0)::BIGINT AS n_dup_lines,
        coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS gone
    FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (gone > 0 AND (n_words - gone < 10 OR 100 * (n_words - gone) < 30 * n_words)) AS kept
FROM m
"""


@query("op6_quality_rules", QUALITY_SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = quality.judged(table(spark, sf_dir, "documents"), "source", "text", carry=["doc_id"])
    return made.select("doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


WARC_SQL = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query("op4_warc", WARC_SQL)
def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(table(spark, sf_dir, "pages"), warc.archive_folder(spark), "page_id", "url", "html")
    page = lambda c: F.regexp_extract(c, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")
    return warc.read(files, payloads=False).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )


CHAT_SQL = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *, length(text) + length(regexp_replace(text, '[^\\\\\\[<]', '', 'g')) AS text_chars, length(role) + length(regexp_replace(role, '[^\\\\\\[<]', '', 'g')) AS role_chars,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place
    FROM said
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(text_chars + CASE role WHEN 'assistant' THEN 10 WHEN 'user' THEN 15 + CASE place WHEN 1 THEN 3 ELSE 0 END WHEN 'system' THEN 13 ELSE 22 + role_chars END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op9_chat_formatting", CHAT_SQL)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(rows.unionByName(added), "conv_id", "turn", "role", "text")
    return chat.digests(formatted).withColumnRenamed("conv", "conv_id")


@query("op7_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    model = langid.fit(docs, "text", "lang", "doc_id", learnable=remainder != 1)
    made = langid.predict(docs, "text", model, carry=["doc_id"])
    return made.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


@query("op8_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic", learnable=remainder != 2)
    made = toxicity.score(docs, "text", machine, carry=["doc_id"])
    value = F.col("toxicity.score")
    return made.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), value.alias("score"), (value >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query("op10_secret_scans")
def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = secrets.scan(table(spark, sf_dir, "documents"), "doc_id", "text", carry=["doc_id"])
    base, spans = F.col("secrets.base"), F.col("secrets.spans")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return made.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(spans).alias("spans"),
    )


@query("op1_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.visible_text(table(spark, sf_dir, "pages"), "html", carry=["page_id"]).select("page_id", "page.title", "page.text")


NEGATIVES_SQL = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
    s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, F.col("vec_id") % 100 == 0)


LINES_SQL = r"""
WITH l AS (
    SELECT doc_id, i, lines[i] AS line,
        translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
), frequent AS (
    SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(frequent.key) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (frequent.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN frequent USING (key) GROUP BY doc_id
"""


@query("op12_line_dedup", LINES_SQL)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = linededup.dedup(table(spark, sf_dir, "documents"), "text", min_docs=10, min_chars=1, keep_first=False, carry=["doc_id"])
    return made.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.text", 256).alias("kept_sha256"))


def _centroids_sql(k: int, rounds: int) -> str:
    near = """SELECT vec_id, v, number AS cluster, d FROM (
        SELECT e.vec_id, e.v, c.number, (list_inner_product(e.v, e.v) - 2 * list_inner_product(e.v, c.v) + list_inner_product(c.v, c.v))::BIGINT AS d
        FROM e CROSS JOIN c{0} c
    ) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, number) = 1"""
    moved = """SELECT c.number, coalesce(m.v, c.v) AS v FROM c{0} c LEFT JOIN (
        SELECT cluster, list(mean ORDER BY pos) AS v FROM (
            SELECT cluster, pos, floor(sum(v[pos])::DOUBLE / count(*)) AS mean FROM a{0}, (SELECT unnest(generate_series(1, 64)) AS pos) GROUP BY cluster, pos
        ) GROUP BY cluster
    ) m ON m.cluster = c.number"""
    parts = [
        """e AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS number, v FROM (SELECT sha256('2:' || vec_id) AS h, v FROM e ORDER BY h LIMIT {k}))""",
    ]
    for i in range(rounds):
        parts += [f"a{i} AS MATERIALIZED ({near.format(i)})", f"c{i + 1} AS MATERIALIZED ({moved.format(i)})"]
    parts.append(f"a AS MATERIALIZED ({near.format(rounds)})")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, cluster::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(list_transform(c.v, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a JOIN c{rounds} c ON c.number = a.cluster"""


@query("op13_centroid_clustering", _centroids_sql(40, 5))
def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    made = centroids.cluster(table(spark, sf_dir, "embeddings"), "embedding", order, k=40, rounds=5, carry=["vec_id"])
    return made.select("vec_id", *[f"centroid.{c}" for c in ("cluster", "distance", "cluster_inertia", "inertia")], F.sha2(F.array_join("centroid.components", ","), 256).alias("centroid_sha256"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
