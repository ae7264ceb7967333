"""Registered queries of this package: one per operator, over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.llm import audit, decontaminate, embeddings, language, licenses, lines, packing, pieces, quality, ranking, simhash, substrings, warc
from estrato.llm.common import crc_fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, CASE WHEN strlen(coalesce(html, '')) >= 1000 THEN max(page_id) OVER (PARTITION BY coalesce(html, '')) END AS keeper FROM pages
)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN keeper IS NULL OR page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM p
"""


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.removed_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT row_no, doc_id, s, array_to_string(w[s : s + 12], ' ') AS body
  FROM (SELECT row_no, doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM docs WHERE len(w) >= 13)
), later AS (
  SELECT row_no, s FROM windows JOIN (SELECT body, min(doc_id) AS least FROM windows GROUP BY body) USING (body) WHERE least < doc_id
), gone AS (
  SELECT DISTINCT row_no, unnest(range(s, s + 13)) AS p FROM later
), words AS (
  SELECT row_no, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs
), kept AS (
  SELECT row_no, string_agg(word, ' ' ORDER BY p) AS body FROM words ANTI JOIN gone USING (row_no, p) GROUP BY row_no
), lost AS (
  SELECT row_no, count(*) AS n FROM gone GROUP BY row_no
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_no) LEFT JOIN lost USING (row_no)
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, crc_fold("doc_id", 4) != 2)
    return language.with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.without_later_copies(docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS d, doc_id, text FROM documents
), raw AS (
  SELECT d, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM docs WHERE text IS NOT NULL
), filled AS (
  SELECT d, no, line, row_number() OVER (PARTITION BY d ORDER BY no) AS i FROM raw WHERE regexp_matches(line, '[^ \t\r\x0B\x0C]')
), pairs AS (
  SELECT a.d, a.i, a.line || chr(10) || b.line AS body FROM filled a JOIN filled b ON a.d = b.d AND b.i = a.i + 1
), later AS (
  SELECT d, i FROM pairs QUALIFY row_number() OVER (PARTITION BY body ORDER BY d, i) > 1
), gone AS (
  SELECT d, i FROM later UNION SELECT d, i + 1 FROM later
), marked AS (
  SELECT raw.d, raw.no, raw.line, filled.i, CASE WHEN filled.i IS NOT NULL THEN gone.i IS NOT NULL END AS g
  FROM raw LEFT JOIN filled USING (d, no) LEFT JOIN gone ON gone.d = raw.d AND gone.i = filled.i
), around AS (
  SELECT *, last_value(g IGNORE NULLS) OVER (PARTITION BY d ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before,
         first_value(g IGNORE NULLS) OVER (PARTITION BY d ORDER BY no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM marked
), counted AS (
  SELECT d, count(i) AS n_lines, count(*) FILTER (WHERE g) AS n_removed,
         string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT coalesce(g, coalesce(before, true) AND coalesce(after, true))) AS kept FROM around GROUP BY d
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(CASE WHEN coalesce(n_removed, 0) = 0 THEN coalesce(text, '') ELSE coalesce(kept, '') END) AS kept_sha256
FROM docs LEFT JOIN counted USING (d)
"""


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


OP5_SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS body
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM items WHERE len(w) > 0)
), starts AS (
  SELECT row_no, s, n, array_to_string(w[s : s + n - 1], ' ') AS body
  FROM (SELECT row_no, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (
  SELECT row_no, s, n, item_id FROM starts JOIN windows USING (n, body)
), hits AS (
  SELECT row_no, count(DISTINCT p) AS n_hit FROM (SELECT row_no, unnest(range(s, s + n)) AS p FROM found) GROUP BY row_no
), listed AS (
  SELECT row_no, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM found GROUP BY row_no
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row_no) LEFT JOIN listed USING (row_no)
"""


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), crc_fold("doc_id", 5) != 0)
    return quality.with_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op8_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = PIECE_MODEL) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encoded_texts(docs, model_path).select(
        "doc_id", "n_words", "n_pieces", "piece_ids", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.with_licenses(docs).select("doc_id", F.size("licenses").alias("n_matches"), "licenses", "coverages", "spans")


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), usable AS (
  SELECT * FROM rows WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= 0.93
), reach AS (
  SELECT r AS a, r AS b FROM rows UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
  SELECT a AS r, min(vec_id) AS component_id FROM reach JOIN rows ON rows.r = reach.b GROUP BY a
), counted AS (
  SELECT a AS r, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows JOIN least USING (r) LEFT JOIN counted USING (r)
"""


def op11_packing(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    import public_tokenizers

    found = packing.packed(table(spark, sf_dir, "documents"), tokenizer_path or public_tokenizers.path("word_bpe_49k.json"), ids=False)
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.best_documents(ranking.Index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), items AS (
  SELECT row_number() OVER () AS item, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark
), asked AS (
  SELECT DISTINCT item, item_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items
), sizes AS (
  SELECT row_no, count(*) AS n FROM docs GROUP BY row_no
), corpus AS (
  SELECT count(*) AS N_, CAST(sum(n) AS BIGINT) AS L FROM sizes
), counts AS (
  SELECT row_no, doc_id, term, count(*) AS tf FROM docs GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * N_ + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, corpus GROUP BY term, N_
), scores AS (
  SELECT item, item_id, row_no, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * N_) // L))))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (row_no), corpus GROUP BY item, item_id, row_no, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) <= 10
"""


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), failed AS (
  SELECT doc_id, part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS e
  FROM docs
), marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), rows AS (
  SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails,
         count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY 1, 2
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, filter_order[s] AS own, left(filter_order, s - 1) AS earlier FROM orders, range(1, 6) AS r(s)
), told AS (
  SELECT part, filter_order, step, own, n, good, toxic, contains(fails, own) AS f, fails = own AS only_own, translate(fails, earlier, '') <> fails AS before FROM rows, steps
), counted AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE NOT f AND NOT before), 0) AS kept, coalesce(sum(n) FILTER (WHERE f AND NOT before), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE f AND before), 0) AS redundant, coalesce(sum(n) FILTER (WHERE only_own), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE f AND NOT before), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE f AND NOT before), 0) AS toxic_lost
  FROM told GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_warc, op2_substring_dedup, op3_language_id, op4_line_dedup, op5_benchmark_decontamination, op6_simhash_near_dedup, op7_quality_classifier, op8_sentencepiece, op9_license_scan, op10_embedding_near_dedup, op11_packing, op12_ranked_search, op13_filter_interactions)}
ORACLE_SQL: dict[str, str] = {"op1_warc": OP1_SQL, "op2_substring_dedup": OP2_SQL, "op4_line_dedup": OP4_SQL, "op5_benchmark_decontamination": OP5_SQL, "op10_embedding_near_dedup": OP10_SQL, "op12_ranked_search": OP12_SQL, "op13_filter_interactions": OP13_SQL}
