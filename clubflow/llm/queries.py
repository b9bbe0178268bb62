"""The dealt operators as queries over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clubflow.llm import (
    chunked_bpe,
    conversation_repair,
    embedding_dedup,
    hard_negatives,
    html_extract,
    language_id,
    mixing,
    packing,
    phrase_fingerprint,
    quality,
    simhash_dedup,
    substring_dedup,
    suffix_dedup,
)
from clubflow.llm.common import documents


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "url", "text", "n_chars")


def op9_phrase_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_fingerprint.compare_edited(documents(spark, sf_dir))


def op10_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_bpe.encode(documents(spark, sf_dir)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"), damage=True)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    return hard_negatives.mine(rows.withColumn("label", hard_negatives.mislabelled(F.col("vec_id"), F.col("label"))))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup, op2_suffix_array_dedup, op3_language_id, op4_substring_dedup, op5_simhash_near_dedup,
        op6_quality_classifier, op7_packing, op8_html_extraction, op9_phrase_fingerprint, op10_chunked_bpe,
        op11_conversation_repair, op12_hard_negatives, op13_source_mixing, pipeline,
    )
}

#: Plain SQL for the same rows.
ORACLES: dict[str, str] = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE good AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach(node, other) AS (
    SELECT a, b FROM links
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
), root AS (
    SELECT node, least(node, min(other)) AS component_id FROM reach GROUP BY node
), counted AS (
    SELECT a AS node, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(r.component_id, e.vec_id) AS component_id,
       coalesce(r.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted c ON c.node = e.vec_id LEFT JOIN root r ON r.node = e.vec_id
""",
    "op2_suffix_array_dedup": """
WITH docs AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), chunks AS (
    SELECT doc_id, c, substr(h, 1024 * c + 1, 1024 + 398) AS part
    FROM (SELECT doc_id, h, unnest(range(0, length(h) // 1024 + 1)) AS c FROM docs)
), windows AS (
    SELECT doc_id, 512 * c + j AS i, md5(substr(part, 2 * j + 1, 400)) AS m
    FROM (SELECT doc_id, c, part, unnest(range(0, least(512, length(part) // 2 - 199))) AS j FROM chunks)
), repeated AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY m) > 1
), marked AS (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS opens FROM repeated
), runs AS (
    SELECT doc_id, min(i) AS b, max(i) + 200 AS e
    FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run
), before AS (
    SELECT r.doc_id, r.b, r.e, substr(d.h, 2 * p + 1, 2 * (r.b - p)) AS kept
    FROM (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS p FROM runs) r JOIN docs d ON d.doc_id = r.doc_id
), cut AS (
    SELECT doc_id, CAST(sum(e - b) AS BIGINT) AS n_removed, count(*) AS n_spans, max(e) AS e, string_agg(kept, '' ORDER BY b) AS kept
    FROM before GROUP BY doc_id
)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, coalesce(c.n_removed, 0) AS n_removed, coalesce(c.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(c.kept, '') || substr(d.h, 2 * coalesce(c.e, 0) + 1))) AS kept_sha256
FROM docs d LEFT JOIN cut c ON c.doc_id = d.doc_id
""",
    "op4_substring_dedup": r"""
WITH words AS (
    SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
), later AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1
), gone AS (
    SELECT DISTINCT doc_id, i + j AS i FROM later, (SELECT unnest(range(0, 20)) AS j)
), each_word AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words
), kept AS (
    SELECT e.doc_id, count(*) FILTER (g.i IS NOT NULL) AS n_removed,
           string_agg(e.word, ' ' ORDER BY e.i) FILTER (g.i IS NULL) AS t
    FROM each_word e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
""",
    "op11_conversation_repair": r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(
               list_concat([4294967295::BIGINT], list_transform(string_split(
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: ascii(ch)::BIGINT)),
               lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))
           ), 4294967295) % 20 AS damage
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN damage = 1 THEN '' WHEN damage = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN damage = 3 THEN 2 ELSE 1 END)) AS copy
    FROM keyed WHERE damage <> 0
), numbered AS (
    SELECT *, left(role, 1) AS initial, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(CAST(length(role) AS VARCHAR) || ':' || role || text), copy) AS i
    FROM damaged
), faulty AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                   WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 0 ELSE 3 END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
    FROM numbered
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
           count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
    FROM faulty GROUP BY conv_id
), inserted(p, r, cost, edits) AS (
    VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'),
           (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')
), written(r, letter, q) AS (
    VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)
), moves AS (
    SELECT f.conv_id, f.i, s.p, s.r AS q, s.cost + 4 AS cost, s.edits || 'D' AS edits FROM faulty f, inserted s
    UNION ALL
    SELECT f.conv_id, f.i, s.p, w.q, s.cost + f.fault, s.edits || 'K'
    FROM faulty f, inserted s JOIN written w ON w.r = s.r WHERE f.fault IN (0, 3) AND w.letter = f.initial
    UNION ALL
    SELECT f.conv_id, f.i, s.p, w.q, s.cost + f.fault + 3, s.edits || 'R'
    FROM faulty f, inserted s JOIN written w ON w.r = s.r WHERE f.fault IN (0, 3) AND w.letter IN ('u', 'a')
), reached AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, {'cost': CAST(0 AS BIGINT), 'audit': ''} AS best FROM counted
    UNION ALL
    SELECT m.conv_id, m.i, m.q, min({'cost': CAST(r.best.cost + m.cost AS BIGINT), 'audit': r.best.audit || m.edits}) AS best
    FROM reached r JOIN moves m ON m.conv_id IS NOT DISTINCT FROM r.conv_id AND m.i = r.i + 1 AND m.p = r.q
    GROUP BY m.conv_id, m.i, m.q
), closed(q, cost, edits) AS (
    VALUES (0, 0, ''), (3, 0, ''), (2, 3, 'I'), (1, 6, 'II')
), chosen AS (
    SELECT c.conv_id, min({'cost': CAST(r.best.cost + e.cost AS BIGINT), 'audit': r.best.audit || e.edits}) AS best
    FROM counted c JOIN reached r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.i = c.n JOIN closed e ON e.q = r.q
    GROUP BY c.conv_id
), letters AS (
    SELECT conv_id, pos, substr(best.audit, pos, 1) AS edit,
           length(replace(left(best.audit, pos), 'I', '')) AS i, length(replace(left(best.audit, pos), 'D', '')) AS place
    FROM (SELECT conv_id, best, unnest(range(1, length(best.audit) + 1)) AS pos FROM chosen)
), spoken AS (
    SELECT l.*, f.role, f.text, bool_or(l.place = 1 AND l.edit = 'K' AND f.initial = 's') OVER (PARTITION BY l.conv_id) AS system
    FROM letters l LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i AND l.edit <> 'I'
    WHERE l.edit <> 'D'
), joined AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - CAST(system AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END
                               || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS t
    FROM spoken GROUP BY conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(x.best.cost, 0) AS cost,
       coalesce(x.best.audit, '') AS audit, sha256(coalesce(j.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN chosen x ON x.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN joined j ON j.conv_id IS NOT DISTINCT FROM o.conv_id
""",
    "op12_hard_negatives": """
WITH whole AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
           CAST(embedding AS DOUBLE[]) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), v AS (
    SELECT vec_id, label, list_transform(e, lambda x: floor(256 * x)) AS v FROM whole
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
), positive AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
""",
    "op13_source_mixing": r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source,
           CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sized GROUP BY source
), shared(round, n, w) AS (
    SELECT 0, CAST(sum(source_size) AS HUGEINT), CAST(sum(w) AS HUGEINT) FROM sources
    UNION ALL
    SELECT * FROM (
        SELECT s.round + 1,
               (SELECT CAST(sum(source_size) AS HUGEINT) FROM sources)
                   - CAST(coalesce(sum(CASE WHEN 3 * x.source_size * s.w < s.n * x.w THEN 3 * x.source_size END), 0) AS HUGEINT) AS n,
               CAST(sum(CASE WHEN 3 * x.source_size * s.w < s.n * x.w THEN 0 ELSE x.w END) AS HUGEINT) AS left_w
        FROM shared s, sources x WHERE s.round < 100 GROUP BY s.round, s.n, s.w
        HAVING left_w <> s.w)
), last_round AS (
    SELECT n, w FROM shared ORDER BY round DESC LIMIT 1
), aimed AS (
    SELECT s.source, s.source_size,
           CASE WHEN 3 * s.source_size * l.w < l.n * s.w THEN CAST(3 * s.source_size AS DOUBLE)
                ELSE CAST(l.n * s.w AS DOUBLE) / CAST(l.w AS DOUBLE) END AS target
    FROM sources s, last_round l
), planned AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS times,
           CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) % source_size ELSE 0 END AS need
    FROM aimed
), by_hash AS (
    SELECT source, h, sum(size) AS amount,
           sum(sum(size)) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
    FROM sized GROUP BY source, h
)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, p.source_size, p.target,
       CAST(p.times * d.size + CASE WHEN b.upto <= p.need THEN d.size
                                    WHEN b.upto - b.amount < p.need THEN d.size * (p.need - b.upto + b.amount) // b.amount
                                    ELSE 0 END AS BIGINT) AS taken
FROM sized d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source
JOIN by_hash b ON b.source IS NOT DISTINCT FROM d.source AND b.h = d.h
""",
}
