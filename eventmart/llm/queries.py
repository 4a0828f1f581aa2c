"""The operators as queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.exact_dedup import exact_dedup
from eventmart.llm.language_id import language_id
from eventmart.llm.line_dedup import line_dedup
from eventmart.llm.metric_tree import top_k
from eventmart.llm.mixing import mix_plan
from eventmart.llm.neighbours import nearest
from eventmart.llm.ngram_join import ngram_join
from eventmart.llm.periodic_runs import periodic_runs
from eventmart.llm.pieces import encode
from eventmart.llm.prefix_trie import prefix_trie
from eventmart.llm.quality import quality
from eventmart.llm.toxicity import toxicity
from eventmart.llm.url_filter import url_filter

#: The vocabulary of the piece queries.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    scored = quality(docs, _table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    ids = F.sha2(F.array_join("ids", " ").cast("binary"), 256)
    coded = encode(docs, PIECE_MODEL, round_trip="round_trip")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), ids.alias("pieces_sha256"), "round_trip")


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return exact_dedup(docs, carry=[]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", digest)


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mix_plan(docs).select("doc_id", "size", "source_size", "target", taken)


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return url_filter(pages).select("page_id", "host", "path", "rule", "verdict")


def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join(_table(spark, folder, "documents").select("doc_id", "text"))


def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity(docs, _table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language_id(docs).select("doc_id", "held_out", "lang_pred", "score")


def op11_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(_table(spark, folder, "conversations"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = periodic_runs(docs, plant=True)
    digest = F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", digest)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_pieces": op2_pieces,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_mixing": op5_mixing,
    "op6_url_filter": op6_url_filter,
    "op7_ngram_join": op7_ngram_join,
    "op8_neighbours": op8_neighbours,
    "op9_toxicity": op9_toxicity,
    "op10_language_id": op10_language_id,
    "op11_top_k": op11_top_k,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE = {
    "op3_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS chars FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(chars) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY chars)
    """,
    "op4_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), places AS (
            SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM lines
        ), keys AS (
            SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM places
        ), shared AS (
            SELECT key FROM keys WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        )
        SELECT doc_id, count(*) AS n_lines, count(shared.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE shared.key IS NULL), ''))
                   AS kept_sha256
        FROM keys LEFT JOIN shared ON keys.key = shared.key
        GROUP BY doc_id
    """,
    "op5_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS weight
            FROM d GROUP BY source
        ), sorted AS (
            SELECT *, row_number() OVER (ORDER BY 2 * source_size / weight, source) AS spot,
                   sum(source_size) OVER () AS total
            FROM s
        ), levels AS (
            SELECT a.spot, (1.5 * CAST(any_value(a.total) AS DOUBLE)
                          - CAST(coalesce(sum(2 * b.source_size) FILTER (WHERE b.spot < a.spot), 0) AS DOUBLE))
                         / CAST(sum(b.weight) FILTER (WHERE b.spot >= a.spot) AS DOUBLE) AS per_weight,
                   any_value(2 * a.source_size) AS own_limit, any_value(a.weight) AS own_weight
            FROM sorted a, sorted b GROUP BY a.spot
        ), level AS (
            SELECT min_by(per_weight, spot) AS per_weight FROM levels WHERE own_weight * per_weight <= own_limit
        ), rates AS (
            SELECT source, source_size, least(weight * per_weight, CAST(2 * source_size AS DOUBLE)) AS target FROM s, level
        ), drawn AS (
            SELECT d.doc_id, d.size, r.source_size, r.target,
                   CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0 END AS rate,
                   CAST('0x' || substr(md5(concat(d.doc_id, ':mix')), 1, 13) AS BIGINT) / 4503599627370496.0 AS draw
            FROM d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
        )
        SELECT doc_id, size, source_size, target,
               CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM drawn
    """,
    "op11_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
        ), pairs AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.x, v.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op12_prefix_trie": r"""
        WITH numbered AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % 20 AS base,
                   xor(list_reduce(list_concat([4294967295], flatten(list_transform(
                           string_split(CAST(conv_id AS VARCHAR), ''),
                           lambda x: list_transform(range(8), lambda i: (ascii(x) >> i) & 1)))),
                       lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 4 AS h
            FROM (SELECT DISTINCT conv_id FROM numbered)
        ), turns AS (
            SELECT c.conv_id, 0 AS part, n.place, concat(len(n.role), ':', n.role, n.text) AS turn,
                   len(regexp_extract_all(n.text, '[^\x20\x09-\x0D]+')) AS words
            FROM convs c JOIN numbered n ON n.conv_id = c.base AND n.place < c.h
            UNION ALL
            SELECT c.conv_id, 1, n.place, concat(len(n.role), ':', n.role, n.text), len(regexp_extract_all(n.text, '[^\x20\x09-\x0D]+'))
            FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.place >= c.h
        ), whole AS (
            SELECT conv_id, coalesce(list(turn ORDER BY part, place) FILTER (WHERE turn IS NOT NULL), []) AS seq,
                   coalesce(list(words ORDER BY part, place) FILTER (WHERE turn IS NOT NULL), []) AS words
            FROM convs LEFT JOIN turns USING (conv_id) GROUP BY conv_id
        ), prefixes AS (
            SELECT conv_id, unnest(range(len(seq) + 1)) AS d, seq, words FROM whole
        ), nodes AS (
            SELECT seq[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n,
                   CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * any_value(words[d]) END AS own,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = len(seq)), '')) AS ends
            FROM prefixes GROUP BY seq[1:d], d
        ), children AS (
            SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY p[1:d - 1]
        ), marked AS (
            SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children ON nodes.p = children.p
        ), above AS (
            SELECT p, unnest(range(d + 1)) AS k, own, n_children FROM marked
        ), sums AS (
            SELECT p[1:k] AS p, CAST(sum(own) AS BIGINT) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
            FROM above GROUP BY p[1:k]
        )
        SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, m.n AS n_convs, m.n_children,
               s.leaves AS n_leaves, s.saved AS saved_tokens, m.ends AS ends_sha256
        FROM marked m JOIN sums s ON m.p = s.p LEFT JOIN nodes up ON m.d > 0 AND up.p = m.p[1:m.d - 1]
    """,
}
