"""One registered query per operator, with production parameters over whole
tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, collocation, decontaminate, html, language, linededup, mixing, neardup, quality, sharding, toxicity, warc, whitening
from .common import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return (warc.read_records(spark, archive, warc.read_index(spark, archive))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("doc_id", F.col("deduped").alias("text"), F.col("n_removed").cast("long").alias("n_removed")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_html_extraction, op2_language_id, op3_warc, op4_mixing, op5_minhash, op6_decontamination,
                                    op7_ann, op8_quality, op9_toxicity, op10_line_dedup, op11_collocations, op12_whitening, op13_sharding)}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


_NEARDUP_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words('text', '[^ \\t-\\r]+')} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

_LEAKS_SQL = f"""
WITH d AS (SELECT doc_id, {_words('text', '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')} AS w FROM documents),
b AS (SELECT item_id, {_words('text', '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
       FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
h AS (SELECT doc_id, item_id, i, k FROM dw JOIN bw USING (k, s)),
n AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, n.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""

_WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
q AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (((('0x' || substr(hex, (i // 4 * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - i % 4 * 5)) & 31) + 1)::BIGINT, 1)), '') AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM f
"""

_PHRASES_SQL = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\n\\x0B\\x0C\\r]')) AS t FROM d),
w AS (SELECT lang, regexp_extract_all(t, '[^ \\t]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, s, count(*) AS a FROM (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(s, ' ') AS w FROM g WHERE k >= 2),
x AS (SELECT c.lang, c.s, c.a, j, l.a AS l, r.a AS r, n.n, ((1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a))::BIGINT AS score
      FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN n ON n.lang = c.lang
      JOIN g l ON l.lang = c.lang AND l.s = array_to_string(list_slice(c.w, 1, j), ' ')
      JOIN g r ON r.lang = c.lang AND r.s = array_to_string(list_slice(c.w, j + 1, c.k), ' ')),
cut AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, j) = 1),
part AS (SELECT lang, array_to_string(list_slice(w, i, i + m - 1), ' ') AS s, max(a) AS of
         FROM (SELECT lang, w, a, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL),
kept AS (SELECT cut.* FROM cut LEFT JOIN part ON part.lang = cut.lang AND part.s = cut.s WHERE part.of IS NULL OR 100 * part.of < 100 * cut.a)
SELECT lang, rank, s AS phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank FROM kept) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_collocations": _PHRASES_SQL, "op3_warc": _WARC_SQL, "op5_minhash": _NEARDUP_SQL, "op6_decontamination": _LEAKS_SQL}
