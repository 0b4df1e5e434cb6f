"""Registered queries of this subpackage: each runs one operator over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.llm import centroid_clustering as _centroids
from lakesmith.llm import decontaminate as _decontaminate
from lakesmith.llm import exact_dedup as _exact
from lakesmith.llm import hard_negatives as _negatives
from lakesmith.llm import html_extract as _html
from lakesmith.llm import language_id as _language
from lakesmith.llm import ngram_join as _ngram
from lakesmith.llm import piece_encoding as _pieces
from lakesmith.llm import quality as _quality
from lakesmith.llm import secret_scan as _secrets
from lakesmith.llm import substring_dedup as _substring
from lakesmith.llm import toxicity as _toxicity
from lakesmith.llm import url_filter as _url


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    return _toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), categories)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _language.language_id(_table(spark, sf_dir, "documents"))


#: a public tokenizer's model, never copied into the repository
PIECE_MODEL = os.environ.get("LAKESMITH_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = _pieces.load_pieces(PIECE_MODEL)
    encoded = _pieces.encode(_table(spark, sf_dir, "documents"), pieces, keep=["doc_id"]).select("row.doc_id", "ids")
    decoded = _pieces.decode(encoded, pieces, keep=["doc_id", "ids"])
    return decoded.select("row.doc_id", F.size("row.ids").cast("long").alias("n_pieces"), "row.ids", F.sha2("text", 256).alias("decoded_sha256"))


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _url.url_filter(_table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "score")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _exact.exact_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, d AS text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS d FROM documents)
WINDOW w AS (PARTITION BY d)
"""


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _substring.substring_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
hit AS (SELECT win.doc_id, win.i FROM win JOIN (SELECT s, min(doc_id) AS least FROM win GROUP BY s) m ON win.s = m.s WHERE m.least < win.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM hit),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (SELECT words.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS t FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ngram.ngram_jaccard_join(_table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + least(5, len(w)) - 1], ' ')) AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
p AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS doc_id, a AS c FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.c, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) m USING (doc_id)
"""


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    listed = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
o AS (SELECT DISTINCT dw.doc_id, dw.i, dw.n, p.item_id FROM dw JOIN p ON dw.win = p.win AND dw.n = p.n),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM o) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS listed FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM o) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(t.listed, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = {"source": F.col("source"), "lang": F.col("lang"), "size": F.floor(F.log2(F.greatest(F.col("n_chars"), F.lit(1)))).cast("string")}
    return _quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), F.col("quality") == 1, meta)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _html.html_extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


CLUSTERS, ROUNDS = 40, 5


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _centroids.centroid_clustering(_table(spark, sf_dir, "embeddings"), dims=64, clusters=CLUSTERS, rounds=ROUNDS, salt="2")


def _op11_sql() -> str:
    """Each round spelled out: nearest centroid by ``(distance, number)``, then exact floors of the means."""
    nearest = "SELECT i, v, min({{'d': list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'k': k}}) AS best FROM v, c{n} GROUP BY i, v"
    parts = [
        "w AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        "WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = 64)",
        "v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, v) AS i, vec_id, v FROM w)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM (SELECT sha256('2:' || vec_id) AS h, v FROM v ORDER BY h, v LIMIT {CLUSTERS}))",
    ]
    for n in range(ROUNDS + 1):
        parts.append(f"a{n} AS MATERIALIZED ({nearest.format(n=n)})")
        if n < ROUNDS:
            parts.append(
                f"m{n} AS MATERIALIZED (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY place) AS c FROM "
                f"(SELECT best.k AS k, place, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM (SELECT best, unnest(v) AS x, unnest(range(64)) AS place FROM a{n}) GROUP BY 1, 2) GROUP BY k)"
            )
            parts.append(f"c{n + 1} AS MATERIALIZED (SELECT k, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (k))")
    last = ROUNDS
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT v.vec_id, a.best.k::INTEGER AS cluster, a.best.d AS distance, (sum(a.best.d) OVER (PARTITION BY a.best.k))::BIGINT AS cluster_inertia,
       (sum(a.best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{last} a JOIN v USING (i) JOIN c{last} c ON c.k = a.best.k
"""
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", label)
    return _negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=5, share=(80, 100))


OP12_SQL = """
WITH e AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT p.*, other AS negative_id, score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _secrets.secret_scan(_table(spark, sf_dir, "documents"))
    base = [r.name for r in _secrets.BASE]

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(listed(of(*base)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def _op13_sql() -> str:
    """Matches and the pieces between them give the offsets; letters in either case by lower-casing A-Z, which keeps offsets."""
    rules, base = (*_secrets.BASE, *_secrets.MORE), len(_secrets.BASE)
    parts = ["d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS f FROM documents)"]
    for n, rule in enumerate(rules):
        text, pattern = ("f", rule.pattern.replace("A-Za-z", "a-z")) if rule.fold else ("t", rule.pattern)
        pattern = "'" + pattern.replace("'", "''") + "'"
        parts.append(
            f"x{n} AS (SELECT r, string_split_regex({text}, {pattern}) AS p, regexp_extract_all({text}, {pattern}) AS m, regexp_extract_all({text}, {pattern}, {rule.group}) AS g FROM d),\n"
            f"y{n} AS (SELECT r, {n} AS n, '{rule.name}' AS kind, i, m, g, coalesce(list_sum(list_transform(p[1:i], lambda s: len(s))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda s: len(s))), 0) AS a "
            f"FROM (SELECT r, p, m, g, unnest(range(1, len(m) + 1)) AS i FROM x{n})),\n"
            f"z{n} AS (SELECT r, n, kind, a::BIGINT AS a, (a + len(m[i]))::BIGINT AS b FROM y{n} WHERE len(g[i]) >= {rule.least})"
        )
    parts.append("s AS (" + " UNION ALL ".join(f"FROM z{n}" for n in range(len(rules))) + ")")
    counts = ", ".join(f"(count(*) FILTER (WHERE n = {n}))::BIGINT AS n_{rule.name}" for n, rule in enumerate(_secrets.BASE))
    listed = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, n)"
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, {counts}, sha256(coalesce({listed} FILTER (WHERE n < {base}), '')) AS base_sha256, coalesce({listed}, '') AS spans
FROM d LEFT JOIN s USING (r) GROUP BY r, doc_id
"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_language_id": op2_language_id,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_url_filter": op4_url_filter,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality": op9_quality,
    "op10_html_extract": op10_html_extract,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_secret_scan": op13_secret_scan,
}
ORACLES = {
    "op5_exact_dedup": OP5_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op7_ngram_jaccard": OP7_SQL,
    "op8_decontaminate": OP8_SQL,
    "op11_centroid_clustering": _op11_sql(),
    "op12_hard_negatives": OP12_SQL,
    "op13_secret_scan": _op13_sql(),
}
