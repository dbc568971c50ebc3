"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, langid, licenses, nearest, packing, quality, simhash, substring, token_counts, token_files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files SOURCE/LANG/ID.txt; one whose first line states a licence is its directory's LICENSE.ID.txt."""
    docs = table(spark, sf_dir, "documents")
    leads = F.substring_index("text", "\n", 1).rlike("(?i)licen[cs]e|rights reserved")
    path = F.concat(F.coalesce("source", F.lit("none")), F.lit("/"), F.coalesce("lang", F.lit("none")), F.lit("/"), F.when(leads, "LICENSE.").otherwise(""), F.col("doc_id").cast("string"), F.lit(".txt"))
    found = licenses.license_scan(docs.select(path.alias("path"), "text"))
    return found.select(F.regexp_extract("path", r"([0-9]+)\.txt$", 1).cast("long").alias("doc_id"), "path", "own_license", F.round("similarity", 9).alias("similarity"), "license", "inherited_from")


def op4_license_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4_license_scan with licence files on two levels, from documents that mention a licence anywhere.

    Of these, SOURCE/LICENSE.ID.txt if doc_id modulo 3 is 0, SOURCE/LANG/PART/LICENSE.ID.txt if 1; all other
    documents are SOURCE/LANG/PART/ID.txt, PART being doc_id modulo 16.
    """
    docs = table(spark, sf_dir, "documents")
    file = F.coalesce(F.col("text").rlike("(?i)licen[cs]e|rights reserved") & (F.col("doc_id") % 3 < 2), F.lit(False))
    source, lang, name = F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    own = F.concat_ws("/", source, lang, (F.col("doc_id") % 16).cast("string"))
    path = F.when(file, F.concat(F.when(F.col("doc_id") % 3 == 0, source).otherwise(own), F.lit("/LICENSE."), name)).otherwise(F.concat(own, F.lit("/"), name))
    found = licenses.license_scan(docs.select(path.alias("path"), "text"))
    return found.select(F.regexp_extract("path", r"([0-9]+)\.txt$", 1).cast("long").alias("doc_id"), "path", "own_license", F.round("similarity", 9).alias("similarity"), "license", "inherited_from")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_digests(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (op1_nearest_neighbours, op2_language_id, op3_token_files, op4_license_scan, op4_license_ancestors, op5_token_counts, op6_decontamination, op7_substring_dedup, op8_simhash, op9_quality, op10_packing, pipeline)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Brute force: every query against every other vector, added up in the order of the components.
OP1 = """
WITH v AS (SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(embedding, lambda y: y <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x) WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT * FROM r WHERE rank <= 20
"""


def _op4() -> str:
    """Every line of every document against every template, without a prefilter."""
    lines = [(name, k, line.replace("'", "''")) for name, of in sorted(licenses.TEMPLATES.items()) for k, line in enumerate(of)]
    templates = ", ".join(f"('{n}', {k}, '{line}')" for n, k, line in lines)
    words = f"regexp_extract_all(translate({{0}}, '{_UPPER}', '{_LOWER}'), '[a-z0-9]+')"
    return f"""
WITH t(name, k, line) AS (VALUES {templates}),
tw AS (SELECT name, k, w, count(*) AS c FROM (SELECT name, k, unnest({words.format("line")}) AS w FROM t) GROUP BY 1, 2, 3),
size AS (SELECT name, k, sum(c) AS size FROM tw GROUP BY 1, 2),
n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT w, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({words.format("text")}) AS w FROM documents) GROUP BY 1),
idf AS (SELECT v.w, ln((1 + n)::DOUBLE / (1 + coalesce(df, 0))) + 1 AS idf FROM (SELECT w FROM tw UNION SELECT w FROM df) v CROSS JOIN n LEFT JOIN df ON df.w = v.w),
tv AS (SELECT name, k, w, c * idf AS x FROM tw JOIN idf USING (w)),
tn AS (SELECT name, k, sqrt(sum(x * x)) AS norm FROM tv GROUP BY 1, 2),
l AS (SELECT doc_id, unnest(range(len(s))) AS i, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
lw AS (SELECT doc_id, i, w, count(*) AS c FROM (SELECT doc_id, i, unnest({words.format("line")}) AS w FROM l) GROUP BY 1, 2, 3),
lv AS (SELECT doc_id, i, w, c * idf AS x FROM lw JOIN idf USING (w)),
ln_ AS (SELECT doc_id, i, sqrt(sum(x * x)) AS norm FROM lv GROUP BY 1, 2),
cosine AS (SELECT lv.doc_id, lv.i, tv.name, tv.k, sum(lv.x * tv.x) / (min(ln_.norm) * min(tn.norm)) AS s FROM lv JOIN tv USING (w) JOIN ln_ ON ln_.doc_id = lv.doc_id AND ln_.i = lv.i JOIN tn ON tn.name = tv.name AND tn.k = tv.k GROUP BY 1, 2, 3, 4),
best AS (SELECT doc_id, name, s FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(s, 9) DESC, size DESC, i, name, k) AS r FROM cosine JOIN size USING (name, k) WHERE s >= {licenses.THRESHOLD}) WHERE r = 1),
f AS (SELECT d.doc_id, coalesce(source, 'none') || '/' || coalesce(lang, 'none') AS dir,
  CASE WHEN regexp_matches(lower(string_split(text, chr(10))[1]), 'licen[cs]e|rights reserved') THEN 'LICENSE.' ELSE '' END || d.doc_id || '.txt' AS file, name, coalesce(s, 0) AS s FROM documents d LEFT JOIN best USING (doc_id)),
own AS (SELECT dir, min(dir || '/' || file) AS path, arg_min(name, dir || '/' || file) AS name FROM f WHERE file LIKE 'LICENSE.%' AND name IS NOT NULL GROUP BY 1)
SELECT f.doc_id, f.dir || '/' || f.file AS path, f.name AS own_license, round(f.s, 9) AS similarity, coalesce(f.name, own.name) AS license, CASE WHEN f.name IS NULL THEN own.path END AS inherited_from FROM f LEFT JOIN own USING (dir)
"""


def _op4_ancestors() -> str:
    """_op4's lines and templates; each document takes the deepest of its ancestors that has a licence file."""
    scored = _op4().split("\nf AS (")[0]
    return f"""{scored}
f AS (SELECT doc_id, CASE WHEN leads AND doc_id % 3 = 0 THEN source ELSE source || '/' || lang || '/' || doc_id % 16 END AS dir, CASE WHEN leads THEN 'LICENSE.' ELSE '' END || doc_id || '.txt' AS file, name, s
  FROM (SELECT d.doc_id, coalesce(source, 'none') AS source, coalesce(lang, 'none') AS lang, coalesce(regexp_matches(lower(text), 'licen[cs]e|rights reserved') AND doc_id % 3 < 2, false) AS leads, name, coalesce(s, 0) AS s FROM documents d LEFT JOIN best USING (doc_id))),
own AS (SELECT dir, min(dir || '/' || file) AS path, arg_min(name, dir || '/' || file) AS name FROM f WHERE file LIKE 'LICENSE.%' AND name IS NOT NULL GROUP BY 1),
near AS (SELECT f.doc_id, arg_max(own.path, length(own.dir)) AS path, arg_max(own.name, length(own.dir)) AS name FROM f JOIN own ON f.dir = own.dir OR starts_with(f.dir, own.dir || '/') GROUP BY 1)
SELECT f.doc_id, f.dir || '/' || f.file AS path, f.name AS own_license, round(f.s, 9) AS similarity, coalesce(f.name, near.name) AS license, CASE WHEN f.name IS NULL THEN near.path END AS inherited_from FROM f LEFT JOIN near USING (doc_id)
"""


_OP6_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP6 = f"""
WITH d AS (SELECT doc_id, {_OP6_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_OP6_WORDS} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= size)),
h AS (SELECT doc_id, i, bw.size, item_id FROM dw JOIN bw ON bw.win = dw.win AND bw.size = dw.size),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP7 = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win WHERE h IN (SELECT h FROM rep)),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {"op1_nearest_neighbours": OP1, "op4_license_scan": _op4(), "op4_license_ancestors": _op4_ancestors(), "op6_decontamination": OP6, "op7_substring_dedup": OP7}
