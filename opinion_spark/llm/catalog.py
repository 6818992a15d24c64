"""The queries of the numbered operators over whole tables, with SQL twins where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinion_spark.llm import (divergence, exactdup, extraction, filteraudit, fingerprints, langid, minhash, mixing,
                               packing, sharding, tokencount, toxicity, urls)
from opinion_spark.llm.common import fold, table

MIX_WEIGHTS = (5, 2, 1)
MIX_SEED = 7
TOXIC_FROM = 0.7
SHARD_BYTES = 1 << 20


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file; every machine has the same one."""
    import public_tokenizers
    return public_tokenizers.path(name)


def with_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``quality_weight``: 1 if labelled good, 1/4 if labelled bad, 1/2 if not labelled."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").alias("labelled")).agg(F.max("quality").alias("q"))
    return docs.join(known, F.col("doc_id") == F.col("labelled"), "left").withColumn(
        "quality_weight", F.when(F.col("q") == 1, 1.0).when(F.col("q") == 0, 0.25).otherwise(0.5)).drop("labelled", "q")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    docs = with_quality(docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size")),
                        table(spark, sf_dir, "labels"))
    mixed = mixing.mix(docs, MIX_WEIGHTS, F.col("quality_weight"), MIX_SEED, size_col="size")
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ((('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT)::DOUBLE + 1.0)
           / 281474976710656.0 AS u
  FROM documents),
q AS (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
k AS (
  SELECT d.*, floor(-ln(u) / CASE q WHEN 1 THEN 1.0::DOUBLE WHEN 0 THEN 0.25::DOUBLE ELSE 0.5::DOUBLE END
                    * 1073741824.0::DOUBLE)::BIGINT AS key
  FROM d LEFT JOIN q USING (doc_id)),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM k GROUP BY source),
r AS (
  SELECT *, source_size::DOUBLE * 3 AS most, (sum(source_size) OVER ())::DOUBLE AS total FROM s),
o AS (
  SELECT *, row_number() OVER (ORDER BY most / w, source NULLS LAST) AS place,
         (total - coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS each
  FROM r),
f AS (SELECT arg_min(each, place) AS each FROM o WHERE NOT most <= w * each),
t AS (
  SELECT source, source_size, CASE WHEN most <= w * o.each THEN most ELSE w * f.each END AS target FROM o, f),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
         sum(size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS till
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + CASE WHEN till - size / 2.0 <= rest THEN size ELSE 0 END)::BIGINT AS taken
FROM p
"""


def toxic_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, labels, fold(F.col("doc_id"), 3) != 1)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.toxicity(docs, toxic_model(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, threshold=0.8)


OP3_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END) AS sh
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id
  JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n
  HAVING 100 * count(*) >= 80 * (nx.n + ny.n - count(*))),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM r JOIN both_ways e ON r.b = e.a),
c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(c.c, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(c.c, w.doc_id)) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.a = w.doc_id
"""


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(), capacity=2048)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the time of their fetch, which follows from the md5 of the id, within 2024."""
    second = F.conv(F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 7), 16, 10).cast("long")
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", F.timestamp_seconds(F.lit(1704067200) + second % 31622400).alias("fetched_at"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated changes of three lists over the hosts, parent domains and pages that occur in ``pages``.

    Which keys are listed, and when they are added, removed and added again,
    follows from the md5 of the key.
    """
    site = urls.host(F.col("url"))
    named = pages.select("url", site.alias("host")).where("host is not null")
    digit = F.conv(F.substring(F.md5(F.col("key").cast("binary")), 1, 6), 16, 10).cast("long")
    hosts = named.select(F.concat(F.lit("host:"), "host").alias("key"), F.lit("malware").alias("list_name"))
    parents = named.where("size(split(host, '[.]')) > 2").select(
        F.concat(F.lit("host:"), F.regexp_replace("host", r"^[^.]+\.", "")).alias("key"), F.lit("spam").alias("list_name"))
    single = named.select(F.element_at(urls.keys(F.col("url")), -1).alias("key"), F.lit("takedown").alias("list_name"))
    keyed = hosts.union(parents).union(single).distinct().withColumn("d", digit).where("d % 3 = 0")
    changes = keyed.withColumn("c", F.explode(F.array(
        F.struct(F.lit("add").alias("action"), (F.col("d") % 180).alias("day")),
        F.struct(F.lit("remove").alias("action"), (F.col("d") % 180 + 20 + F.col("d") % 70).alias("day")),
        F.struct(F.lit("add").alias("action"), (F.col("d") % 180 + 110 + F.col("d") % 50).alias("day")))))
    return changes.select("key", "list_name", "c.action", F.timestamp_seconds(
        F.lit(1704067200) + F.col("c.day") * 86400).alias("at"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = captures(spark, sf_dir)
    told = urls.temporal_filter(taken, list_entries(taken))
    return told.select("page_id", "url", F.unix_timestamp("fetched_at").alias("fetched_s"), "lists", "entries", "blocked")


OP6_SQL = r"""
WITH p AS (
  SELECT page_id, url, 1704067200 + ('0x' || substr(md5(page_id::VARCHAR), 1, 7))::BIGINT % 31622400 AS t,
         nullif(regexp_replace(lower(regexp_extract(coalesce(url, ''),
           '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.$', ''), '') AS host,
         'page:' || regexp_replace(regexp_extract(url, '://(?:[^/?#@]*@)?([^?#]*)', 1), '/+$', '') AS page
  FROM pages),
named AS (
  SELECT 'host:' || host AS key, 'malware' AS list_name FROM p WHERE host IS NOT NULL
  UNION SELECT 'host:' || regexp_replace(host, '^[^.]+\.', ''), 'spam' FROM p
        WHERE host IS NOT NULL AND len(string_split(host, '.')) > 2
  UNION SELECT page, 'takedown' FROM p WHERE host IS NOT NULL),
k AS (SELECT *, ('0x' || substr(md5(key), 1, 6))::BIGINT AS d FROM named),
spans AS (
  SELECT key, list_name, 1704067200 + (d % 180) * 86400 AS f, 1704067200 + (d % 180 + 20 + d % 70) * 86400 AS u
  FROM k WHERE d % 3 = 0
  UNION ALL
  SELECT key, list_name, 1704067200 + (d % 180 + 110 + d % 50) * 86400, 253370764800 FROM k WHERE d % 3 = 0),
a AS (
  SELECT page_id, t, unnest(list_concat(
    [ 'host:' || array_to_string(string_split(host, '.')[i:], '.') FOR i IN range(1, len(string_split(host, '.')) + 1)],
    [page])) AS key
  FROM p WHERE host IS NOT NULL),
h AS (
  SELECT page_id, string_agg(DISTINCT list_name, ',' ORDER BY list_name) AS lists, count(*) AS n
  FROM a JOIN spans USING (key) WHERE f <= t AND t < u GROUP BY page_id)
SELECT p.page_id, p.url, t AS fetched_s, coalesce(lists, '') AS lists, coalesce(n, 0)::BIGINT AS entries,
       n IS NOT NULL AS blocked
FROM p LEFT JOIN h USING (page_id)
"""


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, fold(F.col("doc_id"), 4) != 2)
    return langid.language(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


OP8_SQL = f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS bytes,
         lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT), 60, '0') AS bits
  FROM documents),
c AS (
  SELECT substr(bits, 1, n) AS prefix, n AS depth, sum(bytes)::BIGINT AS bytes, count(*) AS n_rows
  FROM d, (SELECT unnest(range(0, 49)) AS n) GROUP BY 1, 2),
s AS (
  SELECT c.* FROM c LEFT JOIN c p ON p.depth = c.depth - 1 AND p.prefix = substr(c.prefix, 1, c.depth - 1)
  WHERE (c.bytes <= {SHARD_BYTES} OR c.n_rows = 1)
    AND (c.depth = 0 OR (p.bytes > {SHARD_BYTES} AND p.n_rows > 1)))
SELECT d.doc_id, d.bytes, s.prefix AS shard, s.depth::INT AS depth, s.bytes AS shard_bytes
FROM d JOIN s ON substr(d.bits, 1, s.depth) = s.prefix
"""


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0  # half of the rows came before the others
    return exactdup.merged_duplicates(docs, known)


OP10_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = """
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(quality = 1, false)::INT AS good, coalesce(toxic = 1, false)::INT AS toxic,
         (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
         + 4 * (100 * len(regexp_extract_all(x, '[A-Z]')) > 5 * length(x))::INT
         + 8 * regexp_matches(x, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY x), false)::INT AS mask
  FROM t LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
p AS (
  SELECT chr(65 + i::INT) AS filter_order, 1 AS step, (1 << i::INT) AS bit, 0 AS before FROM range(5) r(i)
  UNION ALL
  SELECT filter_order || chr(65 + i::INT), step + 1, (1 << i::INT), before + bit
  FROM p, range(5) r(i) WHERE step < 5 AND ((before + bit) & (1 << i::INT)) = 0),
o AS (
  SELECT whole.filter_order, p.step, p.bit, p.before
  FROM p whole JOIN p ON whole.step = 5 AND p.filter_order = left(whole.filter_order, p.step)),
r AS (
  SELECT part, filter_order, step, o.bit,
         coalesce(sum(n) FILTER ((mask & (before + o.bit)) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER ((mask & before) = 0 AND (mask & o.bit) > 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER ((mask & before) > 0 AND (mask & o.bit) > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = o.bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER ((mask & before) = 0 AND (mask & o.bit) > 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER ((mask & before) = 0 AND (mask & o.bit) > 0), 0)::BIGINT AS toxic_lost
  FROM c, o GROUP BY part, filter_order, step, o.bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
"""


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
v AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
s AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS total FROM v GROUP BY lang),
c AS (
  SELECT g.lang, g.source, v.term, coalesce(n.n, 0)::HUGEINT AS n,
         sum(coalesce(n.n, 0)) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS total, lang_n, s.total AS lang_total, s.v
  FROM g JOIN v USING (lang) JOIN s USING (lang)
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = v.term),
p AS (
  SELECT lang, source, term, n, (1 + (1000000000 * (n + 5)) // (total + 5 * v))::BIGINT AS p,
         (1 + (1000000000 * (lang_n + 5)) // (lang_total + 5 * v))::BIGINT AS q
  FROM c),
pairs AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, sum(abs(x.p - y.p))::BIGINT AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source != y.source GROUP BY ALL
  UNION ALL
  SELECT x.lang, x.source, 'pair', y.source, 0
  FROM g x JOIN g y ON x.lang = y.lang AND x.source != y.source WHERE x.lang NOT IN (SELECT lang FROM s)),
told AS (
  SELECT * FROM pairs UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM told QUALIFY part = 'pair' OR rank <= 50
"""


def op13_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_text(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_mixing": op1_mixing, "op2_toxicity": op2_toxicity, "op3_minhash": op3_minhash, "op4_packing": op4_packing,
    "op5_fingerprints": op5_fingerprints, "op6_url_filters": op6_url_filters, "op7_language": op7_language,
    "op8_sharding": op8_sharding, "op9_token_counts": op9_token_counts, "op10_exact_dedup": op10_exact_dedup,
    "op11_filter_audit": op11_filter_audit, "op12_divergence": op12_divergence, "op13_html": op13_html}
ORACLES = {
    "op1_mixing": OP1_SQL, "op3_minhash": OP3_SQL, "op6_url_filters": OP6_SQL, "op8_sharding": OP8_SQL,
    "op10_exact_dedup": OP10_SQL, "op11_filter_audit": OP11_SQL, "op12_divergence": OP12_SQL}
