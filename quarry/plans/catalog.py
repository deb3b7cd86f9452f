"""Queries of the engine's own operators over the driver's tables, by name, with their SQL.

Sums that SQL compares are over integers or decimals; windows and first rows have total orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import sequences, strings
from quarry.operators import alignment, clustering, columns, consensus, coverage, joins, lengths, ordering, profile, refinement, sets, similarity, synth, taxonomy
from quarry.sources import tables
from quarry.storage import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


class _Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query("""
WITH a AS (
  SELECT source, doc_id, n_chars AS l, sum(n_chars) OVER w AS c, row_number() OVER w AS i, sum(n_chars) OVER (PARTITION BY source) AS s
  FROM documents WINDOW w AS (PARTITION BY source ORDER BY n_chars, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
h AS (SELECT *, min(CASE WHEN c >= 0.5 * s THEN i END) OVER (PARTITION BY source) AS i50 FROM a),
n AS (
  SELECT source, max(CASE WHEN i = i50 THEN l END) AS n50_length, coalesce(arg_min(CASE WHEN i <> i50 AND c >= 0.1 * s THEN l END, CASE WHEN i <> i50 AND c >= 0.1 * s THEN i END), 0) AS n90_length
  FROM h GROUP BY source)
SELECT d.source, count(*) AS contigs, CAST(sum(n_chars) AS BIGINT) AS total_size_bp, min(n_chars) AS min_length, max(n_chars) AS max_length, avg(n_chars) AS avg_length,
  median(n_chars) AS median_length, any_value(n50_length) AS n50_length, any_value(n90_length) AS n90_length
FROM documents d JOIN n USING (source) GROUP BY d.source""")
def assembly_stats(spark, d):
    return lengths.length_stats(_Tables(spark, d).documents, "source", "n_chars", "doc_id")


_STEPS = ", ".join(f"({t})" for t in lengths.THRESHOLDS)


@query(f"""
SELECT lang, min_length, count(*) AS num_contigs, CAST(sum(n_chars) AS BIGINT) AS total_length, 100.0 * sum(n_chars) / any_value(t) AS percent
FROM documents JOIN (SELECT lang, sum(n_chars) AS t FROM documents GROUP BY lang) USING (lang), (VALUES {_STEPS}) AS s(min_length)
WHERE n_chars >= min_length GROUP BY lang, min_length""")
def size_distribution(spark, d):
    return lengths.size_distribution(_Tables(spark, d).documents, "lang", "n_chars")


@query("SELECT doc_id, n_chars FROM documents WHERE n_chars >= 1000")
def length_filter(spark, d):
    return _Tables(spark, d).documents.where(F.length("text") >= 1000).select("doc_id", "n_chars")


@query("""SELECT l_orderkey AS tool_l_orderkey, l_linenumber AS tool_l_linenumber, l_partkey AS tool_l_partkey, l_quantity AS tool_l_quantity, l_discount AS tool_l_discount,
  l_orderkey AS sequence_id FROM lineitem WHERE l_quantity >= 30 AND l_discount >= 0.07""")
def score_len_filter(spark, d):
    rows = _Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")
    rows = consensus.score_length_filter(rows, "l_quantity", "l_discount", 30, 0.07)
    return columns.prefixed(rows, "tool_").withColumn("sequence_id", F.col("tool_l_orderkey"))


@query("""
SELECT c_custkey, regexp_replace(c_name || '|provirus_1_20', '\\|provir.+$', '') AS region_free, regexp_replace(c_name || '_1 1-20/30', '(.+)_\\d\\s.+$', '\\1') AS fragment_free,
  split_part(split_part(c_name || '||x y', ' ', 1), '||', 1) AS clean, regexp_replace(c_name || ' some text', '\\s.*', '') AS bare, regexp_replace(c_name || '_12', '_\\d+$', '') AS contig
FROM customer""")
def identifier_cleaning(spark, d):
    c, n = _Tables(spark, d).customer, F.col("c_name")
    return c.select(
        "c_custkey",
        strings.strip_region(F.concat(n, F.lit("|provirus_1_20"))).alias("region_free"),
        strings.strip_fragment(F.concat(n, F.lit("_1 1-20/30"))).alias("fragment_free"),
        strings.clean_id(F.concat(n, F.lit("||x y"))).alias("clean"),
        strings.drop_description(F.concat(n, F.lit(" some text"))).alias("bare"),
        strings.contig_of_gene(F.concat(n, F.lit("_12"))).alias("contig"),
    )


@query("""
SELECT page_id, regexp_replace(url, '^.*/', '') AS base, regexp_replace(regexp_replace(url, '^.*/', ''), '\\.[^.]*$', '') AS stem,
  CASE WHEN len(string_split(url, '/')) >= 3 THEN string_split(url, '/')[-3] END AS third FROM pages""")
def path_parts(spark, d):
    u = F.col("url")
    return _Tables(spark, d).pages.select("page_id", strings.base_name(u).alias("base"), strings.stem(u).alias("stem"), strings.path_part(u, 3).alias("third"))


@query("""
SELECT p_partkey, len(string_split(h, ' # ')) - 1 AS n_fields, string_split(h, ' # ')[1] AS gene, CAST(string_split(h, ' # ')[2] AS BIGINT) AS first_pos,
  regexp_extract(h, '^(.*ID=)(\\d+)_(\\d+)(.*)$', 1) || '77_' || regexp_extract(h, '^(.*ID=)(\\d+)_(\\d+)(.*)$', 3) || regexp_extract(h, '^(.*ID=)(\\d+)_(\\d+)(.*)$', 4) AS renumbered
FROM (SELECT p_partkey, 'c' || p_partkey || '_' || p_size || ' # ' || p_size || ' # ' || (p_size + 30) || ' # 1 # ID=' || p_partkey || '_' || p_size || ';x=y' AS h FROM part)""")
def gene_headers(spark, d):
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    h = F.concat(F.lit("c"), key, F.lit("_"), size, F.lit(" # "), size, F.lit(" # "), (F.col("p_size") + 30).cast("string"), F.lit(" # 1 # ID="), key, F.lit("_"), size, F.lit(";x=y"))
    f = strings.header_fields(F.col("h"))
    return _Tables(spark, d).part.select("p_partkey", h.alias("h")).select(
        "p_partkey", F.size(f).cast("long").alias("n_fields"), F.get(f, F.lit(0)).alias("gene"), F.get(f, F.lit(1)).cast("long").alias("first_pos"), strings.renumber_id(F.col("h"), F.lit(77)).alias("renumbered")
    )


@query("SELECT source AS sample_id, doc_id || '_' || source AS key, n_chars FROM documents UNION ALL SELECT 'pages', page_id || '_pages', NULL FROM pages")
def suffix_key_union(spark, d):
    """Keys of all sources' documents and of the pages, which have no n_chars."""
    t = _Tables(spark, d)
    parts = [t.documents.select("doc_id", "n_chars", F.col("source").alias("sample_id")), t.pages.select(F.col("page_id").alias("doc_id"), F.lit("pages").alias("sample_id"))]
    return columns.suffixed_key(sets.loose_union(parts), "doc_id", "sample_id", "key").select("sample_id", "key", "n_chars")


@query("""
SELECT 'c' AS sample_id, c_custkey AS key, c_name AS name, c_acctbal AS balance, 'customer' AS source_file FROM customer
UNION ALL SELECT 's', s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier""")
def strict_row_bind(spark, d):
    t = _Tables(spark, d)
    a = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return sets.strict_union([columns.with_origin(a, "customer", "c"), columns.with_origin(b, "supplier", "s")])


@query("""
SELECT coalesce(a.i, b.i) AS ord, c_custkey AS left_key, s_suppkey AS right_key FROM (SELECT row_number() OVER (ORDER BY c_custkey) AS i, c_custkey FROM customer) a
FULL JOIN (SELECT row_number() OVER (ORDER BY s_suppkey) AS i, s_suppkey FROM supplier) b ON a.i = b.i""")
def column_bind(spark, d):
    t = _Tables(spark, d)
    return joins.column_bind(t.customer.select("c_custkey"), t.supplier.select("s_suppkey"), ["c_custkey"], ["s_suppkey"]).select("ord", F.col("c_custkey").alias("left_key"), F.col("s_suppkey").alias("right_key"))


@query("""SELECT c_custkey, c_mktsegment AS checkv_segment, o_orderkey AS tool_order, o_totalprice AS tool_price FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def left_fanout(spark, d):
    t = _Tables(spark, d)
    left = columns.prefixed_unless(t.customer.select("c_custkey", F.col("c_mktsegment").alias("checkv_segment")), "checkv_", keep=["c_custkey"])
    right = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("tool_order"), F.col("o_totalprice").alias("tool_price"))
    return left.join(right, "c_custkey", "left")



@query("""
WITH k AS (SELECT DISTINCT event_type FROM events),
c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)
SELECT coalesce(a.user_id, b.user_id, x.user_id) AS user_id, a.n AS first_n, CASE WHEN b.n <> 1 THEN b.n END AS second_n, x.n AS third_n
FROM (SELECT * FROM c WHERE event_type = (SELECT min(event_type) FROM k)) a
FULL JOIN (SELECT * FROM c WHERE event_type = (SELECT max(event_type) FROM k)) b ON a.user_id = b.user_id
FULL JOIN (SELECT user_id, count(*) AS n FROM events WHERE value > 90 GROUP BY user_id) x ON x.user_id = coalesce(a.user_id, b.user_id)""")
def outer_reduce_3(spark, d):
    e = _Tables(spark, d).events
    ends = e.agg(F.min("event_type").alias("lo"), F.max("event_type").alias("hi"))
    both = e.join(F.broadcast(ends))  # one row
    count = lambda rows, out: rows.groupBy("user_id").agg(F.count("*").alias(out))
    out = joins.outer_reduce([count(both.where("event_type = lo"), "first_n"), count(both.where("event_type = hi"), "second_n"), count(e.where("value > 90"), "third_n")], "user_id")
    out = columns.without(out.withColumn("subfamily_note", F.lit("x")), "subfamily")
    return out.withColumn("second_n", F.when(F.col("second_n") != 1, F.col("second_n")))


_BANDS = [(15 * i, 15 * (i + 1)) for i in range(7)]


@query("SELECT user_id, " + ", ".join(f"nullif(count(*) FILTER (value >= {a} AND value < {b}), 0) AS band_{i}" for i, (a, b) in enumerate(_BANDS)) + f" FROM events WHERE value >= 0 AND value < {_BANDS[-1][1]} GROUP BY user_id")
def outer_reduce_7(spark, d):
    """Seven tables of counts by user, joined on the user."""
    e = _Tables(spark, d).events
    return joins.outer_reduce([e.where((F.col("value") >= a) & (F.col("value") < b)).groupBy("user_id").agg(F.count("*").alias(f"band_{i}")) for i, (a, b) in enumerate(_BANDS)], "user_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_list(spark, d):
    t = _Tables(spark, d)
    return joins.in_list(t.documents.select("doc_id", "lang"), t.labels.where("quality = 1"), "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def anti_list(spark, d):
    t = _Tables(spark, d)
    return joins.not_in_list(t.documents.select("doc_id", "lang"), t.labels.where("quality = 1"), "doc_id")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_difference(spark, d):
    t = _Tables(spark, d)
    return sets.difference(t.documents, t.labels, "doc_id")


@query("SELECT doc_id AS id, n_chars AS length FROM documents WHERE n_chars >= 500 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) AND doc_id IN (SELECT doc_id FROM labels)")
def sequence_admission(spark, d):
    t = _Tables(spark, d)
    seqs = t.documents.select(F.col("doc_id").alias("id"), F.col("n_chars").alias("length"))
    ids = t.labels.select(F.col("doc_id").alias("id"), "toxic")
    return joins.admitted(seqs, 500, ids.where("toxic = 1"), ids)


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey, l_quantity) AS i FROM lineitem),
k AS (SELECT p_partkey FROM part UNION ALL SELECT -s_suppkey FROM supplier)
SELECT p_partkey, coalesce(CAST(l_orderkey AS VARCHAR), 'No hit') AS best_hit, coalesce(l_extendedprice, 0) AS score FROM k LEFT JOIN (SELECT * FROM r WHERE i = 1) ON p_partkey = l_partkey""")
def best_hit(spark, d):
    t = _Tables(spark, d)
    hits = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_extendedprice").alias("score"), "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", F.col("l_orderkey").cast("string").alias("best_hit"))
    asked = t.part.select("p_partkey").union(t.supplier.select(-F.col("s_suppkey")))  # parts, and keys that no line has
    return joins.best_hit(asked, hits, "p_partkey", "score", ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"], ["best_hit", "score"], {"best_hit": "No hit", "score": 0.0})


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS i FROM documents) WHERE i = 1")
def keep_first(spark, d):
    docs = _Tables(spark, d).documents.select("doc_id", "source", F.sha2("text", 256).alias("digest"))  # texts themselves aren't shuffled
    return ordering.keep_first(docs, ["digest"], ["doc_id"]).select("doc_id", "source")


_EVENTS = "SELECT *, lag(event_type) OVER w AS p, lead(event_type) OVER w AS q, row_number() OVER w AS i FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"


@query(f"SELECT event_id, user_id, event_type FROM ({_EVENTS}) WHERE p IS DISTINCT FROM event_type OR i = 1")
def adjacent_uniq(spark, d):
    return ordering.adjacent_distinct(_Tables(spark, d).events, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


@query(f"SELECT event_id, user_id, event_type FROM ({_EVENTS}) WHERE (p IS NULL OR p <> event_type) AND (q IS NULL OR q <> event_type)")
def adjacent_single(spark, d):
    return ordering.adjacent_single(_Tables(spark, d).events, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


@query(f"""SELECT user_id, CAST(run AS BIGINT) AS run, event_type, count(*) AS rows FROM (
  SELECT *, sum(CASE WHEN i > 1 AND p = event_type THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM ({_EVENTS})) GROUP BY user_id, run, event_type""")
def gaps_islands_blocks(spark, d):
    return alignment.blocks(_Tables(spark, d).events, ["user_id"], ["ts", "event_id"], "event_type")


_HSP = """SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS alen, CAST(round(l_discount * 100) AS BIGINT) AS disc, l_partkey % 1000 AS s,
  l_partkey % 1000 + CAST(l_quantity AS BIGINT) AS e, CAST(round(l_tax * 100) AS BIGINT) AS tax, l_extendedprice FROM lineitem"""


def _hsps(t: _Tables) -> DataFrame:
    q = F.col("l_quantity").cast("long")
    start = F.pmod("l_partkey", F.lit(1000))
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", q.alias("alen"), F.round(F.col("l_discount") * 100).cast("long").alias("disc"), start.alias("s"), (start + q).alias("e"), F.round(F.col("l_tax") * 100).cast("long").alias("tax"), "l_extendedprice")


_ORDER = "l_orderkey, l_linenumber, l_partkey, alen, l_extendedprice"


@query(f"""
WITH a AS (SELECT *, coalesce(sum(alen) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM ({_HSP}) WHERE tax <= 4 WINDOW w AS (PARTITION BY l_suppkey ORDER BY {_ORDER})),
b AS (SELECT *, max(CASE WHEN prior >= 500 OR alen + prior >= 1.10 * 500 THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM a)
SELECT l_suppkey, count(*) AS kept, CAST(sum(alen) AS BIGINT) AS covered FROM b WHERE stop = 0 GROUP BY l_suppkey""")
def early_stop_prefix(spark, d):
    rows = _hsps(_Tables(spark, d))
    kept = alignment.early_stop(rows, ["l_suppkey"], _ORDER.split(", "), "alen", F.lit(500), max_evalue=4, evalue="tax")
    return kept.groupBy("l_suppkey").agg(F.count("*").alias("kept"), F.sum("alen").alias("covered"))


@query(f"SELECT l_partkey, count(*) AS num_alns, sum(alen * (100 - disc)) / sum(alen) AS ani FROM ({_HSP}) GROUP BY l_partkey")
def weighted_identity(spark, d):
    rows = _hsps(_Tables(spark, d)).withColumn("pid", 100 - F.col("disc"))
    return alignment.weighted_identity(rows, ["l_partkey"], "alen", "pid")


@query(f"""SELECT l_suppkey, CAST(sum(greatest(0, e - greatest(s, coalesce(p + 1, s)) + 1)) AS BIGINT) AS covered FROM (
  SELECT *, max(e) OVER (PARTITION BY l_suppkey ORDER BY s, e, {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM ({_HSP})) GROUP BY l_suppkey""")
def interval_coverage(spark, d):
    return alignment.covered_length(_hsps(_Tables(spark, d)), ["l_suppkey"], "s", "e", _ORDER.split(", "))


@query(f"""
WITH a AS (SELECT *, e - s + 1 AS aln, coalesce(sum(e - s + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM ({_HSP}) WHERE tax <= 4
  WINDOW w AS (PARTITION BY l_suppkey, l_returnflag ORDER BY {_ORDER})),
b AS (SELECT *, max(CASE WHEN prior >= 900 OR aln + prior >= 1.10 * 900 THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM a),
k AS (SELECT *, max(e) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY s, e, {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM b WHERE stop = 0)
SELECT l_suppkey AS qname, l_returnflag AS tname, count(*) AS num_alns, round(sum(alen * (100 - disc)) / sum(alen), 2) AS pid,
  round(100.0 * CAST(sum(greatest(0, e - greatest(s, coalesce(p + 1, s)) + 1)) AS DOUBLE) / 900, 2) AS qcov, round(100.0 * CAST(sum(greatest(0, e - greatest(s, coalesce(p + 1, s)) + 1)) AS DOUBLE) / 1200, 2) AS tcov
FROM k GROUP BY l_suppkey, l_returnflag""")
def pair_ani(spark, d):
    rows = _hsps(_Tables(spark, d)).select(
        F.col("l_suppkey").alias("qname"), F.col("l_returnflag").alias("tname"), (100 - F.col("disc")).alias("pid"), F.col("alen").alias("len"), F.col("e").alias("qstart"), F.col("s").alias("qend"),
        F.col("s").alias("tstart"), F.col("e").alias("tend"), F.when(F.col("tax") <= 4, 0.0).otherwise(1.0).alias("evalue"), F.lit(900.0).alias("qlen"), F.lit(1200.0).alias("tlen"), "l_orderkey", "l_linenumber", "l_partkey", "alen", "l_extendedprice")
    return alignment.pair_identity(rows, _ORDER.split(", "))


@query(f"""
WITH h AS ({_HSP}), c AS (SELECT s_suppkey AS contig, 1020 + s_suppkey % 7 AS length FROM supplier),
d AS (SELECT l_suppkey AS contig, p, count(*) AS depth FROM (SELECT l_suppkey, unnest(generate_series(greatest(s, 1), e)) AS p FROM h) JOIN c ON contig = l_suppkey WHERE p <= length GROUP BY ALL),
t AS (SELECT contig, count(*) AS covered, max(depth) AS most, sum(depth) AS s, sum(depth * depth) AS q FROM d GROUP BY contig)
SELECT contig, length, coalesce(covered, 0) AS covered, coalesce(most, 0) AS most, coalesce(s, 0)::DOUBLE / length AS mean, (coalesce(q, 0)::HUGEINT * length - coalesce(s, 0)::HUGEINT * coalesce(s, 0))::DOUBLE / (length * (length - 1)) AS variance
FROM c LEFT JOIN t USING (contig)""")
def depth_summary(spark, d):
    """Depth of suppliers' line items, which stand for alignments."""
    t = _Tables(spark, d)
    contigs = t.supplier.select(F.col("s_suppkey").alias("contig"), (F.lit(1020) + F.col("s_suppkey") % 7).alias("length"))
    return coverage.depths(_hsps(t).withColumnRenamed("l_suppkey", "contig"), contigs, "s", "e")


@query(f"""SELECT s_suppkey AS ask, l_orderkey, l_linenumber, l_partkey, s, e FROM ({_HSP}) JOIN supplier ON s_suppkey = l_suppkey WHERE s <= 100 + s_suppkey % 500 + 20 AND e >= 100 + s_suppkey % 500""")
def coordinate_lookup(spark, d):
    """Line items sorted by supplier and place, looked up by a range for each supplier."""
    import uuid

    from quarry.sources import coordinate
    from quarry.storage import shared_dir

    t, path = _Tables(spark, d), f"{shared_dir(spark)}/sorted-{uuid.uuid4().hex}"
    coordinate.write_sorted(_hsps(t).select("l_suppkey", "s", "e", "l_orderkey", "l_linenumber", "l_partkey"), path, "l_suppkey", "s", "e")
    first = F.lit(100) + F.col("s_suppkey") % 500
    asked = t.supplier.select(F.col("s_suppkey").alias("ask"), F.col("s_suppkey").alias("contig"), first.alias("first"), (first + 20).alias("last"))
    return coordinate.lookups(spark, path, asked, ("l_suppkey", "s", "e")).drop("l_suppkey")


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS hit_score, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS provirus_hit_score,
  CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'Provirus (both)' WHEN o_orderstatus = 'F' THEN 'Provirus (A)' WHEN o_orderpriority = '1-URGENT' THEN 'Provirus (B)' ELSE 'Virus' END AS type FROM orders""")
def consensus_label(spark, d):
    o = _Tables(spark, d).orders
    a, b = F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT"
    one = lambda c: F.when(c, 1).otherwise(0)
    return o.select("o_orderkey", consensus.hit_score(F.col("o_totalprice"), 200000).alias("hit_score"), (one(a) + one(b)).alias("provirus_hit_score"), consensus.vote_label(a, b, "Virus", "Provirus (both)", "Provirus (A)", "Provirus (B)").alias("type"))


@query("""
WITH a AS (SELECT *, CASE WHEN l_linestatus = 'F' THEN 'Virus' ELSE 'Provirus' END AS type, nullif(l_partkey % 12, 11) AS contamination, nullif('w' || (l_suppkey % 7), 'w6') AS warning,
  CASE l_returnflag WHEN 'A' THEN 'Low-quality' WHEN 'N' THEN NULL ELSE 'High-quality' END AS quality, l_linenumber - 1 AS hallmarks, 1 - l_discount AS score FROM lineitem),
b AS (SELECT * FROM a WHERE type <> 'Virus' OR contamination <= 10),
q AS (SELECT quantile_cont(l_extendedprice, 0.9) AS cut FROM b),
c AS (SELECT *, coalesce(quality IN ('Not-determined', 'Low-quality'), false) AS poor FROM b, q WHERE warning IS NULL OR warning NOT IN ('w1', 'w2')),
e AS (SELECT * FROM c WHERE NOT poor OR (hallmarks = 0 AND score >= 0.99) OR (hallmarks BETWEEN 1 AND 5 AND score >= 0.95) OR (hallmarks > 5 AND score >= 0.90) OR l_extendedprice >= cut)
SELECT l_orderkey, l_linenumber, type, quality, score FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY poor, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS i FROM e) WHERE i = 1""")
def consensus_filter(spark, d):
    rows = _Tables(spark, d).lineitem
    rows = rows.withColumns({
        "type": F.when(F.col("l_linestatus") == "F", "Virus").otherwise("Provirus"), "contamination": F.nullif(F.pmod("l_partkey", F.lit(12)), F.lit(11)), "warning": F.nullif(F.concat(F.lit("w"), F.pmod("l_suppkey", F.lit(7))), F.lit("w6")),
        "quality": F.when(F.col("l_returnflag") == "A", "Low-quality").when(F.col("l_returnflag") != "N", "High-quality"), "hallmarks": F.col("l_linenumber") - 1, "score": 1 - F.col("l_discount")})
    names = {"label": "type", "contamination": "contamination", "warnings": "warning", "quality": "quality", "hallmarks": "hallmarks", "score": "score", "enrichment": "l_extendedprice"}
    out = consensus.consensus(rows, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], names, excluded=["w1", "w2"])
    return out.select("l_orderkey", "l_linenumber", "type", "quality", "score")


@query("SELECT o_orderkey, o_totalprice FROM orders, (SELECT quantile_cont(o_totalprice, 0.9) AS cut FROM orders) WHERE o_totalprice >= cut")
def quantile_threshold(spark, d):
    o = _Tables(spark, d).orders
    cut = consensus.exact_quantile(o, "o_totalprice", 0.9)
    return o.join(F.broadcast(cut), F.col("o_totalprice") >= F.col("cut")).select("o_orderkey", "o_totalprice")  # one row


@query("SELECT p_partkey, nullif(p_brand, 'Brand#11') AS brand FROM part WHERE nullif(p_brand, 'Brand#11') IS NULL OR nullif(p_brand, 'Brand#11') NOT IN ('Brand#12', 'Brand#13')")
def exclusion_list(spark, d):
    rows = _Tables(spark, d).part.select("p_partkey", F.nullif("p_brand", F.lit("Brand#11")).alias("brand"))
    return rows.where(consensus.not_excluded(F.col("brand"), ["Brand#12", "Brand#13"]))


@query("""
SELECT c_custkey, p[1] AS virus, p[2] AS realm, p[3] AS kingdom, p[4] AS phylum, p[5] AS class, p[6] AS "order", p[7] AS family FROM (
  SELECT c_custkey, string_split(r_name || ';' || n_name || ';' || c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN ';a;b;c;d' ELSE '' END, ';') AS p
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""")
def lineage_split(spark, d):
    t = _Tables(spark, d)
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select("c_custkey", F.concat(F.concat_ws(";", "r_name", "n_name", "c_mktsegment"), F.when(F.col("c_custkey") % 2 == 0, ";a;b;c;d").otherwise("")).alias("lineage"))
    return taxonomy.split_lineage(rows, "lineage").drop("lineage")


_CLADES = """SELECT DISTINCT 'k__' || r_name AS clade FROM region UNION ALL SELECT 'k__' || r_name || '|p__' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT DISTINCT 'k__' || r_name || '|p__' || n_name || '|c__' || c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@query(f"""WITH x AS ({_CLADES}) SELECT clade, CASE WHEN clade LIKE '%|c\\_\\_%' ESCAPE '\\' THEN 'c' WHEN clade LIKE '%|p\\_\\_%' ESCAPE '\\' THEN 'p' ELSE 'k' END AS rank FROM x
  WHERE clade NOT LIKE '%|c\\_\\_%' ESCAPE '\\'""")
def rank_filter(spark, d):
    t = _Tables(spark, d)
    pair = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    k = t.region.select(F.concat(F.lit("k__"), "r_name").alias("clade")).distinct()
    p = pair.select(F.concat(F.lit("k__"), "r_name", F.lit("|p__"), "n_name").alias("clade"))
    c = t.customer.join(pair, F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("k__"), "r_name", F.lit("|p__"), "n_name", F.lit("|c__"), "c_mktsegment").alias("clade")).distinct()
    every = k.union(p).union(c)
    kept = [taxonomy.of_rank(every, "clade", r).withColumn("rank", F.lit(r)) for r in ("k", "p")]
    return sets.strict_union(kept)


@query("""
WITH h AS (SELECT l_suppkey AS contig, p_type AS genus, p_brand AS subfamily, CAST(p_size % 3 AS VARCHAR) AS family, CAST(NULL AS VARCHAR) AS "order" FROM lineitem JOIN part ON l_partkey = p_partkey),
long AS (SELECT contig, 0 AS level, 'genus' AS rank, genus AS taxon FROM h UNION ALL SELECT contig, 1, 'subfamily', subfamily FROM h UNION ALL SELECT contig, 2, 'family', family FROM h),
c AS (SELECT contig, level, rank, taxon, count(*) AS votes FROM long WHERE taxon IS NOT NULL GROUP BY ALL),
t AS (SELECT contig, count(*) AS total_prot FROM h GROUP BY contig),
f(taxon, factor, avg_cds, std_cds) AS (SELECT DISTINCT p_brand, 0.2, 1000.0, 100.0 FROM part UNION ALL VALUES ('0', 0.5, 1000.0, 1.0), ('1', 0.55, 1000.0, 1.0)),
r AS (
  SELECT c.*, sum(votes) OVER (PARTITION BY contig, level) AS total, coalesce(factor, 1.0) * 0.6 AS share, factor IS NOT NULL AND total_prot <= avg_cds + 2 * std_cds AS fits
  FROM c JOIN t USING (contig) LEFT JOIN f USING (taxon)),
o AS (SELECT *, votes / total >= share AS over_it, CAST(ceil(share * total) AS BIGINT) - votes AS lacks FROM r),
e AS (
  SELECT contig, level, rank, any_value(total) AS total, bool_or(over_it) AS any_over, arg_min(taxon, (-votes, taxon)) FILTER (over_it AND fits) AS win, max(votes) FILTER (over_it AND fits) AS win_votes,
    min((lacks, taxon, votes)) FILTER (NOT over_it) AS u FROM o GROUP BY contig, level, rank),
dec AS (SELECT *, CASE WHEN win IS NOT NULL THEN 'taxon' WHEN NOT any_over THEN 'deficit' ELSE 'none' END AS decision FROM e),
best AS (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY CASE WHEN decision = 'taxon' THEN 0 ELSE 1 END, CASE WHEN decision = 'taxon' THEN level ELSE -level END) AS i FROM dec)
SELECT contig, rank, CASE decision WHEN 'taxon' THEN win WHEN 'deficit' THEN CAST(u[1] AS VARCHAR) END AS taxon, CAST(CASE decision WHEN 'taxon' THEN win_votes WHEN 'deficit' THEN u[3] END AS BIGINT) AS votes,
  CAST(total AS BIGINT) AS total, decision FROM best WHERE i = 1""")
def majority_vote(spark, d):
    t = _Tables(spark, d)
    h = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").alias("contig"), F.col("p_type").alias("genus"), F.col("p_brand").alias("subfamily"), F.pmod("p_size", F.lit(3)).cast("string").alias("family"), F.lit(None).cast("string").alias("order"))
    totals = h.groupBy("contig").agg(F.count("*").alias("total_prot"))
    more = spark.createDataFrame([("0", 0.5, 1000.0, 1.0), ("1", 0.55, 1000.0, 1.0)], "taxon string, factor double, avg_cds double, std_cds double")
    factors = t.part.select(F.col("p_brand").alias("taxon")).distinct().select("taxon", F.lit(0.2).alias("factor"), F.lit(1000.0).alias("avg_cds"), F.lit(100.0).alias("std_cds")).unionByName(more)
    return taxonomy.majority_vote(h, "contig", totals, factors)


@query("""
WITH RECURSIVE tree AS (SELECT 1000 + r_regionkey AS taxid, r_name AS name, 'order' AS rank, 1000 + r_regionkey AS parent FROM region UNION ALL SELECT n_nationkey, n_name, 'genus', 1000 + n_regionkey FROM nation)
SELECT t.taxid, t.name, t.rank, CASE WHEN t.rank = 'genus' THEN t.name END AS genus, CAST(NULL AS VARCHAR) AS subfamily, CAST(NULL AS VARCHAR) AS family,
  CASE WHEN t.rank = 'order' THEN t.name ELSE p.name END AS "order", CAST(NULL AS VARCHAR) AS class FROM tree t JOIN tree p ON t.parent = p.taxid""")
def lineage_closure(spark, d):
    t = _Tables(spark, d)
    top = t.region.select((F.col("r_regionkey") + 1000).alias("taxid"), F.col("r_name").alias("name"), F.lit("order").alias("rank"), (F.col("r_regionkey") + 1000).alias("parent"))
    low = t.nation.select(F.col("n_nationkey").alias("taxid"), F.col("n_name").alias("name"), F.lit("genus").alias("rank"), (F.col("n_regionkey") + 1000).alias("parent"))
    return taxonomy.lineages(top.unionByName(low))


@query("SELECT c_custkey AS taxid, c_name AS name, ['genus', 'subfamily', 'family', 'order', 'class'][c_custkey % 5 + 1] AS rank, " + ", ".join(f"min(CASE WHEN c_custkey % 5 = {i} THEN c_name END) OVER o AS \"{r}\"" for i, r in enumerate(taxonomy.VOTE_RANKS)) + " FROM customer WINDOW o AS (ORDER BY c_custkey DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
def lineage_chain(spark, d):
    """Customers as one lineage, each below the one of the next smaller key: as deep as the table is long."""
    c = _Tables(spark, d).customer.select(F.col("c_custkey").alias("taxid"), F.col("c_name").alias("name"), F.element_at(F.array(*map(F.lit, taxonomy.VOTE_RANKS)), (F.col("c_custkey") % 5 + 1).cast("int")).alias("rank"), F.when(F.col("c_custkey") > 0, F.col("c_custkey") - 1).otherwise(F.col("c_custkey")).alias("parent"))
    return taxonomy.lineages(c)


@query("SELECT c_nationkey AS assembly, count(*) AS n, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS members FROM customer GROUP BY c_nationkey")
def group_collect(spark, d):
    c = _Tables(spark, d).customer
    return c.groupBy(F.col("c_nationkey").alias("assembly")).agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("c_custkey")), lambda x: x.cast("string")), ",").alias("members"))


@query("""SELECT centroid, part, count(*) AS size, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS members
FROM (SELECT c_nationkey AS centroid, c_custkey AS id, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 20 AS part FROM customer) GROUP BY ALL""")
def member_parts(spark, d):
    """Customers of a nation, 20 to a row."""
    c = _Tables(spark, d).customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("centroid"))
    return clustering.member_parts(c, 20).withColumn("members", F.array_join(F.transform("members", lambda x: x.cast("string")), ","))


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def duplicate_check(spark, d):
    return _Tables(spark, d).lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies")).where("copies > 1")


@query("""
SELECT c_custkey, coalesce(nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE c_name END), ''), 'acc' || c_custkey) AS sample_id, coalesce(nullif(c_mktsegment, 'BUILDING'), nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE c_name END), ''), 'acc' || c_custkey) AS assembly,
  '/data/' || coalesce(nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE c_name END), ''), 'acc' || c_custkey) || '_1.fastq.gz' AS R1 FROM customer""")
def coalesce_defaults(spark, d):
    c = _Tables(spark, d).customer
    none = F.lit(None).cast("string")
    rows = c.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "  ").otherwise(F.col("c_name")).alias("sample_id"), F.concat(F.lit("acc"), "c_custkey").alias("accession"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("assembly"), none.alias("R1"), none.alias("R2"))
    return tables.completed_samples(rows, "/data/").select("c_custkey", "sample_id", "assembly", "R1")


@query("SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum, max(CAST(json_extract(props, '$.k') AS BIGINT)) AS k_max FROM events GROUP BY event_type")
def json_extract(spark, d):
    k = F.from_json("props", T.StructType([T.StructField("k", T.LongType())]))["k"]
    return _Tables(spark, d).events.groupBy("event_type").agg(F.sum(k).alias("k_sum"), F.max(k).alias("k_max"))


@query("SELECT doc_id AS seq_id, length(text) AS length, CASE WHEN length(text) > 0 THEN 100.0 * (length(text) - length(translate(upper(text), 'GC', ''))) / length(text) END AS gc_percent FROM documents")
def gc_content(spark, d):
    return _Tables(spark, d).documents.select(F.col("doc_id").alias("seq_id"), F.length("text").cast("long").alias("length"), sequences.gc_percent(F.col("text")).alias("gc_percent"))


@query("""
SELECT doc_id, piece, piece * 1000 AS start, CASE WHEN piece = n - 1 THEN length(text) ELSE (piece + 1) * 1000 END AS "end" FROM (
  SELECT doc_id, text, greatest(length(text) // 1000, 1) AS n, unnest(range(0, greatest(length(text) // 1000, 1))) AS piece FROM documents)""")
def cut_up(spark, d):
    return sequences.cut_up(_Tables(spark, d).documents.select("doc_id", "text"), "text", 1000).select("doc_id", "piece", "start", "end")


@query("""SELECT contig, bin FROM (SELECT l_orderkey AS contig, l_returnflag AS bin, row_number() OVER (PARTITION BY l_orderkey ORDER BY count(*) DESC, l_returnflag) AS i FROM lineitem GROUP BY l_orderkey, l_returnflag) WHERE i = 1""")
def merge_cut_up(spark, d):
    return sequences.merge_cut_up(_Tables(spark, d).lineitem.select(F.col("l_orderkey").alias("contig"), F.col("l_returnflag").alias("bin")))


@query("""WITH v AS (SELECT user_id, event_type, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS v FROM events GROUP BY user_id, event_type)
SELECT user_id, event_type, 1e6 * v / sum(v) OVER (PARTITION BY event_type) AS cpm FROM v""")
def cpm_renorm(spark, d):
    v = _Tables(spark, d).events.groupBy("user_id", "event_type").agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("v"))
    return profile.per_million(v, "event_type", "v").select("user_id", "event_type", "cpm")


@query("""WITH v AS (SELECT l_partkey, l_returnflag, count(*) AS reads, any_value(p_size) AS len FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, l_returnflag)
SELECT l_partkey, l_returnflag, reads / (len / 1e3) / (sum(reads) OVER s / 1e6) AS rpkm, round(1e6 * (reads / len) / sum(reads / len) OVER s, 6) AS tpm FROM v WINDOW s AS (PARTITION BY l_returnflag)""")
def tpm_rpkm(spark, d):
    t = _Tables(spark, d)
    v = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_partkey", "l_returnflag").agg(F.count("*").alias("reads"), F.first("p_size").alias("len"))
    return profile.abundance(v, "l_returnflag", "reads", "len").select("l_partkey", "l_returnflag", "rpkm", F.round("tpm", 6).alias("tpm"))


@query("""
WITH v AS (SELECT CASE WHEN l_partkey % 50 = 0 THEN 'UNMAPPED' ELSE CAST(l_partkey AS VARCHAR) END AS feature, l_returnflag AS sample, CAST(l_quantity AS BIGINT) AS value FROM lineitem),
g AS (SELECT CAST(p_partkey AS VARCHAR) AS feature, p_brand AS grp FROM part WHERE p_size > 10),
s AS (SELECT CASE WHEN v.feature = 'UNMAPPED' THEN 'UNMAPPED' ELSE coalesce(grp, 'UNGROUPED') END AS grp, sample, CAST(sum(value) AS BIGINT) AS value FROM v LEFT JOIN g ON v.feature = g.feature GROUP BY ALL)
SELECT CASE WHEN grp LIKE 'Brand#1%' THEN grp || ': name of ' || grp ELSE grp END AS "group", sample, value FROM s""")
def regroup_sum(spark, d):
    t = _Tables(spark, d)
    v = t.lineitem.select(F.when(F.col("l_partkey") % 50 == 0, "UNMAPPED").otherwise(F.col("l_partkey").cast("string")).alias("feature"), F.col("l_returnflag").alias("sample"), F.col("l_quantity").cast("long").alias("value"))
    g = t.part.where("p_size > 10").select(F.col("p_partkey").cast("string").alias("feature"), F.col("p_brand").alias("group"))
    names = t.part.where(F.col("p_brand").startswith("Brand#1")).select(F.col("p_brand").alias("id")).distinct().withColumn("name", F.concat(F.lit("name of "), "id"))
    return profile.renamed(profile.regrouped(v, g, "feature", "sample", "value"), names, "group")


@query("SELECT CASE WHEN contains(f, '|') THEN 'stratified' ELSE 'community' END AS part, count(*) AS rows, CAST(sum(p_size) AS BIGINT) AS total FROM (SELECT CASE WHEN p_partkey % 3 = 0 THEN p_brand || '|' || p_type ELSE p_brand END AS f, p_size FROM part) GROUP BY ALL")
def stratified_split(spark, d):
    p = _Tables(spark, d).part.select(F.when(F.col("p_partkey") % 3 == 0, F.concat("p_brand", F.lit("|"), "p_type")).otherwise(F.col("p_brand")).alias("f"), "p_size")
    both = zip(("stratified", "community"), profile.stratified(p, "f"))
    return sets.strict_union([x.groupBy(F.lit(n).alias("part")).agg(F.count("*").alias("rows"), F.sum("p_size").alias("total")) for n, x in both])


@query("""SELECT n_name AS feature, coalesce(sum(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 END), 0)::BIGINT AS "AUTOMOBILE", coalesce(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END), 0)::BIGINT AS "BUILDING",
  coalesce(sum(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 END), 0)::BIGINT AS "MACHINERY" FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def profile_pivot(spark, d):
    t = _Tables(spark, d)
    long = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("feature"), F.col("c_mktsegment").alias("sample"), F.lit(1).cast("long").alias("value"))
    return profile.wide(long, "feature", "sample", "value", ["AUTOMOBILE", "BUILDING", "MACHINERY"])


@query("SELECT o_custkey, o_orderkey, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def topk_per_group(spark, d):
    return ordering.top_k(_Tables(spark, d).orders, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "rank")


@query("SELECT conv_id % 8 AS chunk, conv_id, turn, CAST(sum(CASE WHEN turn = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id % 8 ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS number FROM conversations")
def renumber(spark, d):
    c = _Tables(spark, d).conversations.select(F.pmod("conv_id", F.lit(8)).alias("chunk"), "conv_id", "turn")
    return ordering.counter(c, ["chunk"], ["conv_id", "turn"], F.col("turn") == 0, "number")


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS ord FROM customer")
def ordinals(spark, d):
    return ordering.ordinal(_Tables(spark, d).customer.select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"]).select("c_custkey", "ord")


@query("SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) % 7 + 1 AS part FROM customer")
def balanced_parts(spark, d):
    return clustering.balanced_parts(_Tables(spark, d).customer.select("c_custkey"), ["c_custkey"], 7)


#: Similar sequences for the clustering queries: documents that share a line of at least 20 characters.
_EDGES = """
line AS (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents),
ln AS (SELECT l, doc_id FROM line WHERE length(l) >= 20),
pr AS (SELECT DISTINCT a.doc_id AS src, b.doc_id AS dst FROM ln a JOIN ln b ON a.l = b.l AND a.doc_id <> b.doc_id)"""


def _lines(t: _Tables) -> DataFrame:
    """(id, group): documents and the digests of their lines of at least 20 characters."""
    lines = t.documents.select(F.col("doc_id").alias("id"), F.explode(F.array_distinct(F.split("text", "\n"))).alias("l"))
    return lines.where(F.length("l") >= 20).select("id", F.sha2("l", 256).alias("group"))


def _by_length(t: _Tables) -> DataFrame:
    return clustering.ranked(t.documents.select(F.col("doc_id").alias("id"), "n_chars"), [F.desc("n_chars"), "id"]).select("id", "place")


@query(f"""
WITH RECURSIVE {_EDGES},
nd AS (SELECT doc_id AS id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS place FROM documents),
out_n AS (SELECT n.id, n.place, coalesce(list(p.dst) FILTER (p.dst IS NOT NULL), []) AS nb FROM nd n LEFT JOIN pr p ON n.id = p.src GROUP BY n.id, n.place),
walk AS (
  SELECT CAST(0 AS BIGINT) AS place, CAST([] AS BIGINT[]) AS covered, CAST([] AS BIGINT[]) AS heads
  UNION ALL
  SELECT o.place, CASE WHEN list_contains(w.covered, o.id) THEN w.covered ELSE list_concat(w.covered, o.nb) END, CASE WHEN list_contains(w.covered, o.id) THEN w.heads ELSE list_append(w.heads, o.id) END
  FROM walk w JOIN out_n o ON o.place = w.place + 1),
hd AS (SELECT unnest(heads) AS id FROM walk WHERE place = (SELECT max(place) FROM walk)),
own AS (SELECT p.dst AS id, arg_min(p.src, n.place) AS centroid FROM pr p JOIN hd ON p.src = hd.id JOIN nd n ON n.id = p.src GROUP BY p.dst)
SELECT nd.id, CASE WHEN hd.id IS NOT NULL THEN nd.id ELSE own.centroid END AS centroid FROM nd LEFT JOIN hd USING (id) LEFT JOIN own USING (id)""")
def greedy_cluster(spark, d):
    t = _Tables(spark, d)
    return clustering.greedy_by_groups(_by_length(t), _lines(t))


def _layer(k: int, live: str) -> str:
    """Greedy centroids of one layer of the tournament: nodes l<k>, edges within a part p<k>, heads h<k>, mapping s<k>."""
    return f"""
l{k} AS (SELECT id, part, row_number() OVER (ORDER BY n_chars DESC, id) AS place FROM nd {live}),
p{k} AS (SELECT src, dst, a.place FROM pr JOIN l{k} a ON a.id = src JOIN l{k} b ON b.id = dst WHERE a.part >> {k} = b.part >> {k}),
n{k} AS (SELECT l.id, l.place, coalesce(list(p.dst) FILTER (p.dst IS NOT NULL), []) AS nb FROM l{k} l LEFT JOIN p{k} p ON l.id = p.src GROUP BY l.id, l.place),
w{k} AS (
  SELECT CAST(0 AS BIGINT) AS place, CAST([] AS BIGINT[]) AS covered, CAST([] AS BIGINT[]) AS heads
  UNION ALL
  SELECT n.place, CASE WHEN list_contains(w.covered, n.id) THEN w.covered ELSE list_concat(w.covered, n.nb) END, CASE WHEN list_contains(w.covered, n.id) THEN w.heads ELSE list_append(w.heads, n.id) END
  FROM w{k} w JOIN n{k} n ON n.place = w.place + 1),
h{k} AS (SELECT unnest(heads) AS id FROM w{k} WHERE place = (SELECT max(place) FROM w{k})),
o{k} AS (SELECT p.dst AS id, arg_min(p.src, p.place) AS centroid FROM p{k} p JOIN h{k} h ON p.src = h.id GROUP BY p.dst),
s{k} AS (SELECT l.id, CASE WHEN h.id IS NOT NULL THEN l.id ELSE o.centroid END AS centroid FROM l{k} l LEFT JOIN h{k} h USING (id) LEFT JOIN o{k} o USING (id))"""


@query(f"""
WITH RECURSIVE {_EDGES},
nd AS (SELECT doc_id AS id, n_chars, CAST(('0x' || substr(md5(doc_id || ':0'), 1, 8)) AS BIGINT) % 4 AS part FROM documents),{_layer(0, "")},{_layer(1, "JOIN h0 USING (id)")},{_layer(2, "JOIN h1 USING (id)")}
SELECT s0.id, s2.centroid FROM s0 JOIN s1 ON s0.centroid = s1.id JOIN s2 ON s1.centroid = s2.id""")
def tournament_cluster(spark, d):
    t = _Tables(spark, d)
    return clustering.tournament(_by_length(t), None, 3, members=materialise(_lines(t), "lines"))


_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "".join(str(i % 4) for i in range(26))
#: Codes of 2, 4, 8 and 16 letters from each place on, forwards and of the other strand.
_DOUBLED = ", ".join(
    f"c{2 * w} AS (SELECT id, n, i, f * {4**w} + lead(f, {w}) OVER o AS f, r + {4**w} * lead(r, {w}) OVER o AS r FROM c{w} WINDOW o AS (PARTITION BY id ORDER BY i))" for w in (1, 2, 4, 8)
)


@query(f"""
WITH v AS (SELECT doc_id AS id, translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), '{_LETTERS}', '{_DIGITS}') AS s FROM documents),
c1 AS (SELECT id, n, i, x::BIGINT AS f, 3 - x::BIGINT AS r FROM (SELECT id, length(s) - 15 AS n, unnest(string_split(s, '')) AS x, generate_subscripts(string_split(s, ''), 1) AS i FROM v WHERE length(s) >= 16)),
{_DOUBLED},
m AS (SELECT id, n, i, (least(f, r)::HUGEINT * {similarity.MIX} % 4294967296)::BIGINT AS code FROM c16 WHERE i <= n),
w AS (SELECT DISTINCT id, code FROM (SELECT id, n, i, min(code) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND {similarity.WINDOW - 1} FOLLOWING) AS code FROM m) WHERE i <= greatest(1, n - {similarity.WINDOW - 1})),
sk AS (SELECT id, list(code ORDER BY code) AS sketch FROM w GROUP BY id),
cl AS (SELECT sketch, min(id) AS class_id, count(*) AS members FROM sk GROUP BY sketch),
t AS MATERIALIZED (SELECT class_id, len(sketch) AS size, unnest(sketch) AS code FROM cl),
o AS (SELECT a.class_id AS a, b.class_id AS b, count(*) AS shared, any_value(a.size) AS x, any_value(b.size) AS y FROM t a JOIN t b ON a.code = b.code AND a.class_id <> b.class_id GROUP BY ALL),
l AS (SELECT a, b, shared / (x + y - shared) AS share FROM o WHERE 100 * shared >= 40 * (x + y - shared)),
k AS (SELECT a AS class_id, count(*) AS links, arg_min(b, (-share, b)) AS nearest, max(share) AS similarity FROM l GROUP BY a),
e AS (SELECT id, class_id, members FROM sk JOIN cl USING (sketch))
SELECT doc_id AS id, coalesce(class_id, doc_id) AS class_id, coalesce(members, 1) AS members, coalesce(links, 0) AS links, nearest, round(similarity, 9) AS similarity
FROM documents LEFT JOIN e ON e.id = doc_id LEFT JOIN k USING (class_id)""")
def minhash_candidates(spark, d):
    """Documents read as nucleotides (letters by their place modulo 4): classes of equal sketches and their links."""
    text = F.translate(F.lower(F.regexp_replace("text", "[^A-Za-z]", "")), _LETTERS, "".join("ACGT"[int(c)] for c in _DIGITS))
    return similarity.link_counts(*similarity.similar(_Tables(spark, d).documents.select(F.col("doc_id").alias("id"), text.alias("seq"))))


@query()
def mock_evaluation(spark, d):
    """Similarity classes, greedy clustering of them and agreement with the known clusters, on as many synthetic originals as there are documents."""
    contigs = synth.mock_contigs(spark, _Tables(spark, d).documents.count(), mean_log=6.0, most=2000)
    seqs = contigs.select(F.col("sequence_id").alias("id"), "seq", "length")
    members, links = similarity.similar(seqs)
    members = materialise(members, "members")
    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    heads = members.where("id = class_id").select("id").join(seqs.select("id", "length"), "id")
    centroids = clustering.greedy_centroids(clustering.ranked(heads, [F.desc("length"), "id"]), edges.union(edges.select("dst", "src")))
    found = members.join(centroids.select(F.col("id").alias("class_id"), "centroid"), "class_id").select("id", "centroid")
    return clustering.pair_agreement(contigs.select(F.col("sequence_id").alias("id"), "true_cluster"), found)


@query("SELECT doc_id AS id, 'd' || doc_id AS description, regexp_replace(coalesce(text, ''), '[\\s>]', '', 'g') AS seq FROM documents")
def fasta_roundtrip(spark, d):
    """Documents, without the mark that starts a record, written as FASTA and scanned again."""
    import uuid

    from quarry.sources import fasta
    from quarry.storage import shared_dir

    docs = _Tables(spark, d).documents.withColumn("text", F.replace(F.coalesce("text", F.lit("")), F.lit(">"), F.lit("")))
    target = f"{shared_dir(spark)}/fasta-{uuid.uuid4().hex}"
    fasta.write(docs.select(F.concat(F.lit("d"), "doc_id").alias("id"), F.col("text").alias("seq")), target)
    back = fasta.scan(spark, target)
    return back.select(F.substring("id", 2, 20).cast("long").alias("id"), "description", "seq")


@query("""SELECT doc_id AS id, CASE doc_id % 3 WHEN 1 THEN 'gzip' WHEN 2 THEN 'bzip2' END AS kind, length(regexp_replace(coalesce(text, ''), '[\\s>]', '', 'g')) AS length FROM documents""")
def fasta_by_content(spark, d):
    """Documents in FASTA files under names that don't tell how they are compressed, told apart by content and scanned."""
    import uuid

    from quarry.sources import fasta
    from quarry.storage import moved, shared_dir

    docs = _Tables(spark, d).documents.select(F.col("doc_id").cast("string").alias("id"), F.replace(F.coalesce("text", F.lit("")), F.lit(">"), F.lit("")).alias("seq"))
    base = f"{shared_dir(spark)}/fasta-{uuid.uuid4().hex}"
    for i, (codec, ending) in enumerate((("none", ".gz"), ("gzip", ".fa"), ("bzip2", ".txt"))):
        fasta.records(docs.where(F.col("id").cast("long") % 3 == i)).write.option("compression", codec).text(f"{base}/{codec}")
        moved(spark, f"{base}/{codec}", f"{base}/all", lambda name: f"{name.split('.')[0]}-{codec}{ending}")
    kinds = fasta.compression(spark, f"{base}/all").withColumnRenamed("file", "_f")
    back = fasta.scan(spark, f"{base}/all")
    return back.join(F.broadcast(kinds), F.col("file") == F.col("_f")).select(F.col("id").cast("long").alias("id"), "kind", "length")  # a row for each file


@query("SELECT row_number() OVER (ORDER BY doc_id) AS place, doc_id, length(text) AS length, CASE WHEN length(text) > 0 THEN length(text) - length(replace(text, ' ', '')) END AS blanks FROM documents")
def chunk_gather(spark, d):
    """Documents in chunks of about equal bytes, worked on chunk by chunk in pandas, and gathered in their order."""
    import uuid

    from quarry.operators import chunks
    from quarry.storage import shared_dir

    docs = _Tables(spark, d).documents.select("doc_id", "text").withColumn("bytes", F.octet_length("text"))
    parts = max(1, -(-(docs.agg(F.sum("bytes")).first()[0] or 0) // (4 << 20)))  # chunks of about 4 MB
    gives = tables.schema(number=T.LongType(), doc_id=T.LongType(), length=T.LongType(), blanks=T.LongType())

    def measured(rows):
        text = rows["text"]
        return rows[["doc_id"]].assign(number=rows["place"], length=text.str.len(), blanks=text.str.count(" ").where(text.str.len() > 0))

    path = f"{shared_dir(spark)}/chunks-{uuid.uuid4().hex}"
    chunks.run(chunks.by_size(docs, ["doc_id"], "bytes", parts), measured, gives, path)
    return chunks.gather(spark, path, gives).select(F.col("number").alias("place"), "doc_id", "length", "blanks")


@query()
def incremental_cluster(spark, d):
    """Documents that come in three batches (by doc_id), as a stream: each one's centroid and the batch that it came with."""
    import uuid

    from quarry.operators import incremental
    from quarry.storage import shared_dir
    from quarry.streaming import sources

    base = f"{shared_dir(spark)}/batches-{uuid.uuid4().hex}"
    text = F.translate(F.lower(F.regexp_replace("text", "[^A-Za-z]", "")), _LETTERS, "".join("ACGT"[int(c)] for c in _DIGITS))
    seqs = _Tables(spark, d).documents.select(F.col("doc_id").alias("id"), text.alias("seq"), F.length("text").cast("long").alias("length"))
    for i in range(3):
        seqs.where(F.pmod("id", F.lit(3)) == i).write.mode("append").parquet(f"{base}/in")
        arriving = sources.arriving(spark, f"{base}/in", seqs.schema)
        incremental.stream(arriving, f"{base}/clusters", f"{base}/state").awaitTermination()
    return incremental.result(spark, f"{base}/clusters")


@query("SELECT event_type, date_trunc('day', ts) AS day, count(*) AS events FROM events GROUP BY ALL")
def stream_union(spark, d):
    """Events read as a stream of files, appended to a table, and counted by day."""
    import uuid

    from quarry.storage import shared_dir
    from quarry.streaming import sources

    base, path = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}", f"{d}/events.parquet"
    rows = sources.arriving(spark, d, spark.read.parquet(path).schema, pathGlobFilter="events.parquet")
    sources.append(rows.select("event_type", "ts"), f"{base}/table", f"{base}/state").awaitTermination()
    return spark.read.schema("event_type string, ts timestamp").parquet(f"{base}/table").groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("events"))


@query("SELECT doc_id, CASE WHEN n_chars <= 500 THEN 1 WHEN n_chars <= 2000 THEN 2 WHEN n_chars <= 8000 THEN 4 ELSE 8 END AS tier FROM documents")
def size_tiers(spark, d):
    return _Tables(spark, d).documents.select("doc_id", lengths.size_tier(F.col("n_chars"), [(500, 1), (2000, 2), (8000, 4)], 8).alias("tier"))


@query("SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 500 AS BIGINT) AS batch FROM orders")
def row_batches(spark, d):
    return ordering.batches(_Tables(spark, d).orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "batch")


@query("SELECT l_returnflag, l_linestatus, l_suppkey, count(*) AS times FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def whole_row_duplicates(spark, d):
    return tables.repeated_rows(_Tables(spark, d).lineitem.select("l_returnflag", "l_linestatus", "l_suppkey"))


@query("""
WITH c AS (SELECT 'part' AS name, count(*) AS rows FROM part UNION ALL SELECT 'partkeys', count(DISTINCT l_partkey) FROM lineitem UNION ALL SELECT 'supplier', count(*) FROM supplier)
SELECT name, rows, (SELECT min(rows) = max(rows) FROM c) AS equal FROM c""")
def table_counts(spark, d):
    t = _Tables(spark, d)
    return joins.row_counts({"part": t.part, "partkeys": t.lineitem.select("l_partkey").distinct(), "supplier": t.supplier})


@query("SELECT 'n' || s_nationkey AS assembly, 's' || s_suppkey AS sample_id, s_name AS accession, 's' || s_suppkey || '_1' AS R1, NULL AS R2 FROM supplier")
def assembly_expansion(spark, d):
    """Suppliers gathered by nation as co-assemblies are, and a row for each again."""
    key = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    rows = _Tables(spark, d).supplier.select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("assembly"), key.alias("sample_id"), F.col("s_name").alias("accession"), F.concat(key, F.lit("_1")).alias("R1"), F.lit(None).cast("string").alias("R2"))
    return tables.expanded(tables.co_assemblies(rows))


@query("""
SELECT conv_id % 8 AS chunk, conv_id, turn,
  CAST((conv_id % 8) * 100000 + sum(CASE WHEN turn = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id % 8 ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS number
FROM conversations""")
def renumber_chunks(spark, d):
    c = _Tables(spark, d).conversations.select(F.pmod("conv_id", F.lit(8)).alias("chunk"), "conv_id", "turn")
    return ordering.renumbered(c, "chunk", ["conv_id", "turn"], F.col("turn") == 0, 100_000, "number")


@query("""
SELECT CAST(doc_id AS VARCHAR) AS chrom, CAST(k * 1000 AS BIGINT) AS "chromStart", CAST(CASE WHEN k = n - 1 THEN l ELSE (k + 1) * 1000 END AS BIGINT) AS "chromEnd", doc_id || '.' || k AS name
FROM (SELECT doc_id, l, n, unnest(range(n)) AS k FROM (SELECT doc_id, length(text) AS l, greatest(length(text) // 1000, 1) AS n FROM documents WHERE text IS NOT NULL))""")
def cut_up_bed(spark, d):
    pieces = sequences.cut_up(_Tables(spark, d).documents.where("text is not null").select(F.col("doc_id").alias("id"), F.col("text").alias("seq")), size=1000)
    return sequences.bed(pieces).withColumns({"chromStart": F.col("chromStart").cast("long"), "chromEnd": F.col("chromEnd").cast("long")})


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount <= 0.05")
def report_filter(spark, d):
    return consensus.reported_hits(_Tables(spark, d).lineitem, "l_discount", "l_quantity", 0.05).select("l_orderkey", "l_linenumber")


@query("""
WITH RECURSIVE b AS (SELECT DISTINCT l_suppkey AS bin, l_partkey AS contig, p_size::BIGINT AS weight FROM lineitem JOIN part ON p_partkey = l_partkey),
st AS (
  SELECT 0 AS step, bin, contig, weight, NULL::BIGINT AS score FROM b
  UNION ALL
  SELECT step + 1, r.bin, r.contig, r.weight, CASE WHEN r.bin = k.bin THEN k.score END
  FROM (SELECT * FROM st WHERE score IS NULL) r, (SELECT bin, sum(weight)::BIGINT AS score FROM st WHERE score IS NULL GROUP BY bin ORDER BY score DESC, bin LIMIT 1) k
  WHERE k.score > 0 AND (r.bin = k.bin OR r.contig NOT IN (SELECT contig FROM st x, (SELECT bin FROM st WHERE score IS NULL GROUP BY bin ORDER BY sum(weight) DESC, bin LIMIT 1) y WHERE x.score IS NULL AND x.bin = y.bin)))
SELECT contig, bin, score FROM st WHERE score IS NOT NULL""")
def bin_refinement(spark, d):
    """Suppliers as bins of parts, which several of them hold; parts weigh their size."""
    t = _Tables(spark, d)
    bins = t.lineitem.select(F.col("l_suppkey").alias("bin"), F.col("l_partkey").alias("contig"))
    return refinement.refined(bins, t.part.select(F.col("p_partkey").alias("contig"), F.col("p_size").cast("long").alias("weight")))


@query("""
WITH s AS (SELECT user_id, (row_number() OVER (ORDER BY user_id) - 1) AS place FROM (SELECT DISTINCT user_id FROM events)),
v AS (SELECT event_type AS feature, place // 25 AS block, place % 25 AS k, sum(round(value * 100)::BIGINT)::DOUBLE AS v FROM events JOIN s USING (user_id) GROUP BY ALL),
m AS (SELECT feature, block, map(list(k), list(v)) AS m FROM v GROUP BY ALL)
SELECT feature, block, array_to_string(list_transform(generate_series(0, 24), lambda i: coalesce(m[i], 0)::BIGINT), ',') AS cells FROM m""")
def profile_blocks(spark, d):
    """Sums by event type and user, 25 users to a row."""
    e = _Tables(spark, d).events
    users = ordering.ordinal(e.select(F.col("user_id").alias("sample")).distinct(), ["sample"], "place").withColumn("place", F.col("place") - 1)
    long = e.select(F.col("event_type").alias("feature"), F.col("user_id").alias("sample"), F.round(F.col("value") * 100).cast("long").alias("value"))
    wide = profile.column_blocks(long, "feature", "sample", "value", users, 25)
    return wide.select("feature", "block", F.array_join(F.transform("values", lambda x: x.cast("long").cast("string")), ",").alias("cells"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 45")
def report_filter_bits(spark, d):
    return consensus.reported_hits(_Tables(spark, d).lineitem, "l_discount", "l_quantity", least_bits=45.0).select("l_orderkey", "l_linenumber")


@query(f"""WITH x AS ({_CLADES}) SELECT clade FROM x WHERE contains(clade, 'p__') AND NOT contains(clade, 'c__')""")
def rank_filter_text(spark, d):
    """Clades of a rank by markers that they hold and lack, anywhere in the text."""
    t = _Tables(spark, d)
    pair = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    k = t.region.select(F.concat(F.lit("k__"), "r_name").alias("clade")).distinct()
    p = pair.select(F.concat(F.lit("k__"), "r_name", F.lit("|p__"), "n_name").alias("clade"))
    c = t.customer.join(pair, F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("k__"), "r_name", F.lit("|p__"), "n_name", F.lit("|c__"), "c_mktsegment").alias("clade")).distinct()
    return taxonomy.of_rank_by_text(k.union(p).union(c), "clade", "p__", "c__")


@query("""
WITH v AS (SELECT o_custkey, o_orderpriority AS taxon, count(*) AS votes FROM orders GROUP BY ALL),
b AS (SELECT o_custkey, arg_min(taxon, (-votes, taxon)) AS taxon FROM v GROUP BY o_custkey)
SELECT o_custkey, taxon, 'subfamily' AS rank, CASE WHEN false THEN '' END AS genus, taxon AS subfamily, 'f' || left(taxon, 1) AS family, 'o' AS "order", CASE WHEN false THEN '' END AS class FROM b""")
def vote_lineage(spark, d):
    """Each customer's most frequent priority as a taxon, with the names of the ranks above it."""
    o = _Tables(spark, d).orders
    votes = o.groupBy("o_custkey", F.col("o_orderpriority").alias("taxon")).agg(F.count("*").alias("votes"))
    best = votes.groupBy("o_custkey").agg(F.min(F.struct((-F.col("votes")).alias("v"), "taxon")).alias("m")).select("o_custkey", F.col("m.taxon").alias("taxon"), F.lit("subfamily").alias("rank"), F.lit("taxon").alias("decision"))
    low = o.select(F.col("o_orderpriority").alias("name")).distinct().withColumn("family", F.concat(F.lit("f"), F.substring("name", 1, 1)))
    tree = low.select(F.col("name").alias("taxid"), "name", F.lit("subfamily").alias("rank"), F.col("family").alias("parent"))
    tree = tree.unionByName(low.select(F.col("family").alias("taxid"), F.col("family").alias("name"), F.lit("family").alias("rank"), F.lit("o").alias("parent")).distinct())
    top = spark.createDataFrame([("o", "o", "order", "o")], "taxid string, name string, rank string, parent string")
    return taxonomy.with_lineage(best, taxonomy.lineages(tree.unionByName(top))).drop("decision")


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS start, event_type, count(*) AS events FROM events GROUP BY ALL")
def windowed_counts(spark, d):
    """Events by kind in windows of six hours, as a stream of files that is read to its end."""
    import uuid

    from quarry.storage import shared_dir
    from quarry.streaming import sources

    base, path = f"{shared_dir(spark)}/windows-{uuid.uuid4().hex}", f"{d}/events.parquet"
    rows = sources.arriving(spark, d, spark.read.parquet(path).schema, pathGlobFilter="events.parquet")
    counts = sources.windowed_counts(rows.select("event_type", F.col("ts").cast("timestamp").alias("ts")), "ts", "event_type", "6 hours", "3650 days")

    def keep(df, batch):  # the last update of a window counts
        df.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{base}/table/of={batch}")

    counts.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    back = spark.read.parquet(f"{base}/table").groupBy("start", "event_type").agg(F.max_by("events", "batch").alias("events"))
    return back.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "events")


@query("SELECT doc_id, string_split(text, ' ')[1] AS first FROM documents")
def first_fields(spark, d):
    """The first blank-separated field of documents."""
    return _Tables(spark, d).documents.select("doc_id", F.split("text", " ", 2)[0].alias("first"))


@query("SELECT event_id, event_type FROM events WHERE event_type IS NOT NULL AND event_type <> 'view'")
def annotated_rows(spark, d):
    return consensus.annotated(_Tables(spark, d).events, "event_type", "view").select("event_id", "event_type")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 2")
def header_rows(spark, d):
    return ordering.head(_Tables(spark, d).orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 2)


@query("SELECT doc_id, (n_chars // 3600) || 'h ' || (n_chars % 3600 // 60) || 'm ' || (n_chars % 60) || 's' AS took, regexp_replace(source || chr(9) || lang, '[\\t\\r\\n]+', ' ', 'g') AS cell FROM documents")
def cells_and_times(spark, d):
    docs = _Tables(spark, d).documents
    return docs.select("doc_id", strings.elapsed(F.col("n_chars")).alias("took"), strings.scrubbed(F.concat("source", F.lit("\t"), "lang")).alias("cell"))


@query(f"""
WITH {_EDGES}, deg AS (SELECT dst FROM pr GROUP BY dst)
SELECT (SELECT count(*) FROM documents) AS sequences, (SELECT count(*) FROM pr) AS edges, (SELECT count(*) FROM documents) - (SELECT count(*) FROM deg) AS clusters,
  (SELECT count(*) FROM documents) - (SELECT count(*) FROM deg) AS singletons""")
def edge_counts(spark, d):
    """Sequences, edges, and the documents without any edge, each a cluster of its own."""
    t = _Tables(spark, d)
    return clustering.group_counts(t.documents.select(F.col("doc_id").alias("id")), _lines(t).withColumn("group", F.unhex("group")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly_stats(spark, sf_dir)
