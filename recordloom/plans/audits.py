"""Counts, votes, histograms and agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit as A
from ..queries import query, table


@query("""
    WITH c AS (SELECT o_custkey AS custkey, o_orderpriority AS value, count(*) AS n FROM orders GROUP BY ALL), r AS (SELECT *, max(n) OVER (PARTITION BY custkey) AS top FROM c)
    SELECT custkey, CASE WHEN count(*) = 1 THEN min(value) END AS value, any_value(n) AS n FROM r WHERE n = top GROUP BY custkey
""")
def mode_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's commonest priority, none if two tie."""
    return A.mode_or_null(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("value")), ["custkey"], "value")


@query("""
    WITH c AS (SELECT user_id, event_type AS value, count(*) AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, value) AS place FROM c)
    SELECT user_id, value, n FROM r WHERE place = 1
""")
def tallied_commonest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's commonest event type, the first in order of equals."""
    return A.commonest(table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("value")), ["user_id"], "value")


@query("""
    WITH v AS (SELECT CAST(o_custkey % 50 AS BIGINT) AS number, CAST(year(o_orderdate) AS BIGINT) AS value, count(DISTINCT o_orderpriority) AS votes FROM orders GROUP BY ALL)
    SELECT *, CAST(row_number() OVER (PARTITION BY number ORDER BY votes DESC, value) AS BIGINT) AS place FROM v
""")
def date_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many sources (priorities) agree on a year."""
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("number"), F.year("o_orderdate").cast("long").alias("value"), F.col("o_orderpriority").alias("voter"))
    return A.votes(o, ["number"], "value", "voter").withColumn("place", F.col("place").cast("long"))


_BOUNDS = [("before", -1), ("0-30", 30), ("31-365", 365), ("1-2 years", 730), ("2-6 years", 2190), ("never seen", 100_000), ("beyond", 10**9)]


@query("""
    WITH l(place, label) AS (VALUES (0, 'before'), (1, '0-30'), (2, '31-365'), (3, '1-2 years'), (4, '2-6 years'), (5, 'never seen'), (6, 'beyond')),
         d AS (SELECT datediff('day', o_orderdate, l_shipdate) AS gap FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
         b AS (SELECT CASE WHEN gap <= -1 THEN 0 WHEN gap <= 30 THEN 1 WHEN gap <= 365 THEN 2 WHEN gap <= 730 THEN 3 WHEN gap <= 2190 THEN 4 WHEN gap <= 100000 THEN 5 ELSE 6 END AS place, count(*) AS n FROM d GROUP BY 1)
    SELECT CAST(l.place AS BIGINT) AS place, label, coalesce(n, 0) AS n FROM l LEFT JOIN b ON l.place = b.place
""")
def gap_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from order to shipping in fixed buckets, empty ones too."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_shipdate")
    joined = lines.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_orderdate"), "k")
    return A.histogram(joined, A.bucket(F.datediff("l_shipdate", "o_orderdate"), _BOUNDS), [x for x, _ in _BOUNDS])


@query("""
    SELECT CASE WHEN GROUPING(lang) = 1 THEN 'all' ELSE lang END AS lang, count(*) AS n, count_if(n_chars < 500) AS short, count_if(text LIKE '%@%') AS with_address, count_if(n_chars > 5000) AS long
    FROM documents GROUP BY ROLLUP (lang)
""")
def class_counts_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents per language and in total, in one pass."""
    d = table(spark, sf_dir, "documents")
    return A.class_counts(d, "lang", {"short": F.col("n_chars") < 500, "with_address": F.contains("text", F.lit("@")), "long": F.col("n_chars") > 5000})


@query("""
    WITH c AS (SELECT l_partkey AS partkey, l_suppkey % 5 AS value, count(*) AS n FROM lineitem GROUP BY ALL), o AS (SELECT *, sum(n) OVER (PARTITION BY partkey) - n AS others FROM c)
    SELECT partkey, value, n, CAST(others AS BIGINT) AS others FROM o WHERE n >= 3 AND n >= 1.0 * others
""")
def dominance_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that one supplier group delivers at least as often as all others."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("partkey"), (F.col("l_suppkey") % 5).alias("value"))
    return A.dominant(rows, ["partkey"], "value", 3, 1)


@query("""
    WITH l AS (SELECT l_orderkey AS k, l_returnflag AS kind, list(l_partkey % 3 ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS items FROM lineitem GROUP BY ALL),
         p(a, b) AS (VALUES ('A', 'N'), ('A', 'R'), ('N', 'R')),
         c AS (SELECT p.a, p.b, CASE WHEN len(x.items) <> len(y.items) THEN 'count' WHEN x.items = y.items THEN 'agree' WHEN list_sort(x.items) = list_sort(y.items) THEN 'order' ELSE 'items' END AS kind
               FROM p JOIN l x ON x.kind = p.a JOIN l y ON y.kind = p.b AND x.k = y.k)
    SELECT a, b, count(*) AS compared, count_if(kind = 'agree') AS n_agree, count_if(kind = 'count') AS n_count, count_if(kind = 'order') AS n_order, count_if(kind = 'items') AS n_items,
           CAST(floor(100.0 * count_if(kind = 'agree') / count(*) + 0.5) AS BIGINT) AS percent FROM c GROUP BY a, b
""")
def pair_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the lists of two kinds agree, key by key."""
    rows = table(spark, sf_dir, "lineitem")
    order = F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    lists = rows.groupBy(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("kind")).agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["l_partkey"] % 3).alias("items"))
    return A.agreement(lists, "k", "kind", "items", [("A", "N"), ("A", "R"), ("N", "R")])


@query("""
    WITH known AS (SELECT doc_id, lang, source FROM documents), f AS (SELECT doc_id, CASE WHEN n_chars % 7 = 0 THEN NULL WHEN n_chars % 5 = 0 THEN 'en' ELSE lang END AS found, lang AS known, source FROM documents)
    SELECT source, count_if(found = known) AS same, count_if(found <> known AND substr(found, 1, 1) = substr(known, 1, 1)) AS same_group, count_if(found <> known AND substr(found, 1, 1) <> substr(known, 1, 1)) AS other, count_if(found IS NULL) AS none
    FROM f WHERE known IS NOT NULL GROUP BY source
""")
def accuracy_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Found answers against known ones: same, same group, other or none."""
    found = F.when(F.col("n_chars") % 7 == 0, None).when(F.col("n_chars") % 5 == 0, "en").otherwise(F.col("lang"))
    rows = table(spark, sf_dir, "documents").select("source", found.alias("found"), F.col("lang").alias("known"))
    return A.accuracy(rows, ["source"], "found", "known", F.substring("found", 1, 1) == F.substring("known", 1, 1))
