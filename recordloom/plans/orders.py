"""Ordered lookups, gaps, samples and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import windows as W
from ..operators.pick import first_rows
from ..queries import query, table


@query("""
    WITH o AS (SELECT o_custkey AS custkey, o_orderkey AS orderkey, CASE WHEN o_orderpriority NOT LIKE '4%' THEN CAST(year(o_orderdate) AS BIGINT) END AS y FROM orders)
    SELECT custkey, orderkey, y AS year, coalesce(y, first_value(y IGNORE NULLS) OVER (PARTITION BY custkey ORDER BY orderkey ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS carried FROM o
""")
def carry_next_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An undated order gets the year of the next dated one of its customer."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), F.when(~F.startswith("o_orderpriority", F.lit("4")), F.year("o_orderdate").cast("long")).alias("year"))
    return o.withColumn("carried", F.coalesce("year", W.carry_next(F.col("year"), ["custkey"], "orderkey")))


@query("""
    WITH o AS (SELECT o_custkey AS custkey, o_orderkey AS orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
         n AS (SELECT *, lag(d) OVER w AS b, lead(d) OVER w AS a FROM o WINDOW w AS (PARTITION BY custkey ORDER BY orderkey))
    SELECT custkey, count(*) AS orders, count_if((b IS NULL OR d > b) AND (a IS NULL OR d < a)) AS in_sequence FROM n GROUP BY custkey
""")
def sequence_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of a customer's orders are dated strictly between the neighbours in key order."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), F.to_date("o_orderdate").alias("d"))
    before, after = W.neighbours(F.col("d"), ["custkey"], "orderkey")
    placed = o.withColumns({"b": before, "a": after})
    return placed.groupBy("custkey").agg(F.count(F.lit(1)).alias("orders"), F.count_if(W.fits(F.col("d"), F.col("b"), F.col("a"))).alias("in_sequence"))


@query("""
    WITH n AS (SELECT DISTINCT doc_id AS number, quality FROM labels), i AS (SELECT *, number - row_number() OVER (PARTITION BY quality ORDER BY number) AS island FROM n)
    SELECT CAST(quality AS BIGINT) AS quality, min(number) AS first, max(number) AS last, count(*) AS n, CASE WHEN min(number) = max(number) THEN '#' || min(number) ELSE '#' || min(number) || '–#' || max(number) END AS range
    FROM i GROUP BY quality, island
""")
def number_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive labelled documents as ranges."""
    found = W.ranges(table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("quality")), ["quality"], "doc_id")
    return found.withColumn("range", W.range_text(F.col("first"), F.col("last")))


@query("""
    WITH m AS (SELECT quality, max(doc_id) AS most FROM labels GROUP BY quality)
    SELECT CAST(quality AS BIGINT) AS quality, number FROM (SELECT quality, unnest(generate_series(1, most)) AS number FROM m) g
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.quality = g.quality AND l.doc_id = g.number)
""")
def missing_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers up to each group's largest that it lacks."""
    rows = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("number"), F.col("quality").cast("long").alias("quality"))
    return W.missing(rows, ["quality"], "number")


@query("""
    SELECT CAST(floor((o_orderkey - 1) / 500) AS BIGINT) AS band, count_if(o_orderstatus = 'F') AS finished, count_if(o_orderstatus <> 'F') AS open FROM orders GROUP BY 1
""")
def banded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per band of 500 order numbers."""
    done = F.col("o_orderstatus") == "F"
    return table(spark, sf_dir, "orders").groupBy(W.band(F.col("o_orderkey"), 500).cast("long").alias("band")).agg(F.count_if(done).alias("finished"), F.count_if(~done).alias("open"))


@query("""
    WITH n AS (SELECT lang, doc_id, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) - 1 AS p, greatest(1, floor(count(*) OVER (PARTITION BY lang) / 25)) AS step FROM documents)
    SELECT lang, doc_id, n_chars FROM n WHERE p % step = 0 AND p / step < 25
""")
def every_nth_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampling operator: 25 documents of each language, evenly spaced by length."""
    d = table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars")
    return W.every_nth(d, ["lang"], [F.desc("n_chars"), F.asc("doc_id")], 25)


@query("""
    WITH o AS (SELECT o_custkey AS custkey, o_orderkey AS orderkey, datediff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) AS gap FROM orders)
    SELECT custkey, orderkey, CAST(gap AS BIGINT) AS gap FROM o WHERE gap IS NOT NULL ORDER BY gap DESC, custkey, orderkey LIMIT 15
""")
def biggest_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top-k report: the 15 longest waits between a customer's orders."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    gap = F.datediff("o_orderdate", F.lag("o_orderdate").over(w)).cast("long")
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), gap.alias("gap"))
    return o.where("gap is not null").orderBy(F.desc("gap"), "custkey", "orderkey").limit(15)


@query("""
    WITH d AS (SELECT c_nationkey AS nationkey, c_custkey AS custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 300000))
    SELECT CAST(nationkey AS BIGINT) AS nationkey, custkey, CAST(floor((row_number() OVER (PARTITION BY nationkey ORDER BY custkey) - 1) / 100) AS BIGINT) AS chunk FROM d
""")
def delta_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wanted and not there yet, in chunks of 100 for a sink that takes so many at once."""
    sent = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    new = table(spark, sf_dir, "customer").join(sent, "c_custkey", "left_anti").select(F.col("c_nationkey").cast("long").alias("nationkey"), F.col("c_custkey").alias("custkey"))
    return W.in_chunks(new, ["nationkey"], [F.col("custkey")], 100).withColumn("chunk", F.col("chunk").cast("long"))


@query("""
    WITH p AS (SELECT *, 1930 + p_size * 2 AS year FROM part), d AS (SELECT *, greatest(1950, (year // 10) * 10) AS decade FROM p),
         r AS (SELECT *, row_number() OVER (PARTITION BY decade, p_name ORDER BY year, p_retailprice, p_partkey) AS place FROM d)
    SELECT CAST(decade AS BIGINT) AS decade, p_name AS name, p_partkey AS partkey, CAST(year AS BIGINT) AS year FROM r WHERE place = 1
""")
def first_by_key_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each name once per decade, its first by (year, price, key)."""
    p = table(spark, sf_dir, "part").withColumn("year", (1930 + F.col("p_size") * 2).cast("int")).withColumn("decade", W.decade(F.col("year")))
    kept = first_rows(p, ["decade", "p_name"], [F.col("year"), F.col("p_retailprice"), F.col("p_partkey")])
    return kept.select(F.col("decade").cast("long").alias("decade"), F.col("p_name").alias("name"), F.col("p_partkey").alias("partkey"), F.col("year").cast("long").alias("year"))
