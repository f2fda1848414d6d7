"""Survivorship picks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fuzzy import close
from ..operators.pick import best, first_rows, guarded_list, not_after, precedence, release_rank, release_year
from ..queries import query, table


@query("""
    SELECT c_custkey AS custkey, c_name AS name, o_orderkey AS orderkey, o_orderstatus AS status, o_orderpriority AS priority
    FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY
            CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END,
            CAST(substr(o_orderpriority, 1, 1) AS INTEGER), o_orderdate, o_orderkey) AS place
          FROM orders JOIN customer ON o_custkey = c_custkey)
    WHERE place = 1
""")
def pick_best_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's best order by (status, priority, date, key): a ranked pick as one aggregate before the join."""
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    rank = [status, F.substring("o_orderpriority", 1, 1).cast("int"), F.col("o_orderdate"), F.col("o_orderkey")]
    won = best(orders, "o_custkey", rank, ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    named = won.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return named.select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
    )


@query("""
    WITH c AS (SELECT l_orderkey AS orderkey, l_returnflag AS source, CAST(year(l_shipdate) AS BIGINT) AS y, CAST(year(o_orderdate) AS BIGINT) AS aired
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
         ok AS (SELECT * FROM c WHERE y <= aired),
         r AS (SELECT *, row_number() OVER (PARTITION BY orderkey ORDER BY CASE source WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END, y) AS place FROM ok),
         m AS (SELECT orderkey, min(y) AS first_year, count(*) AS candidates FROM c GROUP BY orderkey)
    SELECT m.orderkey, r.y AS year, r.source AS year_from, m.first_year, m.candidates FROM m LEFT JOIN r ON m.orderkey = r.orderkey AND r.place = 1
""")
def source_precedence_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which source's year survives: never one after the order's own, then by the sources' rank."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_returnflag").alias("source"), F.year("l_shipdate").cast("long").alias("y"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), F.year("o_orderdate").cast("long").alias("aired"))
    joined = lines.join(orders, "orderkey").withColumn("ok", not_after(F.col("y"), F.col("aired")))
    won = joined.groupBy("orderkey").agg(precedence(F.col("ok"), F.col("source"), ["A", "N", "R"]).alias("won"), F.min("y").alias("first_year"), F.count(F.lit(1)).alias("candidates"))
    return won.select("orderkey", F.col("won.value").alias("year"), F.col("won.source").alias("year_from"), "first_year", "candidates")


_WANTED = ("large azure widget", "larje azure widget", "smal brass gadgett", "red panel", "heavy coper valve", "shiny steel bolt", "gren flange", "no such thing at all")


@query("""
    WITH w AS (SELECT unnest(['large azure widget', 'larje azure widget', 'smal brass gadgett', 'red panel', 'heavy coper valve', 'shiny steel bolt', 'gren flange', 'no such thing at all']) AS wanted),
         n AS (SELECT DISTINCT p_name AS name, p_size AS size FROM part),
         c AS (SELECT wanted, name, size, CASE WHEN wanted = name THEN 0 ELSE 1 END AS class, levenshtein(wanted, name) AS d FROM w JOIN n
               ON list_has_any(string_split(wanted, ' '), string_split(name, ' ')) WHERE wanted = name OR (least(length(wanted), length(name)) >= 5
                  AND levenshtein(wanted, name) <= CAST(floor(0.4::DOUBLE * greatest(length(wanted), length(name))) AS INTEGER))),
         r AS (SELECT *, row_number() OVER (PARTITION BY wanted ORDER BY class, d, size, name) AS place, count(*) OVER (PARTITION BY wanted) AS n FROM c)
    SELECT w.wanted, r.name, CAST(r.size AS BIGINT) AS size, CASE r.class WHEN 0 THEN 'exact' WHEN 1 THEN 'near' ELSE 'none' END AS class, coalesce(r.n, 0) AS candidates
    FROM w LEFT JOIN r ON w.wanted = r.wanted AND r.place = 1
""")
def exact_then_near_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best catalogue name for each wanted one: exact before near, then the closest. Names are blocked by a shared word, never crossed."""
    wanted = spark.createDataFrame([(w,) for w in _WANTED], "wanted string")
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_size").alias("size")).distinct()
    words = lambda c: F.explode(F.array_distinct(F.split(c, " ")))
    blocked = wanted.select("wanted", words("wanted").alias("word")).join(names.select("name", "size", words("name").alias("word")), "word").drop("word").distinct()
    near = blocked.where(close(F.col("wanted"), F.col("name"), 0.4)).withColumn("class", F.when(F.col("wanted") == F.col("name"), 0).otherwise(1))
    counted = near.groupBy("wanted").agg(F.count(F.lit(1)).alias("candidates"))
    won = first_rows(near, ["wanted"], [F.col("class"), F.levenshtein("wanted", "name"), F.col("size"), F.col("name")])
    out = wanted.join(won, "wanted", "left").join(counted, "wanted", "left")
    kind = F.when(F.col("class") == 0, "exact").when(F.col("class") == 1, "near").otherwise("none")
    return out.select("wanted", "name", F.col("size").cast("long").alias("size"), kind.alias("class"), F.coalesce("candidates", F.lit(0).cast("long")).alias("candidates"))


@query("""
    WITH s AS (SELECT l_orderkey AS orderkey, l_returnflag AS kind, count(*) AS size FROM lineitem GROUP BY ALL),
         x AS (SELECT *, CASE kind WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS rank, kind = 'R' AS base,
               coalesce(max(CASE WHEN kind <> 'R' THEN size END) OVER (PARTITION BY orderkey), 0) AS longest FROM s),
         r AS (SELECT *, row_number() OVER (PARTITION BY orderkey ORDER BY CASE WHEN base OR size >= longest - 1 THEN 0 ELSE 1 END, rank) AS place FROM x)
    SELECT orderkey, kind, size FROM r WHERE place = 1
""")
def longest_list_guard_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list kept of each order: the highest-ranked kind unless it is too short beside the longest."""
    lists = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("orderkey"), F.col("l_returnflag").alias("kind")).agg(F.count(F.lit(1)).alias("size"))
    return guarded_list(lists, "orderkey", "kind", "size", ["A", "N", "R"], ["R"]).select("orderkey", "kind", "size")


@query("""
    WITH r AS (SELECT p_name AS title, p_partkey AS id, p_size < 5 AS unofficial, p_brand LIKE '%1' AS compilation, p_brand LIKE '%2' AS reissue,
                      CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey % 97 END AS master, CASE WHEN p_size % 7 = 0 THEN NULL ELSE 1950 + p_size END AS year,
                      CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 1900 + p_partkey % 97 END AS master_year FROM part),
         k AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY unofficial::INT, (compilation OR reissue)::INT, (master IS NULL)::INT, coalesce(year, 9999), id) AS place,
               CASE WHEN compilation OR unofficial THEN NULL WHEN reissue THEN master_year ELSE year END AS own FROM r),
         y AS (SELECT title, min(CASE WHEN own > 1800 THEN own END) AS first_year, count(*) AS releases FROM k GROUP BY title)
    SELECT y.title, k.id AS release_id, CAST(y.first_year AS BIGINT) AS first_year, y.releases FROM y JOIN k ON y.title = k.title WHERE k.place = 1
""")
def choose_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a title's releases the one kept, and the earliest year that any of them vouches for."""
    p = table(spark, sf_dir, "part")
    master = F.when(F.col("p_partkey") % 3 != 0, F.col("p_partkey") % 97)
    r = F.struct(
        F.col("p_partkey").alias("id"), (F.col("p_size") < 5).alias("unofficial"), F.endswith("p_brand", F.lit("1")).alias("compilation"), F.endswith("p_brand", F.lit("2")).alias("reissue"),
        master.alias("master"), F.when(F.col("p_size") % 7 != 0, 1950 + F.col("p_size")).alias("year"),
    )
    rows = p.select(F.col("p_name").alias("title"), r.alias("r"), (1900 + master).cast("int").alias("master_year"))
    rows = rows.select("title", F.col("r.id").alias("release_id"), "r", release_year(F.col("r"), F.col("master_year")).alias("own"))
    won = best(rows, "title", release_rank(F.col("r")), ["release_id"])
    years = rows.groupBy("title").agg(F.min("own").cast("long").alias("first_year"), F.count(F.lit(1)).alias("releases"))
    return won.join(years, "title")
