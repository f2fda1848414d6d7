"""Spelling dictionaries, rule lists and incremental merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dictionary as D
from ..operators import merge as M
from ..queries import query, table

_CODES = [
    ("large", ["LA"]), ("small", ["SM", "XS"]), ("red", ["RD"]), ("azure", ["BL"]), ("brass", ["BR", "CU"]), ("copper", ["CU"]), ("widget", None),
    ("bolt", ["BO"]), ("gadget", ["GA", "EU"]), ("small widget", ["SW"]), ("panel", ["EU"]), ("steel", ["FE"]),
]


@query("""
    WITH t(spelling, codes) AS (VALUES ('large', ['LA']), ('small', ['SM', 'XS']), ('red', ['RD']), ('azure', ['BL']), ('brass', ['BR', 'CU']), ('copper', ['CU']), ('widget', CAST(NULL AS VARCHAR[])),
                       ('bolt', ['BO']), ('gadget', ['GA', 'EU']), ('small widget', ['SW']), ('panel', ['EU']), ('steel', ['FE'])),
         k AS (SELECT DISTINCT p_name AS name FROM part), w AS (SELECT k.name, t.codes, t.spelling IS NOT NULL AS hit FROM k LEFT JOIN t ON k.name = t.spelling),
         p AS (SELECT name, unnest(string_split(name, ' ')) AS part, unnest(range(len(string_split(name, ' ')))) AS pos FROM w WHERE NOT hit),
         j AS (SELECT p.name, bool_and(t.spelling IS NOT NULL) AS every, flatten(list(coalesce(t.codes, []) ORDER BY pos)) AS codes FROM p LEFT JOIN t ON p.part = t.spelling GROUP BY p.name),
         c AS (SELECT w.name, w.hit, j.every, CASE WHEN w.hit THEN coalesce(w.codes, []) WHEN j.every THEN j.codes END AS codes FROM w LEFT JOIN j ON w.name = j.name),
         u AS (SELECT name, hit, every, list_filter(codes, lambda x, i: list_position(codes, x) = i) AS codes FROM c)
    SELECT name, CASE WHEN len(codes) > 0 THEN array_to_string(codes, ';') END AS codes,
           CASE WHEN codes IS NOT NULL AND len(codes) = 0 THEN 'placeholder' WHEN hit THEN 'whole' WHEN every THEN 'parts' ELSE 'unmapped' END AS status,
           (codes IS NOT NULL AND len(codes) = 0) OR coalesce(len(list_filter(codes, lambda x: x <> 'EU')) = 0, FALSE) AS vague
    FROM u
""")
def whole_or_parts_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names looked up whole, else word by word; unmapped unless every word is known."""
    codes = spark.createDataFrame(_CODES, "spelling string, codes array<string>")
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    found = D.whole_or_parts(names, "name", codes, " ")
    return found.select("name", F.array_join("codes", ";").alias("codes"), "status", D.vague(F.col("codes"), F.col("status")).alias("vague"))


_GRAPH = [
    ("PROMO", "Promotion"), ("Promotion", "Promotional Goods"), ("Promotional Goods", "Promotional Goods"), ("STANDARD", "Std"), ("Std", "Standard"), ("Std", "Regular"),
    ("SMALL", "Tiny"), ("Tiny", "SMALL"), ("ECONOMY", None), ("LARGE", "Big"),
]


@query("""
    WITH RECURSIVE t(s, n) AS (VALUES ('PROMO', 'Promotion'), ('Promotion', 'Promotional Goods'), ('Promotional Goods', 'Promotional Goods'), ('STANDARD', 'Std'), ('Std', 'Standard'), ('Std', 'Regular'),
                                       ('SMALL', 'Tiny'), ('Tiny', 'SMALL'), ('ECONOMY', NULL), ('LARGE', 'Big')),
         walk(s, goal, path) AS (SELECT s, n, [s] FROM t UNION ALL SELECT w.s, t.n, list_append(w.path, w.goal) FROM walk w JOIN t ON w.goal = t.s WHERE NOT list_contains(w.path, w.goal)),
         ends AS (SELECT DISTINCT s, goal FROM walk WHERE goal IS NOT NULL AND (list_contains(path, goal) OR goal NOT IN (SELECT s FROM t)))
    SELECT k.kind, e.goal AS name, k.parts FROM (SELECT upper(split_part(p_type, ' ', 1)) AS kind, count(*) AS parts FROM part GROUP BY 1) k LEFT JOIN ends e ON e.s = k.kind
""")
def dictionary_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types under the names their spellings lead to, cycles and self-maps guarded."""
    closed = D.closure(spark.createDataFrame(_GRAPH, "spelling string, name string"))
    kinds = table(spark, sf_dir, "part").groupBy(F.upper(F.split_part("p_type", F.lit(" "), F.lit(1))).alias("kind")).agg(F.count(F.lit(1)).alias("parts"))
    return kinds.join(closed.withColumnRenamed("spelling", "kind"), "kind", "left").select("kind", "name", "parts")


_LAST = [
    (1, "Brand#11", None, None, "first", None), (2, " brand#11 ", "large azure widget", None, "second", 7), (3, "Brand#11", None, 10, None, 9),
    (4, "Brand#23", None, None, "third", None), (5, "BRAND#23", None, None, "fourth", 1), (6, "Brand#45", "red steel bolt", None, None, 3),
]


@query("""
    WITH e(pos, brand, name, size, set_label, set_year) AS (VALUES (1, 'Brand#11', NULL, NULL, 'first', NULL), (2, ' brand#11 ', 'large azure widget', NULL, 'second', 7), (3, 'Brand#11', NULL, 10, NULL, 9),
              (4, 'Brand#23', NULL, NULL, 'third', NULL), (5, 'BRAND#23', NULL, NULL, 'fourth', 1), (6, 'Brand#45', 'red steel bolt', NULL, NULL, 3)),
         h AS (SELECT p_partkey, e.* FROM part JOIN e ON lower(trim(e.brand)) = lower(trim(p_brand)) AND (e.name IS NULL OR lower(trim(e.name)) = lower(trim(p_name))) AND (e.size IS NULL OR e.size = p_size)),
         w AS (SELECT p_partkey, arg_max(set_label, CASE WHEN set_label IS NOT NULL THEN pos END) AS label, arg_max(set_year, CASE WHEN set_year IS NOT NULL THEN pos END) AS year, count(*) AS n FROM h GROUP BY 1)
    SELECT part.p_partkey AS partkey, coalesce(w.label, p_type) AS label, CAST(coalesce(w.year, p_size) AS BIGINT) AS year, coalesce(w.n, 0) AS rules_applied FROM part LEFT JOIN w ON part.p_partkey = w.p_partkey
""")
def rules_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides: every rule that fits is applied in order, field by field."""
    rules = spark.createDataFrame(_LAST, "pos int, brand string, name string, size int, set_label string, set_year int")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), F.col("p_size").alias("size"), F.col("p_type").alias("label"), F.col("p_size").alias("year"))
    out = D.rules_last_wins(p, rules, "partkey", ["brand", "name", "size"], "brand", ["label", "year"])
    return out.select("partkey", "label", F.col("year").cast("long").alias("year"), "rules_applied")


_FIRST = [
    (1, "Brand#11", "large azure widget", None, "Large Azure Widget"), (2, None, "red steel bolt", "Brand#99", None), (3, "Brand#12", None, "Brand#13", None), (4, None, "large azure widget", None, "late"),
]


@query("""
    WITH e(pos, brand, name, to_brand, to_name) AS (VALUES (1, 'Brand#11', 'large azure widget', NULL, 'Large Azure Widget'), (2, NULL, 'red steel bolt', 'Brand#99', NULL), (3, 'Brand#12', NULL, 'Brand#13', NULL), (4, NULL, 'large azure widget', NULL, 'late')),
         h AS (SELECT p_partkey, min(pos) AS pos FROM part JOIN e ON (lower(e.brand) = lower(p_brand) OR lower(e.name) = lower(p_name))
               AND (e.brand IS NULL OR lower(e.brand) = lower(p_brand) OR coalesce(lower(e.to_brand) = lower(p_brand), FALSE))
               AND (e.name IS NULL OR lower(e.name) = lower(p_name) OR coalesce(lower(e.to_name) = lower(p_name), FALSE)) GROUP BY 1)
    SELECT part.p_partkey AS partkey, coalesce(e.to_brand, p_brand) AS brand, coalesce(e.to_name, p_name) AS name, CAST(h.pos AS BIGINT) AS match_pos
    FROM part LEFT JOIN h ON part.p_partkey = h.p_partkey LEFT JOIN e ON e.pos = h.pos
""")
def rules_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restorations: the first rule that names a row, as printed or partly restored."""
    rules = spark.createDataFrame(_FIRST, "pos int, brand string, name string, to_brand string, to_name string")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"))
    return D.rules_first_match(p, rules, "partkey", ["brand", "name"]).select("partkey", "brand", "name", F.col("match_pos").cast("long").alias("match_pos"))


@query("""
    WITH now AS (SELECT doc_id, substr(sha256(coalesce(text, '') || chr(10) || coalesce(lang, '')), 1, 16) AS mark FROM documents WHERE doc_id % 11 <> 0),
         old AS (SELECT doc_id, substr(sha256(CASE WHEN doc_id % 13 = 0 THEN 'old ' || text ELSE coalesce(text, '') END || chr(10) || coalesce(lang, '')), 1, 16) AS mark FROM documents WHERE doc_id % 17 <> 0)
    SELECT coalesce(now.doc_id, old.doc_id) AS doc_id, CASE WHEN old.mark IS NULL THEN 'new' WHEN now.mark IS NULL THEN 'gone' ELSE 'edited' END AS change
    FROM now FULL JOIN old ON now.doc_id = old.doc_id WHERE now.mark IS DISTINCT FROM old.mark
""")
def hash_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between yesterday's documents (derived) and today's, by content hash."""
    d = table(spark, sf_dir, "documents")
    now = d.where("doc_id % 11 <> 0").select("doc_id", M.content_hash("text", "lang").alias("mark"))
    edited = d.where("doc_id % 17 <> 0").withColumn("text", F.when(F.col("doc_id") % 13 == 0, F.concat(F.lit("old "), "text")).otherwise(F.col("text")))
    return M.changes(edited.select("doc_id", M.content_hash("text", "lang").alias("mark")), now, "doc_id", "mark")


@query("""
    WITH before AS (SELECT d.lang, d.source, d.n_chars % 40 AS size, l.doc_id AS pos, CASE WHEN l.quality = 1 THEN l.doc_id END AS answer, l.toxic = 0 AS asked FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
         r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, size ORDER BY pos DESC) AS place FROM before), last AS (SELECT * FROM r WHERE place = 1),
         j AS (SELECT d.doc_id, CASE WHEN d.n_chars % 3 = 0 AND last.asked AND last.answer IS NULL THEN FALSE ELSE coalesce(last.asked, FALSE) END AS asked_answer, last.answer FROM documents d
               LEFT JOIN last ON d.lang IS NOT DISTINCT FROM last.lang AND d.source IS NOT DISTINCT FROM last.source AND d.n_chars % 40 = last.size)
    SELECT doc_id, answer, asked_answer, NOT asked_answer AS needs_answer FROM j
""")
def keep_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers carried over to rows of the same names, and misses forgotten for some of them; three states by value and flag."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", (F.col("n_chars") % 40).alias("size"), "n_chars")
    marks = table(spark, sf_dir, "labels")
    before = marks.join(d, "doc_id").select("lang", "source", "size", F.col("doc_id").alias("pos"), F.when(F.col("quality") == 1, F.col("doc_id")).alias("answer"), (F.col("toxic") == 0).alias("asked_answer"))
    kept = M.keep_answers(d, before, ["lang", "source", "size"], ["answer"], "pos")
    kept = M.forgotten(kept, "answer", (F.col("n_chars") % 3 == 0) & M.missed("answer"))
    return kept.select("doc_id", "answer", "asked_answer", M.needs("answer").alias("needs_answer"))


@query("""
    SELECT o_orderkey AS orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49) AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def id_set_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reduction by id sets: orders with a large line, without customers in debt."""
    big = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_orderkey").alias("o_orderkey"))
    debt = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").join(big, "o_orderkey", "left_semi").join(debt, "o_custkey", "left_anti").select(F.col("o_orderkey").alias("orderkey"))
