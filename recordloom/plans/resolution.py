"""Entity resolution: blocking, verification, verdicts, alignment, nesting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import textkeys as K
from ..operators import resolve as R
from ..operators.align import with_comparison
from ..queries import query, table


def _sentences(c):
    """Normalised sentences of eight characters and more, cut behind ". " and at line feeds."""
    return F.filter(F.transform(F.split(F.lower(c), r"(?<=[.!?:])\s+|\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: F.length(x) >= 8)


_SENTENCES = r"""list_filter(list_transform(regexp_split_to_array(regexp_replace(lower(text), '([.!?:])\s+', '\1' || chr(10), 'g'), chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: length(x) >= 8)"""


@query(rf"""
    WITH d AS (SELECT doc_id, text, list_distinct({_SENTENCES}) AS s FROM documents), b AS (SELECT item_id, text, list_distinct({_SENTENCES}) AS s FROM benchmark),
         du AS (SELECT doc_id, unnest(s) AS k FROM d), bu AS (SELECT item_id, unnest(s) AS k FROM b), c AS (SELECT DISTINCT doc_id, item_id FROM du JOIN bu USING (k))
    SELECT c.doc_id, c.item_id, len(list_intersect(d.s, b.s)) AS shared, len(b.s) AS sentences, contains(d.text, b.text) AS verbatim FROM c JOIN d USING (doc_id) JOIN b USING (item_id)
    WHERE 2 * len(list_intersect(d.s, b.s)) >= len(b.s)
""")
def shared_line_block_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block by an equal sentence, then verify that half of the item's sentences are there."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", F.array_distinct(_sentences(F.col("text"))).alias("mine"))
    b = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item"), F.array_distinct(_sentences(F.col("text"))).alias("theirs"))
    # only ids and keys meet in the block; the texts come back for the candidates
    pairs = R.blocked(d.select("doc_id", "mine"), b.select("item_id", "theirs"), "mine", "theirs", "doc_id", "item_id")
    both = pairs.select("doc_id", "item_id", "mine", "theirs").join(d.select("doc_id", "text"), "doc_id").join(b.select("item_id", "item"), "item_id")
    shared = F.size(F.array_intersect("mine", "theirs")).cast("long")
    return both.where(2 * shared >= F.size("theirs")).select("doc_id", "item_id", shared.alias("shared"), F.size("theirs").cast("long").alias("sentences"), F.contains("text", "item").alias("verbatim"))


@query(rf"""
    WITH b AS (SELECT item_id, list_distinct({_SENTENCES}) AS s FROM benchmark), p AS (SELECT item_id, unnest(s) AS part FROM b), u AS (SELECT part, min(item_id) AS item_id FROM p GROUP BY part HAVING count(*) = 1),
         d AS (SELECT doc_id, unnest(list_distinct({_SENTENCES})) AS part FROM documents)
    SELECT d.doc_id, min(u.item_id) AS item_id, count(*) AS parts, count(DISTINCT u.item_id) AS items FROM d JOIN u USING (part) GROUP BY d.doc_id
""")
def unique_part_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that repeat a sentence which one item alone has."""
    b = table(spark, sf_dir, "benchmark").select("item_id", _sentences(F.col("text")).alias("parts"))
    unique = R.unique_parts(b, "item_id", "parts")
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(_sentences(F.col("text")))).alias("part"))
    return d.join(unique, "part").groupBy("doc_id").agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("parts"), F.count_distinct("item_id").alias("items"))


@query("""
    WITH rows AS (SELECT p_partkey AS partkey, p_name AS name, p_brand AS brand, p_size > 3 AS ready, p_type LIKE 'PROMO%' AS compilation FROM part),
         cat AS (SELECT p_name AS name, p_brand AS brand, min(p_partkey) AS id, CAST(min(p_size) % 3 AS BIGINT) AS grp FROM part WHERE p_retailprice > 1800 GROUP BY ALL),
         m AS (SELECT r.partkey, count(DISTINCT c.grp) AS groups, min(c.id) AS match FROM rows r JOIN cat c ON r.name = c.name AND r.brand = c.brand OR r.name = c.name AND substr(r.brand, 1, 7) = substr(c.brand, 1, 7) GROUP BY 1),
         j AS (SELECT r.*, m.groups, m.match, CASE WHEN NOT ready THEN 'none_to_match' WHEN groups = 1 THEN 'matched' WHEN groups > 1 THEN 'ambiguous' WHEN compilation THEN 'compilation' ELSE 'unmatched' END AS class FROM rows r LEFT JOIN m USING (partkey))
    SELECT partkey, class, CASE WHEN class = 'matched' THEN match END AS match FROM j
""")
def resolution_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part's verdict against a catalogue: matched, ambiguous, compilation, unmatched or nothing to match."""
    p = table(spark, sf_dir, "part")
    rows = p.select(F.col("p_partkey").alias("partkey"), F.col("p_name").alias("name"), F.substring("p_brand", 1, 7).alias("brand"), (F.col("p_size") > 3).alias("ready"), F.startswith("p_type", F.lit("PROMO")).alias("compilation"))
    cat = p.where("p_retailprice > 1800").groupBy(F.col("p_name").alias("name"), F.col("p_brand").alias("full")).agg(F.min("p_partkey").alias("match"), (F.min("p_size") % 3).alias("grp"))
    matches = rows.join(cat.withColumn("brand", F.substring("full", 1, 7)), ["name", "brand"]).select("partkey", "match", "grp")
    return R.classes(rows, matches, "partkey", F.col("ready"), F.col("compilation"), "grp")


def _rounds(n: int) -> str:
    """The rounds of ``namesake_fixpoint``, one after the other."""
    out = ["c AS (SELECT DISTINCT l_orderkey AS orderkey, l_orderkey % 500 AS name, l_suppkey AS owner FROM lineitem)", "r0 AS (SELECT orderkey, min(name) AS name, min(owner) AS owner, 0 AS round FROM c GROUP BY orderkey HAVING count(*) = 1)"]
    for k in range(1, n + 1):
        known = f"FROM c JOIN (SELECT DISTINCT name, owner FROM r{k - 1}) USING (name, owner) WHERE orderkey NOT IN (SELECT orderkey FROM r{k - 1})"
        out.append(f"r{k} AS (SELECT * FROM r{k - 1} UNION ALL SELECT orderkey, min(name), min(owner), {k} {known} GROUP BY orderkey HAVING count(*) = 1)")
    return "WITH " + ", ".join(out) + f" SELECT orderkey, name, owner, CAST(round AS BIGINT) AS round FROM r{n}"


@query(_rounds(R.ROUNDS))
def namesake_fixpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one name told apart in rounds by suppliers that are settled already, over all lines."""
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), (F.col("l_orderkey") % 500).alias("name"), F.col("l_suppkey").alias("owner"))
    return R.settled(c, "orderkey", "name", "owner").select("orderkey", "name", "owner", F.col("round").cast("long").alias("round"))


@query("""
    WITH j AS (SELECT l_orderkey AS orderkey, l_suppkey AS suppkey, p_partkey AS partkey, p_name AS name, p_brand AS brand, l_quantity AS q, p_type AS type FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 2),
         d AS (SELECT *, CASE WHEN partkey IS NULL THEN 'gone' WHEN suppkey % 10 <> CAST(substr(brand, 7, 1) AS BIGINT) THEN 'artist' WHEN least(length(name), 30) < 9 THEN 'title' WHEN q > 40 AND regexp_matches(type, '(^|[^A-Za-z0-9_])(PROMO|ECONOMY)($|[^A-Za-z0-9_])') THEN 'version' END AS doubt FROM j)
    SELECT doubt, count(*) AS n, CAST(sum(q) AS BIGINT) AS quantity FROM d GROUP BY doubt
""")
def doubt_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a link is doubtful: the first test that fails, counted."""
    p = table(spark, sf_dir, "part").where("p_size > 2").select("p_partkey", "p_name", "p_brand", "p_type")
    j = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity").join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
    live = F.col("p_type").rlike(r"(?<![A-Za-z0-9_])(?:PROMO|ECONOMY)(?![A-Za-z0-9_])")
    doubt = (
        F.when(F.col("p_partkey").isNull(), "gone").when(F.col("l_suppkey") % 10 != F.substring("p_brand", 7, 1).cast("long"), "artist")
        .when(F.length("p_name") < 9, "title").when((F.col("l_quantity") > 40) & live, "version")
    )
    return j.select(doubt.alias("doubt"), "l_quantity").groupBy("doubt").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


_NORM = r"regexp_replace(regexp_replace(regexp_replace(replace(strip_accents(lower({0})), '&', 'and'), '^the\s+', ''), '\b(kh|x)', 'h', 'g'), '[^a-z0-9]', '', 'g')"


def _like(x: str, y: str) -> str:
    """The same name, allowing for spelling."""
    return (
        f"CASE WHEN {x} = '' OR {y} = '' THEN {x} = {y} ELSE {x} = {y} OR (least(length({x}), length({y})) >= 4 AND (contains({x}, {y}) OR contains({y}, {x})))"
        f" OR levenshtein({x}, {y}) <= greatest(2, CAST(floor(0.3::DOUBLE * greatest(length({x}), length({y}))) AS BIGINT)) END"
    )


@query(f"""
    WITH RECURSIVE
      l AS (SELECT l_orderkey AS k, l_returnflag AS flag, {_NORM.format("p_name")} AS x, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_shipdate, {_NORM.format("p_name")}) - 1 AS p
            FROM lineitem JOIN part ON l_partkey = p_partkey),
      a AS (SELECT k, p AS i, x FROM l WHERE flag = 'A'), b AS (SELECT k, p AS j, x AS y FROM l WHERE flag = 'N'),
      n AS (SELECT k, (SELECT count(*) FROM a WHERE a.k = s.k) AS n, (SELECT count(*) FROM b WHERE b.k = s.k) AS m FROM (SELECT DISTINCT a.k FROM a JOIN b USING (k)) s),
      alike AS (SELECT k, i, j, {_like("x", "y")} AS s FROM a JOIN b USING (k)),
      best AS (
        SELECT k, n AS i, unnest(range(m + 1)) AS j, 0::BIGINT AS v FROM n
        UNION ALL
        SELECT k, i, j, max(c) OVER (PARTITION BY k ORDER BY j DESC) FROM (
          SELECT t.k, t.i - 1 AS i, t.j, CASE WHEN s THEN 1 + coalesce(lead(t.v) OVER (PARTITION BY t.k ORDER BY t.j), 0) ELSE t.v END AS c
          FROM best t LEFT JOIN alike ON alike.k = t.k AND alike.i = t.i - 1 AND alike.j = t.j WHERE t.i > 0)),
      walk AS (
        SELECT k, 0::BIGINT AS i, 0::BIGINT AS j, false AS paired FROM n
        UNION ALL
        SELECT w.k, CASE WHEN s OR d.v >= r.v THEN w.i + 1 ELSE w.i END, CASE WHEN s OR d.v < r.v THEN w.j + 1 ELSE w.j END, s
        FROM walk w JOIN alike e ON e.k = w.k AND e.i = w.i AND e.j = w.j JOIN best d ON d.k = w.k AND d.i = w.i + 1 AND d.j = w.j JOIN best r ON r.k = w.k AND r.i = w.i AND r.j = w.j + 1),
      pairs AS (SELECT k, i - 1 AS i, j - 1 AS j FROM walk WHERE paired),
      oa AS (SELECT a.k, list(x ORDER BY i) AS o FROM a ANTI JOIN pairs USING (k, i) GROUP BY a.k), ob AS (SELECT b.k, list(y ORDER BY j) AS o FROM b ANTI JOIN pairs USING (k, j) GROUP BY b.k),
      moved AS (SELECT k, count(DISTINCT i) AS c FROM (SELECT a.k, a.i FROM a ANTI JOIN pairs USING (k, i)) JOIN (SELECT b.k, b.j FROM b ANTI JOIN pairs USING (k, j)) USING (k) JOIN alike USING (k, i, j) WHERE s GROUP BY k)
    SELECT n.k AS orderkey, CASE WHEN n.n <> n.m THEN 'count' WHEN oa.o IS NULL THEN 'agree' WHEN moved.c = len(oa.o) AND len(oa.o) = len(ob.o) THEN 'order' ELSE 'artists' END AS kind,
           coalesce(p.c, 0) AS matched, coalesce(array_to_string(oa.o, '; '), '') AS only_a, coalesce(array_to_string(ob.o, '; '), '') AS only_b
    FROM n LEFT JOIN oa USING (k) LEFT JOIN ob USING (k) LEFT JOIN moved USING (k) LEFT JOIN (SELECT k, count(*) AS c FROM pairs GROUP BY k) p USING (k)
""")
def list_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part lists of two return flags of an order, aligned under fuzzy equality."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    keys = p.select("p_name").distinct().withColumn("key", K.norm("p_name"))
    rows = table(spark, sf_dir, "lineitem").join(p, "l_partkey").join(keys, "p_name")
    order = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_shipdate", "key"))), lambda x: x["key"])
    lists = rows.groupBy("l_orderkey", "l_returnflag").agg(order.alias("items"))
    both = lists.where("l_returnflag = 'A'").select("l_orderkey", F.col("items").alias("a")).join(lists.where("l_returnflag = 'N'").select("l_orderkey", F.col("items").alias("b")), "l_orderkey")
    found = with_comparison(both, "a", "b")
    return found.select(F.col("l_orderkey").alias("orderkey"), "c.kind", F.col("c.matched").cast("long").alias("matched"), F.array_join("c.only_a", "; ").alias("only_a"), F.array_join("c.only_b", "; ").alias("only_b"))


@query("""
    SELECT l_orderkey AS orderkey, l_partkey AS partkey, l_suppkey AS suppkey, l_quantity AS quantity, count(*) OVER (PARTITION BY l_orderkey) AS lines,
           CASE WHEN l_discount > 0.05 THEN l_discount END AS discount, CASE WHEN l_discount > 0.05 THEN l_returnflag END AS discount_from FROM lineitem
""")
def nested_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines nested under their order as JSON, read back and flattened; dependent fields only beside their anchor."""
    from ..operators.merge import shaped

    item = F.struct(F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey"), F.col("l_quantity").alias("quantity"), F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("discount"), F.col("l_returnflag").alias("discount_from"))
    nested = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("orderkey")).agg(F.to_json(F.collect_list(item)).alias("tracks"))
    schema = "array<struct<partkey: bigint, suppkey: bigint, quantity: double, discount: double, discount_from: string>>"
    read = nested.select("orderkey", F.from_json("tracks", schema).alias("tracks")).withColumn("lines", F.size("tracks").cast("long"))
    flat = read.select("orderkey", "lines", F.inline("tracks"))
    return shaped(flat, ["orderkey", "partkey", "suppkey", "quantity", "lines", "discount", "discount_from"], {"discount_from": "discount"})


@query("""
    WITH a AS (SELECT c_custkey AS custkey, o_orderkey AS orderkey, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_totalprice > 400000),
         s1 AS (SELECT custkey, orderkey FROM a WHERE p = 1),
         b AS (SELECT c_custkey AS custkey, o_orderkey AS orderkey, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM customer JOIN orders ON o_custkey = c_custkey
               WHERE o_orderpriority LIKE '1%' AND c_custkey NOT IN (SELECT custkey FROM s1)), s2 AS (SELECT custkey, orderkey FROM b WHERE p = 1),
         c AS (SELECT c_custkey AS custkey, min(o_orderkey) AS orderkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_custkey NOT IN (SELECT custkey FROM s1 UNION ALL SELECT custkey FROM s2) GROUP BY 1)
    SELECT custkey, orderkey, 1 AS stage FROM s1 UNION ALL SELECT custkey, orderkey, 2 FROM s2 UNION ALL SELECT custkey, orderkey, 3 FROM c
""")
def staged_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search in steps, each only for what the steps before did not find."""
    from ..operators.pick import best

    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")
    early = [F.col("o_orderdate"), F.col("o_orderkey")]
    pick = lambda rows, rank: best(rows, "custkey", rank, ["o_orderkey"]).withColumnRenamed("o_orderkey", "orderkey")
    stages = [
        lambda left: pick(orders.where("o_totalprice > 400000").join(left, "custkey", "left_semi"), early),
        lambda left: pick(orders.where("o_orderpriority like '1%'").join(left, "custkey", "left_semi"), early),
        lambda left: pick(orders.join(left, "custkey", "left_semi"), [F.col("o_orderkey")]),
    ]
    found = R.staged(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey")), "custkey", stages)
    return found.select("custkey", "orderkey", F.col("stage").cast("int").alias("stage"))
