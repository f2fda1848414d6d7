"""Keeping an archive: what is shown of a track, what is pending, what is written back, which list of a broadcast is taken."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import extract as X
from ..operators import catalogue as C
from ..operators import dictionary as D
from ..operators import merge as M
from ..operators import pick as P
from ..operators import windows as W
from ..operators.durable import new_folder
from ..queries import query, table
from ..sources import episodes as E
from ..sources import readers as R
from ..sources import sinks
from ..streaming import incremental as I
from . import cases as S

_PRINTED, _LABEL = ["UK", "USA", "Europe", "?"], ["Mute", "mute records", "self-released", "?", ""]


@query(f"""
    WITH t AS (SELECT p_partkey AS id, p_brand AS artist, p_name AS track, p_type AS album, CASE WHEN p_size % 6 > 0 THEN {S.sql(_PRINTED, "p_partkey")} END AS printed, CASE WHEN p_size % 7 > 0 THEN {S.sql(_LABEL, "p_partkey")} END AS label, CASE WHEN p_size % 8 = 0 THEN 'DE' END AS stored,
                      CASE WHEN p_size % 16 = 0 THEN 'archive' END AS stored_from, CASE WHEN p_size % 2 = 0 THEN 'Warp' END AS theirs, CASE WHEN p_size % 3 > 0 THEN 1990 END AS year FROM part),
         c AS (SELECT *, CASE WHEN printed IN ('UK', 'USA') THEN CASE printed WHEN 'UK' THEN 'GB' ELSE 'US' END WHEN printed IS NULL THEN stored WHEN stored IS NOT NULL AND stored_from IS NOT NULL THEN stored WHEN printed = 'Europe' THEN 'EU' WHEN printed = '?' THEN NULL ELSE stored END AS country,
                      CASE WHEN printed IS NULL OR printed IN ('Europe', '?') THEN stored_from END AS country_from FROM t),
         r AS (SELECT * REPLACE (CASE WHEN artist = 'Brand#13' AND track = 'cold widget' THEN 'Cold Widget' ELSE track END AS track) FROM c), s AS (SELECT * REPLACE (CASE artist WHEN 'Brand#5' THEN 'Brand Five' ELSE artist END AS artist) FROM r),
         l AS (SELECT *, CASE WHEN label IS NULL OR label = 'self-released' THEN NULL WHEN label IN ('Mute', 'mute records') THEN 'Mute' ELSE theirs END AS labels, CASE WHEN label IN ('?', '') AND theirs IS NOT NULL THEN 'discogs' END AS label_from FROM s),
         o AS (SELECT * REPLACE (CASE WHEN artist = 'Brand#7' AND album = 'PROMO' THEN 1971 WHEN artist = 'Brand#7' THEN 1970 ELSE year END AS year) FROM l)
    SELECT id, artist, track, country, CASE WHEN country IS NOT NULL THEN country_from END AS country_from, labels AS label, label_from, CAST(year AS BIGINT) AS year FROM o
""")
def corrected_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A track as it is shown: country, names, labels, then the hand fixes."""
    k, s = F.col("p_partkey"), F.col("p_size")
    tracks = table(spark, sf_dir, "part").select(
        k.alias("id"), F.col("p_brand").alias("artist"), F.col("p_name").alias("track"), F.col("p_type").alias("album"), F.when(s % 6 > 0, S.of(_PRINTED, k)).alias("printed_country"), F.when(s % 7 > 0, S.of(_LABEL, k)).alias("printed_label"),
        F.when(s % 8 == 0, F.array(F.lit("DE"))).alias("country"), F.when(s % 16 == 0, "archive").alias("country_from"), F.when(s % 2 == 0, F.array(F.lit("Warp (2)"))).alias("catalogue_labels"), F.when(s % 3 > 0, 1990).alias("year"),
    )
    countries = spark.createDataFrame([("UK", ["GB"]), ("USA", ["US"]), ("Europe", ["EU"]), ("?", None)], "spelling string, codes array<string>")
    titles = spark.createDataFrame([(0, "Brand#13", "cold widget", None, None, "Cold Widget", None)], "pos int, artist string, track string, album string, to_artist string, to_track string, to_album string")
    spellings = spark.createDataFrame([("Brand#5", "Brand Five")], "spelling string, name string")
    labels = D.closure(spark.createDataFrame([("mute records", "Mute"), ("Mute", "Mute")], "spelling string, name string"))
    fixes = spark.createDataFrame([(0, "brand#7", None, None, 1970), (1, "Brand#7", None, "promo", 1971)], "pos int, artist string, track string, album string, set_year int")
    columns = ["artist", "track", "album", "country", "country_from", "label", "label_from", "year"]
    shown = C.corrected(tracks, "id", countries, titles, spellings, labels, fixes, columns, {"country_from": "country", "label_from": "label"})
    listed = lambda c: F.array_join(c, "|").alias(c)
    return shown.select("id", "artist", "track", listed("country"), "country_from", listed("label"), "label_from", F.col("year").cast("long").alias("year"))


@query("""
    WITH l AS (SELECT o_custkey AS number, CASE o_orderkey % 4 WHEN 0 THEN 'site' WHEN 1 THEN 'cue' WHEN 2 THEN 'base' ELSE 'post' END AS kind, o_orderstatus AS label, count(*) AS size, min(o_orderdate)::DATE AS d FROM orders GROUP BY ALL),
         one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY number, kind ORDER BY size DESC, label) AS nth FROM l) WHERE nth = 1),
         m AS (SELECT *, coalesce(max(CASE WHEN kind <> 'base' THEN size END) OVER (PARTITION BY number), 0) AS most, list_position(['site', 'post', 'cue', 'base'], kind) AS rank FROM one),
         c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY number ORDER BY CASE WHEN kind = 'base' OR size >= most - 1 THEN 0 ELSE 1 END, rank) AS pick FROM m) WHERE pick = 1),
         n AS (SELECT c.*, lag(d) OVER (ORDER BY number) AS before, lead(d) OVER (ORDER BY number) AS after FROM c),
         v AS (SELECT n.number, n.d AS mine, n.before, n.after, m.d, count(*) AS votes, min(m.rank) AS rank FROM n JOIN m ON m.number = n.number AND m.kind <> n.kind GROUP BY ALL),
         o AS (SELECT number, max(CASE WHEN d <> mine THEN votes END) AS top_n, arg_min(d, (-votes, rank, d)) FILTER (d <> mine) AS top, sum(CASE WHEN d = mine THEN votes ELSE 0 END) AS own, arg_min(d, (rank, d)) FILTER (d <> mine AND (before IS NULL OR d > before) AND (after IS NULL OR d < after)) AS fitting FROM v GROUP BY number),
         x AS (SELECT m.number, max(size) AS longest FROM m JOIN (SELECT number, kind AS k FROM c) USING (number) WHERE kind <> k AND kind <> 'base' GROUP BY m.number)
    SELECT n.number, n.kind, n.label, strftime(CASE WHEN top_n >= 2 AND own = 0 THEN top WHEN NOT ((before IS NULL OR d > before) AND (after IS NULL OR d < after)) AND fitting IS NOT NULL THEN fitting ELSE d END, '%Y-%m-%d') AS day,
           CASE WHEN top_n >= 2 AND own = 0 THEN 'outvoted' WHEN NOT ((before IS NULL OR d > before) AND (after IS NULL OR d < after)) AND fitting IS NOT NULL THEN 'misplaced' ELSE 'own' END AS why, n.size,
           CASE WHEN coalesce(longest, 0) >= n.size + 2 THEN 'shorter' WHEN n.size < 10 THEN 'short' END AS incomplete
    FROM n LEFT JOIN o USING (number) LEFT JOIN x USING (number)
""")
def broadcast_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list a broadcast out of all its sources', with the date they vote for and what is odd about it."""
    k = F.col("o_orderkey") % 4
    kind = F.when(k == 0, "site").when(k == 1, "cue").when(k == 2, "base").otherwise("post")
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("number"), kind.alias("kind"), F.col("o_orderstatus").alias("label"))
    lists = o.agg(F.min("o_orderdate").cast("date").alias("date"), F.collect_list(F.lit('1. A "b"')).alias("entries"))
    got = E.consolidated(lists, ["site", "post", "cue", "base"], ["base"])
    return got.select("number", "kind", "label", F.col("date").cast("string").alias("day"), F.col("date_from").alias("why"), F.size("entries").cast("long").alias("size"), "incomplete")


@query("""
    WITH l AS (SELECT l_orderkey AS k, l_returnflag AS kind, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT a.k AS number, a.kind AS a, b.kind AS b, CASE WHEN a.n <> b.n THEN 'count' ELSE 'agree' END AS kind, least(a.n, b.n) AS matched FROM l a JOIN l b USING (k) WHERE (a.kind, b.kind) IN (('A', 'N'), ('A', 'R'))
""")
def list_cross_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of two kinds that an order has, compared artist by artist: here one artist in all of them, under several spellings."""
    name = S.of(["Beirut", "beirut", "The Beirut", "Beirut (USA)"], F.col("l_linenumber"))
    entry = F.concat(F.lit("1. "), name, F.lit(' "'), F.col("l_partkey"), F.lit('"'))
    lists = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("number"), F.col("l_returnflag").alias("kind")).agg(F.collect_list(entry).alias("entries"))
    return E.cross_check(lists, [("A", "N"), ("A", "R")]).select("number", "a", "b", "kind", F.col("matched").cast("long").alias("matched"))


@query("""
    WITH w AS (SELECT number, after, CASE WHEN number % 3 > 0 THEN day END AS day FROM (SELECT c_custkey AS number, c_custkey * 1000 AS after, strftime(date '2000-01-01' + (c_custkey % 900)::INT, '%Y-%m-%d') AS day FROM customer))
    SELECT number, last_value(day IGNORE NULLS) OVER (ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, first_value(day IGNORE NULLS) OVER (ORDER BY number ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS behind FROM w
""")
def neighbouring_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest known days before and behind each number of a whole table, found by blocks of numbers."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k.alias("number"), F.when(k % 3 > 0, F.date_add(F.lit("2000-01-01").cast("date"), (k % 900).cast("int")).cast("string")).alias("day"))
    return W.neighbours_by_number(rows, "day", "number", 64).select("number", "before", F.col("after").alias("behind"))


@query("""
    SELECT doc_id, lang AS stored_lang, CASE WHEN doc_id % 13 = 0 THEN 'en' WHEN doc_id % 17 = 0 THEN 'de' ELSE lang END AS lang, CASE WHEN doc_id % 13 = 0 THEN 'hand' ELSE source END AS source,
           regexp_matches(coalesce(lang, '') || chr(10) || coalesce(source, ''), '^(en|de)\n.*o') AS wanted FROM documents
""")
def exception_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-made exceptions by key, where the table has a value; and rows chosen by a pattern over several columns."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    fixes = d.where("doc_id % 13 = 0 or doc_id % 17 = 0").select("doc_id", F.when(F.col("doc_id") % 13 == 0, "en").otherwise("de").alias("lang"), F.when(F.col("doc_id") % 13 == 0, "hand").alias("source"))
    wanted = M.matching(d, r"\A(?:en|de)\n.*o", ["lang", "source"]).select("doc_id", F.lit(True).alias("wanted"))
    rows = E.exceptions(d, fixes, "doc_id", ["lang", "source"]).join(d.select("doc_id", F.col("lang").alias("stored_lang")), "doc_id").join(wanted, "doc_id", "left")
    return rows.select("doc_id", "stored_lang", "lang", "source", F.coalesce("wanted", F.lit(False)).alias("wanted"))


@query("""
    WITH w AS (SELECT DISTINCT lang AS name FROM documents WHERE lang IS NOT NULL), k AS (SELECT unnest(['en', 'xx']) AS name, unnest(['English', 'Other']) AS shown)
    SELECT name, shown FROM k UNION ALL SELECT name, upper(name) FROM w WHERE name NOT IN (SELECT name FROM k)
""")
def dictionary_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary with the entries it lacks; what is there is never changed."""
    table_ = spark.createDataFrame([("en", "English"), ("xx", "Other")], "name string, shown string")
    new = table(spark, sf_dir, "documents").select(F.col("lang").alias("name")).where("name is not null").distinct().withColumn("shown", F.upper("name"))
    return D.grown(table_, new, "name")


@query("""
    WITH p AS (SELECT o_orderpriority AS program, o_orderkey AS k, o_totalprice AS v FROM orders) SELECT program, k, CASE WHEN program LIKE '1%' THEN -1.0 ELSE v END AS v FROM p WHERE NOT (program LIKE '1%' AND k % 2 = 1)
""")
def partition_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written by program, of which one program is written again: the others stay."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("program"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    folder = new_folder(spark, "partitions")
    sinks.write_partitions(rows, folder, "program")
    sinks.write_partitions(rows.where("program like '1%' and k % 2 = 0").withColumn("v", F.lit(-1.0)), folder, "program")
    return spark.read.parquet(folder).select("program", "k", "v")


@query("""
    SELECT o_custkey AS k, string_agg(o_orderpriority, '; ' ORDER BY o_orderkey) AS priorities, '«' || min(o_orderkey) || '»' || CASE WHEN count(*) > 1 THEN ', «' || list_sort(list(o_orderkey))[2] || '»' ELSE '' END || CASE WHEN count(*) > 2 THEN ' and ' || (count(*) - 2) || ' more' ELSE '' END AS named
    FROM orders GROUP BY o_custkey
""")
def csv_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists as a CSV download has them, written and read, and as a report names them."""
    item = F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority")))
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(item.alias("i"))
    rows = rows.select("k", F.transform("i", lambda x: x["o_orderpriority"]).alias("priorities"), sinks.named_list(F.transform("i", lambda x: x["o_orderkey"].cast("string")), 2).alias("named"))
    folder = f"{new_folder(spark, 'csv')}/csv"
    sinks.write_csv(rows, folder)
    return spark.read.csv(folder, schema="k long, priorities string, named string", header=True, escape='"')


@query("""
    WITH d AS (SELECT doc_id, lang, n_chars, CASE WHEN lang IS NULL THEN 'no language' WHEN n_chars < 100 THEN 'too short' WHEN n_chars > 50000 THEN 'too long' END AS doubt FROM documents) SELECT doc_id, lang, n_chars, doubt FROM d WHERE doubt IS NOT NULL
""")
def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The doubtful rows with why, for a person to go through."""
    why = F.when(F.col("lang").isNull(), "no language").when(F.col("n_chars") < 100, "too short").when(F.col("n_chars") > 50_000, "too long")
    return sinks.review_queue(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), why, [F.col("doubt"), F.col("doc_id")])


@query("""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN doc_id % 5 = 0 THEN coalesce(text, '') || ' edited' ELSE coalesce(text, '') END AS now FROM documents),
         s AS (SELECT doc_id, substr(sha256(t), 1, 16) AS mark, doc_id % 3 = 0 AS lacks FROM d WHERE doc_id % 7 > 0)
    SELECT d.doc_id, s.mark IS NULL OR s.mark <> substr(sha256(now), 1, 16) AS pending, coalesce(lacks AND s.mark = substr(sha256(now), 1, 16), false) AS readable FROM d LEFT JOIN s USING (doc_id)
""")
def pending_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are new or edited since they were read, and those that may be read again for a field they lack because they are still the same."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    now = d.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" edited"))).otherwise(F.col("text")))
    stored = d.where("doc_id % 7 > 0").select("doc_id", M.content_hash("text").alias("mark"), F.when(F.col("doc_id") % 3 > 0, "x").alias("field"))
    pending = I.pending(now, stored, "doc_id", "text").select("doc_id", F.lit(True).alias("pending"))
    again = I.readable_again(stored, now, "doc_id", "field", 10**9).select("doc_id", F.lit(True).alias("readable"))
    flag = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return d.select("doc_id").join(pending, "doc_id", "left").join(again, "doc_id", "left").select("doc_id", flag("pending"), flag("readable"))


@query("""
    WITH n AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT k, 1 AS section, 1 + n AS lines, k % 900 + 1 AS number FROM n UNION ALL SELECT k, 2, 1 + n, NULL FROM n WHERE k % 2 = 0 UNION ALL SELECT k, 0, 2, NULL FROM n
""")
def playlist_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles cut at header lines that entries follow; a line that only mentions a playlist begins nothing."""
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    entry = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.concat(i.cast("string"), F.lit('. A "b"')))
    before = F.array(F.lit("A text that mentions a playlist"), F.lit("and goes on"))
    first = F.concat(F.array(F.concat(F.lit("Плейлист (выпуск "), (F.col("k") % 900 + 1).cast("string"), F.lit("):"))), entry)
    second = F.when(F.col("k") % 2 == 0, F.concat(F.array(F.lit("Play-list of the week")), entry)).otherwise(F.array().cast("array<string>"))
    # what a line mentions three lines above an entry is no header, so the text before is longer than that
    lines = n.select("k", F.posexplode(F.concat(before, first, second)).alias("pos", "line"))
    header = F.col("line").rlike(r"(?iu)\A(?:пл[еэ]й-?\s?лист|play-?\s?list|трек-?\s?лист)")
    cut = R.sections(lines, ["k"], header)
    return cut.groupBy("k", "section").agg(F.count(F.lit(1)).alias("lines"), F.max(F.when(header, X.header_number("line"))).cast("long").alias("number")).select("k", F.col("section").cast("int").alias("section"), "lines", "number")


@query("""
    WITH t AS (SELECT l_orderkey AS k, l_linenumber AS i, l_suppkey % 40 + 1970 AS year, l_returnflag AS flag, l_shipdate AS d, l_partkey AS p, l_quantity AS q, l_extendedprice AS e FROM lineitem),
         r AS (SELECT k, i, flag, CASE WHEN year <= 1995 THEN year END AS kept, year AS y, p, q, e FROM t)
    SELECT flag, greatest(1950, (y // 10) * 10) AS decade, count(*) AS n, count(kept) AS kept, min(kept) AS first, CAST(sum(q) AS BIGINT) AS q FROM r GROUP BY ALL
""")
def years_by_decade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years that are not after a bound, by decade."""
    year = F.col("l_suppkey") % 40 + 1970
    t = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), W.decade(year).cast("long").alias("decade"), P.not_after(year, F.lit(1995)).alias("kept"), "l_quantity")
    return t.groupBy("flag", "decade").agg(F.count(F.lit(1)).alias("n"), F.count("kept").alias("kept"), F.min("kept").alias("first"), F.sum("l_quantity").cast("long").alias("q"))


@query("""
    SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN lower(lang) = lower(source) ELSE true END AS same, coalesce(CASE WHEN doc_id % 3 > 0 THEN doc_id::VARCHAR END, '2001-01-0' || doc_id % 9) AS key FROM documents
""")
def row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality of names but for case and spaces, null like empty; a row's key: its number, else its date."""
    d = table(spark, sf_dir, "documents")
    other = F.when(F.col("doc_id") % 4 == 0, F.col("source")).otherwise(F.concat(F.lit(" "), F.upper("lang"), F.lit("  ")))
    key = F.coalesce(F.when(F.col("doc_id") % 3 > 0, F.col("doc_id").cast("string")), F.concat(F.lit("2001-01-0"), F.col("doc_id") % 9))
    return d.select("doc_id", D.same(F.col("lang"), other).alias("same"), key.alias("key"))


_TEXTS = ["&laquo;A&raquo; &amp; B&hellip;", "&#1078;&#x416; &bdquo;x&rdquo;", "&AMP; &nbsp;y &copy; &unknown;", "plain ​ text  here", "&amp;lt; &apos;&quot;"]


@query(f"""
    WITH t AS (SELECT p_partkey AS k, {S.sql(_TEXTS, "p_partkey")} AS t, p_partkey % 5 AS i FROM part)
    SELECT k, (['«A» & B…', 'жЖ „x”', '&  y © &unknown;', 'plain ​ text  here', '&lt; ''"'])[i + 1] AS page, (['«A» & B…', 'жЖ &bdquo;x”', '&  y &copy; &unknown;', 'plain ​ text  here', '&lt; ''"'])[i + 1] AS article,
           (['&laquo;A&raquo; & B&hellip;', 'жЖ &bdquo;x&rdquo;', '&AMP; &nbsp;y &copy; &unknown;', 'plain ​ text  here', '&lt; ''"'])[i + 1] AS dump, (['&laquo;A&raquo; & B&hellip;', 'ж&#x416; &bdquo;x&rdquo;', '&AMP; &nbsp;y &copy; &unknown;', 'plain ​ text  here', '&lt; ''"'])[i + 1] AS feed,
           trim(regexp_replace(replace(t, '​', ''), '[\\s ]+', ' ', 'g')) AS clean, CASE WHEN k % 3 = 0 THEN t WHEN k % 3 = 1 THEN (['&laquo;A&raquo; & B&hellip;', 'ж&#x416; &bdquo;x&rdquo;', '&AMP; &nbsp;y &copy; &unknown;', 'plain ​ text  here', '&lt; ''"'])[i + 1] END AS element FROM t
""")
def entity_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four ways in which references are decoded, spaces made single, and an XML element's text: CDATA as it is, else decoded, empty as null."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(k.alias("k"), S.of(_TEXTS, k).alias("t"))
    xml = F.when(F.col("k") % 3 == 0, F.concat(F.lit("<a>no</a><b x='1'> <![CDATA["), "t", F.lit("]]> </b>"))).when(F.col("k") % 3 == 1, F.concat(F.lit("<b>"), "t", F.lit("</b>"))).otherwise("<b> </b>")
    return rows.select("k", *(X.decode_entities("t", kind).alias(kind) for kind in ("page", "article", "dump", "feed")), X.clean("t").alias("clean"), X.xml_element(xml, "b").alias("element"))




@query("""
    WITH f AS (SELECT l_orderkey AS url, l_orderkey * 10 + l_linenumber AS key FROM lineitem GROUP BY ALL), d AS (SELECT * FROM f WHERE key % 3 = 0 OR url % 4 = 0 OR (url % 7 = 0 AND key % 2 = 0)),
         o AS (SELECT url FROM f GROUP BY url HAVING count(*) > (SELECT count(*) FROM d WHERE d.url = f.url))
    SELECT url, key FROM f WHERE url IN (SELECT url FROM o) AND key NOT IN (SELECT key FROM d)
""")
def unfiled_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of articles that are not filed yet; nothing of an article that has all of its own."""
    k = F.col("l_orderkey")
    found = table(spark, sf_dir, "lineitem").select(k.alias("url"), (k * 10 + F.col("l_linenumber")).alias("key")).distinct()
    filed = found.where("key % 3 = 0 or url % 4 = 0 or (url % 7 = 0 and key % 2 = 0)")
    return I.unfiled(found, filed, "url", "key").select("url", "key")


@query("""
    WITH w AS (SELECT DISTINCT l_suppkey AS id FROM lineitem) SELECT id, CASE WHEN id % 3 = 0 THEN 'kept' ELSE 'asked' END AS via, CASE WHEN id % 3 = 0 THEN 1900 + id % 100 ELSE 2000 + id % 10 END AS year FROM w
""")
def remembered_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years from a table of answers, and of the others by asking for each once."""
    known = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("id"), F.lit("kept").alias("via"), (1900 + F.col("s_suppkey") % 100).alias("year"))
    return I.remembered(known, table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("id")), "id", lambda ids: ids.select("id", F.lit("asked").alias("via"), (2000 + F.col("id") % 10).alias("year")))
