"""Sources and sinks: what is written in each form reads back as it should. Each query prints the table's rows in a form, reads that, and its SQL says what must come out."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import extract as X
from ..operators.durable import new_folder
from ..queries import query, table
from ..sources import episodes as E
from ..sources import readers as R
from ..sources import sinks
from . import cases as S


@query("""
    WITH o AS (SELECT o_orderkey AS k, substr('abc', (o_custkey % 3 + 1)::INT, 1) AS program, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS title FROM orders WHERE o_orderkey % 23 > 0)
    SELECT program, CASE WHEN k % 10 > 0 THEN k END AS number, CASE WHEN k % 10 = 0 THEN day || '' WHEN k % 3 > 0 THEN day END AS date, CASE WHEN k % 4 > 0 THEN 'https://x.org/' || k END AS url, title, CASE WHEN k % 7 = 0 THEN 'a note' END AS note,
           md5('1. A "b"' || chr(10) || '2. C "' || k || '"') AS text_md5, CAST(row_number() OVER (PARTITION BY program ORDER BY CASE WHEN k % 10 > 0 THEN 0 ELSE 1 END, CASE WHEN k % 10 > 0 THEN k END DESC, CASE WHEN k % 10 = 0 THEN day WHEN k % 3 > 0 THEN day ELSE '' END DESC, k) AS BIGINT) AS place FROM o
""")
def playlist_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Playlist files as they are written, read back: header lines, text, and the order in which they are listed. Files by other names are passed over."""
    from pyspark.sql import Window

    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    program = F.substring(F.lit("abc"), (F.col("o_custkey") % 3 + 1).cast("int"), F.lit(1))
    entries = F.array(F.lit('1. A "b"'), F.concat(F.lit('2. C "'), k.cast("string"), F.lit('"')))
    text = sinks.playlist_text(F.when(k % 4 > 0, F.concat(F.lit("https://x.org/"), k)), F.when(k % 3 > 0, day), F.col("o_orderstatus"), F.when(k % 7 == 0, "a note"), entries)
    name = F.when(k % 23 == 0, F.concat(F.lit("draft-"), k)).when(k % 10 > 0, k.cast("string")).otherwise(day)
    files = table(spark, sf_dir, "orders").select(F.concat(F.lit("/data/"), program, F.lit("/playlists/"), name, F.lit(".txt")).alias("path"), text.alias("value"), k.alias("k"))
    rows = R.playlist_rows(files)
    last = X.found("text", r'C "(\d+)"').cast("long")
    place = F.row_number().over(Window.partitionBy("program").orderBy(*R.newest_first(), last)).cast("long")
    return rows.withColumn("place", place).select("program", F.col("number").cast("long").alias("number"), "date", "url", "title", "note", F.md5(F.col("text").cast("binary")).alias("text_md5"), "place")


def _encoded(name: str):
    @F.arrow_udf(T.BinaryType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else t.encode(name) for t in texts.to_pylist()], pa.binary())

    return run


_in_cp1251, _in_cp866 = _encoded("cp1251"), _encoded("cp866")


def _written(rows: DataFrame, name: str, kind: str, **options) -> str:
    """The rows in a folder of the shared place."""
    folder = f"{new_folder(rows.sparkSession, name)}/{name}"
    rows.write.format(kind).options(**options).save(folder)
    return folder


@query("""
    WITH p AS (SELECT p_partkey AS k, p_size AS s, p_name AS n, p_brand AS b, p_type AS t FROM part)
    SELECT k AS id, CASE WHEN s % 3 > 0 THEN k + 1 END AS main, CASE WHEN s % 4 > 0 THEN 1960 + s END AS year, n || ' & <' || b || '>' AS title, 'ok' AS quality, CASE WHEN s % 5 > 0 THEN k + 1 || ':' || b || ':' || b || ' Band' ELSE '-:X:-' END AS artists,
           t AS genres, CASE WHEN s % 2 = 0 THEN 'Pop' ELSE '' END AS styles, n AS videos FROM p
""")
def xml_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump of masters in XML, written and read: ids, names without namesake marks, genres that are no numbers."""
    k, s, n, b = F.col("p_partkey"), F.col("p_size"), F.col("p_name"), F.col("p_brand")
    listed = lambda name, c: F.struct(c.alias(name))
    artist = F.when(s % 5 > 0, F.struct((k + 1).alias("id"), F.concat(b, F.lit(" (2)")).alias("name"), F.concat(b, F.lit(" Band*")).alias("anv"))).otherwise(F.struct(F.lit(0).cast("long").alias("id"), F.lit("X").alias("name"), F.lit("").alias("anv")))
    rows = table(spark, sf_dir, "part").select(
        k.alias("_id"), F.when(s % 3 > 0, k + 1).alias("main_release"), listed("artist", F.array(artist)).alias("artists"), F.concat(n, F.lit(" & <"), b, F.lit(">")).alias("title"), F.when(s % 4 > 0, 1960 + s).otherwise(0).alias("year"),
        F.lit("ok").alias("data_quality"), listed("genre", F.array(F.col("p_type"), F.lit("12"))).alias("genres"), listed("style", F.when(s % 2 == 0, F.array(F.lit("Pop")))).alias("styles"), listed("video", F.array(listed("title", n))).alias("videos"),
    )
    m = R.masters(spark, _written(rows, "masters", "xml", rowTag="master", rootTag="masters"))
    text = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("-"))
    named = F.transform("artists", lambda a: F.concat_ws(":", F.coalesce(a["id"].cast("string"), F.lit("-")), a["name"], text(a["anv"])))
    return m.select("id", "main", F.col("year").cast("long").alias("year"), "title", "quality", F.array_join(named, "|").alias("artists"), F.array_join("genres", "|").alias("genres"), F.array_join("styles", "|").alias("styles"), F.array_join("videos", "|").alias("videos"))


@query("""
    WITH p AS (SELECT p_partkey AS k, p_size AS s, p_name AS n, p_brand AS b FROM part)
    SELECT k AS id, n AS title, CASE WHEN s % 3 > 0 THEN 1960 + s END AS year, CASE WHEN s % 4 > 0 THEN k // 2 END AS master, s % 5 = 0 AS compilation, s % 6 = 0 AS reissue, s % 7 = 0 AS unofficial, 'UK' AS country, b AS labels,
           n || ' = ' || b || '|' || n || '|' || b || '|Part' AS titles FROM p WHERE k // 2 > 0 OR s % 4 = 0
    UNION ALL SELECT k, n, CASE WHEN s % 3 > 0 THEN 1960 + s END, NULL, s % 5 = 0, s % 6 = 0, s % 7 = 0, 'UK', b, n || ' = ' || b || '|' || n || '|' || b || '|Part' FROM p WHERE NOT (k // 2 > 0 OR s % 4 = 0)
""")
def xml_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump of releases in XML, written and read: year, master, kinds, labels and all titles of a track, its parts' and both halves of "A = B"."""
    k, s, n, b = F.col("p_partkey"), F.col("p_size"), F.col("p_name"), F.col("p_brand")
    kinds = F.filter(F.array(F.lit("LP"), F.when(s % 5 == 0, "Compilation"), F.when(s % 6 == 0, "Repress"), F.when(s % 7 == 0, "Unofficial Release")), lambda x: x.isNotNull())
    rows = table(spark, sf_dir, "part").select(
        k.alias("_id"), F.struct(F.array(F.struct(k.alias("id"), b.alias("name"))).alias("artist")).alias("artists"), n.alias("title"), F.struct(F.array(F.struct(b.alias("_name"))).alias("label")).alias("labels"),
        F.struct(F.array(F.struct(F.struct(kinds.alias("description")).alias("descriptions"))).alias("format")).alias("formats"), F.lit("UK").alias("country"), F.when(s % 3 > 0, F.concat((1960 + s).cast("string"), F.lit("-05-00"))).otherwise("?").alias("released"),
        F.when(s % 4 > 0, F.struct(F.lit(True).alias("_is_main_release"), F.floor(k / 2).alias("_VALUE"))).alias("master_id"),
        F.struct(F.array(F.struct(F.concat(n, F.lit(" = "), b).alias("title"), F.struct(F.array(F.struct(F.lit("Part").alias("title"))).alias("track")).alias("sub_tracks"))).alias("track")).alias("tracklist"),
    )
    r = R.releases(spark, _written(rows, "releases", "xml", rowTag="release", rootTag="releases"))
    titles = F.flatten(F.transform("tracks", lambda t: t["titles"]))
    return r.select("id", "title", F.col("year").cast("long").alias("year"), "master", "compilation", "reissue", "unofficial", "country", F.array_join("labels", "|").alias("labels"), F.array_join(titles, "|").alias("titles"))


@query("""
    SELECT 'g' || event_id AS guid, CASE WHEN user_id % 3 > 0 THEN user_id END AS number, strftime(date_trunc('second', ts) - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS published, 'http://x/' || event_id AS url, CAST(floor(value) AS BIGINT) % 60 + 60 * (user_id % 50) + 3600 AS seconds
    FROM events WHERE event_id % 11 > 0
""")
def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed's items, written as XML and read: number from the title, date, duration; without a guid they are left out."""
    e, u = F.col("event_id"), F.col("user_id")
    minutes, whole = u % 50, F.floor("value") % 60
    item = F.concat(
        F.lit("<item>"), F.when(e % 11 > 0, F.concat(F.lit("<guid>g"), e, F.lit("</guid>"))).otherwise(""), F.lit("<title>"), F.when(u % 3 > 0, F.concat(F.lit("Show #"), u)).otherwise("Special"), F.lit("</title><pubDate>Mon, "),
        F.date_format("ts", "d MMM yyyy HH:mm:ss"), F.lit(" +0300</pubDate><link>http://x/"), e, F.lit("</link><itunes:duration>"), F.format_string("1:%02d:%02d", minutes, whole), F.lit("</itunes:duration></item>"),
    )
    items = F.array_join(F.collect_list(item), "")
    feeds = table(spark, sf_dir, "events").groupBy((e % 8).alias("n")).agg(F.concat(F.lit("<rss><channel>"), items, F.lit("</channel></rss>")).alias("value"))
    folder = new_folder(spark, "feed")
    feeds.write.partitionBy("n").text(folder)
    f = R.feed(spark, f"{folder}/*")
    return f.select("guid", F.col("number").cast("long").alias("number"), F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"), "url", F.col("duration_sec").alias("seconds"))


@query(r"""
    WITH a AS (SELECT page_id, html, regexp_extract(html, '<article>(.*?)</article>', 1, 's') AS body FROM pages),
         l AS (SELECT page_id, html, list_filter(list_transform(string_split(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '<script\b.*?</script>', '', 'gis'), '<style\b.*?</style>', '', 'gis'),
                      '<(?:br|p|div|li|h\d|tr)\b[^>]*>', chr(10), 'gi'), '<[^>]+>', '', 'g'), '&quot;', '"'), '&amp;', '&'), chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS lines FROM a)
    SELECT page_id, len(lines) AS n_lines, md5(array_to_string(lines, chr(10))) AS lines_md5 FROM l WHERE contains(html, '<article>') UNION ALL SELECT page_id, NULL, NULL FROM l WHERE NOT contains(html, '<article>')
""")
def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each page's article, up to its own closing tag."""
    files = table(spark, sf_dir, "pages").select("page_id", F.col("page_id").cast("string").alias("file"), F.col("html").alias("value"))
    a = R.article_rows(files.select("file", "value"), "<article>").join(files.select("page_id", "file", F.contains("value", F.lit("<article>")).alias("has")), "file")
    return a.select("page_id", F.when(F.col("has"), F.size("lines").cast("long")).alias("n_lines"), F.when(F.col("has"), F.md5(F.array_join("lines", "\n").cast("binary"))).alias("lines_md5"))


@query("""
    WITH s AS (SELECT DISTINCT l_orderkey AS k, l_partkey AS p FROM lineitem), n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p) AS nth FROM s), b AS (SELECT n.*, p_name AS name, p_size % 8 = 0 AS talk FROM n JOIN part ON p_partkey = p),
         t AS (SELECT k, nth, name, p, row_number() OVER (PARTITION BY k ORDER BY nth) AS pos FROM b WHERE NOT talk)
    SELECT k AS number, string_agg(pos || '. Артист ' || p || ' "' || name || '"' || CASE WHEN k % 3 = 0 THEN ' CD "Альбом, второй" (Лейбл)' WHEN k % 3 = 1 THEN ' CD "Alb ' || p || '"' ELSE '' END, '|' ORDER BY pos) AS entries, CASE WHEN k % 50 = 7 THEN k + 0 END AS moved_from,
           CASE WHEN k % 4 = 0 THEN 'https://y.org/files/Show_N' || k || '_01.08.2010_1.cue' ELSE 'https://x.org/files/Show_N' || k || '_01.08.2010_1.cue' END AS url
    FROM t WHERE k % 60 <> 3 GROUP BY k
""")
def cue_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CUE sheets in two encodings, made of orders and read: talk left out, album and label in the performer of early ones, some ignored, some moved, some with their own address."""
    from pyspark.sql import Window

    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", (F.col("p_size") % 8 == 0).alias("talk"))
    songs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_partkey").distinct().withColumn("nth", F.row_number().over(Window.partitionBy("k").orderBy("l_partkey"))).join(part, "l_partkey")
    early, later = F.col("k") % 3 == 0, F.col("k") % 3 == 1
    performer = F.concat(F.lit("Артист "), F.col("l_partkey"), F.when(early, " [Альбом, второй, Лейбл]").otherwise(""))
    block = F.concat(
        F.format_string("\n  TRACK %02d AUDIO\n", F.col("nth")), F.lit('    TITLE "'), F.when(F.col("talk"), F.format_string("(Track %02d)", F.col("nth"))).otherwise(F.col("p_name")), F.lit('"\n    PERFORMER "'), performer, F.lit('"\n'),
        F.when(later, F.concat(F.lit("    REM XALBUM Alb "), F.col("l_partkey"), F.lit("\n"))).otherwise(""),
    )
    sheets = songs.groupBy("k").agg(F.concat(F.lit('TITLE "x"\nPERFORMER "y"'), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", block.alias("b")))), lambda x: x["b"]), "")).alias("text"))
    name = F.concat(F.lit("Show_N"), F.col("k"), F.lit("_01.08.2010_1.cue"))
    files = sheets.select(F.concat(F.lit("/cue/"), name).alias("path"), F.when(F.col("k") % 2 == 0, F.col("text").cast("binary")).otherwise(_in_cp1251("text")).alias("content"))
    keys = sheets.select("k", name.alias("file"))
    urls = keys.where("k % 4 = 0").select(F.concat(F.lit("https://y.org/files/"), "file").alias("url"))
    moved = keys.where("k % 50 = 7").select("file", F.col("k").cast("int").alias("number"), F.lit("a reason").alias("why"))
    found = R.cue_sources(R.cue_rows(files), "https://x.org/files", urls, moved).join(keys.where("k % 60 = 3").select("file"), "file", "left_anti")
    return found.select(F.col("number").cast("long").alias("number"), F.array_join("entries", "|").alias("entries"), F.col("moved_from").cast("long").alias("moved_from"), "url")


@query("""
    WITH r AS (SELECT o_custkey AS number, o_orderkey AS id, CASE WHEN o_orderkey % 6 > 0 THEN o_orderkey % 12 END AS sn, strftime(o_orderdate, '%Y-%m') AS day FROM orders),
         s AS (SELECT *, max(CASE WHEN sn IS NOT NULL THEN id END) OVER (PARTITION BY number ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r),
         t AS (SELECT s.*, CASE WHEN s.sn IS NOT NULL THEN s.sn ELSE coalesce(b.sn, -1) END AS a, CASE WHEN s.sn IS NOT NULL THEN s.id ELSE coalesce(s.before, -1) END AS i FROM s LEFT JOIN r b ON b.id = s.before AND b.number = s.number),
         e AS (SELECT number, string_agg(CASE WHEN sn IS NOT NULL THEN sn || '. ' ELSE '' END || 'A "' || id || '" (UK) "so, ng" CD "cd"', '|' ORDER BY a, i, sn IS NULL, id) AS entries, count_if(sn IS NULL) AS unnumbered, min(day) AS date, count(DISTINCT day) AS dates FROM t GROUP BY number),
         n AS (SELECT number, sn, count(*) AS c FROM r WHERE sn IS NOT NULL GROUP BY ALL), w AS (SELECT number, count_if(c > 1) AS repeated, max(sn) - min(sn) + 1 - count(*) AS skipped FROM n GROUP BY number)
    SELECT e.number, entries, unnumbered, date, dates, coalesce(repeated, 0) AS repeated, coalesce(skipped, 0) AS skipped FROM e LEFT JOIN w USING (number) WHERE e.number BETWEEN 3 AND 1000000
""")
def spreadsheet_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spreadsheet's rows, written as CSV with quotes, commas and breaks, read back and gathered: unnumbered rows behind the row entered before them, and what is odd."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        k.alias("ID"), F.col("o_custkey").alias("bNum"), F.date_format("o_orderdate", "yyyy-MM").alias("Date"), F.when(k % 6 > 0, k % 12).alias("sNum"), F.concat(F.lit('A  "'), k, F.lit('"')).alias("Artist"), F.lit("UK").alias("Country"), F.lit("so,\nng").alias("Song"),
        F.lit("cd").alias("CD"), F.lit("").alias("Label"), F.lit('a "comment",\nlong').alias("Comment"),
    )
    found = R.table_lists(R.table_rows(spark, _written(rows, "table", "csv", header=True, quote='"', escape='"', emptyValue="")), 3, 1_000_000)
    size = lambda c: F.size(c).cast("long").alias(c)
    return found.select(F.col("number").cast("long").alias("number"), F.array_join("entries", "|").alias("entries"), size("unnumbered"), "date", size("dates"), size("repeated"), size("skipped"))


@query("""
    SELECT p_partkey || ' ' || p_name AS spelling, pos, CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN '[' || p_brand || '] x' ELSE p_brand || pos END AS name
    FROM part, (SELECT unnest([0, 1]) AS pos) WHERE pos = 0 OR p_size % 3 = 2
""")
def spelling_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary in JSON whose values are a name, several, or null; a name may begin with a bracket."""
    brand = F.col("p_brand")
    value = F.when(F.col("p_size") % 3 == 0, "null").when(F.col("p_size") % 3 == 1, F.concat(F.lit('"['), brand, F.lit('] x"'))).otherwise(F.concat(F.lit('["'), brand, F.lit('0", "'), brand, F.lit('1"]')))
    entry = F.concat(F.lit('"'), F.col("p_partkey"), F.lit(" "), F.col("p_name"), F.lit('": '), value)
    # a file of so many entries is one object; files are read whole
    objects = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 8).alias("file")).agg(F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ",\n"), F.lit("}")).alias("value"))
    folder = new_folder(spark, "spellings")
    objects.write.partitionBy("file").text(folder)
    return R.dictionary(spark, f"{folder}/*").select("spelling", F.col("pos").cast("long").alias("pos"), "name")


@query("""
    WITH r AS (SELECT doc_id % 40 AS file, row_number() OVER (PARTITION BY doc_id % 40 ORDER BY doc_id) - 1 AS pos, lang AS artist, CASE WHEN doc_id % 3 > 0 THEN n_chars END AS year FROM documents) SELECT file, pos, artist, year FROM r
""")
def rule_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of rules in JSON: in the order of the file, with what each rule gives."""
    rule = F.to_json(F.struct(F.col("lang").alias("artist"), F.when(F.col("doc_id") % 3 > 0, F.col("n_chars")).alias("year"), (F.col("doc_id") % 40).alias("file")))
    lists = table(spark, sf_dir, "documents").groupBy((F.col("doc_id") % 40).alias("n")).agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", rule.alias("rule")))), lambda x: x["rule"]), ","), F.lit("]")).alias("value"))
    folder = new_folder(spark, "rules")
    lists.write.partitionBy("n").text(folder)
    return R.rule_list(spark, f"{folder}/*", "artist string, year long, file long").select("file", F.col("pos").cast("long").alias("pos"), "artist", "year")


@query("""
    WITH l AS (SELECT l_orderkey AS k, min(l_linenumber) AS a, max(l_linenumber) AS b FROM lineitem GROUP BY l_orderkey)
    SELECT k AS number, 'f' || k AS file, '1. A "' || a || '"|2. B "' || b || '"' AS entries FROM l
""")
def tag_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON object of files' tags: the numbered lines of the comments, without the notes behind them."""
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_linenumber").alias("a"), F.max("l_linenumber").alias("b"))  # noqa: E741
    comment = F.concat(F.lit('hello\n1. A  "'), F.col("a"), F.lit('",(a note)\n\nnot one\n2. B "'), F.col("b"), F.lit('"'))
    entry = F.concat(F.lit('"'), F.col("k"), F.lit('": '), F.to_json(F.struct(F.concat(F.lit("f"), F.col("k")).alias("file"), F.lit("t").alias("title"), comment.alias("comment"))))
    objects = l.groupBy((F.col("k") % 16).alias("n")).agg(F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ","), F.lit("}")).alias("value"))
    folder = new_folder(spark, "tags")
    objects.write.partitionBy("n").text(folder)
    return R.tag_lists(spark, f"{folder}/*").select(F.col("number").cast("long").alias("number"), "file", F.array_join("entries", "|").alias("entries"))


@query("""
    SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 2 = 0 THEN 'cp866' ELSE 'cp1251' END AS encoding, '1. Новости & ' || o_orderkey || '|2. Сторона' AS entries
    FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 2013 UNION ALL
    SELECT o_orderkey, NULL, CASE WHEN o_orderkey % 2 = 0 THEN 'cp866' ELSE 'cp1251' END, '1. Новости & ' || o_orderkey || '|2. Сторона' FROM orders WHERE NOT year(o_orderdate) BETWEEN 1997 AND 2013
""")
def table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of tables in either Russian encoding: which one reads as Russian, the header's date, the entries by row."""
    k = F.col("o_orderkey")
    html = F.concat(F.lit("<b>PLAYLIST #"), k, F.lit(" "), F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit(".</b><table><tr><td>1. Новости &amp; "), k, F.lit("<br><i>пометка</i></td></tr><tr><td>2. <b>Сторона</b></td></tr><tr><td>конец</td></tr></table>"))
    pages = table(spark, sf_dir, "orders").select(k.cast("int").alias("k"), F.when(k % 2 == 0, _in_cp866(html)).otherwise(_in_cp1251(html)).alias("raw"))
    return E.table_page_lists(pages, "k", "raw").select(F.col("k").cast("long").alias("k"), F.col("date").cast("string").alias("day"), "encoding", F.array_join("entries", "|").alias("entries"))


@query("""
    WITH l AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT k, k AS number, strftime(date '2001-03-04' + (k % 300)::INT, '%Y-%m-%d') AS day, array_to_string(list_transform(range(1, n + 1), lambda i: i || CASE WHEN i % 2 = 0 THEN '. ' ELSE '. ' END || 'A (UK) "' || i * k || '"'), '|') AS entries,
           array_to_string(list_transform(range(1, n + 1), lambda i: i || '. A (UK) "' || i * k || '"'), '|') AS among, CASE WHEN k % 3 = 0 THEN 'вместо A был B' ELSE '' END AS remarks FROM l
""")
def page_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and posts of numbered lines: header, a number alone on its line, a note between entries, what follows the list; remarks behind "P.S."."""
    k = F.col("k")
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    title = lambda i: F.concat(F.lit('A (UK) "'), (i * k).cast("string"), F.lit('"'))
    # every fifth number stands alone; a note stands before every third entry but the first
    line = lambda i: F.concat(F.when((i % 3 == 0) & (i % 5 > 0), "<p>a note").otherwise(""), F.lit("<p>"), i.cast("string"), F.when(i % 5 == 0, ".<br>").otherwise(". "), title(i))
    day = F.date_format(F.date_add(F.lit("2001-03-04").cast("date"), (k % 300).cast("int")), "dd.MM.yyyy")
    listed = F.array_join(F.transform(F.sequence(F.lit(1).cast("long"), F.col("n")), line), "\n")
    html = F.concat(F.lit('<p>before<div id="m"><p>Intro<p>PLAYLIST #'), k, F.lit(" "), day, listed, F.lit('</div><p>The end<p>and more<p>99. Z "z"'))
    pages = n.select(k.cast("int").alias("key"), html.alias("html"))
    post = lambda i: F.concat(i.cast("string"), F.lit(". "), title(i), F.when(i % 2 == 0, " [a\nremark]").otherwise(""), F.lit("\nwhat the host says"))
    text = F.concat(F.lit("[a note of\nthe host]\n"), F.array_join(F.transform(F.sequence(F.lit(1).cast("long"), F.col("n")), post), "\n"), F.when(k % 3 == 0, "\nP.S.\nвместо A был B\nвыкинул").otherwise("\nP.S. bye"))
    posts = E.post_lists(n.select(k.cast("int").alias("key"), text.alias("text")), "key", "text")
    both = E.page_lists(pages, "key", "html", '<div id="m">').join(posts.select("key", F.array_join("entries", "|").alias("among"), F.array_join("remarks", "|").alias("remarks")), "key")
    return both.select(F.col("key").cast("long").alias("k"), F.col("number").cast("long").alias("number"), F.col("date").cast("string").alias("day"), F.array_join("entries", "|").alias("entries"), "among", "remarks")


_HEADERS = ['Плей-лист (выпуск 141):', 'Плейлист "Музыки" #356', "плейлист № 200", "Плейлист 307-го выпуска", "Show # 12 - The Title - more", "no number", "a-b - c", " - x"]


@query(rf"""
    WITH h AS (SELECT doc_id, {S.sql(_HEADERS, "doc_id")} AS h FROM documents)
    SELECT doc_id, CAST(coalesce(nullif(regexp_extract(h, '(?i)(?:выпуск\S*|#|№)\s*(\d+)', 1), ''), nullif(regexp_extract(h, '(?i)(\d+)-?(?:го|й|ый|ой)?\s+выпуск', 1), '')) AS BIGINT) AS header_number, CAST(nullif(regexp_extract(h, '#\s?(\d+)', 1), '') AS BIGINT) AS episode_number,
           trim(string_split(h, ' - ')[1]) AS artist, CASE WHEN contains(h, ' - ') THEN trim(substr(h, strpos(h, ' - ') + 3)) END AS title FROM h
""")
def header_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers in headers and titles, and what stands before and after the first dash."""
    d = table(spark, sf_dir, "documents").select("doc_id", S.of(_HEADERS, F.col("doc_id")).alias("h"))
    cut = X.split_once("h")
    return d.select("doc_id", X.header_number("h").cast("long").alias("header_number"), X.episode_number("h").cast("long").alias("episode_number"), cut["left"].alias("artist"), cut["right"].alias("title"))


@query("""
    WITH p AS (SELECT p_partkey AS k, p_size AS s, p_name AS n, p_brand AS b FROM part)
    SELECT k, b AS artist, CASE WHEN s % 5 = 4 THEN '' ELSE n END AS title, CASE WHEN s % 5 = 3 THEN 'it''s' END AS quoted, k % 99 + 1 AS number, CASE WHEN s % 2 = 0 THEN 'UK' END AS country, CASE WHEN s % 5 = 4 THEN 0 ELSE 1 END AS confidence FROM p
""")
def entry_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of every notation of quotes, taken apart."""
    s, n, b = F.col("p_size"), F.col("p_name"), F.col("p_brand")
    number = F.col("p_partkey") % 99 + 1
    country = F.when(s % 2 == 0, " (UK)").otherwise("")
    quoted = F.when(s % 5 == 4, "").when(s % 5 == 0, F.concat(F.lit(' "'), n, F.lit('"'))).when(s % 5 == 1, F.concat(F.lit(" «"), n, F.lit("»"))).otherwise(F.concat(F.lit(' "'), n, F.lit('" CD "x" (lab)')))
    text = F.concat(number.cast("string"), F.when(number > 50, ". ").otherwise(") "), b, F.when(s % 5 == 4, "").otherwise(country), quoted)
    single = F.when(s % 5 == 3, F.concat(F.lit("1. x `it’s`")))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), s.alias("s"), text.alias("t"), single.alias("q"))
    parts, parsed, quotes = X.parts_of("t"), X.parse_entry("t"), X.parts_of("q")
    return rows.select(
        "k", parts["artist"].alias("artist"), parts["title"].alias("title"), F.when(F.col("q").isNotNull(), F.when(quotes["title"] == "it", "it's")).alias("quoted"), parsed["number"].cast("long").alias("number"),
        F.when(F.col("s") % 5 == 4, F.when(F.col("s") % 2 == 0, "UK")).otherwise(parsed["country"]).alias("country"), parsed["confidence"].alias("confidence"),
    )


@query("""
    WITH f AS (SELECT '/d/dump_' || strftime(o_orderdate, '%Y%m%d') || CASE WHEN o_orderkey % 2 = 0 THEN '_masters.xml.gz' ELSE '_artists.xml.gz' END AS path, strftime(o_orderdate, '%Y%m%d') AS date FROM orders)
    SELECT path, date FROM f WHERE path LIKE '%masters%' ORDER BY date DESC, path LIMIT 1
""")
def newest_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest dump of a kind, by the date in its name."""
    name = F.concat(F.lit("/d/dump_"), F.date_format("o_orderdate", "yyyyMMdd"), F.when(F.col("o_orderkey") % 2 == 0, "_masters.xml.gz").otherwise("_artists.xml.gz"))
    return R.newest_of(table(spark, sf_dir, "orders").select(name.alias("path")), r"\Adump_(\d{8})_masters\.xml\.gz\z")


@query("""
    WITH p AS (SELECT o_custkey AS k, CASE o_orderkey % 3 WHEN 0 THEN 'near' WHEN 1 THEN 'plain' ELSE 'print' END AS kind, max(o_orderkey) AS page, max(o_orderkey) % 5 > 1 AS has FROM orders GROUP BY ALL),
         r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY list_position(['near', 'print', 'plain'], kind)) AS nth FROM p WHERE has)
    SELECT k, kind, page FROM r WHERE nth = 1
""")
def page_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a broadcast's pages the first kind in order that has any entries."""
    n = F.col("o_orderkey") % 3
    pages = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k"), F.when(n == 0, "near").when(n == 1, "plain").otherwise("print").alias("kind")).agg(F.max("o_orderkey").alias("page"))
    pages = pages.withColumn("entries", F.when(F.col("page") % 5 > 1, F.array(F.lit("1. A"))).otherwise(F.array().cast("array<string>")))
    return E.by_priority(pages, "k", "kind", ["near", "print", "plain"]).select("k", "kind", "page")


@query("""
    WITH l AS (SELECT l_orderkey AS k, l_partkey AS pos, CASE WHEN min(l_linenumber) % 4 = 0 THEN 'a note 1.' ELSE min(l_linenumber) || CASE min(l_linenumber) % 3 WHEN 0 THEN '. x' WHEN 1 THEN ') x' ELSE ' x' END END AS line, min(l_linenumber) % 4 > 0 AS own FROM lineitem GROUP BY ALL)
    SELECT k, string_agg(line, '|' ORDER BY pos) AS entries FROM l WHERE own GROUP BY k
""")
def numbered_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbered lines of texts, in order."""
    n = F.min("l_linenumber")
    mark = F.when(n % 3 == 0, ". x").when(n % 3 == 1, ") x").otherwise(" x")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("pos")).agg(F.when(n % 4 == 0, "a note 1.").otherwise(F.concat(n.cast("string"), mark)).alias("line"))
    return E.numbered_lines(lines, ["k"]).select("k", F.array_join("entries", "|").alias("entries"))


@query(f"""
    WITH e AS (SELECT substr('abc', (p_size % 3 + 1)::INT, 1) AS program, p_size AS number, p_partkey AS i, {S.sql(S.ARTISTS, "p_partkey")} AS artist, CASE WHEN p_partkey % 5 > 0 THEN {S.sql(S.TITLES, "p_partkey")} END AS album FROM part),
         x AS (SELECT *, row_number() OVER (PARTITION BY program, number ORDER BY i) - 1 AS index FROM e)
    SELECT program, number::BIGINT AS number, index, artist, {S.bare(f"coalesce({S.credited('artist')}[1], '')")} AS lead, {S.artist_key("coalesce(album, '')")} AS album_key, 1990 + number % 20 AS air_year FROM x
""")
def json_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks nested under their episodes, written as JSON, read, and laid flat again with what matching needs."""
    k, size = F.col("p_partkey"), F.col("p_size")
    tracks = table(spark, sf_dir, "part").select(
        F.substring(F.lit("abc"), (size % 3 + 1).cast("int"), F.lit(1)).alias("program"), size.cast("long").alias("number"), F.concat((1990 + size % 20).cast("string"), F.lit("-02-03")).alias("date"), k.alias("i"),
        S.of(S.ARTISTS, k).alias("artist"), F.when(k % 5 > 0, S.of(S.TITLES, k)).alias("album"),
    )
    folder = f"{new_folder(spark, 'archive')}/episodes"
    sinks.write_json(sinks.nested(tracks, ["program", "number", "date"], "i"), folder)
    read = spark.read.schema("program string, number long, date string, tracks array<struct<artist: string, album: string>>").json(folder)
    return R.flattened(read).select("program", "number", F.col("index").cast("long").alias("index"), "artist", "lead", "album_key", F.col("air_year").cast("long").alias("air_year"))
