"""Keys and extraction on the text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import textkeys as K
from ..functions.fuzzy import close
from ..queries import query, table

_PLAIN = r"""trim(regexp_replace(replace(regexp_replace(regexp_replace(strip_accents(lower(s)), '\s[(\[].*$', '', 's'), '\s[-–—]\s.*\b(remaster|remastered|version|mix|edit|mono|stereo|live)\b.*$', '', 's'), '&', ' and '), '[^\p{L}\p{N}]+', ' ', 'g'))"""


@query(rf"""
    WITH l AS (SELECT doc_id, coalesce(text, '') AS s FROM documents), k AS (SELECT doc_id, {_PLAIN} AS plain, s FROM l)
    SELECT doc_id, CAST(length(plain) AS BIGINT) AS plain_length, md5(plain) AS plain_md5, md5(replace(regexp_replace(plain, '^the\s+', ''), ' ', '')) AS squash_md5,
           md5(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(s)), '^the\s+', ''), '\s+and\s+', '&', 'g'), '[^\p{{L}}\p{{N}}&]', '', 'g')) AS artist_md5 FROM k
""")
def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison keys of whole texts, as digests."""
    keyed = table(spark, sf_dir, "documents").select("doc_id", K.plain("text").alias("plain"), K.artist_key(F.coalesce("text", F.lit(""))).alias("artist"))
    digest = lambda c: F.md5(c.cast("binary"))
    return keyed.select("doc_id", F.length("plain").cast("long").alias("plain_length"), digest(F.col("plain")).alias("plain_md5"), digest(K.squash(K.without_the(F.col("plain")))).alias("squash_md5"), digest(F.col("artist")).alias("artist_md5"))


@query("""
    WITH n AS (SELECT DISTINCT p_name AS name FROM part), w AS (SELECT name, list_extract(string_split(name, ' '), 1) AS block FROM n)
    SELECT a.name AS a, b.name AS b, CAST(levenshtein(a.name, b.name) AS BIGINT) AS distance FROM w a JOIN w b ON a.block = b.block AND a.name < b.name
    WHERE least(length(a.name), length(b.name)) >= 5 AND levenshtein(a.name, b.name) <= CAST(floor(0.5::DOUBLE * greatest(length(a.name), length(b.name))) AS INTEGER)
""")
def close_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part names that are near each other, within the block of their first word."""
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct().withColumn("block", F.split_part("name", F.lit(" "), F.lit(1)))
    a, b = names.select("block", F.col("name").alias("a")), names.select("block", F.col("name").alias("b"))
    pairs = a.join(b, "block").where("a < b").where(close(F.col("a"), F.col("b"), 0.5))
    return pairs.select("a", "b", F.levenshtein("a", "b").cast("long").alias("distance"))


_ENTITY = "replace(replace(replace(replace({}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '&middot;'), '&amp;', '&')"
_ARTICLE_ENTITY = "replace(replace({}, '&quot;', '\"'), '&amp;', '&')"


def _lines_sql(dropped: str, comments: bool, blocks: str, cut: str, entity: str) -> str:
    """Pages as lines: elements dropped whole, then comments; an opening tag of a block begins a line; all other tags go."""
    t = "coalesce(html, '')"
    for tag in dropped.split("|"):
        t = rf"regexp_replace({t}, '<{tag}\b.*?</{tag}>', '', 'gis')"
    t = f"regexp_replace({t}, '<!--.*?-->', '', 'gs')" if comments else t
    t = rf"regexp_replace(regexp_replace({t}, '<(?:{blocks})\b[^>]*>', chr(10), 'gi'), '<[^>]+>', '', 'g')"
    return rf"list_filter(list_transform(regexp_split_to_array({entity.format(t)}, '{cut}'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '')"


def _lines_query(lines: str) -> str:
    return f"WITH l AS (SELECT page_id, {lines} AS lines FROM pages) SELECT page_id, len(lines) AS n_lines, lines[1] AS first_line, md5(array_to_string(lines, chr(10))) AS lines_md5 FROM l"


def _lines(spark: SparkSession, sf_dir: str, lines) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", lines("html").alias("lines"))
    return p.select("page_id", F.size("lines").cast("long").alias("n_lines"), F.get("lines", F.lit(0)).alias("first_line"), F.md5(F.array_join("lines", "\n").cast("binary")).alias("lines_md5"))


@query(_lines_query(_lines_sql("script|style|noscript", True, r"br|p|div|li|h\d|tr|table", r"\r\n|\r|\n", _ENTITY)))
def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text lines of every page, read as an episode's page."""
    return _lines(spark, sf_dir, X.page_lines)


@query(_lines_query(_lines_sql("script|style|svg|noscript|iframe", False, r"br|p|div|li|h\d|tr", r"\n", _ARTICLE_ENTITY).replace("x <> ''", "x NOT IN ('', 'SoundCloud', 'YouTube')")))
def article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text lines of every page, read as an article's body."""
    return _lines(spark, sf_dir, X.article_lines)


@query(rf"""
    SELECT page_id, {_ENTITY.format("nullif(trim(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is')), '')")} AS title, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
           len(regexp_extract_all(html, '<a\s', 0, 'i')) AS links, nullif(regexp_extract(html, '<meta\s[^>]*?(?:property|name)=["'']description["''][^>]*?content=["'']([^"'']*)["'']', 1, 'is'), '') AS description
    FROM pages
""")
def html_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, host, links and description of every page."""
    return table(spark, sf_dir, "pages").select(
        "page_id", X.html_title("html").alias("title"), X.found("url", r"\Ahttps?://([^/]+)").alias("host"),
        F.size(F.regexp_extract_all("html", F.lit(r"(?i)<a\s"), F.lit(0))).cast("long").alias("links"), X.html_meta("html", "description").alias("description"),
    )


@query(r"""
    SELECT doc_id, len(regexp_extract_all(text, '[\w.+-]+@[\w-]+(?:\.[\w-]+)+')) AS addresses, md5(regexp_replace(text, '[\w.+-]+@[\w-]+(?:\.[\w-]+)+', '[address]', 'g')) AS scrubbed_md5 FROM documents
""")
def email_scrub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses counted and blanked out."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(F.regexp_extract_all("text", F.lit(X.EMAIL), F.lit(0))).cast("long").alias("addresses"), F.md5(X.scrub_emails("text", "[address]").cast("binary")).alias("scrubbed_md5")
    )


@query("""
    WITH s AS (SELECT doc_id, lang, len(regexp_extract_all(lower(text), 'th|he|in|er|an')) AS en, len(regexp_extract_all(lower(text), 'en|er|ch|de|ei')) AS de, len(regexp_extract_all(lower(text), 'es|le|de|en|re')) AS fr FROM documents)
    SELECT doc_id, en, de, fr, CASE WHEN en >= de AND en >= fr THEN 'en' WHEN de >= fr THEN 'de' ELSE 'fr' END AS reads_like FROM s
""")
def charset_bigram_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of several readings has most of its frequent letter pairs, the scoring by which an encoding is chosen."""
    pairs = {"en": "th|he|in|er|an", "de": "en|er|ch|de|ei", "fr": "es|le|de|en|re"}
    d = table(spark, sf_dir, "documents").select("doc_id", *(F.regexp_count(F.lower("text"), F.lit(p)).cast("long").alias(k) for k, p in pairs.items()))
    best = F.when((F.col("en") >= F.col("de")) & (F.col("en") >= F.col("fr")), "en").when(F.col("de") >= F.col("fr"), "de").otherwise("fr")
    return d.withColumn("reads_like", best)


@query("""
    WITH t AS (SELECT conv_id, turn, role, text, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section FROM conversations)
    SELECT conv_id, CAST(section AS BIGINT) AS section, min(turn) AS first_turn, count(*) AS turns, max(length(text)) AS longest FROM t GROUP BY conv_id, section
""")
def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations cut into sections that begin with a user's turn: a running count of headers as the section's number."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    t = table(spark, sf_dir, "conversations").withColumn("section", F.sum(F.when(F.col("role") == "user", 1).otherwise(0)).over(w).cast("long"))
    return t.groupBy("conv_id", "section").agg(F.min("turn").alias("first_turn"), F.count(F.lit(1)).alias("turns"), F.max(F.length("text")).cast("long").alias("longest"))


@query("""
    SELECT o_orderkey AS orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(o_orderkey % 90000 AS BIGINT) AS seconds, CAST(greatest(1950, (year(o_orderdate) // 10) * 10) AS BIGINT) AS decade FROM orders
""")
def duration_and_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates and durations printed in the notations of the sources and read back."""
    from ..operators.windows import decade

    s = F.col("o_orderkey") % 90000
    clock = F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    short = F.when(s < 60, s.cast("string")).otherwise(clock)
    printed = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "d.M.yyyy")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy.MM.dd"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), F.concat(F.lit("on "), printed).alias("printed"), short.alias("clock"), F.date_format("o_orderdate", "d MMM yyyy HH:mm:ss").alias("feed"))
    day = X.iso_date("printed", 1900, 2100)
    again = F.to_date(X.rfc822_date(F.concat(F.lit("Mon, "), "feed", F.lit(" +0000"))))
    return o.select("orderkey", F.when(day == again, day.cast("string")).alias("day"), X.duration_seconds("clock").alias("seconds"), decade(F.year(day)).cast("long").alias("decade"))
