"""Readers of the record sources: playlists, CUE sheets, tables, XML catalogues, feeds, articles and dictionaries.

All are lazy DataFrames over Spark's own file sources with explicit schemas, so they read whatever store Spark reads and
never infer anything. Whole-file readers are for small files (a playlist, a sheet, a page).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import textkeys as K

PLAYLIST_NAME = r"(?:\A|/)(\d+|\d{4}-\d{2}-\d{2})\.txt\z"
HEADER = r"\A(?:(?:url|date|title|note): [^\n]*\n)*"


def header_field(text: Column, name: str) -> Column:
    """A ``name: value`` line of the header lines a text begins with; of repeated ones the last."""
    head = F.regexp_extract(text, HEADER, 0)
    return F.trim(X.found(head, rf"(?s)(?:.*\n|\A){name}: ([^\n]*)\n"))


def playlists(spark: SparkSession, path: str) -> DataFrame:
    """(program, number, date, url, title, note, text) of ``<program>/playlists/<number or date>.txt`` files; other names are passed over.

    In the order of ``newest_first`` when sorted by it.
    """
    return playlist_rows(spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path")))


def playlist_rows(files: DataFrame) -> DataFrame:
    """``playlists`` of (path, value)."""
    found = files.where(F.col("path").rlike(PLAYLIST_NAME))
    stem = F.regexp_extract("path", PLAYLIST_NAME, 1)
    special = F.contains(stem, F.lit("-"))
    # a header's last line may end the file
    text = F.concat("value", F.lit("\n"))
    return found.select(
        X.found("path", r"/([^/]+)/playlists/[^/]*\z").alias("program"), F.when(~special, stem.cast("int")).alias("number"),
        F.when(special, stem).otherwise(header_field(text, "date")).alias("date"), header_field(text, "url").alias("url"), header_field(text, "title").alias("title"),
        header_field(text, "note").alias("note"), F.regexp_replace(F.regexp_replace(text, HEADER, ""), rf"\A{K.SPACE}+|{K.SPACE}+\z", "").alias("text"),
    )


def newest_first() -> list[Column]:
    """Numbered rows from the highest down, then the specials from the latest."""
    return [F.col("number").isNull().cast("int"), F.desc("number"), F.desc(F.coalesce("date", F.lit("")))]


def programs(rows: DataFrame) -> DataFrame:
    return rows.select("program").where(F.col("program").rlike(r"\A[a-z]+\z")).distinct()


def playlist_lines(rows: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, pos, line): the cleaned lines of a text, without empty ones."""
    lines = F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), X.clean), lambda x: x != "")
    return rows.select(*key, F.posexplode(lines).alias("pos", "line"))


CUE_TRACK = r"(?m)^\s*TRACK \d+ AUDIO\s*$"


def cue_songs(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, date, pos, performer, title, album, label) of CUE sheets, in UTF-8 or cp1251; talk and blocks without a performer left out.

    Sheets without an album line may have it in the performer, as ``Artist [Album, Label]``.
    """
    return cue_rows(spark.read.format("binaryFile").load(path).select("path", "content"))


def cue_rows(files: DataFrame) -> DataFrame:
    """``cue_songs`` of (path, content)."""
    raw = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), X.decode_utf8_or_cp1251("content").alias("text"))
    blocks = raw.select("file", F.posexplode(F.split("text", CUE_TRACK)).alias("pos", "block")).where("pos > 0")
    field = lambda name: X.found("block", rf'(?m)^\s*{name}\s+"(.*)"\s*$')
    songs = blocks.select("file", "pos", field("TITLE").alias("title"), field("PERFORMER").alias("performer"), F.trim(X.found("block", r"(?m)^\s*REM \w*ALBUM[ \t]+(.*?)\s*$")).alias("album"))
    songs = songs.where(F.col("performer").isNotNull() & (F.col("performer") != "") & ~F.coalesce("title", F.lit("")).rlike(r"(?i)\A\(?Track \d+\)?\z"))
    performer, inside = X.clean("performer"), X.found(X.clean("performer"), r"\A.*?\s*\[(.*)\]\z")
    early = F.col("album").isNull() & inside.isNotNull()
    album, label = X.found(inside, r"\A(.*), .*?\z"), X.found(inside, r"\A.*, (.*?)\z")
    name = F.col("file")
    day = F.coalesce(X.found(name, r"(\d{4}\.\d{2}\.\d{2})"), X.found(name, r"(\d{2}\.\d{2}\.\d{4})"))
    return songs.select(
        "file", X.found(name, r"_N(\d+)").cast("int").alias("number"), X.iso_date(day).alias("date"), (F.row_number().over(Window.partitionBy("file").orderBy("pos"))).alias("pos"),
        F.when(early, X.found(performer, r"\A(.*?)\s*\[.*\]\z")).otherwise(performer).alias("performer"), X.clean("title").alias("title"),
        F.when(early, F.coalesce(album, inside)).otherwise(X.clean("album")).alias("album"), F.when(early, label).alias("label"),
    )


def cue_sources(songs: DataFrame, base: str, urls: DataFrame | None = None, moved: DataFrame | None = None, ignored: tuple[str, ...] = ()) -> DataFrame:
    """(file, number, moved_from, why, url, date, entries) of the sheets of ``cue_songs``, those of ``ignored`` files left out.

    ``urls``: (url), a sheet's is the one that ends in its name, else ``base`` and its name. ``moved``: (file, number, why), sheets that are another episode's than their names say.
    """
    kept = songs.where(~F.col("file").isin(*ignored)) if ignored else songs
    none = F.lit(None).cast("string")
    line = entry_text(F.col("pos"), F.col("performer"), none, F.coalesce("title", F.lit("")), F.col("album"), F.col("label"))
    lists = kept.groupBy("file", "number", "date").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))), lambda x: x["line"]).alias("entries"))
    if urls is not None:
        known = urls.where(F.trim("url") != "").groupBy(F.element_at(F.split(F.trim("url"), "/"), -1).alias("file")).agg(F.min(F.trim("url")).alias("_url"))
        lists = lists.join(known, "file", "left")
    else:
        lists = lists.withColumn("_url", none)
    if moved is not None:
        lists = lists.join(moved.select("file", F.col("number").alias("_to"), "why"), "file", "left")
    else:
        lists = lists.withColumns({"_to": F.lit(None).cast("int"), "why": none})
    return lists.select(
        "file", F.coalesce("_to", "number").alias("number"), F.when(F.col("_to").isNotNull(), F.col("number")).alias("moved_from"), "why",
        F.coalesce("_url", F.concat(F.lit(base.rstrip("/") + "/"), "file")).alias("url"), "date", "entries",
    )


def entry_text(number: Column, artist: Column, country: Column, title: Column, album: Column, label: Column) -> Column:
    """A playlist line of a song's parts, those that are null or empty left out."""
    some = lambda c, form: F.when(F.coalesce(c, F.lit("")) != "", F.format_string(form, c)).otherwise("")
    before = F.when(number.isNotNull(), F.format_string("%d. ", number)).otherwise("")
    return F.concat(before, F.coalesce(artist, F.lit("")), some(country, " (%s)"), F.lit(' "'), F.coalesce(title, F.lit("")), F.lit('"'), some(album, ' CD "%s"'), some(label, " (%s)"))


TABLE = "ID string, bNum string, Date string, sNum string, Artist string, Country string, Song string, CD string, Label string, Comment string"


def table_rows(spark: SparkSession, path: str, schema: str = TABLE, header: bool = True) -> DataFrame:
    """A CSV table by RFC 4180 (quoted line feeds, doubled quotes), its values cleaned; rows without an episode number are left out."""
    raw = spark.read.csv(path, schema=schema, header=header, multiLine=True, quote='"', escape='"')
    cleaned = raw.select(*(X.clean(F.coalesce(F.regexp_replace(c, r"\A﻿", ""), F.lit(""))).alias(c) for c in raw.columns))
    number = F.col("bNum").try_cast("int")
    return cleaned.select(number.alias("number"), F.col("ID").try_cast("int").alias("id"), F.nullif(F.col("Date"), F.lit("")).alias("date"), F.col("sNum").try_cast("int").alias("song_number"), "Artist", "Country", "Song", "CD", "Label").where("number is not null")


def table_lists(rows: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """(number, date, entries, unnumbered, repeated, skipped, dates) of each episode of ``table_rows``.

    In song order; a row without a number stands behind the row with the next lower id. The other columns tell what is odd about the list.
    """
    if first is not None or last is not None:
        rows = rows.where(F.col("number").between(first if first is not None else 0, last if last is not None else 2**31 - 1))
    by_id = Window.partitionBy("number").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    # an unnumbered row takes the slot of the numbered row entered last before it; before any, that of the list's start
    slot = F.when(F.col("song_number").isNotNull(), F.struct(F.col("song_number").alias("n"), F.col("id").alias("i")))
    placed = rows.withColumn("_slot", F.coalesce(slot, F.last(slot, ignorenulls=True).over(by_id), F.struct(F.lit(-1).alias("n"), F.lit(-1).alias("i"))))
    text = entry_text(F.col("song_number"), F.col("Artist"), F.col("Country"), F.col("Song"), F.col("CD"), F.col("Label"))
    item = F.struct(F.col("_slot"), F.col("song_number").isNull().alias("after"), F.col("id"), text.alias("entry"), F.col("song_number").alias("n"), F.col("Artist").alias("artist"))
    lists = placed.groupBy("number").agg(F.array_sort(F.collect_list(item)).alias("rows"), F.array_sort(F.collect_set("date")).alias("dates"))
    numbers = F.transform(F.filter("rows", lambda r: r["n"].isNotNull()), lambda r: r["n"])
    lists = lists.withColumn("_numbers", numbers)
    span = F.when(F.size("_numbers") > 0, F.sequence(F.array_min("_numbers"), F.array_max("_numbers"))).otherwise(F.array().cast("array<int>"))
    twice = F.array_distinct(F.filter("_numbers", lambda n: F.size(F.filter(F.col("_numbers"), lambda m: m == n)) > 1))
    return lists.select(
        "number", F.get("dates", F.lit(0)).alias("date"), F.transform("rows", lambda r: r["entry"]).alias("entries"), F.transform(F.filter("rows", lambda r: r["n"].isNull()), lambda r: r["artist"]).alias("unnumbered"),
        twice.alias("repeated"), F.array_except(span, F.col("_numbers")).alias("skipped"), "dates",
    )


_ARTISTS = "struct<artist: array<struct<id: bigint, name: string, anv: string>>>"
_LIST = "struct<{0}: array<string>>"
_SUB = f"struct<track: array<struct<title: string, artists: {_ARTISTS}>>>"
MASTER = f"_id bigint, main_release bigint, artists {_ARTISTS}, title string, year int, data_quality string, genres {_LIST.format('genre')}, styles {_LIST.format('style')}, videos struct<video: array<struct<title: string>>>"
RELEASE = (
    f"_id bigint, artists {_ARTISTS}, title string, labels struct<label: array<struct<_name: string>>>, formats struct<format: array<struct<descriptions: struct<description: array<string>>>>>, "
    f"genres {_LIST.format('genre')}, styles {_LIST.format('style')}, country string, released string, master_id struct<_VALUE: bigint, _is_main_release: boolean>, "
    f"tracklist struct<track: array<struct<title: string, artists: {_ARTISTS}, sub_tracks: {_SUB}>>>"
)
ARTIST = "id bigint, name string, namevariations struct<name: array<string>>, aliases struct<name: array<string>>"


def records(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """The elements of an XML dump, gzipped or not. A gzipped file can't be cut: one task reads it, and its records are dealt out to all before anything else is done with them."""
    found = spark.read.schema(schema).option("rowTag", tag).xml(path)
    return found.repartition(spark.sparkContext.defaultParallelism) if path.endswith(".gz") else found


def _artists(c: Column) -> Column:
    clean = lambda n: K.catalogue_name(F.coalesce(n, F.lit("")))
    named = F.transform(F.coalesce(c["artist"], F.array().cast("array<struct<id: bigint, name: string, anv: string>>")), lambda a: F.struct(F.nullif(a["id"], F.lit(0)).alias("id"), clean(a["name"]).alias("name"), clean(a["anv"]).alias("anv")))
    return named


def _strings(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def _tags(c: Column) -> Column:
    """Without names that are digits only."""
    return F.filter(_strings(c), lambda g: ~g.rlike(r"\A\d+\z"))


def masters(spark: SparkSession, path: str) -> DataFrame:
    r = records(spark, path, "master", MASTER)
    return r.select(
        F.col("_id").alias("id"), F.col("main_release").alias("main"), F.nullif("year", F.lit(0)).alias("year"), "title", F.col("data_quality").alias("quality"), _artists(F.col("artists")).alias("artists"),
        _tags(F.col("genres.genre")).alias("genres"), _tags(F.col("styles.style")).alias("styles"), F.transform(F.coalesce("videos.video", F.array().cast("array<struct<title: string>>")), lambda v: v["title"]).alias("videos"),
    )


def titles_of(title: Column, sub: Column) -> Column:
    """A track's titles: its own and its parts', each also cut at " = "."""
    own = F.concat(F.array(F.coalesce(title, F.lit(""))), F.transform(F.coalesce(sub, F.array().cast(f"array<struct<title: string, artists: {_ARTISTS}>>")), lambda t: F.coalesce(t["title"], F.lit(""))))
    return F.array_distinct(F.filter(F.flatten(F.transform(own, lambda t: F.concat(F.array(t), F.split(t, " = ")))), lambda t: t != ""))


def releases(spark: SparkSession, path: str) -> DataFrame:
    r = records(spark, path, "release", RELEASE)
    kinds = F.flatten(F.transform(F.coalesce("formats.format", F.array().cast("array<struct<descriptions: struct<description: array<string>>>>")), lambda f: _strings(f["descriptions"]["description"])))
    track = lambda t: F.struct(titles_of(t["title"], t["sub_tracks"]["track"]).alias("titles"), _artists(t["artists"]).alias("artists"))
    none = F.array().cast(f"array<struct<title: string, artists: {_ARTISTS}, sub_tracks: {_SUB}>>")
    master = F.col("master_id._VALUE")
    return r.select(
        F.col("_id").alias("id"), "title", _artists(F.col("artists")).alias("artists"), X.found("released", r"\A(\d{4})").cast("int").alias("year"), F.when(master > 0, master).alias("master"),
        F.array_contains(kinds, "Compilation").alias("compilation"), F.arrays_overlap(kinds, F.array(*map(F.lit, ("Reissue", "Repress", "Remastered")))).alias("reissue"),
        F.array_contains(kinds, "Unofficial Release").alias("unofficial"), "country", F.transform(F.coalesce("labels.label", F.array().cast("array<struct<_name: string>>")), lambda x: x["_name"]).alias("labels"),
        _tags(F.col("genres.genre")).alias("genres"), _tags(F.col("styles.style")).alias("styles"), F.transform(F.coalesce("tracklist.track", none), track).alias("tracks"),
    ).withColumn("year", F.nullif("year", F.lit(0)))


def artist_names(spark: SparkSession, path: str) -> DataFrame:
    """(id, name) of every artist, with its variations and aliases."""
    r = records(spark, path, "artist", ARTIST)
    return r.select("id", F.explode(F.array_distinct(F.concat(F.array("name"), _strings(F.col("namevariations.name")), _strings(F.col("aliases.name"))))).alias("name")).where("name is not null")


def label_names(spark: SparkSession, path: str) -> DataFrame:
    return records(spark, path, "label", "id bigint, name string").where("name is not null")


ITEM = "guid string, title string, pubDate string, link string, enclosure struct<_url: string>, `itunes:duration` string, description string"


def feed(spark: SparkSession, path: str) -> DataFrame:
    """(guid, number, title, published_at, url, mp3_url, duration_sec, description) of a feed's items; those without a guid are left out."""
    r = records(spark, path, "item", ITEM)
    return r.where("guid is not null").select(
        F.trim("guid").alias("guid"), X.episode_number("title").alias("number"), "title", X.rfc822_date("pubDate").alias("published_at"), F.col("link").alias("url"),
        F.col("enclosure._url").alias("mp3_url"), X.duration_seconds("itunes:duration").alias("duration_sec"), "description",
    )


def articles(spark: SparkSession, path: str, body: str = '<div class="wsw">') -> DataFrame:
    """(file, title, published, lines) of article pages: the title and date of the page's metadata, the lines of its body."""
    return article_rows(spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), "value"), body)


def article_rows(files: DataFrame, body: str = '<div class="wsw">') -> DataFrame:
    """``articles`` of (file, value)."""
    with_body = files.withColumn("_body", X.element_body("value", body))
    return with_body.select("file", X.html_meta("value", "og:title", "article").alias("title"), F.substring(X.found("value", r'"datePublished"\s*:\s*"([^"]*)"'), 1, 10).alias("published"), X.article_lines("_body").alias("lines"))


def sections(lines: DataFrame, by: list[str], header: Column, within: int = 3) -> DataFrame:
    """Lines with the number of their section: a header line begins one if an entry stands in the ``within`` lines behind it. Lines before the first are section 0."""
    w = Window.partitionBy(*by).orderBy("pos")
    near = F.coalesce(F.max(X.is_entry(F.col("line")).cast("int")).over(w.rowsBetween(1, within)), F.lit(0)) == 1
    return lines.withColumn("_begins", (header & near).cast("int")).withColumn("section", F.sum("_begins").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_begins")


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(spelling, pos, name) of a JSON object of strings, lists of strings or nulls; a null value gives one row without a name."""
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string, variant>")).alias("spelling", "value"))
    kind = F.schema_of_variant("value")
    listed = F.when(F.startswith(kind, F.lit("ARRAY")), F.try_variant_get("value", "$", "array<string>")).when(kind == "STRING", F.array(F.try_variant_get("value", "$", "string")))
    return raw.select("spelling", F.posexplode_outer(F.coalesce(listed, F.array(F.lit(None).cast("string")))).alias("pos", "name"))


def rule_list(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """(pos, fields…) of a JSON array of objects, in the file's order; ``fields`` is a DDL schema."""
    raw = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", f"array<struct<{fields}>>")).alias("pos", "rule"))
    return raw.select("pos", "rule.*")


def tag_lists(spark: SparkSession, path: str) -> DataFrame:
    """(number, file, entries) of a JSON object number -> {file, title, track, comment}: the comment's numbered lines, without a ",(note)" at the end."""
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string, struct<file: string, title: string, track: string, comment: string>>")).alias("number", "tag"))
    lines = F.filter(F.transform(F.split(F.coalesce("tag.comment", F.lit("")), r"\r\n|\r|\n"), X.clean), lambda x: x.rlike(X.NUMBERED))
    return raw.select(F.col("number").cast("int").alias("number"), "tag.file", F.transform(lines, lambda x: F.regexp_replace(x, r",\s*\([^()]*\)\z", "")).alias("entries"))


def newest_of(files: DataFrame, pattern: str = r"(\d{8})") -> DataFrame:
    """(path, date) of the newest of the files (path), by the date in their names; the first by name of several; no row without one."""
    dated = files.select("path", X.found(F.element_at(F.split("path", "/"), -1), pattern).alias("date")).where("date is not null")
    return dated.orderBy(F.desc("date"), "path").limit(1)


def newest(spark: SparkSession, path: str, pattern: str = r"(\d{8})") -> tuple[str, str] | None:
    """The path and date of the newest of the files that a glob names; None if there is none."""
    row = newest_of(spark.read.format("binaryFile").load(path).select("path"), pattern).first()
    return (row["path"], row["date"]) if row else None


def flattened(episodes: DataFrame) -> DataFrame:
    """Tracks of episodes with their ``tracks`` array: one row each with program, number, index, the air year and what matching needs."""
    rows = episodes.select("program", "number", "date", F.posexplode("tracks").alias("index", "track"))
    flat = rows.select("program", "number", "date", "index", "track.*")
    return flat.withColumns({"air_year": F.year(F.try_to_date("date", "yyyy-MM-dd")), "lead": K.lead("artist"), "album_key": K.artist_key(F.coalesce("album", F.lit("")))})
