"""Tracks and a store's or a base's candidates for them: every part is a track, every line a candidate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fuzzy as Z
from ..functions import textkeys as K
from ..operators import catalogue as C
from ..queries import query, table
from . import cases as S

ALBUMS = ["In Flux", "inFLUX", "Live at Home", "Nouse Luonto - Lauluja", "Nouse Luonto", "", "Greatest Hits", "Tango", "Tango - Deluxe", "Alankomaat"]
_N = {"a": len(S.ARTISTS), "t": len(S.TITLES), "l": len(ALBUMS)}


def _cases(name: str, cases: list[str]) -> str:
    return f"{name} AS (SELECT unnest(range({len(cases)})) AS i, unnest([{', '.join(map(S.literal, cases))}]) AS n)"


_SHORT = S.squash(S.plain(r"regexp_split_to_array(b.n, '\s[-–—]\s')[1]"))
#: The lists of cases, and what holds between any two: ap (same artist), tp (same and near title), lp (same album).
DIMENSIONS = f"""
    {_cases("a0", S.ARTISTS)}, {_cases("t0", S.TITLES)}, {_cases("l0", ALBUMS)},
    ak AS (SELECT i, n, {S.name_keys("n")} AS k FROM a0),
    ap AS (SELECT a.i AS x, b.i AS y, len(a.k) > 0 AND len(b.k) > 0 AND (len(list_filter(b.k, lambda f: {S.close("a.k[1]", "f")})) > 0 OR len(list_filter(a.k, lambda f: {S.close("f", "b.k[1]")})) > 0) AS same FROM ak a, ak b),
    tk AS (SELECT i, n, {S.plain("n")} AS p, {S.forms("n")} AS k FROM t0),
    tp AS (SELECT a.i AS x, b.i AS y, len(list_filter(b.k, lambda f: {S.squash(S.counted("f"))} = {S.squash(S.counted("a.p"))})) > 0 AS same,
                  len(list_filter(b.k, lambda f: {S.close(S.counted("a.p"), S.counted("f"))} AND {S.numbers(S.counted("a.p"))} = {S.numbers(S.counted("f"))})) > 0 AS near FROM tk a, tk b),
    lp AS (SELECT a.i AS x, b.i AS y, {S.squash(S.plain("a.n"))} <> '' AND ({S.squash(S.plain("b.n"))} = {S.squash(S.plain("a.n"))} OR {_SHORT} = {S.squash(S.plain("a.n"))}) AS same FROM l0 a, l0 b)
"""

#: Candidates: (k, id, ax, ay, tx, ty, lx, ly, released, line): indexes of the host's and the candidate's artist, title and album.
CANDIDATES = f"""
    c AS (SELECT l_partkey AS k, l_orderkey * 10 + l_linenumber AS id, l_partkey % {_N["a"]} AS ax, (l_partkey + CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE 0 END) % {_N["a"]} AS ay,
                 (l_partkey // 7) % {_N["t"]} AS tx, (l_partkey // 7 + CASE WHEN l_quantity::BIGINT % 4 = 0 THEN 1 ELSE 0 END) % {_N["t"]} AS ty, (l_partkey // 5) % {_N["l"]} AS lx, (l_partkey // 5 + l_linenumber) % {_N["l"]} AS ly,
                 CASE WHEN l_tax < 0.01 THEN '1900-01-01' WHEN l_tax < 0.07 THEN strftime(l_shipdate, '%Y-%m-%d') END AS released, l_linenumber AS line FROM lineitem)
"""


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates of CANDIDATES, as texts."""
    k, up = F.col("l_partkey"), lambda test: F.when(test, 1).otherwise(0)
    seventh, fifth = F.floor(k / 7), F.floor(k / 5)
    return table(spark, sf_dir, "lineitem").select(
        k.alias("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), S.of(S.ARTISTS, k).alias("artist"), S.of(S.TITLES, seventh).alias("track"), S.of(ALBUMS, fifth).alias("album"),
        S.of(S.ARTISTS, k + up(F.col("l_suppkey") % 3 == 0)).alias("song_artist"), S.of(S.TITLES, seventh + up(F.col("l_quantity").cast("long") % 4 == 0)).alias("song_title"), S.of(ALBUMS, fifth + F.col("l_linenumber")).alias("song_album"),
        F.when(F.col("l_tax") < 0.01, "1900-01-01").when(F.col("l_tax") < 0.07, F.date_format("l_shipdate", "yyyy-MM-dd")).alias("released"), F.col("l_linenumber").alias("line"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates of CANDIDATES, with their keys."""
    return C.with_keys(C.with_keys(_texts(spark, sf_dir), "artist", "track", "album", "h_"), "song_artist", "song_title", "song_album", "c_")


_WORD = r"regexp_matches({0}, '(?i)(^|[^A-Za-z0-9_])({1})($|[^A-Za-z0-9_])')"
_STORE = "live|demo|edit|remix|mix|instrumental|acoustic|karaoke|session|rehearsal"
_STUDIO = f"NOT {_WORD.format('t0.n', _STORE)} AND NOT {_WORD.format('l0.n', 'live')}"


def pick_sql(rows: str, out: str) -> str:
    """The store's pick of each track among ``rows`` (like c), as (k, id, year, near, weak)."""
    return f"""
    {out}_s AS (SELECT r.*, CASE WHEN tp.same THEN 0 ELSE 1 END AS kind, {_STUDIO} AS studio, lp.same AS own, CASE WHEN substr(released, 1, 4)::INT > 1900 THEN substr(released, 1, 4)::INT END AS y
                FROM {rows} r JOIN ap ON ap.x = ax AND ap.y = ay AND ap.same JOIN tp ON tp.x = tx AND tp.y = ty AND (tp.same OR tp.near) JOIN lp ON lp.x = lx AND lp.y = ly JOIN t0 ON t0.i = ty JOIN l0 ON l0.i = ly),
    {out}_o AS (SELECT *, row_number() OVER (PARTITION BY k, kind ORDER BY coalesce(released, '9999'), id) AS nth FROM {out}_s),
    {out}_f AS (SELECT k, kind, min(CASE WHEN own AND studio THEN nth END) AS a, min(CASE WHEN own THEN nth END) AS b, min(CASE WHEN studio THEN nth END) AS c FROM {out}_o GROUP BY k, kind),
    {out}_b AS (SELECT k, min(CASE WHEN kind = 0 THEN coalesce(a, b, c) END) AS e, min(CASE WHEN kind = 1 THEN coalesce(a, b, c) END) AS n, min(kind) AS least FROM {out}_f GROUP BY k),
    {out}_c AS (SELECT k, CASE WHEN e IS NOT NULL THEN 0 WHEN n IS NOT NULL THEN 1 ELSE least END AS kind, coalesce(e, n, 1) AS nth, least FROM {out}_b),
    {out}_y AS (SELECT k, kind, min(y) AS first FROM {out}_s GROUP BY k, kind),
    {out} AS (SELECT ch.k, o.id, least(f.first, o.y) AS year, ch.kind = 1 AS near, NOT o.studio AND NOT o.own AS weak
              FROM {out}_c ch JOIN {out}_o o ON o.k = ch.k AND o.kind = ch.kind AND o.nth = ch.nth JOIN {out}_y f ON f.k = ch.k AND f.kind = ch.least)
    """


@query(f"WITH {DIMENSIONS}, {CANDIDATES}, {pick_sql('c', 'p')} SELECT k, id, CAST(year AS BIGINT) AS year, near, weak FROM p")
def song_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version kept of each track among a store's songs, and the song's first year."""
    return C.pick_song(candidates(spark, sf_dir), "k").withColumn("year", F.col("year").cast("long"))


_ALBUMS_SQL = f"""
    al AS (SELECT p_partkey AS k, p_partkey % 40 AS collection_id, p_size % 2 = 0 AS own, 0 AS pos FROM part WHERE p_size % 3 = 0 UNION ALL SELECT p_partkey, p_size % 40, true, 1 FROM part WHERE p_size % 3 < 2),
    sg AS (SELECT s.p_partkey % 40 AS collection_id, s.p_partkey AS id, s.p_partkey % {_N["t"]} AS ti, CASE WHEN s.p_size % 5 > 0 THEN (1890 + s.p_partkey % 130)::VARCHAR || '-01-01' END AS released, s.p_size % 7 = 0 AS own_artist FROM part s)
"""


@query(f"""
    WITH {DIMENSIONS}, {CANDIDATES}, {_ALBUMS_SQL}, se AS (SELECT * FROM c WHERE line <= 1), ca AS (SELECT * FROM c WHERE line <= 2), {pick_sql("se", "one")}, {pick_sql("ca", "two")},
    m AS (SELECT p_partkey AS k, (p_partkey // 7) % {_N["t"]} AS tx, one.id AS id1, two.id AS id2, one.k IS NULL OR one.weak AS again, two.k IS NOT NULL AND (one.k IS NULL OR NOT two.weak) AS better, one.year AS y1, two.year AS y2, one.near AS n1, two.near AS n2
          FROM part LEFT JOIN one ON one.k = p_partkey LEFT JOIN two ON two.k = p_partkey),
    s AS (SELECT k, tx, CASE WHEN again AND better THEN id2 ELSE id1 END AS id, CASE WHEN again AND better THEN y2 ELSE y1 END AS year, CASE WHEN again AND better THEN CASE WHEN n2 THEN 'near' ELSE 'catalogue' END WHEN id1 IS NOT NULL THEN CASE WHEN n1 THEN 'near' ELSE 'search' END END AS via FROM m),
    f AS (SELECT * FROM (SELECT al.*, row_number() OVER (PARTITION BY k ORDER BY pos) AS nth FROM al) WHERE nth = 1),
    h AS (SELECT s.k, sg.id, CASE WHEN (f.own OR sg.own_artist) AND substr(sg.released, 1, 4)::INT > 1900 THEN substr(sg.released, 1, 4)::INT END AS year, row_number() OVER (PARTITION BY s.k ORDER BY sg.id) AS nth
          FROM s JOIN f USING (k) JOIN sg USING (collection_id) JOIN tp ON tp.x = s.tx AND tp.y = sg.ti AND tp.same WHERE s.id IS NULL)
    SELECT k, id, CAST(year AS BIGINT) AS year, via FROM s WHERE id IS NOT NULL UNION ALL SELECT k, id, CAST(year AS BIGINT), 'album' FROM h WHERE nth = 1
""")
def song_search_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A song by search, else from the artist's whole catalogue, else on the host's album."""
    found = C.judged_once(_texts(spark, sf_dir).where("line <= 2"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("size"))
    tracks = C.with_keys(part.select("k", S.of(S.TITLES, F.floor(F.col("k") / 7)).alias("track")), title="track", prefix="h_")
    some = lambda test, collection, own, pos: part.where(test).select("k", collection.alias("collection_id"), own.alias("own"), F.lit(pos).alias("pos"))
    albums = some("size % 3 = 0", F.col("k") % 40, F.col("size") % 2 == 0, 0).unionByName(some("size % 3 < 2", (F.col("size") % 40).cast("long"), F.lit(True), 1))
    released = F.when(F.col("size") % 5 > 0, F.concat((1890 + F.col("k") % 130).cast("string"), F.lit("-01-01")))
    songs = part.select((F.col("k") % 40).alias("collection_id"), F.col("k").alias("id"), S.of(S.TITLES, F.col("k")).alias("song_title"), released.alias("released"), (F.col("size") % 7 == 0).alias("own_artist"), F.col("k").alias("pos"))
    got = C.find_song(tracks, found.where("line <= 1"), found.where("line = 2"), albums, C.with_keys(songs, title="song_title", prefix="c_"), "k")
    return got.withColumn("year", F.col("year").cast("long"))


@query(f"""
    WITH {DIMENSIONS}, p AS (SELECT a.i AS x, b.i AS y, {S.close(S.squash(S.bare(S.main_credit("a.n"))), S.squash(S.bare("b.n")))} AS same FROM a0 a, a0 b),
    t AS (SELECT p_partkey AS k, p_partkey // 2 AS song FROM part)
    SELECT k, CASE WHEN lp.same THEN song % 1000 END AS album_id, CASE WHEN p.same THEN CASE WHEN song % 3 = 0 THEN song + 1 ELSE song END % {_N["a"]} END AS artist_id
    FROM t JOIN lp ON lp.x = (k // 5) % {_N["l"]} AND lp.y = (song // 2) % {_N["l"]} JOIN p ON p.x = song % {_N["a"]} AND p.y = CASE WHEN song % 3 = 0 THEN song + 1 ELSE song END % {_N["a"]}
""")
def song_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The album and artist of linked songs, each only where the names agree."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    song = F.floor(F.col("k") / 2)
    tracks = C.with_keys(part.select("k", song.alias("song_id"), S.of(S.ARTISTS, song).alias("artist"), S.of(ALBUMS, F.floor(F.col("k") / 5)).alias("album")), album="album", prefix="h_")
    credits = tracks.select("artist").distinct().select("artist", K.squash(K.bare(K.main_credit("artist"))).alias("h_credit"))
    by = F.when(F.col("k") % 3 == 0, F.col("k") + 1).otherwise(F.col("k")) % len(S.ARTISTS)
    songs = C.with_keys(part.select(F.col("k").alias("song_id"), (F.col("k") % 1000).alias("collection_id"), by.alias("artist_id"), S.of(ALBUMS, F.floor(F.col("k") / 2)).alias("album")), album="album", prefix="c_").drop("album")
    pages = spark.createDataFrame(list(enumerate(S.ARTISTS)), "artist_id long, name string").select("artist_id", K.squash(K.bare("name")).alias("page_key"))
    return C.links(tracks.join(credits, "artist"), songs, pages, "k")


@query(f"""
    WITH {DIMENSIONS}, {CANDIDATES},
    d AS (SELECT CASE WHEN c.id % 11 = 0 THEN 'gone' WHEN NOT ap.same THEN 'artist' WHEN NOT tp.same AND NOT tp.near THEN 'title' WHEN NOT ({_STUDIO}) AND NOT lp.same THEN 'version' END AS doubt
          FROM c JOIN ap ON ap.x = ax AND ap.y = ay JOIN tp ON tp.x = tx AND tp.y = ty JOIN lp ON lp.x = lx AND lp.y = ly JOIN t0 ON t0.i = ty JOIN l0 ON l0.i = ly)
    SELECT doubt, count(*) AS n FROM d GROUP BY doubt
""")
def link_doubts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why stored links look wrong, counted: gone, by another, under another title, a version that is not on the host's album."""
    rows = candidates(spark, sf_dir)
    title = Z.same_title(F.col("h_title"), F.col("c_forms")) | Z.near_titles(F.col("h_title"), F.col("c_forms"))
    why = C.doubt(F.col("id") % 11 == 0, Z.same_artist(F.col("h_names"), F.col("c_names")), title, C.studio_song(F.col("song_title"), F.col("song_album")), C.on_album())
    return rows.select(why.alias("doubt")).groupBy("doubt").agg(F.count(F.lit(1)).alias("n"))


_NOTES = ["", "live", "demo version", "remix", "olive", "re-recording"]
_BASE = "live|demo|remix|rmx|karaoke|rehearsal|re-?recording|instrumental"


@query(f"""
    WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS id, {S.sql(S.TITLES, "l_partkey")} AS title, {S.sql(_NOTES, "l_suppkey")} AS note, {S.sql(S.TITLES, "l_partkey // 3")} AS host, {S.sql(ALBUMS, "l_partkey")} AS album, l_linenumber AS line, l_quantity AS q,
                      l_suppkey AS s, 1700 + l_orderkey % 400 AS y FROM lineitem)
    SELECT id, NOT {_WORD.format("title", _STORE)} AND NOT {_WORD.format("album", "live")} AS store_studio,
           NOT ({_WORD.format("title", _BASE)} AND NOT {_WORD.format("host", _BASE)}) AND NOT {_WORD.format("note", _BASE)} AND (line = 1 OR NOT (s % 4 = 0 OR q > 25) OR (line > 2 AND s % 5 <> 0)) AS base_studio,
           {_WORD.format("album", "best of|greatest|collection|anthology|singles|complete|hits|archives?|anniversary|remaster(ed)?|deluxe")} AS compilation, CASE WHEN y > 1800 AND y <= 2027 THEN y END AS base_year, CASE WHEN y > 1900 AND y <= 3000 THEN y END AS store_year FROM r
""")
def studio_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is a song, or a recording with its releases, the studio's? Is an album's title a compilation's? And the years that count."""
    line, s = F.col("l_linenumber"), F.col("l_suppkey")
    kind = "array<struct<status: string, types: array<string>>>"
    first = F.struct(F.when(s % 4 == 0, "Bootleg").otherwise("Official").alias("status"), F.when(F.col("l_quantity") > 25, F.array(F.lit("Live"))).otherwise(F.array().cast("array<string>")).alias("types"))
    more = F.struct(F.lit("Promotion").alias("status"), F.when(s % 5 == 0, F.array(F.lit("Compilation"), F.lit("DJ-mix"))).otherwise(F.array(F.lit("Compilation"))).alias("types"))
    releases = F.when(line == 1, F.array().cast(kind)).when(line == 2, F.array(first).cast(kind)).otherwise(F.array(first, more).cast(kind))
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + line).alias("id"), S.of(S.TITLES, F.col("l_partkey")).alias("title"), S.of(_NOTES, s).alias("note"), S.of(S.TITLES, F.floor(F.col("l_partkey") / 3)).alias("host"),
        S.of(ALBUMS, F.col("l_partkey")).alias("album"), releases.alias("releases"), (1700 + F.col("l_orderkey") % 400).alias("y"),
    )
    return rows.select(
        "id", C.studio_song(F.col("title"), F.col("album")).alias("store_studio"), C.studio_recording(F.col("title"), F.col("note"), F.col("host"), F.col("releases")).alias("base_studio"),
        C.like_compilation(F.col("album")).alias("compilation"), K.valid_year(F.col("y"), 1800, 2027).alias("base_year"), K.valid_year(F.col("y"), 1900, 3000).alias("store_year"),
    )


_RECORDINGS = """
    r AS (SELECT l_partkey % 4000 AS k, l_orderkey * 10 + l_linenumber AS id, l_suppkey % 5 AS artist, 'k' || (l_suppkey % 2) AS name, CASE WHEN l_linenumber % 3 = 0 OR l_partkey % 13 = 0 THEN 'near' ELSE 'same' END AS kind, l_quantity > 8 AS studio,
                 l_discount > 0.08 AS own, l_discount > 0.09 AS original, CASE WHEN l_tax > 0.02 THEN year(l_shipdate) END AS y, l_linenumber AS releases FROM lineitem)
"""


def _recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") % 4000).alias("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (s % 5).alias("artist_id"), F.concat(F.lit("k"), s % 2).alias("artist_key"),
        F.when((F.col("l_linenumber") % 3 == 0) | (F.col("l_partkey") % 13 == 0), "near").otherwise("same").alias("kind"), (F.col("l_quantity") > 8).alias("studio"), (F.col("l_discount") > 0.08).alias("own_album"), (F.col("l_discount") > 0.09).alias("own_original"),
        F.when(F.col("l_tax") > 0.02, F.year("l_shipdate")).alias("year"), F.col("l_linenumber").alias("releases"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
    )


@query(f"""
    WITH {_RECORDINGS}, w AS (SELECT *, count_if(kind = 'same') OVER (PARTITION BY k) AS n_same, count_if(kind = 'near') OVER (PARTITION BY k) AS n_near FROM r),
    t AS (SELECT * FROM w WHERE (kind = 'same' OR n_near > n_same) AND studio),
    a AS (SELECT k, name, artist, count(*) AS n, bool_or(own) AS own FROM t GROUP BY ALL),
    g AS (SELECT k, name, count(*) AS ids, count_if(own) AS owners FROM a GROUP BY ALL),
    p AS (SELECT a.*, g.ids, g.owners, CASE WHEN owners = 0 OR own THEN n ELSE 0 END AS counted FROM a JOIN g USING (k, name)),
    b AS (SELECT *, sum(counted) OVER (PARTITION BY k, name) AS total FROM p),
    v AS (SELECT *, ids = 1 OR (owners = 1 AND own) OR (owners <> 1 AND counted >= 3 AND counted >= 3 * (total - counted)) AS wins FROM b),
    lost AS (SELECT k FROM v GROUP BY k, name HAVING NOT bool_or(wins)),
    m AS (SELECT t.*, n_same = 0 AS near FROM t JOIN v USING (k, name, artist) WHERE wins AND k NOT IN (SELECT k FROM lost)),
    o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY CASE WHEN original THEN 0 ELSE 1 END, coalesce(y, 9999), releases DESC, id) AS nth, min(CASE WHEN y > 1800 THEN y END) OVER (PARTITION BY k) AS first, count(*) OVER (PARTITION BY k) AS recordings FROM m)
    SELECT k, id, near, CAST(first AS BIGINT) AS year, recordings FROM o WHERE nth = 1
""")
def base_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recording that stands for each track, among those that are its artist's once namesakes are told apart."""
    rows = C.matching_recordings(_recordings(spark, sf_dir), "k")
    from ..operators.durable import keep

    rows = keep(rows)
    many = rows.groupBy("k").agg(F.count(F.lit(1)).alias("recordings"))
    return C.primary_recording(rows, "k").join(many, "k").select("k", "id", "near", F.col("year").cast("long").alias("year"), "recordings")


_CODES = ["GB", "XC", "CS", "US", "XE", "FR", "XG"]


@query(f"""
    WITH ar AS (SELECT s_suppkey AS id, 'n' || (s_suppkey % 60) AS name, ({_CODES})[s_suppkey % 7 + 1] AS code FROM supplier),
         u AS (SELECT name, min(id) AS id FROM ar GROUP BY name HAVING count(DISTINCT id) = 1),
         c AS (SELECT l_orderkey AS k, l_linenumber AS pos, CASE WHEN l_orderkey % 2 = 0 THEN l_suppkey ELSE u.id END AS id FROM lineitem LEFT JOIN u ON u.name = 'n' || (l_partkey % 60)),
         d AS (SELECT k, pos, c.id, CASE code WHEN 'XC' THEN 'CS' WHEN 'XG' THEN 'DD' WHEN 'CS' THEN NULL WHEN 'XE' THEN NULL ELSE code END AS code FROM c LEFT JOIN ar ON ar.id = c.id),
         f AS (SELECT k, code, min(pos) AS pos FROM d WHERE code IS NOT NULL GROUP BY k, code), l AS (SELECT k, string_agg(code, '|' ORDER BY pos, code) AS codes FROM f GROUP BY k), e AS (SELECT k, bool_and(id IS NOT NULL) AS every FROM d GROUP BY k)
    SELECT e.k, CASE WHEN every THEN codes END AS codes FROM e LEFT JOIN l USING (k)
""")
def credited_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The countries of a track's artists in the order of its credits, by id or by a name that one artist alone has."""
    artists = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("artist_id"), F.concat(F.lit("n"), F.col("s_suppkey") % 60).alias("name_key"), S.of(_CODES, F.col("s_suppkey")).alias("code"))
    lines = table(spark, sf_dir, "lineitem")
    credits = lines.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("pos"), F.when(F.col("l_orderkey") % 2 == 0, F.col("l_suppkey")).alias("artist_id"), F.concat(F.lit("n"), F.col("l_partkey") % 60).alias("name_key"))
    return C.artist_countries(credits.withColumn("name_key", F.when(F.col("artist_id").isNull(), F.col("name_key"))), artists, "k").select("k", F.array_join("codes", "|").alias("codes"))


_PRINTED = ["The A", "a", "A ", "B", "the  b", "C", "", "D d"]


@query(f"""
    WITH t AS (SELECT trim(regexp_replace(regexp_replace(lower({S.sql(_PRINTED, "o_custkey")}), '^the\\s+', ''), '\\s+', ' ', 'g')) AS artist, CASE WHEN o_orderkey % 9 > 0 THEN ({_CODES})[(o_orderkey % 3 + o_custkey % 2) % 7 + 1] END AS code FROM orders WHERE o_orderstatus <> 'P'),
         n AS (SELECT artist, code, count(*) AS n FROM t WHERE artist <> '' AND code IS NOT NULL GROUP BY ALL), r AS (SELECT *, max(n) OVER (PARTITION BY artist) AS most FROM n)
    SELECT artist AS artist_key, min(code) AS codes FROM r WHERE n = most GROUP BY artist HAVING count(*) = 1
""")
def archive_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country most often printed for an artist elsewhere in the archive, none if two are as common."""
    code = F.when(F.col("o_orderkey") % 9 > 0, S.of(_CODES, (F.col("o_orderkey") % 3 + F.col("o_custkey") % 2) % 7))
    tracks = table(spark, sf_dir, "orders").select(S.of(_PRINTED, F.col("o_custkey")).alias("artist"), F.when(code.isNotNull(), F.array(code)).alias("codes"), (F.col("o_orderstatus") != "P").alias("clear"))
    return C.inferred_countries(tracks).select("artist_key", F.array_join("codes", "/").alias("codes"))
