"""Picks among catalogue candidates, and what follows from them.

Candidates come as tables: one row per (track, candidate) with ``pos``, the order of the source's own result, which settles ties.
Text keys that need an Arrow function are columns made beforehand, once per distinct value (``with_keys``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fuzzy as Z
from ..functions import textkeys as K
from .audit import mode_or_null
from .durable import keep
from .pick import best, first_rows, release_rank, release_year
from .spread import few

# Words that mark a version as not the studio's; the two sources' lists differ.
NOT_STUDIO_STORE = "live|demo|edit|remix|mix|instrumental|acoustic|karaoke|session|rehearsal"
NOT_STUDIO_BASE = "live|demo|remix|rmx|karaoke|rehearsal|re-?recording|instrumental"
NOT_STUDIO_TYPES = ["Live", "Demo", "Remix", "DJ-mix"]
COMPILATION_TITLE = "best of|greatest|collection|anthology|singles|complete|hits|archives?|anniversary|remaster(?:ed)?|deluxe"
#: The catalogue's artist that stands for "Various".
VARIOUS = 194


def word(c: Column, words: str) -> Column:
    """Does the text hold one of the words, bounded by what is no ASCII letter or digit?"""
    return F.coalesce(c, F.lit("")).rlike(rf"(?i)(?<![A-Za-z0-9_])(?:{words})(?![A-Za-z0-9_])")


def like_compilation(title: Column) -> Column:
    return word(title, COMPILATION_TITLE)


def studio_song(title: Column, album: Column) -> Column:
    return ~word(title, NOT_STUDIO_STORE) & ~word(album, "live")


def studio_recording(title: Column, note: Column, host_title: Column, releases: Column) -> Column:
    """``releases``: array of structs (status, types). At least one is neither a bootleg nor of a type that is no studio's; none at all will do."""
    named = word(title, NOT_STUDIO_BASE) & ~word(host_title, NOT_STUDIO_BASE) | word(note, NOT_STUDIO_BASE)
    good = F.exists(releases, lambda r: (F.coalesce(r["status"], F.lit("")) != "Bootleg") & ~F.coalesce(F.arrays_overlap(r["types"], F.array(*map(F.lit, NOT_STUDIO_TYPES))), F.lit(False)))
    return ~named & ((F.coalesce(F.size(releases), F.lit(0)) <= 0) | good)


def with_keys(rows: DataFrame, artist: str | None = None, title: str | None = None, album: str | None = None, prefix: str = "") -> DataFrame:
    """Adds <prefix>names, <prefix>title, <prefix>forms and <prefix>album_key, each worked out once per distinct value."""
    for column, made in (
        (artist, lambda c: {"names": K.name_keys(c)}),
        (title, lambda c: {"title": K.plain(c), "forms": Z.forms(c)}),
        (album, lambda c: {"album_key": K.squash(K.plain(c)), "album_short": K.squash(K.plain(F.get(F.split(K.text_of(c), rf"{K.SPACE}[-–—]{K.SPACE}"), F.lit(0))))}),
    ):
        if column:
            keys = rows.select(column).distinct()
            keys = keys.select(F.col(column).alias("_value"), *(v.alias(f"{prefix}{k}") for k, v in made(column).items()))
            rows = rows.join(keys, F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")
    return rows


def on_album(host: str = "h_", other: str = "c_") -> Column:
    """The album keys of ``with_keys`` agree; an empty host album is like nothing."""
    want = F.col(f"{host}album_key")
    return F.coalesce((want != "") & ((F.col(f"{other}album_key") == want) | (F.col(f"{other}album_short") == want)), F.lit(False))


def pick_song(pairs: DataFrame, key: str) -> DataFrame:
    """(key, id, year, near, weak): the version kept of each track's store songs, and the song's first year.

    ``pairs``: keyed tracks (h_*) with candidates (c_*, id, song_title, song_album, released, pos), or ``judged_once`` ones. Equal titles before near ones, each on the host's
    album and studio-made before on it, before studio-made elsewhere; else the earliest of any kind. The year is the least of equal titles (of near ones if there are none).
    """
    rows = (pairs if "_kind" in pairs.columns else judged(pairs)).where(F.col(key).isNotNull())
    year = F.substring("released", 1, 4).try_cast("int")
    rows = rows.withColumn("_year", F.when(year > 1900, year))
    good = F.when(F.col("_album") & F.col("_studio"), 0).when(F.col("_album"), 1).when(F.col("_studio"), 2)
    # a good one of either kind goes before what is not: equal good 0-2, near good 3-5, equal 6, near 7
    rank = F.when(good.isNotNull(), F.col("_kind") * 3 + good).otherwise(6 + F.col("_kind"))
    won = F.min(F.struct(rank.alias("_rank"), F.coalesce("released", F.lit("9999")).alias("_released"), "pos", "id", "_kind", "_studio", "_album", "_year"))
    same = F.min(F.when(F.col("_kind") == 0, F.col("_year")))
    picks = rows.groupBy(key).agg(won.alias("_won"), same.alias("_same"), F.min("_year").alias("_any"), F.min("_kind").alias("_least")).select(key, "_won.*", "_same", "_any", "_least")
    first = F.when(F.col("_least") == 0, F.least("_same", "_year")).otherwise(F.least("_any", "_year"))
    return picks.select(key, "id", first.alias("year"), (F.col("_kind") == 1).alias("near"), (~F.col("_studio") & ~F.col("_album")).alias("weak"))


def _title_kind() -> Column:
    return F.when(Z.same_title(F.col("h_title"), F.col("c_forms")), 0).when(Z.near_titles(F.col("h_title"), F.col("c_forms")), 1)


def judged(pairs: DataFrame) -> DataFrame:
    """The keyed pairs by the same artist under the same title (_kind 0) or a near one (1), with _studio and _album: is it the studio's, and on the host's album?"""
    own = pairs.where(Z.same_artist(F.col("h_names"), F.col("c_names")))
    return own.withColumns({"_kind": _title_kind(), "_studio": studio_song(F.col("song_title"), F.col("song_album")), "_album": on_album()}).where("_kind is not null")


def judged_once(rows: DataFrame) -> DataFrame:
    """As ``judged``, for rows without keys (artist, track, album, song_artist, song_title, song_album): every two texts that meet are compared once, whatever the number of rows."""
    keyed = lambda one, two, what: with_keys(with_keys(rows.select(one, two).distinct(), **{what: one}, prefix="h_"), **{what: two}, prefix="c_")
    artists = keyed("artist", "song_artist", "artist").where(Z.same_artist(F.col("h_names"), F.col("c_names"))).select("artist", "song_artist")
    titles = keyed("track", "song_title", "title").select("track", "song_title", _title_kind().alias("_kind")).where("_kind is not null")
    studio = rows.select("song_title", "song_album").distinct().withColumn("_studio", studio_song(F.col("song_title"), F.col("song_album")))
    albums = keyed("album", "song_album", "album").select("album", "song_album", on_album().alias("_album"))
    for made, by in ((artists, ["artist", "song_artist"]), (titles, ["track", "song_title"]), (studio, ["song_title", "song_album"]), (albums, ["album", "song_album"])):
        small = few(made).withColumnsRenamed({c: f"_by_{c}" for c in by})
        rows = rows.join(small, F.col(by[0]).eqNullSafe(F.col(f"_by_{by[0]}")) & F.col(by[1]).eqNullSafe(F.col(f"_by_{by[1]}"))).drop(*(f"_by_{c}" for c in by))
    return rows


def find_song(tracks: DataFrame, searched: DataFrame, catalogue: DataFrame, albums: DataFrame, album_songs: DataFrame, key: str) -> DataFrame:
    """(key, id, year, via): from the search; if it gives nothing or a weak match, from the artist's whole catalogue; else from the host's album.

    A weak match is replaced only by a better one. ``searched`` and ``catalogue`` are pairs as ``pick_song`` has them; ``albums``: (key, collection_id, own, pos), already
    those of the host's title; ``album_songs``: (collection_id, id, c_forms, released, own_artist, pos).
    """
    one = keep(pick_song(searched, key))
    open_ = tracks.select(key).join(one.where("not weak").select(key), key, "left_anti")
    two = keep(pick_song(searched.unionByName(catalogue).join(open_, key, "left_semi"), key))
    use = two.join(one.select(key, F.lit(True).alias("_had")), key, "left").where(F.col("_had").isNull() | ~F.col("weak")).drop("_had")
    chosen = use.withColumn("via", F.lit("catalogue")).unionByName(one.join(use, key, "left_anti").withColumn("via", F.lit("search")))
    chosen = chosen.withColumn("via", F.when(F.col("near"), "near").otherwise(F.col("via")))
    left = tracks.join(chosen.select(key), key, "left_anti")
    album = first_rows(albums.join(left.select(key), key, "left_semi"), [key], [F.col("pos")]).drop("pos")
    wanted = left.select(key, "h_title").join(album, key)
    # titles are compared once an album, with the first song of those that match by the same forms
    titles = wanted.select("collection_id", "h_title").distinct().join(first_rows(album_songs, ["collection_id", "c_forms"], [F.col("pos")]), "collection_id").where(Z.same_title(F.col("h_title"), F.col("c_forms")))
    songs = wanted.join(first_rows(titles, ["collection_id", "h_title"], [F.col("pos")]), ["collection_id", "h_title"])
    year = F.substring("released", 1, 4).try_cast("int")
    third = first_rows(songs, [key], [F.col("pos")]).select(key, "id", F.when((F.col("own") | F.col("own_artist")) & (year > 1900), year).alias("year"), F.lit("album").alias("via"))
    return chosen.select(key, "id", "year", "via").unionByName(third)


def links(tracks: DataFrame, songs: DataFrame, artists: DataFrame, key: str) -> DataFrame:
    """(key, album_id, artist_id) of linked tracks, each only where the names agree.

    ``tracks``: keyed, with song_id and h_credit, the squashed key of the whole credit; ``songs``: (song_id, collection_id, c_album_key, c_album_short, artist_id); ``artists``: (artist_id, page_key).
    """
    joined = tracks.join(songs, "song_id", "left").join(artists, "artist_id", "left")
    credit = F.coalesce(Z.close(F.col("h_credit"), F.col("page_key")), F.lit(False))
    return joined.select(key, F.when(on_album(), F.col("collection_id")).alias("album_id"), F.when(credit, F.col("artist_id")).alias("artist_id"))


def doubt(song_gone: Column, same_artist: Column, same_title: Column, studio: Column, album: Column) -> Column:
    """Why a stored link looks wrong: the first test that fails, or null."""
    return F.when(song_gone, "gone").when(~same_artist, "artist").when(~same_title, "title").when(~studio & ~album, "version")


def matching_recordings(rows: DataFrame, key: str) -> DataFrame:
    """The studio recordings that stand for each track, namesakes told apart; a track with a namesake that can't be told apart has none.

    ``rows``: (key, artist_id, artist_key, kind 'same' or 'near', studio, own_album, …). Near titles count too if they outnumber the same ones. Of artists that share a key the one with
    the host's album stays, else one with three recordings at least and three times the others'.
    """
    w = Window.partitionBy(key)
    same, near = F.count_if(F.col("kind") == "same").over(w), F.count_if(F.col("kind") == "near").over(w)
    titled = rows.withColumns({"_same": same, "_near": near}).where((F.col("kind") == "same") | (F.col("_near") > F.col("_same"))).where("studio").drop("_near")
    each = titled.groupBy(key, "artist_key", "artist_id").agg(F.count(F.lit(1)).alias("_n"), F.max("own_album").alias("_own"))
    g = Window.partitionBy(key, "artist_key")
    each = each.withColumns({"_ids": F.count(F.lit(1)).over(g), "_owners": F.count_if(F.col("_own")).over(g)})
    runs = F.col("_own") | (F.col("_owners") == 0)
    each = each.withColumns({"_all": F.sum(F.when(runs, F.col("_n"))).over(g), "_runs": runs})
    wins = (F.col("_ids") == 1) | F.when(F.col("_owners") == 1, F.col("_own")).otherwise(F.col("_runs") & (F.col("_n") >= 3) & (F.col("_n") >= 3 * (F.col("_all") - F.col("_n"))))
    judged = each.withColumn("_wins", F.coalesce(wins, F.lit(False)))
    lost = judged.groupBy(key, "artist_key").agg(F.max("_wins").alias("_any")).where("not _any").select(key).distinct()
    kept = judged.where("_wins").select(key, "artist_key", "artist_id")
    return titled.join(kept, [key, "artist_key", "artist_id"], "left_semi").join(lost, key, "left_anti").withColumn("near", F.col("_same") == 0).drop("_same")


def primary_recording(rows: DataFrame, key: str) -> DataFrame:
    """Of ``matching_recordings`` the one on the host's album that is no compilation, else the earliest; ties to the one on most releases. (key, id, year, near)"""
    rank = [F.when(F.col("own_original"), 0).otherwise(1), F.coalesce("year", F.lit(9999)), -F.col("releases"), F.col("pos")]
    won = best(rows, key, rank, ["id", "near"])
    first = rows.groupBy(key).agg(F.min(F.when(F.col("year") > 1800, F.col("year"))).alias("year"))
    return won.join(first, key)


# The base's codes for former and vague countries, as ours.
BASE_CODES = {"XC": "CS", "XG": "DD", "CS": None, "XW": None, "XE": None, "XU": None}


def country_code(code: Column) -> Column:
    out = code
    for theirs, ours in BASE_CODES.items():
        out = F.when(code == theirs, F.lit(ours)).otherwise(out)
    return out


def artist_countries(credits: DataFrame, artists: DataFrame, key: str) -> DataFrame:
    """(key, codes): the codes of a track's credited artists in order, each once; none at all if a name has not exactly one artist.

    ``credits``: (key, pos, artist_id or null, name_key); ``artists``: (artist_id, name_key, code), a row for each name of an artist.
    """
    unique = artists.groupBy("name_key").agg(F.count_distinct("artist_id").alias("_n"), F.min("artist_id").alias("_by_name")).where("_n = 1").select("name_key", "_by_name")
    known = credits.join(unique, "name_key", "left").withColumn("artist_id", F.coalesce("artist_id", "_by_name"))
    codes = artists.groupBy("artist_id").agg(country_code(F.min("code")).alias("code"))
    joined = known.join(codes, "artist_id", "left").groupBy(key).agg(F.bool_and(F.col("artist_id").isNotNull()).alias("_all"), F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("_codes"))
    named = F.array_distinct(F.filter(F.transform("_codes", lambda x: x["code"]), lambda c: c.isNotNull()))
    return joined.select(key, F.when(F.col("_all") & (F.size(named) > 0), named).alias("codes"))


def inferred_countries(tracks: DataFrame, artist: str = "artist") -> DataFrame:
    """(artist_key, codes): the codes most often printed clearly for an artist, none if two are as common. ``tracks``: artist, codes (array), clear."""
    clear = tracks.where("clear and codes is not null").select(K.loose_artist_key(artist).alias("artist_key"), F.array_join("codes", "/").alias("codes")).where("artist_key <> ''")
    return mode_or_null(clear, ["artist_key"], "codes").where("codes is not null").select("artist_key", F.split("codes", "/").alias("codes"))


def coded(codes: Column, is_vague: Column, printed: Column, read: Column, stored: Column, stored_from: Column) -> tuple[Column, Column]:
    """(country, country_from) of a track: what is printed clearly, else what was inferred before, else the vague print's codes. Not read yet: as stored."""
    clear = F.coalesce(printed, F.lit("")) != ""
    inferred = stored_from.isNotNull() & stored.isNotNull()
    country = F.when(~read, stored).when(clear & ~is_vague, codes).when(inferred, stored).when(clear, codes).otherwise(stored)
    return country, F.when(~read | (~(clear & ~is_vague) & stored_from.isNotNull()), stored_from)


def labelled(printed_names: Column, printed: Column, read: Column, catalogue_names: Column) -> tuple[Column, Column]:
    """(label, label_from): the printed labels; none for a self-release; the catalogue's where nothing, or a placeholder, is printed."""
    some = F.coalesce(F.size(printed_names), F.lit(0)) > 0
    self_released = (F.coalesce(printed, F.lit("")) != "") & ~K.placeholder(printed)
    theirs = F.when(F.coalesce(F.size(catalogue_names), F.lit(0)) > 0, catalogue_names)
    label = F.when(~read, F.lit(None)).when(some, printed_names).when(self_released, F.lit(None)).otherwise(theirs)
    return label, F.when(read & ~some & ~self_released & theirs.isNotNull(), F.lit("discogs"))


def find_release(pairs: DataFrame, albums: DataFrame, key: str, checked: int = 3) -> DataFrame:
    """(key, release_id, master, year, via): of the first ``checked`` releases by year the first whose tracklist has the title; else the first of the host's album.

    The rank is taken before the title test. ``pairs``: (key, release_id, master, year, reissue, compilation, master_year, has_title, pos), the artist's own; ``albums`` the same without has_title.
    """
    early = [F.coalesce("year", F.lit(9999)), F.col("pos")]
    own = F.when(F.col("reissue"), F.col("master_year")).otherwise(F.col("year"))
    first = first_rows(first_rows(pairs, [key], early, checked).where("has_title"), [key], early).select(key, "release_id", "master", own.alias("year"), F.lit("track").alias("via"))
    rest = first_rows(albums.join(first, key, "left_anti"), [key], early)
    return first.unionByName(rest.select(key, "release_id", "master", F.when(~F.col("compilation"), own).alias("year"), F.lit("album").alias("via")))


def match_masters(tracks: DataFrame, masters: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """(key, class, master_id): each track's master by equal album key and its lead among the master's artists' names.

    ``tracks``: (key, album_key, lead, stored_master, asked_master); ``masters``: (master_id, title_key, artist_ids, year); ``names``: (artist_id, name_key).
    classes: no_album, matched, duplicates (same artists and year: the lowest id), ambiguous, compilation, unmatched. A master that is stored, or was asked for in vain, is never overwritten.
    Masters are found once for all keys that ask the same, by title and name together, so no track meets all masters of its title.
    """
    ready = tracks.where((F.coalesce("album_key", F.lit("")) != "") & (F.coalesce("lead", F.lit("")) != ""))
    asked = ready.groupBy(key).agg(F.sort_array(F.collect_set(F.struct("album_key", "lead"))).alias("_asked"))
    wants = asked.select("_asked").distinct().select("_asked", F.inline("_asked"))
    each = masters.select("master_id", "title_key", "year", F.array_sort("artist_ids").alias("artist_ids"), F.explode("artist_ids").alias("artist_id"))
    named = each.join(names, "artist_id").select(F.col("title_key").alias("album_key"), F.col("name_key").alias("lead"), "master_id", "year", "artist_ids").distinct()
    found = wants.join(named, ["album_key", "lead"]).select("_asked", "master_id", "year", "artist_ids").distinct()
    groups = found.groupBy("_asked").agg(F.count(F.lit(1)).alias("_n"), F.count_distinct(F.to_json(F.struct("artist_ids", "year"))).alias("_kinds"), F.min("master_id").alias("_master"))
    titled = masters.groupBy(F.col("title_key").alias("album_key")).agg(F.max(F.array_contains("artist_ids", VARIOUS)).alias("_various"))
    various = wants.join(titled, "album_key").groupBy("_asked").agg(F.max("_various").alias("_various"))
    joined = tracks.join(asked.join(groups, "_asked", "left").join(various, "_asked", "left"), key, "left")
    kind = (
        F.when((F.coalesce("album_key", F.lit("")) == "") | (F.coalesce("lead", F.lit("")) == ""), "no_album").when(F.col("_n") == 1, "matched").when(F.col("_kinds") == 1, "duplicates")
        .when(F.col("_n") > 1, "ambiguous").when(F.col("_various"), "compilation").otherwise("unmatched")
    )
    return joined.select(key, kind.alias("class"), F.when(F.col("asked_master"), F.col("stored_master")).when(kind.isin("matched", "duplicates"), F.col("_master")).alias("master_id"))


def block_releases(tracks: DataFrame, releases: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """(key, release_id, artist_id, exact): matches of tracks with all releases of a dump, by performer, then title.

    ``tracks``: (key, first_name, h_title); ``releases``: (release_id, artist_id, name_key, titles: array of structs (plain, forms)); ``names``: (artist_id, name_key) of variations and
    aliases. A release meets a track by an equal performer key or by an artist that has it as a variation; typos are allowed within such a block only in the title.

    A title is tested once in each block, however many tracks and releases have it. Keys that ask the same, and releases that offer the same, are matched as one class, so
    each row of the result is made once, by joins on the classes, and none is shuffled.
    """
    asked = tracks.groupBy(key).agg(F.sort_array(F.collect_set(F.struct("first_name", "h_title"))).alias("_asked"))
    offered = releases.groupBy("release_id", "artist_id").agg(F.sort_array(F.collect_set(F.struct("artist_id", "name_key", "titles"))).alias("_offered"))
    wants, has = (c.select(name).distinct().select(name, F.inline(name)) for c, name in ((asked, "_asked"), (offered, "_offered")))
    one = wants.select("first_name", "h_title").distinct()
    ids = one.join(names.select("artist_id", F.col("name_key").alias("first_name")).distinct(), "first_name")
    title = F.exists("titles", lambda t: Z.title_test(F.col("h_title"), t["plain"], t["forms"]))
    by_name = one.join(has.select(F.col("name_key").alias("first_name"), "titles").distinct(), "first_name").where(title)
    by_id = ids.select("artist_id", "h_title").distinct().join(has.select("artist_id", "titles").distinct(), "artist_id").where(title)
    named = by_name.join(has.withColumn("first_name", F.col("name_key")), ["first_name", "titles"])
    listed = by_id.join(ids, ["artist_id", "h_title"]).join(has, ["artist_id", "titles"])
    met = named.select("first_name", "h_title", "_offered", "name_key").unionByName(listed.select("first_name", "h_title", "_offered", "name_key"))
    exact = F.max(F.coalesce(F.col("first_name") == F.col("name_key"), F.lit(False))).alias("exact")
    matches = met.join(wants, ["first_name", "h_title"]).groupBy("_asked", "_offered").agg(exact)
    return asked.join(offered.join(matches, "_offered"), "_asked").select(key, "release_id", "artist_id", "exact")


def choose_releases(matches: DataFrame, key: str) -> DataFrame:
    """(key, release_id, master, year): the release kept of each track's, and the earliest year an exact match vouches for. ``matches``: (key, r struct, master_year, exact)"""
    rows = matches.withColumns({"release_id": F.col("r.id"), "master": F.col("r.master"), "_year": F.when(F.col("exact"), release_year(F.col("r"), F.col("master_year")))})
    won = best(rows, key, release_rank(F.col("r")), ["release_id", "master"])
    return won.join(rows.groupBy(key).agg(F.min("_year").alias("year")), key)


def release_labels(tracks: DataFrame, labels: DataFrame, mains: DataFrame, key: str) -> DataFrame:
    """(key, labels, from): the labels of a track's release, else of its master's main release. ``labels``: (release_id, labels); ``mains``: (master_id, main)"""
    own = tracks.join(mains, "master_id", "left").withColumn("_release", F.coalesce("release_id", "main")).where("_release is not null")
    named = own.drop("labels").join(labels.select(F.col("release_id").alias("_release"), "labels"), "_release", "left")
    return named.select(key, "labels", F.when(F.col("labels").isNull(), "missing").when(F.col("release_id").isNotNull(), "release").otherwise("main").alias("from"))


def older_masters(tracks: DataFrame, masters: DataFrame, key: str) -> DataFrame:
    """(key, year, master_year, gap): tracks whose master is older than their year, by how much, the largest gap first."""
    joined = tracks.join(masters.select("master_id", F.col("year").alias("master_year")), "master_id").withColumn("gap", F.col("year") - F.col("master_year"))
    return joined.where("gap > 0").select(key, "year", "master_year", "gap").orderBy(F.desc("gap"), key)


def year_rule(year: Column, source: Column, found: Column, aired: Column, doubtful: Column) -> Column:
    """What a master's year does to a track's: ``take``, ``ask`` or ``nothing``.

    Nothing after the air year, and never over the owner's. It fills a missing year; it replaces the store's if it is earlier, equal or one later (else: ask), and a release's own if it is earlier;
    against the base's it only asks, from two years on. Where the match is doubtful (a compilation, a namesake), what would be taken is asked, or left if it would change nothing.
    """
    gap = year - found
    plain = (
        F.when(found.isNull() | F.coalesce(found > aired, F.lit(False)) | F.coalesce(source == "owner", F.lit(False)), "nothing").when(year.isNull(), "take")
        .when(source == "apple", F.when(gap >= -1, "take").otherwise("ask")).when(source == "discogs", F.when(gap > 0, "take").otherwise("nothing"))
        .when(source == "musicbrainz", F.when(gap >= 2, "ask").otherwise("nothing")).otherwise("nothing")
    )
    return F.when((plain == "take") & doubtful, F.when(F.coalesce(gap == 0, F.lit(False)), "nothing").otherwise("ask")).otherwise(plain)


def air_date(lists: DataFrame, key: str) -> DataFrame:
    """(key, date, why): the chosen list's date, unless two others agree on another and none on it, or it is out of order and another fits.

    ``lists``: (key, kind, rank, chosen, date, before, after), ``before`` and ``after`` the neighbouring episodes' dates.
    """
    dated = lists.where("date is not null")
    mine = lists.groupBy(key).agg(F.coalesce(F.max(F.when(F.col("chosen"), F.col("date"))), F.min_by("date", F.when(F.col("date").isNotNull(), F.col("rank")))).alias("_mine"), F.max("before").alias("_before"), F.max("after").alias("_after"))
    votes = dated.join(mine, key).where("not chosen").groupBy(key, "date", "_mine").agg(F.count(F.lit(1)).alias("_n"), F.min("rank").alias("_rank"))
    fits = lambda c: (F.col("_before").isNull() | (c > F.col("_before"))) & (F.col("_after").isNull() | (c < F.col("_after")))
    other = votes.join(mine.drop("_mine"), key).groupBy(key).agg(
        F.min(F.when(F.col("date") != F.col("_mine"), F.struct((-F.col("_n")).alias("n"), F.col("_rank"), F.col("date")))).alias("_top"), F.sum(F.when(F.col("date") == F.col("_mine"), F.col("_n")).otherwise(0)).alias("_with"),
        F.min(F.when((F.col("date") != F.col("_mine")) & fits(F.col("date")), F.struct("_rank", "date"))).alias("_fitting"),
    )
    joined = mine.join(other, key, "left")
    outvoted = F.coalesce((F.col("_top.n") <= -2) & (F.col("_with") == 0), F.lit(False))
    misplaced = ~fits(F.col("_mine")) & F.col("_fitting").isNotNull()
    return joined.select(key, F.when(outvoted, F.col("_top.date")).when(misplaced, F.col("_fitting.date")).otherwise(F.col("_mine")).alias("date"), F.when(outvoted, "outvoted").when(misplaced, "misplaced").otherwise("own").alias("why"))


def incomplete(size: Column, longest_other: Column, usual: int = 10) -> Column:
    """Why a chosen list is short: another is longer by two, or it has fewer entries than usual; null if it isn't."""
    return F.when(longest_other >= size + 2, "shorter").when(size < usual, "short")


def spelling_votes(rows: DataFrame, key: str, name: str) -> DataFrame:
    """(key, spelling, n): the spelling proposed for each key: the commonest that is not in one case throughout, quotes around it gone and apostrophes straight; else none."""
    tidy = F.translate(F.regexp_replace(F.trim(name), r"\A[\"«“„'‘](.+)[\"»”“'’]\z", "$1"), "`’", "''")
    mixed = rows.select(key, tidy.alias("spelling")).where((F.lower("spelling") != F.col("spelling")) & (F.upper("spelling") != F.col("spelling")))
    counts = mixed.groupBy(key, "spelling").agg(F.count(F.lit(1)).alias("n"))
    won = counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("spelling"))).alias("_top"))
    return won.select(key, F.col("_top.spelling").alias("spelling"), (-F.col("_top.m")).alias("n"))


def proposals(rows: DataFrame, key: str, name: str, credited: DataFrame | None = None) -> DataFrame:
    """(name, spelling): new dictionary entries. A name is joined to its key's spelling if they differ in case, accents or punctuation only; with a
    key of three letters or fewer in case only; or if a source credits the name's own tracks so. ``credited``: (name, spelling)."""
    voted = rows.select(key, name).distinct().join(spelling_votes(rows, key, name), key).where(F.col(name) != F.col("spelling"))
    own = credited.select(F.col("name").alias("_name"), F.col("spelling").alias("_credit")).distinct() if credited is not None else None
    safe = F.when(F.length(key) <= 3, F.lower(name) == F.lower("spelling")).otherwise(F.lit(True))
    if own is None:
        return voted.where(safe).select(F.col(name).alias("name"), "spelling")
    joined = voted.join(own, (F.col(name) == F.col("_name")) & (F.col("spelling") == F.col("_credit")), "left")
    return joined.where(safe | F.col("_credit").isNotNull()).select(F.col(name).alias("name"), "spelling")


def reruns(rows: DataFrame, known: DataFrame, key: str, title: str) -> DataFrame:
    """(key, known_key): rows whose plain title, or a part of eight characters and more of it, is that of one known row alone; the whole title goes before a part."""
    parts = lambda c: F.filter(F.transform(F.split(c, r"(?<=[.!?:])\s+"), lambda x: F.trim(x)), lambda x: F.length(x) >= 8)
    low = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    whole = known.groupBy(low(F.col(title)).alias("_t")).agg(F.min(key).alias("known_key"))
    each = known.select(key, F.explode(F.array_distinct(parts(low(F.col(title))))).alias("_p"))
    part = each.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_part_key")).where("_n = 1").drop("_n")
    mine = rows.select(key, low(F.col(title)).alias("_t"))
    by_part = mine.select(key, F.explode(parts(F.col("_t"))).alias("_p")).join(part, "_p").groupBy(key).agg(F.min("_part_key").alias("_part_key"))
    return mine.join(whole, "_t", "left").join(by_part, key, "left").select(key, F.coalesce("known_key", "_part_key").alias("known_key"))


def corrected(tracks: DataFrame, row_id: str, countries: DataFrame, titles: DataFrame, spellings: DataFrame, labels: DataFrame, overrides: DataFrame, columns: list[str], anchors: dict[str, str]) -> DataFrame:
    """A track as it is shown: the codes of its printed country, under its restored names and its artist's spelling, with its labels, shaped; then its hand fixes, tested on
    the row as it came to them, and shaped again. Nothing is asked anew, so doing it twice changes nothing.

    ``tracks``: artist, track, album, printed_country, printed_label, country (array), country_from, catalogue_labels (array) and what else ``columns`` name. ``countries``: (spelling, codes); ``titles``:
    (pos, artist, track, album, to_artist, to_track, to_album); ``spellings``: (spelling, name); ``labels``: (spelling, name), closed (see ``dictionary.closure``); ``overrides``: (pos, artist, track,
    album, set_<field> …).
    """
    from . import dictionary as D
    from .merge import shaped

    read = D.whole_or_parts(tracks, "printed_country", countries, r"\s*[/,&]\s*").withColumnsRenamed({"codes": "_codes", "status": "_status"})
    rows = tracks.join(read, "printed_country", "left")
    country, country_from = coded(F.col("_codes"), F.coalesce(D.vague(F.col("_codes"), F.col("_status")), F.lit(False)), F.col("printed_country"), F.col("printed_country").isNotNull(), F.col("country"), F.col("country_from"))
    rows = rows.withColumns({"country": country, "country_from": country_from}).drop("_codes", "_status")
    rows = D.rules_first_match(rows, titles, row_id, ["artist", "track", "album"]).drop("match_pos")
    rows = D.restored(rows, "artist", spellings).drop("was_restored")
    names = labels.groupBy(F.lower("spelling").alias("_spelling")).agg(F.array_sort(F.collect_set("name")).alias("_names"))
    printed = rows.withColumn("_spelling", F.lower(K.tidy_label("printed_label"))).join(names, "_spelling", "left")
    own = F.when(F.col("_names").isNotNull(), F.col("_names")).when(K.not_a_label(K.tidy_label("printed_label")), F.array().cast("array<string>")).otherwise(F.array(K.tidy_label("printed_label")))
    label, label_from = labelled(own, F.col("printed_label"), F.col("printed_label").isNotNull(), K.catalogue_labels(F.col("catalogue_labels")))
    rows = shaped(printed.withColumns({"label": label, "label_from": label_from}), [row_id, *columns], anchors)
    fields = [c.removeprefix("set_") for c in overrides.columns if c.startswith("set_")]
    return shaped(D.rules_last_wins(rows, overrides, row_id, ["artist", "track", "album"], "artist", fields).drop("rules_applied"), [row_id, *columns], anchors)
