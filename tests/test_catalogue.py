"""Catalogue picks on small tables."""

from pyspark.sql import functions as F

from recordloom.operators import catalogue as C
from recordloom.operators import resolve as R


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def pairs(spark, data):
    """(key, artist, title, album, c_artist, song_title, song_album, released, id)"""
    t = spark.createDataFrame([(*d, k) for k, d in enumerate(data)], "key int, artist string, track string, album string, song_artist string, song_title string, song_album string, released string, id int, pos int")
    return C.with_keys(C.with_keys(t, "artist", "track", "album", "h_"), "song_artist", "song_title", "song_album", "c_")


def test_pick_song(spark):
    p = pairs(spark, [
        (1, "A & B", "Song", "LP", "A", "Song (Live)", "LP", "1980-01-01", 10), (1, "A & B", "Song", "LP", "A", "Song", "LP", "1985-01-01", 11), (1, "A & B", "Song", "LP", "A", "Song", "Hits", "1979-01-01", 12),
        (2, "Artist", "Crequee Alley", None, "Artist", "Creeque Alley", "X", "1967", 20), (2, "Artist", "Crequee Alley", None, "Other One", "Crequee Alley", "X", "1960", 21),
        (3, "Artist", "Tune", "", "Artist", "Tune (Remix)", "X", None, 30),
    ])
    assert rows(C.pick_song(p, "key"), "key", "id", "year", "near", "weak") == [(1, 11, 1979, False, False), (2, 20, 1967, True, False), (3, 30, None, False, True)]
    shuffled = p.orderBy(F.desc("id"))
    assert rows(C.pick_song(shuffled, "key"), "key", "id") == rows(C.pick_song(p, "key"), "key", "id")


def test_find_song_in_steps(spark):
    searched = pairs(spark, [(1, "A", "One", "LP", "A", "One", "LP", "1980", 1), (2, "A", "Two", "LP", "A", "Two (Live)", "Q", "1981", 2)])
    catalogue = pairs(spark, [(2, "A", "Two", "LP", "A", "Two", "Z", "1990", 3)])
    tracks = C.with_keys(spark.createDataFrame([(1, "One"), (2, "Two"), (3, "Three"), (4, "Four")], "key int, track string"), title="track", prefix="h_")
    albums = spark.createDataFrame([(3, 70, False, 1), (3, 71, True, 0), (4, 72, True, 0)], "key int, collection_id int, own boolean, pos int")
    songs = C.with_keys(spark.createDataFrame([(71, "Three", 9, "2001", False, 0), (72, "Other", 8, "2001", False, 0)], "collection_id int, t string, id int, released string, own_artist boolean, pos int"), title="t", prefix="c_")
    got = C.find_song(tracks, searched, catalogue, albums, songs, "key")
    assert rows(got, "key", "id", "year", "via") == [(1, 1, 1980, "search"), (2, 3, 1981, "catalogue"), (3, 9, 2001, "album")]


def test_namesakes_of_recordings(spark):
    data = [(1, "x", "k", "same", True, False), (1, "y", "k", "same", True, True), (2, "x", "k", "same", True, False), (2, "y", "k", "same", True, False)] + [(3, "x", "k", "same", True, False)] * 3 + [(3, "y", "k", "same", True, False)]
    data += [(4, "x", "k", "same", True, False), (4, "z", "other", "same", True, False), (5, "x", "k", "near", True, False), (6, "x", "k", "same", False, False)]
    t = spark.createDataFrame(data, "key int, artist_id string, artist_key string, kind string, studio boolean, own_album boolean")
    got = C.matching_recordings(t, "key")
    assert sorted(set(rows(got, "key", "artist_id", "near"))) == [(1, "y", False), (3, "x", False), (4, "x", False), (4, "z", False), (5, "x", True)]
    r = spark.createDataFrame([(1, "a", False, False, 1970, 5, 0), (1, "b", False, True, 1980, 1, 1), (2, "c", True, False, None, 1, 0), (2, "d", True, False, 1990, 1, 1)], "key int, id string, near boolean, own_original boolean, year int, releases int, pos int")
    assert rows(C.primary_recording(r, "key"), "key", "id", "year") == [(1, "b", 1970), (2, "d", 1990)]


def test_masters(spark):
    tracks = spark.createDataFrame([(1, "lp", "nits", None, False), (2, "dup", "nits", None, False), (3, "two", "nits", None, False), (4, "va", "nits", None, False), (5, "", "nits", None, False), (6, "lp", "nits", 99, True), (7, "zz", "nits", None, False), (8, "lp", "nits", None, True)], "key int, album_key string, lead string, stored_master int, asked_master boolean")
    masters = spark.createDataFrame([(10, "lp", [1], 1980), (21, "dup", [1, 2], 1990), (20, "dup", [2, 1], 1990), (30, "two", [1], 1990), (31, "two", [1], 1991), (40, "va", [194], 2000)], "master_id int, title_key string, artist_ids array<int>, year int")
    names = spark.createDataFrame([(1, "nits"), (2, "other"), (194, "various")], "artist_id int, name_key string")
    got = rows(C.match_masters(tracks, masters, names, "key"), "key", "class", "master_id")
    assert got == [(1, "matched", 10), (2, "duplicates", 20), (3, "ambiguous", None), (4, "compilation", None), (5, "no_album", None), (6, "matched", 99), (7, "unmatched", None), (8, "matched", None)]
    years = spark.createDataFrame([(1, 10, 1985), (2, 20, 1990)], "key int, master_id int, year int")
    assert rows(C.older_masters(years, masters, "key"), "key", "gap") == [(1, 5)]


def test_releases(spark):
    r = "struct<id: int, master: int, year: int, compilation: boolean, reissue: boolean, unofficial: boolean>"
    m = spark.createDataFrame([(1, (5, None, 1970, True, False, False), None, True), (1, (6, 9, 1985, False, True, False), 1980, True), (1, (7, 9, 1990, False, False, False), 1980, True), (1, (4, 9, 1960, False, False, True), None, True), (2, (8, None, 1990, False, False, False), None, False)], f"key int, r {r}, master_year int, exact boolean")
    assert rows(C.choose_releases(m, "key"), "key", "release_id", "year") == [(1, 7, 1980), (2, 8, None)]
    found = spark.createDataFrame([(1, 1, None, 1970, False, False, None, False, 0), (1, 2, 5, 1975, True, False, 1971, True, 1), (2, 3, None, 1, False, False, None, False, 0), (2, 4, None, 2, False, False, None, False, 1), (2, 5, None, 3, False, False, None, False, 2), (2, 6, None, 4, False, False, None, True, 3)], "key int, release_id int, master int, year int, reissue boolean, compilation boolean, master_year int, has_title boolean, pos int")
    albums = spark.createDataFrame([(1, 7, None, 1, False, False, None, 0), (2, 8, None, 1999, False, True, None, 0)], "key int, release_id int, master int, year int, reissue boolean, compilation boolean, master_year int, pos int")
    assert rows(C.find_release(found, albums, "key"), "key", "release_id", "year", "via") == [(1, 2, 1971, "track"), (2, 8, None, "album")]
    tracks = C.with_keys(spark.createDataFrame([(1, "nits", "Звёзды всегда хороши"), (2, "nits", "Zzz Zzz")], "key int, first_name string, t string"), title="t", prefix="h_").select("key", "first_name", "h_title")
    titles = C.with_keys(spark.createDataFrame([(50, 1, "nits", "Звёзды всегда хороши, особенно ночью"), (51, 7, "the alias", "Звёзды всегда хороши"), (52, 8, "walkers", "Звёзды всегда хороши")], "release_id int, artist_id int, name_key string, t string"), title="t", prefix="c_")
    releases = titles.select("release_id", "artist_id", "name_key", F.array(F.struct(F.col("c_title").alias("plain"), F.col("c_forms").alias("forms"))).alias("titles"))
    names = spark.createDataFrame([(7, "nits"), (8, "other")], "artist_id int, name_key string")
    assert rows(C.block_releases(tracks, releases, names, "key"), "key", "release_id", "exact") == [(1, 50, True), (1, 51, False)]


def test_countries_labels_years(spark):
    credits = spark.createDataFrame([(1, 0, None, "a"), (1, 1, None, "b"), (2, 0, None, "dup"), (3, 0, 4, "x")], "key int, pos int, artist_id int, name_key string")
    artists = spark.createDataFrame([(1, "a", "GB"), (2, "b", "XC"), (3, "dup", "US"), (4, "dup", "FR")], "artist_id int, name_key string, code string")
    assert rows(C.artist_countries(credits, artists, "key"), "key", "codes") == [(1, ["GB", "CS"]), (2, None), (3, ["FR"])]
    t = spark.createDataFrame([("The A", ["GB"], True), ("a", ["GB"], True), ("A", ["US"], True), ("b", ["FR"], True), ("B", ["DE"], True)], "artist string, codes array<string>, clear boolean")
    assert rows(C.inferred_countries(t), "artist_key", "codes") == [("a", ["GB"])]
    rule = lambda *x: spark.range(1).select(C.year_rule(*(F.lit(v).cast("int") if k != 1 else F.lit(v).cast("string") for k, v in enumerate(x[:4])), F.lit(x[4]))).first()[0]
    assert [rule(*x) for x in [(None, None, 1980, 2000, False), (1990, "apple", 1980, 2000, False), (1990, "apple", 1991, 2000, False), (1990, "apple", 1995, 2000, False), (1990, "musicbrainz", 1980, 2000, False), (1990, "owner", 1980, 2000, False), (1990, "apple", 1980, 1970, False), (1990, "apple", 1980, 2000, True), (1990, "apple", 1990, 2000, True)]] == ["take", "take", "take", "ask", "ask", "nothing", "nothing", "ask", "nothing"]
    label = spark.createDataFrame([(1, ["Mute"], "Mute", True, ["X"]), (2, [], "self-released", True, ["X"]), (3, [], "?", True, ["X"]), (4, [], None, False, ["X"])], "key int, names array<string>, printed string, read boolean, theirs array<string>")
    name, source = C.labelled(F.col("names"), F.col("printed"), F.col("read"), F.col("theirs"))
    assert rows(label.select("key", name.alias("l"), source.alias("f")), "key", "l", "f") == [(1, ["Mute"], None), (2, None, None), (3, ["X"], "discogs"), (4, None, None)]


def test_dates_spellings_reruns(spark):
    lists = spark.createDataFrame([(1, "a", 0, True, "2001-01-05", "2001-01-01", "2001-01-10"), (1, "b", 1, False, "2001-01-06", "2001-01-01", "2001-01-10"), (1, "c", 2, False, "2001-01-06", "2001-01-01", "2001-01-10"), (2, "a", 0, True, "2002-01-01", "2001-01-01", "2001-01-10"), (2, "b", 1, False, "2001-01-04", "2001-01-01", "2001-01-10"), (3, "a", 0, True, None, None, None), (3, "b", 1, False, "2003-01-01", None, None)], "key int, kind string, rank int, chosen boolean, date string, before string, after string")
    assert rows(C.air_date(lists, "key"), "key", "date", "why") == [(1, "2001-01-06", "outvoted"), (2, "2001-01-04", "misplaced"), (3, "2003-01-01", "own")]
    names = spark.createDataFrame([("nits", "Nits"), ("nits", "Nits"), ("nits", "NITS"), ("nits", "«NiTs»"), ("abc", "abc"), ("ab", "Ab"), ("ab", "A.B.")], "key string, name string")
    assert rows(C.proposals(names, "key", "name"), "name", "spelling") == [("NITS", "Nits"), ("«NiTs»", "Nits")]
    known = spark.createDataFrame([(1, "Part one here. Shared part"), (2, "Other title. Shared part")], "key int, title string")
    again = spark.createDataFrame([(10, "OTHER title.  Shared part"), (11, "Part one here. New"), (12, "Shared part only? Shared part"), (13, "nothing")], "key int, title string")
    assert rows(C.reruns(again, known, "key", "title"), "key", "known_key") == [(10, 2), (11, 1), (12, None), (13, None)]


def test_settled_rounds(spark):
    c = spark.createDataFrame([(1, "n", "a"), (2, "n", "a"), (2, "n", "b"), (3, "n", "c"), (3, "n", "d")], "key int, name string, owner string")
    assert rows(R.settled(c, "key", "name", "owner"), "key", "owner", "round") == [(1, "a", 0), (2, "a", 1)]


def test_rounds_end_as_documented(spark):
    import pytest

    chain = [(0, "n0", "a")] + [(k, f"n{k - 1}", "a") for k in range(1, 8)] + [(k, f"n{k}", "b") for k in range(1, 8)]
    c = spark.createDataFrame(chain, "key int, name string, owner string")
    assert R.ROUNDS == 5 and {r["round"] for r in R.settled(c, "key", "name", "owner").collect()} <= set(range(6))
    assert R.settled(c, "key", "name", "owner", whole=True).count() >= 1
    rows = [(0, "n", "a"), (1, "n", "a"), (1, "m", "b")]
    steps = spark.createDataFrame(rows, "key int, name string, owner string")
    with pytest.raises(RuntimeError, match="not settled"):
        R.settled(steps, "key", "name", "owner", rounds=0, whole=True)
