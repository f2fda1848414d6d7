"""Catalogue operators on many rows that share few texts, and on repeated keys."""

import time

from pyspark.sql import functions as F

from recordloom.operators import catalogue as C


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def blocks(spark, tracks, releases):
    t = C.with_keys(tracks, title="t", prefix="h_").select("key", "first_name", "h_title")
    r = C.with_keys(releases, title="t", prefix="c_").select("release_id", "artist_id", "name_key", F.array(F.struct(F.col("c_title").alias("plain"), F.col("c_forms").alias("forms"))).alias("titles"))
    return C.block_releases(t, r, spark.createDataFrame([(7, "nits"), (7, "nits"), (8, "other")], "artist_id int, name_key string"), "key")


def test_a_title_is_tested_once_in_a_block(spark):
    n = 8000
    many = spark.range(n).select(F.col("id").alias("key"), F.lit("nits").alias("first_name"), F.concat(F.lit("A rather long title of a song, no. "), F.col("id") % 40).alias("t"))
    other = F.when(F.col("id") == 5, "A rather long title of a song, no. 3").otherwise(F.concat(F.lit("Some quite different piece of music, no. "), F.col("id") % 40))
    more = spark.range(n).select(F.col("id").alias("release_id"), F.lit(7).alias("artist_id"), F.lit("nits").alias("name_key"), other.alias("t"))
    began = time.monotonic()
    assert blocks(spark, many, more).count() == n // 40
    assert time.monotonic() - began < 60


def test_keys_and_releases_with_several_rows(spark):
    tracks = spark.createDataFrame([(1, "nits", "Away"), (1, "walkers", "In Flux"), (1, "nits", "Away"), (None, "nits", "In Flux"), (3, None, "Away"), (4, "walkers", "Nothing alike")], "key int, first_name string, t string")
    releases = spark.createDataFrame([(50, 1, "nits", "Away"), (50, 1, "walkers", "In Flux"), (51, 7, None, "Away"), (51, 7, "nits", "In Flux"), (None, None, "walkers", "inFLUX"), (53, 7, "walkers", "(Rope) Away")], "release_id int, artist_id int, name_key string, t string")
    want = [(1, 50, 1, True), (1, 51, 7, False), (1, None, None, True), (1, 53, 7, False), (None, 51, 7, True)]
    assert rows(blocks(spark, tracks, releases), "key", "release_id", "artist_id", "exact") == sorted(want, key=str)


def test_a_common_title_has_many_tracks_and_masters(spark):
    n = 12_000
    k = F.col("id")
    tracks = spark.range(n).select(k.alias("key"), F.lit("hits").alias("album_key"), F.concat(F.lit("n"), k % 5).alias("lead"), F.lit(None).cast("long").alias("stored_master"), F.lit(False).alias("asked_master"))
    masters = spark.range(n).select(k.alias("master_id"), F.lit("hits").alias("title_key"), F.array(F.when(k < 2, F.lit(0)).when(k < 4, F.lit(1)).otherwise(F.lit(9)), F.lit(8)).alias("artist_ids"), F.when(k < 2, 1990).otherwise(k).alias("year"))
    names = spark.createDataFrame([(0, "n0"), (1, "n1"), (9, "n3"), (8, "x")], "artist_id int, name_key string")
    began = time.monotonic()
    got = C.match_masters(tracks, masters, names, "key").groupBy("class", "master_id").count()
    assert rows(got, "class", "master_id", "count") == sorted([("duplicates", 0, n // 5), ("ambiguous", None, 2 * n // 5), ("unmatched", None, 2 * n // 5)], key=str)
    assert time.monotonic() - began < 40


def test_a_key_with_several_albums_counts_all_its_masters(spark):
    tracks = spark.createDataFrame([(1, "lp", "nits", None, False), (1, "ep", "nits", None, False), (1, "", "nits", None, False), (2, "lp", "nits", 5, True), (2, "lp", "nits", 6, False), (3, "lp", "other", None, False), (3, "va", "nits", None, False), (None, "lp", "nits", None, False)], "key int, album_key string, lead string, stored_master int, asked_master boolean")
    masters = spark.createDataFrame([(10, "lp", [1], 1980), (10, "lp", [1], 1980), (11, "ep", [1], 1990), (40, "va", [194], 2000), (41, "va", None, 2000)], "master_id int, title_key string, artist_ids array<int>, year int")
    names = spark.createDataFrame([(1, "nits"), (1, "nits"), (194, "various")], "artist_id int, name_key string")
    want = [(1, "ambiguous", None), (1, "ambiguous", None), (1, "no_album", None), (2, "matched", 5), (2, "matched", 10), (3, "compilation", None), (3, "compilation", None), (None, "unmatched", None)]
    assert rows(C.match_masters(tracks, masters, names, "key"), "key", "class", "master_id") == sorted(want, key=str)


PAIRS = "key int, artist string, track string, album string, song_artist string, song_title string, song_album string, released string, id int, pos int"


def keyed(t):
    return C.with_keys(C.with_keys(t, "artist", "track", "album", "h_"), "song_artist", "song_title", "song_album", "c_")


def test_an_album_of_many_songs_for_many_tracks(spark):
    n = 12_000
    k = F.col("id")
    none = keyed(spark.createDataFrame([], PAIRS))
    tracks = C.with_keys(spark.range(n).select(k.alias("key"), F.concat(F.lit("Some long title of a track, no. "), k % 40).alias("track")), title="track", prefix="h_")
    albums = spark.range(n).select(k.alias("key"), F.lit(70).alias("collection_id"), (k % 2 == 0).alias("own"), F.lit(0).alias("pos"))
    songs = C.with_keys(spark.range(n).select(F.lit(70).alias("collection_id"), k.alias("id"), F.concat(F.lit("Some long title of a track, no. "), 20 + k % 40).alias("t"), F.concat(1950 + k % 50, F.lit("-01-01")).alias("released"), (k % 3 == 0).alias("own_artist"), (-k).alias("pos")), title="t", prefix="c_")
    began = time.monotonic()
    got = rows(C.find_song(tracks, none, none, albums, songs, "key").join(tracks.select("key", (F.col("key") % 40).alias("of")), "key").groupBy("of", "id", "year", "via").count(), "of", "id", "year", "via", "count")
    last = lambda of: n - 40 + of - 20  # noqa: E731  the song that comes first is the last of its title
    assert got == sorted([(of, last(of), 1950 + last(of) % 50 if of % 2 == 0 or last(of) % 3 == 0 else None, "album", n // 40) for of in range(20, 40)], key=str)
    assert time.monotonic() - began < 60


def test_texts_compared_once_give_the_same_picks(spark):
    artists, titles, albums = ["A & B", "Nits", "", None, "The Nits", "Beirut"], ["Song", "Song (Live)", "Crequee Alley", "Creeque Alley", None, "Tune, pt II", "Tune part 2"], ["LP", "Live", None, "", "LP - Deluxe"]
    data = [(k % 90, artists[k % 6], titles[k % 7], albums[k % 5], artists[k * 5 // 7 % 6], titles[k // 3 % 7], albums[k // 11 % 5], None if k % 9 == 0 else str(1890 + k % 130), k, k) for k in range(3000)]
    t = spark.createDataFrame([*data, (None, *data[0][1:])], PAIRS)
    columns = ["key", "id", "year", "near", "weak"]
    want = rows(C.pick_song(keyed(t), "key"), *columns)
    assert len(want) > 20 and rows(C.pick_song(C.judged_once(t), "key"), *columns) == want
