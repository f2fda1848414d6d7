"""Names, titles and labels: the keys they compare by and the tests between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fuzzy as Z
from ..functions import textkeys as K
from ..operators import catalogue as C
from ..queries import query, table
from . import cases as S

_ARTIST = S.sql(S.ARTISTS, "p_partkey")


@query(f"""
    WITH a AS (SELECT p_partkey AS partkey, {_ARTIST} AS n FROM part)
    SELECT partkey, {S.unmixed("n")} AS unmixed, replace({S.unmixed("n")}, '`', '''') AS searchable, {S.main_credit("n")} AS main, array_to_string({S.credited("n")}, '|') AS names,
           {S.bare(f"coalesce({S.credited('n')}[1], '')")} AS lead, {S.plain("n")} AS plain, array_to_string({S.name_keys("n")}, '|') AS host_names FROM a
""")
def credit_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of a credit: each word in one script, guests left out, each name's key, the first one's."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), S.of(S.ARTISTS, F.col("p_partkey")).alias("n"))
    names = rows.select("n").distinct().select(
        "n", K.unmixed("n").alias("unmixed"), K.searchable("n").alias("searchable"), K.main_credit("n").alias("main"), F.array_join(K.credited("n"), "|").alias("names"), K.lead("n").alias("lead"),
        K.plain("n").alias("plain"), F.array_join(K.name_keys("n"), "|").alias("host_names"),
    )
    return rows.join(names, "n").drop("n")


@query(f"""
    WITH a AS (SELECT p_partkey AS partkey, {_ARTIST} AS n FROM part)
    SELECT partkey, {S.artist_key("n")} AS artist_key, trim(regexp_replace(regexp_replace(lower(n), '^the\\s+', ''), '\\s+', ' ', 'g')) AS loose_key, {S.norm("n")} AS norm,
           trim(regexp_replace(regexp_replace(lower(n), '[​﻿]', '', 'g'), '\\s+', ' ', 'g')) AS spelling FROM a
""")
def artist_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of an artist: for spellings, for countries, for comparing lists, for dictionaries."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), S.of(S.ARTISTS, F.col("p_partkey")).alias("n")).select(
        "partkey", K.artist_key("n").alias("artist_key"), K.loose_artist_key("n").alias("loose_key"), K.norm("n").alias("norm"), K.spelling("n").alias("spelling")
    )


@query(f"""
    WITH a AS (SELECT p_partkey AS partkey, {S.sql(S.TITLES, "p_partkey")} AS t FROM part), k AS (SELECT *, {S.plain("t")} AS p FROM a)
    SELECT partkey, p AS plain, {S.numbers("p")} AS numbers, {S.counted("p")} AS counted, {S.squash(S.counted("p"))} AS squashed,
           array_to_string(list_transform(list_sort(list_distinct({S.forms("t")})), lambda f: f), '|') AS forms,
           CASE WHEN trim(regexp_replace(t, '\\s*[(\\[][^)\\]]*[)\\]]\\s*', ' ', 'g')) = '' THEN t ELSE trim(regexp_replace(t, '\\s*[(\\[][^)\\]]*[)\\]]\\s*', ' ', 'g')) END AS bare_title,
           length({S.squash("p")}) > 2 AND NOT regexp_matches(p, '^(intro|outro|interlude|untitled|unknown|hidden track|bonus track|track \\d+|\\d+)$') AS matchable FROM k
""")
def title_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title's plain form, its numbers, its countable form, all forms it can match by, and whether it tells songs apart at all."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), S.of(S.TITLES, F.col("p_partkey")).alias("t"))
    p = K.plain("t")
    return rows.select(
        "partkey", p.alias("plain"), K.numbers(p).alias("numbers"), K.counted(p).alias("counted"), K.squash(K.counted(p)).alias("squashed"), F.array_join(F.array_sort(Z.forms("t")), "|").alias("forms"),
        K.bare_title("t").alias("bare_title"), Z.matchable("t").alias("matchable"),
    )


def _exists(items: str, test: str) -> str:
    return f"len(list_filter({items}, lambda f: {test})) > 0"


_CH, _CF = S.counted("h"), S.counted("f")
_SAME, _NEAR = _exists("ff", f"{S.squash(_CF)} = {S.squash(_CH)}"), _exists("ff", f"{S.close(_CH, _CF)} AND {S.numbers(_CH)} = {S.numbers(_CF)}")
_SHORT = S.squash(S.plain(r"regexp_split_to_array(other, '\s[-–—]\s')[1]"))


@query(f"""
    WITH a AS (SELECT p_partkey AS partkey, {S.sql(S.TITLES, "p_partkey")} AS host, {S.sql(S.TITLES, "p_partkey // " + str(len(S.TITLES)) + " + p_size")} AS other FROM part),
         k AS (SELECT *, {S.plain("host")} AS h, {S.plain("other")} AS o, {S.forms("other")} AS ff FROM a)
    SELECT partkey, {S.close("h", "o")} AS close, {S.close("h", "o")} AND {S.numbers("h")} = {S.numbers("o")} AS near_title, {_SAME} AS same_title, {_NEAR} AS near_titles,
           {_SAME} OR {_NEAR} OR (len(string_split(h, ' ')) >= 3 AND starts_with(o || ' ', h || ' ')) AS title_test,
           {S.squash("h")} <> '' AND ({S.squash("o")} = {S.squash("h")} OR {_SHORT} = {S.squash("h")}) AS same_album FROM k
""")
def title_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two titles: close, near, the same in any form, an album's with or without its subtitle."""
    n = len(S.TITLES)
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), S.of(S.TITLES, F.col("p_partkey")).alias("host"), S.of(S.TITLES, F.floor(F.col("p_partkey") / n) + F.col("p_size")).alias("other"))
    pairs = C.with_keys(C.with_keys(rows, title="host", prefix="h_"), title="other", prefix="o_").withColumnsRenamed({"h_title": "h", "o_title": "o", "o_forms": "ff"})
    h, o, ff = F.col("h"), F.col("o"), F.col("ff")
    return pairs.select(
        "partkey", Z.close(h, o).alias("close"), Z.near_title(h, o).alias("near_title"), Z.same_title(h, ff).alias("same_title"), Z.near_titles(h, ff).alias("near_titles"), Z.title_test(h, o, ff).alias("title_test"),
        Z.same_album(F.col("host"), F.col("other")).alias("same_album"),
    )


def _like(x: str, y: str) -> str:
    return (
        f"CASE WHEN {x} = '' OR {y} = '' THEN {x} = {y} ELSE {x} = {y} OR (least(length({x}), length({y})) >= 4 AND (contains({x}, {y}) OR contains({y}, {x})))"
        f" OR levenshtein({x}, {y}) <= greatest(2, floor(0.3::DOUBLE * greatest(length({x}), length({y})))) END"
    )


@query(f"""
    WITH a AS (SELECT p_partkey AS partkey, {_ARTIST} AS host, {S.sql(S.ARTISTS, "p_partkey // " + str(len(S.ARTISTS)) + " + p_size")} AS other FROM part),
         k AS (SELECT *, {S.name_keys("host")} AS hk, {S.name_keys("other")} AS ok, {S.norm("host")} AS x, {S.norm("other")} AS y FROM a)
    SELECT partkey, len(hk) > 0 AND len(ok) > 0 AND ({_exists("ok", S.close("hk[1]", "f"))} OR {_exists("hk", S.close("f", "ok[1]"))}) AS same_artist,
           len(hk) > 0 AND {_exists("ok", S.close("hk[1]", "f"))} AS host_first_on, len(hk) > 0 AND coalesce(list_contains(ok, hk[1]), false) AS exact, {_like("x", "y")} AS similar FROM k
""")
def artist_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two credits: the same artist either way, the host's first name on the other, exactly so, and similar in a list."""
    n = len(S.ARTISTS)
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), S.of(S.ARTISTS, F.col("p_partkey")).alias("host"), S.of(S.ARTISTS, F.floor(F.col("p_partkey") / n) + F.col("p_size")).alias("other"))
    pairs = C.with_keys(C.with_keys(rows, artist="host", prefix="h_"), artist="other", prefix="o_")
    hk, ok = F.col("h_names"), F.col("o_names")
    return pairs.select(
        "partkey", Z.same_artist(hk, ok).alias("same_artist"), Z.host_first_on(hk, ok).alias("host_first_on"), F.coalesce(F.array_contains(ok, F.get(hk, F.lit(0))), F.lit(False)).alias("exact"),
        Z.similar(K.norm("host"), K.norm("other")).alias("similar"),
    )


_NONE = (
    r"^(self[-\s]?(released?|release|produced|published)?|selfreleased?|self-?made|independent|indie|diy|d\.i\.y\.?|private(\s+(press|release|issue))?|no\s+label|not\s+on\s+label.*|unsigned|white\s+label"
    r"|artists?''?s?\s+(own\s+)?release|eigen(release|verlag)|not\s+released|unreleased|promo|demo|промо|демо|cd-?r|none|n/a|unknown|bandcamp|soundcloud|youtube|самиздат|независимый|без\s+лейбла"
    r"|собственн(ый|ое)\s+(лейбл|издание|релиз)|сам(о)?издание|\?+|-+|\.+)$"
)
_TAIL = r"[\s,.]+(records?|recordings?|rec\.?|recording\s+co(mpany)?\.?|label|ltd\.?|limited|inc\.?|gmbh|llc)\.?$"


def _tidy(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(regexp_replace({x}, '^[\"«“„''‘](.+)[\"»”“''’]$', '\1'), '(?i)^(label|лейбл)\s+', ''), '\s+', ' ', 'g'))"


def _not_a_label(x: str) -> str:
    return f"({x} = '' OR regexp_matches({x}, '(?i){_NONE}'))"


def _catalogue_name(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({x}, '\s\(\d+\)$', ''), '\*$', ''))"


@query(rf"""
    WITH a AS (SELECT p_partkey AS partkey, {S.sql(S.LABELS, "p_partkey")} AS l, {S.sql(S.LABELS, "p_partkey // 3")} AS m FROM part)
    SELECT partkey, {_tidy("l")} AS tidy, {S.artist_key(rf"regexp_replace(regexp_replace(l, '^\[(.+)\]', '\1'), '(?i){_TAIL}', '')")} AS label_key, {_not_a_label("l")} AS not_a_label,
           regexp_matches(l, '^[\s?.\-–—]*$') AS placeholder, {_catalogue_name("l")} AS catalogue_name, regexp_matches(l, 'Ã[\x{{80}}-\x{{BF}}]') AS garbled,
           array_to_string(list_filter(CASE WHEN {_catalogue_name("l")} = {_catalogue_name("m")} THEN [{_catalogue_name("l")}] ELSE [{_catalogue_name("l")}, {_catalogue_name("m")}] END, lambda n: NOT {_not_a_label("n")}), '|') AS labels FROM a
""")
def label_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A printed label: tidied, its key, whether it names a label at all; and the names a catalogue's labels give."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), S.of(S.LABELS, F.col("p_partkey")).alias("l"), S.of(S.LABELS, F.floor(F.col("p_partkey") / 3)).alias("m"))
    return rows.select(
        "partkey", K.tidy_label("l").alias("tidy"), K.label_key("l").alias("label_key"), K.not_a_label("l").alias("not_a_label"), K.placeholder("l").alias("placeholder"),
        K.catalogue_name("l").alias("catalogue_name"), K.garbled("l").alias("garbled"), F.array_join(K.catalogue_labels(F.array("l", "m")), "|").alias("labels"),
    )


@query(rf"""
    WITH a AS (SELECT p_partkey AS partkey, {S.sql(S.LABELS, "p_partkey")} AS l, {S.sql(S.LABELS, "p_partkey // 3")} AS m, p_size % 4 <> 0 AS read, p_size % 3 AS kind FROM part),
         b AS (SELECT *, CASE WHEN kind = 0 THEN [] WHEN {_not_a_label("l")} THEN [] ELSE [l] END AS own, list_filter([{_catalogue_name("m")}], lambda n: NOT {_not_a_label("n")}) AS theirs FROM a)
    SELECT partkey, CASE WHEN NOT read THEN NULL WHEN len(own) > 0 THEN array_to_string(own, '|') WHEN l <> '' AND NOT regexp_matches(l, '^[\s?.\-–—]*$') THEN NULL WHEN len(theirs) > 0 THEN array_to_string(theirs, '|') END AS label,
           CASE WHEN read AND len(own) = 0 AND (l = '' OR regexp_matches(l, '^[\s?.\-–—]*$')) AND len(theirs) > 0 THEN 'discogs' END AS label_from FROM b
""")
def track_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A track's labels: the printed ones; none for a self-release; the catalogue's where nothing or a placeholder is printed; none before it was read."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), "p_size", S.of(S.LABELS, F.col("p_partkey")).alias("l"), S.of(S.LABELS, F.floor(F.col("p_partkey") / 3)).alias("m"))
    none = F.array().cast("array<string>")
    own = F.when((F.col("p_size") % 3 == 0) | K.not_a_label("l"), none).otherwise(F.array("l"))
    label, source = C.labelled(own, F.col("l"), F.col("p_size") % 4 != 0, K.catalogue_labels(F.array("m")))
    return rows.select("partkey", F.array_join(label, "|").alias("label"), source.alias("label_from"))


_ALIASES = ["Jackson, Wanda", "Earth, Wind", "Cohen, Leonard", "Plain Name", "Björk, X", "Smith, J, Jr"]
_NAMES = ["Wanda Jackson", "Other", "Leonard Cohen", "Plain Name", "x björk", "J, Jr Smith", "SIGUR ROS", "Motley Crue", "Nits"]
_ACCENTED = ["Wanda Jackson", "Sigur Rós", "Mötley Crüe", "Nîts", "Nits"]


@query(rf"""
    WITH a AS (SELECT p_partkey AS partkey, {S.sql(_ALIASES, "p_partkey")} AS alias, {S.sql(_NAMES, "p_partkey // 6")} AS name, {S.sql(_ACCENTED, "p_partkey // 11")} AS other FROM part),
         b AS (SELECT *, regexp_extract(alias, '^(.+?),\s+(.+)$', 1) AS last, regexp_extract(alias, '^(.+?),\s+(.+)$', 2) AS given FROM a)
    SELECT partkey, CASE WHEN last <> '' AND ends_with({S.plain("name")}, {S.plain("last")}) THEN given || ' ' || last ELSE alias END AS natural_order,
           CASE WHEN length(name) = length(other) AND lower(strip_accents(name)) = lower(strip_accents(other)) AND strip_accents(other) <> other AND strip_accents(name) = name
                THEN array_to_string(list_transform(range(1, length(name) + 1), lambda i: CASE WHEN substr(name, i, 1) = upper(substr(name, i, 1)) THEN upper(substr(other, i, 1)) ELSE lower(substr(other, i, 1)) END), '') ELSE name END AS accented FROM b
""")
def name_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ "Last, First" put in order where it is the artist's name, and a spelling with another one's accents."""
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("partkey"), S.of(_ALIASES, F.col("p_partkey")).alias("alias"), S.of(_NAMES, F.floor(F.col("p_partkey") / 6)).alias("name"), S.of(_ACCENTED, F.floor(F.col("p_partkey") / 11)).alias("other")
    )
    return rows.select("partkey", K.natural_order(F.col("alias"), F.col("name")).alias("natural_order"), K.with_accents("name", "other").alias("accented"))
