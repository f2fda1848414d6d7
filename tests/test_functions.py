"""The examples that pin down each key and predicate."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.functions import extract as X
from recordloom.functions import fuzzy as Z
from recordloom.functions import textkeys as K
from recordloom.operators import align


@pytest.fixture(scope="module")
def value(spark):
    one = spark.range(1)
    return lambda c: one.select(c.alias("x")).first()["x"]


def lit(x):
    return F.lit(x).cast("string")


@pytest.mark.parametrize("f,text,want", [
    (K.plain, "Звуки Му", "zvuki mu"), (K.plain, "Zvuki Mu", "zvuki mu"), (K.plain, "Café (Live) x", "cafe"), (K.plain, "A & B - 2009 Remastered", "a and b"), (K.plain, None, ""),
    (K.unmixed, "Мооn Safari", "Moon Safari"), (K.unmixed, "Воплi Вiдоплясова", "Воплі Відоплясова"), (K.unmixed, "Deadушки", "Deadушки"), (K.searchable, "Don`t", "Don't"),
    (K.main_credit, "A ft. B", "A"), (K.lead, "The Nits & B", "nits"), (K.artist_key, "2RAUMWOHNUNG", "2raumwohnung"), (K.artist_key, "The 2raum  wohnung", "2raumwohnung"),
    (K.artist_key, "2ва самолёта", "2васамолета"), (K.artist_key, "Simon and Garfunkel", "simon&garfunkel"), (K.loose_artist_key, "The  B  C", "b c"),
    (K.label_key, "[PIAS]", "pias"), (K.label_key, "Mute Records", "mute"), (K.label_key, "Mute", "mute"), (K.tidy_label, "label  «Mute»", "«Mute»"), (K.spelling, " UK​  and ", "uk and"),
    (K.norm, "The Хор", "hor"), (K.norm, "Xaver & Co", "haverandco"), (K.norm, "Йод", "iod"), (K.catalogue_name, "Nits (2)", "Nits"), (K.bare_title, "(Rope) Away", "Away"), (K.bare_title, "(Rope)", "(Rope)"),
    (X.scrub_emails, "to a.b@c-d.org.", "to ."), (X.clean, " a  b﻿ ", "a b"), (X.decode_entities, "&#x41;&#66;&laquo;&zzz;&AMP;", "AB«&zzz;&"),
])
def test_strings(value, f, text, want):
    assert value(f(lit(text))) == want


@pytest.mark.parametrize("text", ["A & B", "A y B", "A / B", "A, B", "A + B", "A feat. B", "A and B"])
def test_credited(value, text):
    assert value(K.credited(lit(text))) == ["A", "B"]


def test_titles(value, spark):
    assert value(K.counted(lit("pt 1"))) == value(K.counted(lit("part one"))) == "part 1"
    assert value(K.numbers(lit("part iv of 012"))) == "12,4"
    assert not value(Z.near_title(lit("song part 1"), lit("song part iv")))
    assert len(value(Z.forms(lit("Черные Цветы / Chernye Cvety")))) == 3 and len(value(Z.forms(lit("Sugar Baby / Kriminaltango")))) == 1
    test = lambda a, b: spark.range(1).select(K.plain(lit(a)).alias("h"), K.plain(lit(b)).alias("o"), Z.forms(lit(b)).alias("f")).select(Z.title_test(F.col("h"), F.col("o"), F.col("f"))).first()[0]
    assert test("Kriminal Tango", "Kriminaltango") and test("Звёзды всегда хороши", "Zvezdy vsegda khoroshi ночью") and not test("Part 1 of it", "Part 2 of it")
    assert test("House of the Rising Sun", "The House of the Rising Sun") and not test("", "abc")
    assert value(Z.same_album(lit("In Flux"), lit("inFLUX"))) and value(Z.same_album(lit("Nouse Luonto"), lit("Nouse Luonto - Lauluja"))) and not value(Z.same_album(lit(""), lit("")))
    assert [value(Z.matchable(lit(t))) for t in ("ab", "Intro", "track 4", "12", "Song")] == [False, False, False, False, True]


def test_artists(value, spark):
    both = lambda f, a, b: spark.range(1).select(K.name_keys(lit(a)).alias("a"), K.name_keys(lit(b)).alias("b")).select(f(F.col("a"), F.col("b"))).first()[0]
    one, two = "Janis Joplin / Big Brother & The Holding Company", "Big Brother & The Holding Company & Janis Joplin"
    assert both(Z.same_artist, one, two) and both(Z.host_first_on, one, two)
    assert not both(Z.host_first_on, "The Frank & Walters", "The Walkers") and not both(Z.same_artist, "", "A")
    assert value(K.natural_order(lit("Jackson, Wanda"), lit("Wanda Jackson"))) == "Wanda Jackson"
    assert value(K.natural_order(lit("Earth, Wind"), lit("Other"))) == "Earth, Wind"
    assert value(K.catalogue_labels(F.array(F.lit("Mute (2)"), F.lit("Not On Label (X)"), F.lit("Mute*"), F.lit("Mute")))) == ["Mute"]
    assert value(K.not_a_label(lit("Self-released"))) and not value(K.not_a_label(lit("Mute"))) and value(K.placeholder(lit(" ?-")))


def test_dates_and_numbers(value):
    day = datetime.date
    assert [value(X.iso_date(lit(t))) for t in ("21.10.2002", "04/03/2012", "x 2009.01.25", "4 марта 2012", "31.02.2002", "1.1.1990", None)] == [day(2002, 10, 21), day(2012, 3, 4), day(2009, 1, 25), day(2012, 3, 4), None, None, None]
    assert [value(X.duration_seconds(lit(t))) for t in ("59", "1:01", "1:02:03", "x", "")] == [59, 61, 3723, None, None]
    assert [value(X.header_number(lit(t))) for t in ("(выпуск 141)", "#356", "№ 200", "307-го выпуска", "none")] == [141, 356, 200, 307, None]
    assert value(X.rfc822_date(lit("Mon, 02 Jan 2006 15:04:05 +0300"))) == datetime.datetime(2006, 1, 2, 12, 4, 5) and value(X.rfc822_date(lit("soon"))) is None
    assert value(X.episode_number(lit("x # 12"))) == 12 and value(X.episode_number(lit("x"))) is None


def test_lists(value):
    lines = lambda *x: F.array(*map(F.lit, x))
    assert value(X.split_run_together(lines('15 a (b) "c" (domino)16 fraser fifield "x"'))) == ['15 a (b) "c" (domino)', '16 fraser fifield "x"']
    text = lines("hello", "1.", 'a "b"', "2. c cd d", "a note", '3 e "f"', "the end", "or so", '4 g "h"')
    assert value(X.entries_in(text)) == ['1. a "b"', "2. c cd d", '3 e "f"']
    # a note is passed over only if the very next line is the next entry
    assert value(X.entries_in(lines('1. a "b"', "a note", "2.", 'c "d"'))) == ['1. a "b"'] and value(X.entry_run(lines("x", "1.", 'a "b"')))["start"] == 2
    assert value(X.entries_among(text)) == ['1. a "b"', "2. c cd d", '3 e "f"', '4 g "h"']
    assert value(X.joined_brackets(lines("a [", "b]", "c"))) == ["a [b]", "c"]
    assert tuple(value(X.parts_of(lit("1. Nits (Holland) 'Three' x")))) == ("Nits", "Three") and tuple(value(X.parts_of(lit("2 A (B) «C» D")))) == ("A", "C")


@pytest.mark.parametrize("entry,want", [
    ('1. Nits (Holland) "Three Sisters" CD "Alankomaat" (Columbia)', (1, "Nits", "Holland", "Three Sisters", "Alankomaat", "Columbia", 1.0)),
    ('1. Erland & The Carnival (UK) - "I am Joan"', (1, "Erland & The Carnival", "UK", "I am Joan", None, None, 1.0)),
    ("1. Beirut (USA) Gibraltar LP No No No", (1, "Beirut", "USA", "Gibraltar", "No No No", None, 0.5)),
    ("1. The National (USA). Turtleneck, LP Sleep Well Beast", (1, "The National", "USA", "Turtleneck", "Sleep Well Beast", None, 0.5)),
    ("1. John Lennon & Plastic Ono Band. Give Peace a Chance", (1, "John Lennon & Plastic Ono Band", None, "Give Peace a Chance", None, None, 0.5)),
    ("just words", (None, "just words", None, None, None, None, 0.0)),
])
def test_grammar(value, entry, want):
    assert tuple(value(X.parse_entry(lit(entry)))) == want


def test_pages(value):
    assert value(X.page_lines(lit("<p>a &amp; b&#33;<br>c<script>x</script> &unknown; <!-- z -->"))) == ["a & b!", "c &unknown;"]
    # opening tags alone begin a line, and only those listed
    assert value(X.page_lines(lit("<b>x</b><p>a</p>b<ul><li>c</ul>&bdquo;d&copy;<table>e"))) == ["x", "ab", "c„d©", "e"]
    assert value(X.article_lines(lit("<b>x</b><p>a</p>b<p>YouTube</p><p>&bdquo;d<table>e<svg><p>no</svg><!-- c --><p>Установить<p>z"))) == ["x", "ab", "&bdquo;de", "z"]
    assert value(X.xml_element(lit("<t>a &amp;amp; &laquo;b&#33;&#x21;</t>"), "t")) == "a &amp; &laquo;b!&#x21;"
    assert value(X.decode_entities(lit("&#x41;&#66; &LT; &lt; &nbsp;"), "dump")) == "AB &LT; < &nbsp;" and value(X.decode_entities(lit("&LT;&nbsp;|&copy;"), "article")) == "< |&copy;"
    assert value(X.html_meta(lit("""<meta content="it's &quot;A&quot;" property="og:title">"""), "og:title")) == 'it\'s "A"'
    assert value(X.xml_element(lit("<t><![CDATA[a&b]]></t>"), "t")) == "a&b" and value(X.xml_element(lit("<t> </t>"), "t")) is None
    assert value(X.element_body(lit('x<div class="w">a<div>b</div>c</div>d'), '<div class="w">')) == "a<div>b</div>c"
    assert value(X.decode_russian(F.lit(bytearray("сторона новости".encode("cp866")))))["encoding"] == "cp866"
    assert value(X.decode_utf8_or_cp1251(F.lit(bytearray("привет".encode("cp1251"))))) == "привет" == value(X.decode_utf8_or_cp1251(F.lit(bytearray("﻿привет".encode()))))


KEY = st.text("abcde", max_size=12)


def edits(a, b):
    cost = {(i, j): i or j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            cost[i, j] = min(cost[i - 1, j] + 1, cost[i, j - 1] + 1, cost[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
    return cost[len(a), len(b)]


def alike(x, y):
    if not (x and y):
        return x == y
    within = min(len(x), len(y)) >= 4 and (x in y or y in x)
    return x == y or within or edits(x, y) <= max(2, int(0.3 * max(len(x), len(y))))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(KEY, KEY), min_size=1, max_size=30))
def test_similar_is_one_predicate(spark, pairs):
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", Z.similar(F.col("a"), F.col("b")).alias("s"), Z.close(F.col("a"), F.col("b")).alias("c"), Z.close(F.col("b"), F.col("a")).alias("d")).collect()
    for r in rows:
        assert r.s == alike(r.a, r.b) and r.c == r.d


def compared(spark, *pairs):
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a array<string>, b array<string>")
    return [r.c and r.c.asDict() for r in align.with_comparison(rows, "a", "b").orderBy("k").collect()]


def test_alignment(spark, value):
    got = compared(spark, (["nits", "beirut", "national"], ["nits", "beirut", "national"]), (["nits", "beirut"], ["beirut", "nits"]), (["nits", "beirut"], ["nits", "zzzzzzz"]), (["nits"], []), ([], []), (None, ["a"]))
    assert [x and x["kind"] for x in got] == ["agree", "order", "artists", "count", "agree", None]
    assert got[2] == {"kind": "artists", "matched": 1, "only_a": ["beirut"], "only_b": ["zzzzzzz"], "reordered": []}
    assert got[3]["only_a"] == ["nits"]
    lists = [F.array(*map(F.lit, x)) for x in (["aaaa", "bbbbbbb", "cccccc"], ["bbbbbbb", "aaaa", "cccccc"])]
    assert [tuple(p) for p in value(align.alignment(*lists))] == [(1, 0), (2, 2)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.lists(KEY, max_size=5), st.lists(KEY, max_size=5)), min_size=1, max_size=20))
def test_alignments_are_longest(spark, pairs):
    from itertools import combinations

    for (a, b), c in zip(pairs, compared(spark, *pairs)):
        most = max(n for n in range(min(len(a), len(b)) + 1) if any(all(alike(a[i], b[j]) for i, j in zip(x, y)) for x in combinations(range(len(a)), n) for y in combinations(range(len(b)), n)))
        assert c["matched"] == most and len(c["only_a"]) == len(a) - most and len(c["only_b"]) == len(b) - most
