"""Rows for the queries on names: every part takes a name from a fixed list, so that whole tables run through operators whose inputs they lack.

``of`` builds the column, ``sql`` the same value for the SQL of a query.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ARTISTS = [
    "The Nits", "Звуки Му", "Zvuki Mu", "Мооn Safari", "Воплi Вiдоплясова", "Deadушки", "A Band & B Choir", "Janis Joplin / Big Brother & The Holding Company",
    "Big Brother & The Holding Company & Janis Joplin", "Beirut ft. Kocani", "Beirut feat. Kocani, Someone", "Sigur Rós", "SIGUR ROS", "The Walkers", "The Frank & Walters", "Nits vs. Them; Others",
    "Kimmo Pohjonen with Kronos Quartet", "Los Amigos y Amigas", "Cat + Dog", "Кино и Аквариум", "2ва Самолёта", "the   Don`t Band", "Ёлка", "", "Щука", "Xaver", "Björk", "Хвост и АукцЫон", "Khan", "Beirut",
]
TITLES = [
    "Song", "The Song", "Song (Live)", "Song [Remastered 2009]", "Song - Remastered Version", "Song, pt II", "Song part 2", "Song Part Two", "Song pt. IV", "Kriminal Tango", "Kriminaltango",
    "Черные Цветы / Chernye Cvety", "Sugar Baby / Kriminaltango", "Звёзды всегда хороши", "Звёзды всегда хороши, особенно ночью", "Zvezdy vsegda horoshi", "(Rope) Away", "Away", "Intro", "Track 7", "In Flux", "inFLUX",
    "Nouse Luonto - Lauluja Monimuotoisuudesta", "Nouse luonto", "007 Blues", "Seven Blues", "7 Blues", "The House of the Rising Sun", "House of the Rising Sun", "House of Rising Son", "Untitled", "xi", "Été", "",
]
LABELS = [
    "Mute", "Mute Records", "[PIAS]", "pias", "PIAS Recordings", "Sub Pop Ltd.", "«Мелодия»", "лейбл  Снегири", "label Ninja Tune", "self-released", "Self Released", "no label", "Not On Label (X)", "?", "-", "...", "",
    "CD-R", "Самиздат", "без лейбла", "BMG/Mute", "4AD, Inc", "Domino Recording Company", "Mute (2)", "Warp*", "independent", "artist's own release", "Ã\u0081rstíðir", "“Quoted”", "demo",
]


def of(cases: list[str], at: Column) -> Column:
    """The case at a place, counted round."""
    return F.element_at(F.array(*map(F.lit, cases)), (F.pmod(at, F.lit(len(cases))) + 1).cast("int"))


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql(cases: list[str], at: str) -> str:
    return f"([{', '.join(map(literal, cases))}])[({at}) % {len(cases)} + 1]"


# ---- the rules of names, as SQL: written from what the rules say, not from the operators

_CYRILLIC = "абвгдеёжзийклмнопрстуфхцчшщъыьэюяіїєґў"
_SPELLED = "a b v g d e e zh z i y k l m n o p r s t u f kh ts ch sh shch _ y _ e yu ya i yi ye g u".replace("_", "").split(" ")
_SHORT = "a b v g d e e zh z i i k l m n o p r s t u f h c ch sh sch _ y _ e yu ya i i e ґ u".replace("_", "").split(" ")
_TO_LATIN = ("аеорсухіјѕгпАВЕКМНОРСТХІЈЅ", "aeopcyxijsrnABEKMHOPCTXIJS")
_TO_CYRILLIC = ("aeopcyxiïABEKMHOPCTXIÏ", "аеорсухіїАВЕКМНОРСТХІЇ")


def spelled(x: str, table: list[str]) -> str:
    for letter, latin in zip(_CYRILLIC, table, strict=True):
        x = f"replace({x}, '{letter}', '{latin}')"
    return x


def unmixed(x: str) -> str:
    """Words of the cases stand between spaces."""
    return (
        rf"array_to_string(list_transform(string_split({x}, ' '), lambda w: CASE WHEN NOT regexp_matches(w, '\p{{Cyrillic}}') OR NOT regexp_matches(w, '\p{{Latin}}') THEN w"
        rf" WHEN NOT regexp_matches(translate(w, '{_TO_LATIN[0]}', ''), '\p{{Cyrillic}}') THEN translate(w, '{_TO_LATIN[0]}', '{_TO_LATIN[1]}')"
        rf" WHEN NOT regexp_matches(translate(w, '{_TO_CYRILLIC[0]}', ''), '\p{{Latin}}') THEN translate(w, '{_TO_CYRILLIC[0]}', '{_TO_CYRILLIC[1]}') ELSE w END), ' ')"
    )


def plain(x: str) -> str:
    t = f"strip_accents({spelled(f'lower({unmixed(x)})', _SPELLED)})"
    t = rf"regexp_replace(regexp_replace({t}, '\s[(\[].*$', ''), '\s[-–—]\s.*\b(remaster(ed)?|version|mix|edit|mono|stereo|live)\b.*$', '')"
    return rf"trim(regexp_replace(replace({t}, '&', ' and '), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def bare(x: str) -> str:
    return rf"regexp_replace({plain(x)}, '^the\s+', '')"


def main_credit(x: str) -> str:
    return rf"trim(regexp_split_to_array({x}, '(?i)\s+(?:ft\.?|feat\.?|featuring)\s+')[1])"


def credited(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '(?i)\s+(?:ft\.?|feat\.?|featuring|with|vs\.?|and|&|и|y|\+)\s+|\s*[/,;]\s*'), lambda n: trim(n) <> '')"


def name_keys(x: str) -> str:
    return f"list_filter(list_transform({credited(main_credit(x))}, lambda c: {bare('c')}), lambda c: c <> '')"


def squash(x: str) -> str:
    return f"replace({x}, ' ', '')"


_NUMBERS = ["i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii"], ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve"]


def number_of(w: str) -> str:
    lists = [f"list_position([{', '.join(map(literal, words))}], {w})" for words in _NUMBERS]
    return rf"CASE WHEN regexp_matches({w}, '^\d+$') THEN {w}::HUGEINT::VARCHAR ELSE coalesce({lists[0]}, {lists[1]})::VARCHAR END"


def numbers(x: str) -> str:
    return f"array_to_string(list_sort(list_filter(list_transform(string_split({x}, ' '), lambda w: {number_of('w')}), lambda n: n IS NOT NULL)), ',')"


def counted(x: str) -> str:
    return rf"array_to_string(list_transform(string_split(regexp_replace({x}, '^the\s+', ''), ' '), lambda w: CASE WHEN w = 'pt' THEN 'part' ELSE coalesce({number_of('w')}, w) END), ' ')"


def close(a: str, b: str, ratio: str = "0.2") -> str:
    most = f"floor({ratio}::DOUBLE * greatest(length({a}), length({b})))"
    return f"({a} = {b} OR (least(length({a}), length({b})) >= 5 AND abs(length({a}) - length({b})) <= {most} AND levenshtein({a}, {b}) <= {most}))"


def forms(x: str) -> str:
    halves = rf"regexp_split_to_array({x}, '\s+/\s+')"
    one, two = plain(f"{halves}[1]"), plain(f"coalesce({halves}[2], '')")
    cut = plain(rf"regexp_replace({x}, '\s*[(\[][^)\]]*[)\]]\s*', ' ', 'g')")
    return f"list_filter(list_concat([{plain(x)}, {cut}], CASE WHEN len({halves}) = 2 AND {close(one, two, '0.3')} THEN [{one}, {two}] ELSE [] END), lambda f: f <> '')"


def norm(x: str) -> str:
    t = spelled(f"strip_accents(lower({x}))", _SHORT)
    return rf"regexp_replace(regexp_replace(regexp_replace(replace({t}, '&', 'and'), '^the\s+', ''), '\b(kh|x)', 'h', 'g'), '[^a-z0-9]', '', 'g')"


def artist_key(x: str) -> str:
    # й keeps its letter and loses its mark, as ё does
    t = rf"regexp_replace(replace(replace(lower(strip_accents({x})), 'ё', 'е'), 'й', 'и'), '^the\s+', '')"
    return rf"regexp_replace(regexp_replace({t}, '\s+(and|и)\s+', '&', 'g'), '[^\p{{L}}\p{{N}}&]', '', 'g')"
