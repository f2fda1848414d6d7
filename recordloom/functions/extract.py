"""Reading records out of text: HTML lines, entities, dates, numbered lists, sections, playlist entries."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textkeys import SPACE, text_of

# The named entities that XML has, that articles have and that pages have; all others stay as they are.
XML_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
ARTICLE_ENTITIES = XML_ENTITIES | {"nbsp": " ", "laquo": "«", "raquo": "»", "mdash": "—", "ndash": "–", "hellip": "…", "rsquo": "’", "lsquo": "‘", "rdquo": "”", "ldquo": "“"}
PAGE_ENTITIES = ARTICLE_ENTITIES | {"bdquo": "„", "copy": "©"}
# Lines that a site puts into every article.
PROMO = (
    "SoundCloud", "YouTube", "Установите Мобильное приложение Радио Свобода", "Установить", "Читайте Свободу в Телеграме", "Войти", "Подпишитесь на Свободу в Google новостях", "Подписаться",
)
# Russian month names in the genitive, January first.
MONTHS = "января февраля марта апреля мая июня июля августа сентября октября ноября декабря".split()
# How a numbered line begins, and what tells an entry from a note.
NUMBERED = r"\A(\d{1,2})(?:\s*[.)]\s*|\s+)(?=\S)"
ENTRY = r"""(?iu)(?<![A-Za-z0-9_])cd(?![A-Za-z0-9_])|["'«]"""
EMAIL = r"[A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def found(c: Column | str, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null, not '', without one."""
    c = _col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def clean(c: Column | str) -> Column:
    """Without zero-width characters, single-spaced and trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(_col(c), r"[\u200B\uFEFF]", ""), rf"{SPACE}+", " "))


_REFERENCE = re.compile(r"&(?:#[xX]([0-9a-fA-F]+)|#([0-9]+)|([A-Za-z]+));")


def _decoder(names: dict[str, str], hexadecimal: bool = True, small: bool = True):
    """An Arrow function that decodes references: decimal ones, hexadecimal ones, and the named ones (in small letters, or in any)."""

    def one(m: re.Match) -> str:
        if m[3]:
            return names.get(m[3].lower() if small else m[3], m[0])
        if m[1] and not hexadecimal:
            return m[0]
        code = int(m[1], 16) if m[1] else int(m[2])
        return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else m[0]

    @F.arrow_udf(T.StringType())
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else _REFERENCE.sub(one, v) for v in values.to_pylist()], pa.string())

    return run


#: Of a feed's elements: five names and decimal references. Of dumps: hexadecimal ones too. Of articles and pages: more names, in any case.
_DECODERS = {"feed": _decoder(XML_ENTITIES, False, False), "dump": _decoder(XML_ENTITIES, True, False), "article": _decoder(ARTICLE_ENTITIES), "page": _decoder(PAGE_ENTITIES)}


def decode_entities(c: Column | str, kind: str = "page") -> Column:
    """The references that a ``kind`` of text has (feed, dump, article or page), each in one pass, so that what comes out is not read again. Values without "&" are left to Spark."""
    c = _col(c)
    return F.when(F.contains(c, F.lit("&")), _DECODERS[kind](c)).otherwise(c)


def _text_lines(c: Column, dropped: str, comments: bool, blocks: str, ends: str, kind: str) -> Column:
    c = F.regexp_replace(text_of(c), rf"(?is)<({dropped})\b.*?</\1>", "")
    if comments:
        c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    c = F.regexp_replace(F.regexp_replace(c, rf"(?i)<(?:{blocks})\b[^>]*>", "\n"), r"<[^>]+>", "")
    return F.filter(F.transform(F.split(decode_entities(c, kind), ends), clean), lambda x: x != "")


def page_lines(c: Column | str) -> Column:
    """The text lines of an episode's page: a paragraph, list item, row or break begins one. Scripts, styles and comments are dropped."""
    return _text_lines(_col(c), "script|style|noscript", True, r"br|p|div|li|h\d|tr|table", r"\r\n|\r|\n", "page")


def article_lines(c: Column | str) -> Column:
    """The text lines of an article's body: as ``page_lines``, but tables begin no line, comments are tags like others, pictures and frames are dropped, and so are the site's own lines."""
    lines = _text_lines(_col(c), "script|style|svg|noscript|iframe", False, r"br|p|div|li|h\d|tr", r"\n", "article")
    return F.filter(lines, lambda x: ~x.isin(*PROMO))


def html_meta(c: Column | str, name: str, kind: str = "page") -> Column:
    """The content of a meta element by its property or name, whichever attribute stands first; null without one."""
    either = rf"""(?:property|name)=["']{re.escape(name)}["']"""
    attributes = (rf"""(?is)<meta\s[^>]*?{either}[^>]*?content=(["'])(.*?)\1""", rf"""(?is)<meta\s[^>]*?content=(["'])(.*?)\1[^>]*?{either}""")
    return decode_entities(F.coalesce(*(found(c, a, 2) for a in attributes)), kind)


def html_title(c: Column | str) -> Column:
    return decode_entities(F.trim(found(c, r"(?is)<title[^>]*>(.*?)</title>")))


@F.arrow_udf(T.StringType())
def _balanced(pages: pa.Array, opening: pa.Array) -> pa.Array:
    out = []
    for page, mark in zip(pages.to_pylist(), opening.to_pylist(), strict=True):
        start = -1 if page is None else page.find(mark)
        body = None
        if start >= 0:
            depth, begin = 1, start + len(mark)
            tag = re.match(r"<(\w+)", mark)[1]
            for m in re.finditer(rf"<(/?){tag}\b", page[begin:]):
                depth += -1 if m[1] else 1
                if not depth:
                    body = page[begin : begin + m.start()]
                    break
            else:
                body = page[begin:]
        out.append(body)
    return pa.array(out, pa.string())


def element_body(page: Column | str, opening: str) -> Column:
    """What stands in the first element that begins with ``opening``, elements of its kind within it balanced; null without one."""
    return _balanced(_col(page), F.lit(opening))


def xml_element(c: Column | str, tag: str) -> Column:
    """The text of an XML fragment's first such element, CDATA unwrapped, entities decoded; null if empty."""
    inner = found(c, rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>")
    raw = found(inner, r"(?s)\A\s*<!\[CDATA\[(.*?)\]\]>\s*\z")
    return F.nullif(F.trim(F.coalesce(raw, decode_entities(inner, "feed"))), F.lit(""))


def iso_date(c: Column | str, first: int = 1997, last: int = 2013) -> Column:
    """The date in "21.10.2002", "04/03/2012" or "2009.01.25", or "4 марта 2012", between the years; else null."""
    c = _col(c)
    by_day = F.concat_ws("-", found(c, r"(\d{1,2})[./](\d{1,2})[./](\d{4})", 3), F.lpad(found(c, r"(\d{1,2})[./](\d{1,2})[./](\d{4})", 2), 2, "0"), F.lpad(found(c, r"(\d{1,2})[./](\d{1,2})[./](\d{4})"), 2, "0"))
    by_year = F.regexp_replace(found(c, r"(\d{4}\.\d{2}\.\d{2})"), r"\.", "-")
    named = rf"(?iu)(\d{{1,2}})\s+({'|'.join(MONTHS)})\s+(\d{{4}})"
    month = F.array_position(F.array(*(F.lit(m) for m in MONTHS)), F.lower(found(c, named, 2)))
    in_words = F.concat_ws("-", found(c, named, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(found(c, named, 1), 2, "0"))
    text = F.coalesce(*(F.when(x.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), x) for x in (by_day, by_year, in_words)))
    day = F.try_to_date(text, "yyyy-MM-dd")
    return F.when(F.year(day).between(first, last), day)


def duration_seconds(c: Column | str) -> Column:
    """SS, MM:SS or HH:MM:SS in seconds; null for anything else."""
    c = F.trim(_col(c))
    parts = F.transform(F.split(c, ":"), lambda x: x.try_cast("long"))
    return F.when(c.rlike(r"\A\d+(?::\d+){0,2}\z"), F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a * 60 + x))


def rfc822_date(c: Column | str) -> Column:
    """A feed's "Mon, 02 Jan 2006 15:04:05 +0300" as a timestamp; null if it is none."""
    bare = F.trim(F.regexp_replace(_col(c), r"\A\s*[A-Za-z]{3},\s*", ""))
    zoned = F.regexp_replace(bare, r"(?:GMT|UTC|UT|Z)\z", "+0000")
    return F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm:ss xx"))


def episode_number(title: Column | str) -> Column:
    return found(title, r"#\s?(\d+)").cast("int")


def header_number(c: Column | str) -> Column:
    """The number in "выпуск 141", "#356", "№ 200" or "307-го выпуска", whichever comes first."""
    c, either = _col(c), r"(?iu)(?:выпуск\S*|#|№)\s*(\d+)|(\d+)(?:\s*-?\s*(?:го|й|ый|ой))?\s+выпуск"
    return F.coalesce(F.nullif(found(c, either, 1), F.lit("")), F.nullif(found(c, either, 2), F.lit(""))).cast("int")


def split_once(c: Column | str, at: str = " - ") -> Column:
    """A struct (left, right) of what stands before and after the first ``at``; right is null without one."""
    parts = F.split(_col(c), re.escape(at), 2)
    return F.struct(F.trim(F.get(parts, F.lit(0))).alias("left"), F.trim(F.get(parts, F.lit(1))).alias("right"))


def scrub_emails(c: Column | str, to: str = "") -> Column:
    return F.regexp_replace(_col(c), EMAIL, to)


def is_entry(line: Column) -> Column:
    return line.rlike(NUMBERED) & line.rlike(ENTRY)


_NUMBERED, _ENTRY, _LONE = re.compile(NUMBERED.replace(r"\z", r"\Z")), re.compile(r"""(?i)(?a:\bcd\b)|["'«]"""), re.compile(r"\d{1,2}\s*[.)]?\Z")


def _number(line: str) -> int:
    m = _NUMBERED.match(line)
    return int(m[1]) if m else 0


def _apart(line: str) -> list[str]:
    """Entries that run together, cut where a closing parenthesis is followed by the next number."""
    out, number = [], _number(line)
    while number:
        number += 1
        m = re.search(rf"\)\s*(?={number}\s*[.)]?\s*[^\s.)])", line)
        if not m:
            break
        out.append(line[: m.start() + 1].strip())
        line = line[m.end() :].strip()
    return [*out, line]


def _entry_at(lines: list[str], at: int) -> tuple[str, int]:
    """What the line says, and how many lines that takes: a number alone belongs to the entry on the next line."""
    alone = _LONE.match(lines[at]) and at + 1 < len(lines) and _ENTRY.search(lines[at + 1])
    return (f"{lines[at]} {lines[at + 1]}", 2) if alone else (lines[at], 1)


def _is_entry(line: str) -> bool:
    return bool(_number(line) and _ENTRY.search(line))


def _run_of_entries(lines: list[str]) -> dict:
    out: list[str] = []
    start, at = None, 0
    while at < len(lines):
        text, used = _entry_at(lines, at)
        behind = lines[at + used] if at + used < len(lines) else ""
        if _is_entry(text):
            start = at + used - 1 if start is None else start
            out += _apart(text)
        elif out and not (_number(out[-1]) and _is_entry(behind) and _number(behind) == _number(out[-1]) + 1):
            break
        at += used
    return {"start": start, "entries": out}


def _scattered_entries(lines: list[str]) -> list[str]:
    out: list[str] = []
    at = 0
    while at < len(lines):
        line, used = _entry_at(lines, at)
        at += used
        if _is_entry(line) and (not out or _number(line) == _number(out[-1]) + 1 or re.search(r"(?ai)\bcd\b", line)):
            out.append(line)
    return out


def _lists(f):
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else f(v) for v in values.to_pylist()], pa.list_(pa.string()))

    return run


@F.arrow_udf(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("entries", T.ArrayType(T.StringType()))]))
def entry_run(values: pa.Array) -> pa.Array:
    """From an array of lines: the first run of numbered entries, and where it starts (null: nowhere); a note is passed over if the line behind it goes on with the next number."""
    found = [None if v is None else _run_of_entries(v) for v in values.to_pylist()]
    return pa.array(found, pa.struct([("start", pa.int32()), ("entries", pa.list_(pa.string()))]))


def entries_in(lines: Column | str) -> Column:
    return entry_run(_col(lines))["entries"]


#: From an array of lines: every entry with the next number, or one that names a CD, whatever stands between.
entries_among = _lists(_scattered_entries)
#: From a one-line array: its entries.
split_run_together = _lists(lambda lines: [e for line in lines for e in _apart(line)])


def joined_brackets(lines: Column) -> Column:
    """An array of lines, those joined to the one before while "[" are open."""
    count = lambda x, mark: F.length(x) - F.length(F.replace(x, F.lit(mark), F.lit("")))
    none = F.array().cast("array<string>")

    def step(done: Column, line: Column) -> Column:
        last = F.element_at(done, -1)
        going = (F.size(done) > 0) & (count(last, "[") > count(last, "]"))
        return F.when(going, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.concat(last, line)))).otherwise(F.concat(done, F.array(line)))

    return F.aggregate(lines, none, lambda done, line: F.when(F.size(done) == 0, F.array(line)).otherwise(step(done, line)))


def parts_of(entry: Column | str) -> Column:
    """A struct (artist, title) of a list entry: the title in double quotes or «», or in single ones if there are no others."""
    text = F.trim(F.translate(F.regexp_replace(_col(entry), NUMBERED, ""), "`’", "''"))
    marks = F.when(text.rlike('["«]'), F.lit('["«»]')).otherwise(F.lit("'"))
    cut = F.split(text, marks, 3)
    head = F.get(cut, F.lit(0))
    artist = F.trim(F.regexp_replace(F.regexp_replace(head, r"\s*\([^()]*\)\s*\z", ""), r"(?s)\s*\(.*\z", ""))
    return F.struct(F.when(artist == "", F.trim(head)).otherwise(artist).alias("artist"), F.coalesce(F.get(cut, F.lit(1)), F.lit("")).alias("title"))


def parse_entry(entry: Column | str) -> Column:
    """A struct of a playlist entry's parts by the notations in use, with how sure the reading is.

    number? artist (country)? [. or -] "title" FORMAT "album" (label): confidence 1 with a quoted title, 0.5 if the title is what stands between the
    artist and the format or the end, 0 if no title could be told apart. Unquoted titles are ambiguous; nothing is guessed beyond that.
    """
    number = found(entry, r"\A\s*(\d{1,3})").cast("int")
    text = F.trim(F.regexp_replace(F.translate(_col(entry), "“”„", '"""'), NUMBERED, ""))
    kinds = r"(?:CD|LP|EP|DVD|MC|7\"|12\"|ЦД|сингл|single|альбом|album)"
    quoted = rf"""(?u)\A([^"«(]*?)\s*(?:\(([^()]*)\))?\s*[-–—.,]?\s*["«]([^"»]*)["»]\s*(?:{kinds}\s*["«]?([^"»(]*)["»]?)?\s*(?:\(([^()]*)\))?"""
    open_ = rf"""(?u)\A([^"«(]*?)\s*(?:\(([^()]*)\)\s*[-–—.,]?|\s[-–—]|\.)\s+([^"«(]+?)(?:,?\s+{kinds}\s+([^"»(]*?))?\s*(?:\(([^()]*)\))?\s*\z"""
    sure, maybe = text.rlike(quoted), text.rlike(open_)
    part = lambda k: F.nullif(F.trim(F.when(sure, F.regexp_extract(text, quoted, k)).when(maybe, F.regexp_extract(text, open_, k))), F.lit(""))
    return F.struct(
        number.alias("number"), F.coalesce(part(1), F.when(~sure & ~maybe, text)).alias("artist"), part(2).alias("country"), part(3).alias("title"),
        part(4).alias("album"), part(5).alias("label"), F.when(sure, 1.0).when(maybe, 0.5).otherwise(0.0).alias("confidence"),
    )


# Frequent letter pairs of Russian, by which an encoding is chosen.
RUSSIAN_PAIRS = re.compile("ст|но|то|на|ен|ов|ни|ра|во|ко|ро|ли|ер|ал")


@F.arrow_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("encoding", T.StringType())]))
def decode_russian(raw: pa.Array) -> pa.Array:
    """Bytes as cp1251 or cp866, whichever reads more like Russian."""
    out = []
    for value in raw.to_pylist():
        if value is None:
            out.append(None)
            continue
        read = {name: value.decode(name, "replace") for name in ("cp1251", "cp866")}
        score = {name: len(RUSSIAN_PAIRS.findall(text)) for name, text in read.items()}
        name = "cp866" if score["cp866"] > score["cp1251"] else "cp1251"
        out.append({"text": read[name], "encoding": name})
    return pa.array(out, pa.struct([("text", pa.string()), ("encoding", pa.string())]))


@F.arrow_udf(T.StringType())
def _cp1251(raw: pa.Array) -> pa.Array:
    return pa.array([None if v is None else v.decode("cp1251", "replace") for v in raw.to_pylist()], pa.string())


def decode_utf8_or_cp1251(raw: Column | str) -> Column:
    """A whole file's bytes as UTF-8 if all of them are, else as cp1251; without a byte-order mark."""
    c = _col(raw)
    text = F.coalesce(F.try_validate_utf8(c.cast("string")), F.when(~F.is_valid_utf8(c.cast("string")), _cp1251(c)))
    return F.regexp_replace(text, r"\A\uFEFF", "")
