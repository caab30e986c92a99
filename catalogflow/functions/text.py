"""String functions, all native column expressions."""

from __future__ import annotations

import functools
import json
import zlib
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_ALL = 1_000_000_000  # "to the end" for slice(); no text holds more pieces than this


def literal_pattern(text: str) -> str:
    """A Java pattern that matches ``text`` exactly, for functions that take a pattern."""
    return "".join("\\" + c if c in "\\^$.|?*+()[]{}" else c for c in text)


def strip_breaks(c: Column) -> Column:
    """Remove carriage returns, line feeds and tabs."""
    return F.translate(c, "\r\n\t", "")


def squeeze(c: Column, drop_spaces: bool = False) -> Column:
    """Remove line breaks, tabs and single quotes; collapse runs of spaces, or drop every space."""
    flat = strip_breaks(c)
    flat = F.replace(flat, F.lit(" "), F.lit("")) if drop_spaces else F.regexp_replace(flat, " {2,}", " ")
    return F.replace(flat, F.lit("'"), F.lit(""))


def drop_spaces_each(values: Column) -> Column:
    """Remove spaces from every value of an array."""
    return F.transform(values, lambda v: F.replace(v, F.lit(" "), F.lit("")))


def plain_chars(c: Column) -> Column:
    """Fraction slash becomes ``/``; no-break space and ``|`` disappear."""
    return F.translate(c, "\u2044\u00a0|", "/")


def strip_tags(c: Column) -> Column:
    """Remove every tag, shortest match; a tag never spans a line feed."""
    return F.regexp_replace(c, "(?d)<.*?>", "")


def strip_anchors(c: Column) -> Column:
    """Remove anchor elements together with their text."""
    return F.regexp_replace(c, "(?d)<a.*?a>", "")


def between(c: Column, start: str, end: str) -> Column:
    """All texts that follow ``start``, each up to the first ``end`` (or whole when ``end`` is missing)."""
    pieces = F.slice(F.split(c, literal_pattern(start)), 2, _ALL)
    return F.transform(pieces, lambda p: F.substring_index(p, end, 1))


def first_between(c: Column, start: str, end: str) -> Column:
    """The first text between the markers, or null."""
    return F.get(between(c, start, end), F.lit(0))


def cut(c: Column, separator: str, part: int = 0) -> Column:
    """The ``part``-th piece of a split; null past the last piece."""
    return F.get(F.split(c, literal_pattern(separator)), F.lit(part))


def cut_each(values: Column, separator: str, part: int = 0) -> Column:
    """:func:`cut` on every value that holds the separator; the others stay as they are."""
    return F.transform(values, lambda v: F.when(v.contains(separator), cut(v, separator, part)).otherwise(v))


def cdata(c: Column) -> Column:
    """Wrap a text as a CDATA section."""
    return F.concat(F.lit("<![CDATA["), c, F.lit("]]>"))


def cdata_each(values: Column) -> Column:
    """Wrap every value of an array as a CDATA section."""
    return F.transform(values, cdata)


def unescape_markup(c: Column) -> Column:
    """Undo the four markup escapes, ampersand first, so ``&amp;lt;`` ends as ``<``."""
    # Escape and character, in the order they are undone.
    for escape, char in (("&amp;", "&"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">")):
        c = F.replace(c, F.lit(escape), F.lit(char))
    return c


# Numbers that stand for another character or for none, by the rules of the HTML standard: 128 to 159 are read as Windows
# characters where that page has one; control characters and non-characters vanish.
_WINDOWS = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}
_NUMBERS = {0: "\ufffd", 13: "\r", **_WINDOWS}
_BEFORE_SEMICOLON = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


# Names by a hash of their text, a few in each branch, so that a look-up compares a few names and not all.
_BRANCHES = 1024


@functools.cache
def _tables() -> str:
    """The branches of names, and the numbers that stand for another character, as JSON."""
    branches: list[dict[str, str]] = [{} for _ in range(_BRANCHES)]
    for name, value in html5.items():
        branches[zlib.crc32(name.encode()) % _BRANCHES][name] = value
    return json.dumps({"names": branches, "numbers": {str(n): c for n, c in _NUMBERS.items()}})


def _let(value: str, name: str, body: str) -> str:
    """SQL in which a name stands for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


# SQL of the character with number n.
_CHARACTER = r"""CASE
    WHEN element_at(x.t.numbers, CAST(n AS STRING)) IS NOT NULL THEN element_at(x.t.numbers, CAST(n AS STRING))
    WHEN n > 1114111 OR n BETWEEN 55296 AND 57343 THEN decode(unhex('EFBFBD'), 'UTF-8')
    WHEN n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007 OR n % 65536 >= 65534 THEN ''
    ELSE decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32') END"""
_DIGITS = r"CASE WHEN length(d) > 7 THEN 1114112L ELSE CAST(conv(d, %d, 10) AS BIGINT) END"
_VALUE = "CASE WHEN head ILIKE '#x%' THEN {} ELSE {} END".format(
    _let(r"regexp_extract(head, r'^..0*([0-9a-fA-F]+)', 1)", "d", _DIGITS % 16), _let(r"regexp_extract(head, r'^#0*([0-9]+)', 1)", "d", _DIGITS % 10))
_NAMED = f"element_at(x.t.names[CAST(crc32(CAST({{0}} AS BINARY)) % {_BRANCHES} AS INT)], {{0}})"
_REST = "substring(p, length({0}) + 1)"
_SHORT = "CASE WHEN short <> '' THEN concat({}, {}) ELSE concat('&', p) END".format(_NAMED.format("short"), _REST.format("short"))
_NAME = "CASE WHEN known IS NOT NULL THEN concat(known, {}) ELSE {} END".format(
    _REST.format("head"), _let("regexp_extract(head, r'^(?:%s)', 0)" % "|".join(_BEFORE_SEMICOLON), "short", _SHORT))
# SQL of a text p that follows an ampersand, with its leading reference decoded.
_REFERENCE = "CASE WHEN startswith(p, '#') THEN {} ELSE {} END".format(
    _let(r"regexp_extract(p, r'^#(?:[0-9]+|[xX][0-9a-fA-F]+);?', 0)", "head",
         "CASE WHEN head = '' THEN concat('&', p) ELSE concat({}, {}) END".format(_let(_VALUE, "n", _CHARACTER), _REST.format("head"))),
    _let(r"regexp_extract(p, r'^[^\t\n\f <&#;]{1,32};?', 0)", "head", _let(_NAMED.format("head"), "known", _NAME)))
_ONCE = "array_join(transform(split({0}, '&', -1), (p, i) -> CASE WHEN i = 0 THEN p ELSE %s END), '')" % _REFERENCE
_TWICE = "x -> " + _let(_ONCE.replace("{0}", "x.c"), "once", "CASE WHEN once <> x.c AND contains(once, '&') THEN {} ELSE once END".format(
    _ONCE.replace("{0}", "once")))


def decode_entities(c: Column) -> Column:
    """Decode every HTML entity, twice: each text after an ampersand may begin with a number or a name, with or without ``;``.

    The second time only texts that the first has changed are looked at.
    """
    tables = F.from_json(F.lit(_tables()), "names array<map<string,string>>, numbers map<string,string>")
    named = F.array(F.struct(c.alias("c"), tables.alias("t")))
    return F.when(c.contains("&"), F.get(F.call_function("transform", named, F.expr(_TWICE)), F.lit(0))).otherwise(c)


def chunks(c: Column, size: int = 2000) -> Column:
    """Consecutive pieces of ``size`` characters, none lost; an empty text gives one empty piece."""
    pieces = F.regexp_extract_all(c, F.lit("(?s).{1,%d}" % size), F.lit(0))
    return F.when(c == "", F.array(F.lit(""))).otherwise(pieces)


def fixed_chunks(c: Column, count: int, size: int = 2000) -> Column:
    """Exactly ``count`` pieces: all but the last hold ``size`` characters, the last takes the rest."""
    heads = [F.substring(c, i * size + 1, size) for i in range(count - 1)]
    return F.array(*heads, F.substring(c, F.lit((count - 1) * size + 1), F.length(c)))


def truncate(c: Column, size: int = 2000) -> Column:
    """The first ``size`` characters."""
    return F.left(c, F.lit(size))


def has_marker(c: Column, marker: str) -> Column:
    """``True`` / ``False`` as text, by presence of a marker."""
    return F.when(c.contains(marker), "True").otherwise("False")
