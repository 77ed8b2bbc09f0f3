"""HTML character references decoded on the JVM, as Python's ``html.unescape`` does.

A text is split at ``&``; each part after the first starts with what may be a reference.  A name is looked up whole, then by the
longest old name (those that need no semicolon) it starts with; a number becomes its character.  The names come from Python's table
of HTML 5, so the two cannot drift apart.
"""

from __future__ import annotations

import html
import json
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What may follow the "&" of a reference.
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Old names, longest first: they are references also without a semicolon, and at the start of a longer word.
OLD = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
OLD_PATTERN = "^(" + "|".join(map(re.escape, OLD)) + ")"
#: Looked up first: a map is searched from its beginning, and these are nearly all that texts hold.
COMMON = ("amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;")
#: Numbers up to here follow no rule (the legacy code page, control characters).
_LISTED = 160


def _names() -> Column:
    """The table of names as one literal, folded once when the query is planned."""
    return F.from_json(F.lit(json.dumps({**{n: html5[n] for n in COMMON}, **html5})), "map<string,string>")


def _numbers() -> Column:
    return F.from_json(F.lit(json.dumps({str(n): html.unescape(f"&#{n};") for n in range(_LISTED)})), "map<string,string>")


def _character(n: Column) -> Column:
    """The character of a code point (a long); nothing for those that are no characters, U+FFFD for those out of range."""
    none = ((n >= 0xFDD0) & (n <= 0xFDEF)) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    utf16 = F.when(n < 0x10000, F.lpad(F.hex(n), 4, "0")).otherwise(
        F.concat(F.hex(F.lit(0xD800) + F.shiftright(n - 0x10000, 10)), F.hex(F.lit(0xDC00) + (n - 0x10000).bitwiseAND(F.lit(0x3FF)))))
    return (F.when(n.isNull() | (n > 0x10FFFF) | ((n >= 0xD800) & (n <= 0xDFFF)), F.lit("�"))
            .when(n < _LISTED, F.element_at(_numbers(), n.cast("string")))
            .when(none, F.lit(""))
            .otherwise(F.decode(F.unhex(utf16), "UTF-16BE")))


def _decoded(part: Column) -> Column:
    """A part of the text after "&", with its reference replaced."""
    ref = F.regexp_extract(part, REFERENCE, 1)
    rest = F.substr(part, F.length(ref) + 1)
    digits = F.regexp_extract(ref, "^#([0-9]+)", 1)
    hexes = F.regexp_extract(ref, "^#[xX]([0-9a-fA-F]+)", 1)
    # Leading zeros aside, more digits than these lie beyond all characters: null.
    short = lambda x, n: F.when(F.length(F.ltrim(x, F.lit("0"))) <= n, x)
    number = F.when(digits != "", short(digits, 9).cast("bigint")).otherwise(F.conv(short(hexes, 8), 16, 10).cast("bigint"))
    whole = F.element_at(_names(), ref)
    old = F.regexp_extract(ref, OLD_PATTERN, 1)
    return (F.when(ref.startswith("#"), F.concat(_character(number), rest))
            .when(whole.isNotNull(), F.concat(whole, rest))
            .when(old != "", F.concat(F.element_at(_names(), old), F.substr(part, F.length(old) + 1)))
            .otherwise(F.concat(F.lit("&"), part)))


def unescape(c: Column) -> Column:
    """``html.unescape`` of a string column."""
    parts = F.split(c, "&", -1)
    decoded = F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), _decoded), "")
    return F.when(c.contains("&"), F.concat(parts[0], decoded)).otherwise(c)
