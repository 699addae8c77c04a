"""Markup to text.

`strip_html` is a chain of built-in expressions and stays in the JVM. It puts a space where a tag was;
runs of spaces are left to `normalize_whitespace`, which always follows.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.basics import bind
from tidewire.functions.text import strip

# Elements whose text is not part of the visible text.
HIDDEN_ELEMENTS = ("script", "style", "template", "rt", "rp")

_HIDDEN = "|".join(rf"<{e}\b[^>]*+>.*?(?:</{e}\s*+>|\z)" for e in HIDDEN_ELEMENTS)
_DROPPED = rf"(?is)<!--.*?-->|{_HIDDEN}"
# A tag may hold '>' inside quotes; possessive quantifiers keep the match linear and off the stack.
# The second form takes tags with an unbalanced quote.
_TAG = r"""<[!/?a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|<[!/?a-zA-Z][^>]*+>"""
_REFERENCE = r"\A(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*)(;?)"

_KEY_END, _ENTRY_END = "\x01", "\x02"
_NAMED = _ENTRY_END.join(
    name[:-1] + _KEY_END + char for name, char in html5.items() if name.endswith(";")
)
# Numeric references 128-159 mean the Windows code page, not the control characters.
_C1 = [i for i in range(128, 160) if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_C1_FROM = "".join(map(chr, _C1))
_C1_TO = bytes(_C1).decode("cp1252")


def _code_point(code: Column) -> Column:
    """The character of a code point; invalid ones become U+FFFD."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    safe = F.when(valid, code).otherwise(F.lit(0xFFFD)).cast("bigint")
    char = F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")
    return F.translate(char, _C1_FROM, _C1_TO)


def _decode_reference(piece: Column) -> Column:
    """`piece` is what follows an ampersand."""
    name = F.regexp_extract(piece, _REFERENCE, 1)
    rest = F.substring(piece, F.length(F.regexp_extract(piece, _REFERENCE, 0)) + 1, F.length(piece))
    named = F.try_element_at(
        F.str_to_map(F.lit(_NAMED), F.lit(_ENTRY_END), F.lit(_KEY_END)), name
    )
    hexadecimal = F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10)
    code = F.when(name.rlike("^#[xX]"), hexadecimal).otherwise(
        F.substring(name, F.lit(2), F.length(name))
    ).try_cast("bigint")
    char = (
        F.when(name == "amp", F.lit("&"))
        .when(name == "quot", F.lit('"'))
        .when(name == "lt", F.lit("<"))
        .when(name == "gt", F.lit(">"))
        .when(name == "nbsp", F.lit(" "))
        .when(name.startswith("#"), _code_point(code))
        .otherwise(F.coalesce(named, F.concat(F.lit("&"), name)))
    )
    return F.when(name == "", F.concat(F.lit("&"), piece)).otherwise(F.concat(char, rest))


def decode_entities(text: Column) -> Column:
    """Character references to characters, each decoded once (`&amp;lt;` gives `&lt;`)."""
    def decoded(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, 2, F.size(parts)), _decode_reference)
        return F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))

    return bind(
        text,
        lambda t: F.when(F.contains(t, F.lit("&")), bind(F.split(t, "&", -1), decoded)).otherwise(t),
    )


def strip_html(text: Column) -> Column:
    visible = F.regexp_replace(F.coalesce(text, F.lit("")), _DROPPED, " ")
    return strip(decode_entities(F.regexp_replace(visible, _TAG, " ")))
