"""Visible text of HTML from built-in expressions, over the whole text.

Markup is dropped in one left-to-right pass: one pattern with an alternative per construct, so
whichever starts first wins, as in a tokenizer. A comment inside a script is script, a script
inside a comment is comment, and a construct that is never closed runs to the end of the text.
Character references are then decoded as in HTML 5: named ones with a table lookup each,
with or without the semicolon where the standard allows that, and decimal and hexadecimal ones.
"""

from __future__ import annotations

import html.entities
import json
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java regex and RE2 (DuckDB) read this pattern the same way.
MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script\b[^>]*(?:\z|>.*?(?:</script\b[^>]*(?:>|\z)|\z))"
    r"|<style\b[^>]*(?:\z|>.*?(?:</style\b[^>]*(?:>|\z)|\z))"
    r"|</?[a-z][^>]*(?:>|\z)"
    r"|<[!?/][^>]*(?:>|\z)"
)
WHITESPACE_RUN = "[ \\t\\n\\r\\f ]+"

NAMED_REFERENCE = r"^[^\t\n\f <&#;]{1,32};?"
NUMERIC_REFERENCE = r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
REPLACEMENT = "\ufffd"
TABLE_SLOTS = 4096
BYTE_ORDER_MARK = "0000FEFF"
TOO_LARGE = 0x110000


def _references() -> dict[str, str]:
    """Name -> text, as the standard library has them; '#n' -> text for the numbers that HTML reads
    differently from Unicode (windows-1252 in the C1 range, NUL, CR)."""
    known = dict(html.entities.html5)
    known["#0"], known["#13"] = REPLACEMENT, "\r"
    for n in range(0x80, 0xA0):
        try:
            known[f"#{n}"] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:  # five numbers without a windows-1252 character
            known[f"#{n}"] = chr(n)
    return known


def _table() -> Column:
    """The references as a constant array of small maps, a name's slot being its CRC: a
    lookup compares a name or two, where one map would be searched from end to end."""
    slots: list[dict[str, str]] = [{} for _ in range(TABLE_SLOTS)]
    for name, text in _references().items():
        slots[zlib.crc32(name.encode()) % TABLE_SLOTS][name] = text
    return F.from_json(F.lit(json.dumps(slots)), "array<map<string,string>>")


def _legacy_prefix() -> str:
    """Pattern of the names that need no semicolon, longest first."""
    names = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return f"^(?:{'|'.join(names)})"


def _character(number: Column) -> Column:
    code = F.unhex(F.concat(F.lit(BYTE_ORDER_MARK), F.lpad(F.hex(number), 8, "0")))
    return F.decode(code, "UTF-32")


def decode_references(text: Column) -> Column:
    """Character references of `text` decoded (once: what a reference yields is not read again)."""
    table, legacy = _table(), _legacy_prefix()

    def found(name: Column) -> Column:
        return F.try_element_at(F.get(table, (F.crc32(name) % TABLE_SLOTS).cast("int")), name)

    def number(reference: Column) -> Column:
        """The number of a decimal or hexadecimal reference, TOO_LARGE beyond Unicode."""
        base16 = F.regexp_extract(reference, "^#[xX]0*([0-9a-fA-F]*)", 1)
        base10 = F.regexp_extract(reference, "^#0*([0-9]*)", 1)
        value = F.when(reference.rlike("^#[xX]"), F.when(F.length(base16) <= 6, F.conv(F.concat(F.lit("0"), base16), 16, 10))) \
            .otherwise(F.when(F.length(base10) <= 7, F.concat(F.lit("0"), base10)))
        return F.coalesce(value.cast("bigint"), F.lit(TOO_LARGE).cast("bigint"))

    def numeric(reference: Column) -> Column:
        n = number(reference)
        surrogate = n.between(0xD800, 0xDFFF)
        no_character = (n.between(0x01, 0x08) | (n == 0x0B) | n.between(0x0E, 0x1F) | (n == 0x7F)
                        | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE))
        return F.coalesce(
            found(F.concat(F.lit("#"), n.cast("string"))),
            F.when(surrogate | (n >= TOO_LARGE), F.lit(REPLACEMENT)).when(no_character, F.lit("")).otherwise(_character(n)))

    def named(name: Column) -> Column:
        """The name's text; else that of the longest legacy name it starts with; else null. The
        legacy names are shorter than the name here, or `found` would have had them."""
        start = F.regexp_extract(name, legacy, 0)
        return F.coalesce(found(name), F.concat(found(start), F.substr(name, F.length(start) + 1)))

    def decoded(piece: Column, place: Column) -> Column:
        """A piece that follows an ampersand, its reference decoded."""
        number_ref = F.regexp_extract(piece, NUMERIC_REFERENCE, 0)
        name = F.regexp_extract(piece, NAMED_REFERENCE, 0)
        return (F.when(place == 0, piece)
                .when(number_ref != "", F.concat(numeric(number_ref), F.substr(piece, F.length(number_ref) + 1)))
                .otherwise(F.coalesce(F.concat(named(name), F.substr(piece, F.length(name) + 1)),
                                      F.concat(F.lit("&"), piece))))

    return F.array_join(F.transform(F.split(text, "&"), decoded), "")


def strip_html(source: Column) -> Column:
    """Visible text of an HTML fragment; null stays null.

    Script and style bodies, comments, declarations and tags become a blank (a `<` that starts
    none of them is text), references are decoded, whitespace runs and no-break spaces become
    one blank, and the ends are trimmed."""
    text = decode_references(F.regexp_replace(source, MARKUP, " "))
    return F.trim(F.regexp_replace(text, WHITESPACE_RUN, " "))
