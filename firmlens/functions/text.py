"""Text shaping: sanitising, snippets, chunks and headlines, as column expressions."""

from __future__ import annotations

import html
import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as whitespace at the ends of a text.
_WHITESPACE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
               "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def strip(col: Column) -> Column:
    """Whitespace off both ends, any kind."""
    return F.btrim(col, F.lit(_WHITESPACE))


def is_blank(col: Column) -> Column:
    return ~col.rlike(r"(?U)[^\s\x1c-\x1f]")


def lines(col: Column) -> Column:
    """Stripped lines of a text."""
    return F.transform(F.split(col, _LINE_END), strip)


# Every character reference, as HTML 5 reads it in running text.
_REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Numbers that stand for another character than their own, by the standard library's reading.
_RENUMBERED = {n: html.unescape(f"&#{n};") for n in (0, 13, *range(0x80, 0xA0))}
# Names in everyday feeds, tried before the whole table.
_EVERYDAY = ("amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;", "copy;", "middot;")


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _table(entries: dict) -> Column:
    """A constant map; folded once, not built per row."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def _numbered(ref: Column) -> Column:
    """The character of a reference by number, given from its # on."""
    digits = F.rtrim(F.substring(ref, 2, 2 ** 30), F.lit(";"))
    is_hex = F.lower(F.substring(digits, 1, 1)) == "x"
    short = F.ltrim(F.when(is_hex, F.substring(digits, 2, 2 ** 30)).otherwise(digits), F.lit("0"))
    # Ten digits, of either base, are past every character.
    padded = F.concat(F.lit("0"), short)
    number = F.when(F.length(short) > 9, F.lit(2 ** 31)).otherwise(
        F.when(is_hex, F.conv(padded, 16, 10)).otherwise(padded).cast("bigint"))

    def character(n: Column) -> Column:
        nothing = (n.between(1, 8) | (n == 0xB) | n.between(0xE, 0x1F) | (n == 0x7F)
                   | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
        own = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        other = F.try_element_at(_table({str(k): v for k, v in _RENUMBERED.items()}),
                                 n.cast("string"))
        return (F.when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("\ufffd"))
                .when(n.isin(*_RENUMBERED), other).when(nothing, F.lit("")).otherwise(own))

    return _let(number, character)


def _named(ref: Column) -> Column:
    """The characters of a reference by name; of a name that is none, those of the longest old name
    (written without a semicolon) that it begins with."""
    old = _table({k: v for k, v in html5.items() if not k.endswith(";")})
    known = F.coalesce(
        *[F.when(ref == name, F.lit(html5[name])) for name in _EVERYDAY],
        F.try_element_at(_table(html5), ref))
    heads = F.filter(F.sequence(F.length(ref) - 1, F.lit(1), F.lit(-1)),
                     lambda k: F.map_contains_key(old, F.left(ref, k)))
    longest = _let(F.get(heads, F.lit(0)), lambda k: F.concat(
        F.try_element_at(old, F.left(ref, k)), F.substring(ref, k + 1, F.length(ref))))
    return F.coalesce(known, F.when(F.length(ref) > 2, longest), F.concat(F.lit("&"), ref))


def decode_entities(col: Column) -> Column:
    """HTML character references to characters, each once, as the standard library's `unescape` does;
    in the JVM, and only in texts that have an ampersand."""
    found = F.transform(F.regexp_extract_all(col, F.lit(_REFERENCE), F.lit(1)), lambda r: F.when(
        r.startswith("#"), _numbered(r)).otherwise(_named(r)))

    def joined(gaps: Column) -> Column:
        rest = F.zip_with(found, F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(0))),
                          lambda character, gap: F.concat(character, gap))
        return F.concat(F.get(gaps, F.lit(0)), F.array_join(rest, ""))

    return F.when(F.contains(col, F.lit("&")), _let(F.split(col, _REFERENCE, -1), joined)) \
        .otherwise(col)


def sanitise(col: Column) -> Column:
    """Decode entities, then tags to a blank, control characters out, blanks and blank lines
    squeezed, ends trimmed. Decoding comes first: an escaped tag is a tag."""
    text = decode_entities(F.coalesce(col, F.lit("")))
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    text = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    text = F.regexp_replace(text, r"[ \t]{2,}", " ")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return strip(text)


def shorten(col: Column, n: int | Column) -> Column:
    """Cut to `n` characters, back to the last sentence end if that lies past the middle."""
    n = F.lit(n) if isinstance(n, int) else n
    cut = F.substring(col, F.lit(1), n)
    tail = F.locate(" .", F.reverse(cut))  # distance of the last ". " from the end
    at_sentence = F.when((tail > 0) & (n - tail - 1 > F.floor(n / 2)),
                         F.substring(cut, F.lit(1), n - tail)).otherwise(cut)
    return F.when(F.length(col) > n, F.concat(at_sentence, F.lit(" …"))).otherwise(col)


def _slices(text: Column, size: int, stride: int) -> Column:
    """Substrings of `size` starting every `stride` characters; none for an empty text."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(stride))
    return F.when(F.length(text) > 0,
                  F.transform(starts, lambda s: F.substring(text, s, F.lit(size)))
                  ).otherwise(F.array().cast("array<string>"))


def fixed_chunks(col: Column, size: int = 3000, max_chunks: int = 5) -> Column:
    """Consecutive slices of the first size*max_chunks characters, blank ones dropped, the
    first one kept if all are blank."""
    head = F.substring(col, 1, size * max_chunks)
    kept = F.filter(_slices(head, size, size), lambda c: ~is_blank(c))
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.substring(col, 1, size)))


def paragraph_chunks(col: Column, size: int = 3000, max_chunks: int = 5,
                     overlap: int = 200) -> Column:
    """Paragraphs packed into chunks; each new chunk repeats the previous chunk's last
    paragraph, and a chunk that still is too long is sliced with `overlap`.

    One fold over the paragraphs. The state holds the closed chunks, the open chunk, its last
    paragraph and its counted length: each paragraph counts two for its separator, the
    repeated one does not.
    """
    head = F.substring(col, 1, size * max_chunks + overlap)
    none = F.lit(None).cast("string")
    state = F.struct(F.array().cast("array<string>").alias("closed"), none.alias("open"),
                     none.alias("last"), F.lit(0).alias("used"))

    def step(s: Column, para: Column) -> Column:
        full = F.size(s["closed"]) >= max_chunks
        spill = s["open"].isNotNull() & (s["used"] + F.length(para) + 2 > size)
        closed = F.when(spill, F.concat(s["closed"], F.array(s["open"]))).otherwise(s["closed"])
        base = F.when(spill, s["last"]).otherwise(s["open"])
        used = F.when(spill, F.length(s["last"])).otherwise(s["used"])
        packed = F.struct(closed.alias("closed"), F.concat_ws("\n\n", base, para).alias("open"),
                          para.alias("last"), (used + F.length(para) + 2).alias("used"))
        return F.when(full, s).otherwise(packed)

    def close(s: Column) -> Column:
        room = F.size(s["closed"]) < max_chunks
        return F.when(room & s["open"].isNotNull(),
                      F.concat(s["closed"], F.array(s["open"]))).otherwise(s["closed"])

    packed = F.aggregate(F.split(head, "\n\n"), state, step, close)
    sliced = F.transform(packed, lambda c: F.when(F.length(c) <= size, F.array(c))
                         .otherwise(_slices(c, size, size - overlap)))
    chunks = F.slice(F.flatten(sliced), 1, max_chunks)
    return F.when(F.length(col) > 0, chunks).otherwise(F.array().cast("array<string>"))


def headline_lines(context: Column) -> Column:
    """Every line that opens an item or a source block."""
    opening = F.filter(lines(context), lambda x: x.startswith("[") | x.startswith("==="))
    return F.array_join(opening, "\n")


def first_headlines(sections: Column) -> Column:
    """The first item line of each section."""
    firsts = F.transform(sections, lambda s: F.try_element_at(
        F.filter(lines(s), lambda x: x.startswith("[")), F.lit(1)))
    return F.array_join(F.filter(firsts, lambda x: x.isNotNull()), "\n")
