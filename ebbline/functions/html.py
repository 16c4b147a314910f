"""Field extraction from stored pages with built-in regular expressions."""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbline.functions.binding import let

_HIDDEN = r"(?is)<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)"

# Tags that end an open paragraph.
PARAGRAPH_ENDS = (
    "address article aside blockquote body center details div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol p pre section table td th tr ul"
).split()
_REFERENCE = "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""


def visible(html: Column) -> Column:
    """Page source without scripts, styles and comments (their strings may hold fake tags); open ones reach the end."""
    return F.regexp_replace(html, _HIDDEN, "")


def inner_text(fragment: Column) -> Column:
    """Text of a fragment: tags dropped, references decoded, white space collapsed."""
    text = decoded(F.regexp_replace(fragment, r"(?s)<[^>]*>", ""))
    return F.trim(F.regexp_replace(text, r"[\s ]+", " "))


def decoded(text: Column) -> Column:
    """Named (HTML 4) and numeric character references as characters; unknown ones stay."""
    names = F.create_map(*[F.lit(x) for n, c in sorted(name2codepoint.items()) for x in (n, c)])

    def part(piece: Column) -> Column:
        name = F.regexp_extract(piece, _REFERENCE, 1)
        number = (
            F.when(F.startswith(F.lower(name), F.lit("#x")), F.conv(F.substring(name, 3, 6), 16, 10).cast("int"))
            .when(F.startswith(name, F.lit("#")), F.substring(name, 2, 7).cast("int"))
            .otherwise(F.try_element_at(names, name))
        )
        known = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        return F.when(known, F.concat(char, F.substr(piece, F.length(name) + 2))).otherwise(F.concat(F.lit("&"), piece))

    def joined(pieces: Column) -> Column:
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), part), ""))

    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), joined(F.split(t, "&"))).otherwise(t))


def _none_if_missing(html: Column, pattern: str, group: int) -> Column:
    return F.when(html.rlike(pattern), F.regexp_extract(html, pattern, group))


def first_element(html: Column, tag: str) -> Column:
    """Text of the first ``<tag>``; NULL when the page has none."""
    return inner_text(_none_if_missing(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1))


def attribute_values(html: Column, tag: str, attribute: str) -> Column:
    """All values of one attribute, quoted either way or not at all, in page order."""
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\s(?:[^>]*?\s)?{attribute}\s*=\s*{_VALUE}"), 1)
    return F.transform(found, lambda v: decoded(F.regexp_replace(v, r"""(?s)^(["'])(.*)\1$""", "$2")))


def element_texts(html: Column, tag: str) -> Column:
    """Texts of every ``<tag>`` that holds no other of its kind, in page order.

    A paragraph also ends at the next block tag or with the page.
    """
    end = rf"(?=</?(?:{'|'.join(PARAGRAPH_ENDS)})[\s/>]|\z)" if tag == "p" else rf"</{tag}\s*>"
    return F.transform(F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?){end}"), 1), inner_text)


def whole_elements(html: Column, tag: str, attribute: str | None = None, value: str | None = None) -> Column:
    """Source of the first ``<tag>`` that is selected, with all it holds up to its own end tag; NULL without one.

    Selected by the word ``value`` in an attribute (id, class, ...), by the mere attribute, or by the
    tag alone.  Start and end tags of the same name are matched by a running depth over the page's
    pieces, so elements of the same kind inside don't end it; an open element reaches the page's end.
    """
    start, end = rf"(?is)^<{tag}(?=[\s/>])", rf"(?is)^</{tag}(?=[\s/>])"
    wanted = start
    if attribute is not None:
        word = "" if value is None else rf"""\s*=\s*(?:"(?:[^">]*\s)?{re.escape(value)}(?=[\s"])|'(?:[^'>]*\s)?{re.escape(value)}(?=[\s'])|{re.escape(value)}(?=[\s>]))"""
        wanted = rf"""(?is)^<{tag}\s(?:(?:[^>"']|"[^"]*"|'[^']*')*?\s)?{attribute}(?=[\s=>/]){word}"""
    pieces = F.split(html, rf"(?i)(?=</?{tag}[\s/>])")

    def element(pieces: Column) -> Column:
        first = F.array_position(F.transform(pieces, lambda x: x.rlike(wanted)), True)
        return F.when(first > 0, let(F.slice(pieces, F.greatest(first, F.lit(1)).cast("int"), F.size(pieces)), inside))

    def inside(pieces: Column) -> Column:
        begin = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(False).alias("done"))

        def step(seen: Column, piece: Column) -> Column:
            depth = seen["depth"] + F.when(piece.rlike(start), 1).when(piece.rlike(end), -1).otherwise(0)
            return F.when(seen["done"], seen).otherwise(
                F.struct(depth.alias("depth"), (seen["n"] + F.when(depth > 0, 1).otherwise(0)).alias("n"), (depth <= 0).alias("done"))
            )

        taken = F.aggregate(pieces, begin, step)["n"]
        return F.regexp_replace(F.array_join(F.slice(pieces, F.lit(1), taken), ""), r"""(?s)^<(?:[^>"']|"[^"]*+"|'[^']*+')*+>""", "")

    return let(pieces, element)


def selected_text(html: Column, tag: str, attribute: str | None = None, value: str | None = None) -> Column:
    """Text of the first whole element that ``whole_elements`` selects; NULL without one."""
    return let(whole_elements(html, tag, attribute, value), inner_text)


def list_entries(html: Column) -> Column:
    """(title, link) of the first link of every list item that has one, in page order.

    An item ends where it is closed, where the next item begins, or with its list.
    """
    items = F.slice(F.split(html, r"(?i)(?=<li[\s>])"), 2, 1 << 30)
    own = F.transform(items, lambda x: F.regexp_replace(x, r"(?is)</(?:li|ul|ol|menu)\s*>.*", ""))
    return F.transform(
        F.filter(own, lambda x: x.rlike(r"(?is)<a\s[^>]*>.*</a\s*>")),
        lambda x: F.struct(first_element(x, "a").alias("title"), F.get(attribute_values(x, "a", "href"), F.lit(0)).alias("link")),
    )


def script_call_arguments(html: Column, function: str, marker: str | None = None) -> Column:
    """Arguments of the first ``function(...)`` call, or of the one after the last marker word."""
    script = html
    if marker is not None:
        script = F.when(F.contains(html, F.lit(marker)), F.substring_index(html, marker, -1))
    call = F.regexp_extract(script, rf"(?s)\b{function}\((.*?)\)", 1)
    return F.split(F.translate(call, "' \t\r\n", ""), ",")


def viewer_link(html: Column, base: str, names: list[str], function: str, marker: str | None = None) -> Column:
    """Link of the page that a script opens, rebuilt from the call's arguments; NULL without them."""

    def link(args: Column) -> Column:
        pairs = [F.concat(F.lit(f"{n}="), F.get(args, F.lit(i))) for i, n in enumerate(names)]
        return F.concat(F.lit(base + "?"), *[p for pair in pairs for p in (F.lit("&"), pair)][1:])

    return let(script_call_arguments(html, function, marker), link)
