"""Page fields as plain SQL, by marks and splits instead of the expressions' patterns."""

from __future__ import annotations

from html.entities import name2codepoint

from ebbline.functions.html import PARAGRAPH_ENDS

_NAMES = "map {" + ", ".join(f"'{n}': {c}" for n, c in sorted(name2codepoint.items())) + "}"
_REFERENCES = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _decoded(x: str) -> str:
    """Every reference that occurs is replaced wherever it stands, that of ``&`` last."""
    number = (
        f"CASE WHEN lower(r[2:3]) = '#x' THEN ('0x' || r[4:-2])::INTEGER WHEN r[2] = '#' THEN r[3:-2]::INTEGER ELSE {_NAMES}[r[2:-2]] END"
    )
    found = f"list_filter(list_distinct(regexp_extract_all({x}, '{_REFERENCES}')), lambda r: r <> '&amp;' AND {number} IS NOT NULL)"
    return f"replace(list_reduce(list_prepend({x}, {found}), lambda t, r: replace(t, r, chr({number}))), '&amp;', '&')"


def _inner(x: str) -> str:
    plain = f"regexp_replace({x}, '(?s)<[^>]*>', '', 'g')"
    return f"trim(regexp_replace({_decoded(plain)}, '[\\s ]+', ' ', 'g'), ' ')"


def _element(tag: str, x: str = "page") -> str:
    """What follows the first start tag, up to the end tag."""
    start = rf"(?is)<{tag}(?:\s[^>]*)?>"
    return f"CASE WHEN regexp_matches({x}, '{start}.*</{tag}\\s*>') THEN " + _inner(f"regexp_extract({x}, '{start}(.*?)</{tag}\\s*>', 1)") + " END"


def _link(tag: str) -> str:
    """The value after href in a start tag: up to its quote, white space or the end."""
    rest = f"regexp_extract({tag}, '(?is)\\shref\\s*=\\s*(.*)>', 1)"
    value = (
        f"CASE WHEN {rest}[1] = chr(34) THEN split_part({rest}, chr(34), 2) WHEN {rest}[1] = chr(39) THEN split_part({rest}, chr(39), 2) "
        f"ELSE regexp_extract({rest}, '^\\S+') END"
    )
    return _decoded(f"({value})")


def _paragraphs() -> str:
    """Block tags become marks; a paragraph runs from its own mark to the next one of any kind."""
    blocks = "|".join(PARAGRAPH_ENDS)
    own = "regexp_replace(page, '(?is)<p(?:\\s[^>]*)?>', chr(1) || chr(2), 'g')"
    marked = f"regexp_replace({own}, '(?is)</?(?:{blocks})(?:[\\s/][^>]*)?>', chr(1), 'g')"
    return f"list_transform(list_filter(string_split({marked}, chr(1)), lambda s: s[1] = chr(2)), lambda s: {_inner('s[2:]')})"


_PAGES = """(SELECT page_id, regexp_replace(html,
    '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<!--.*?-->', '', 'g') AS page FROM pages)"""

HTML_EXTRACT = f"""SELECT page_id, {_element("title")} AS title, {_element("h1")} AS headline,
    array_to_string(list_transform(list_filter(regexp_extract_all(page, '(?is)<a\\s[^>]*>'), lambda a: regexp_matches(a, '(?is)\\shref\\s*=')),
        lambda a: {_link("a")}), ' ') AS links,
    array_to_string({_paragraphs()}, chr(10)) AS body
    FROM {_PAGES}"""

ARTICLE_LIST_EXTRACT = f"""SELECT page_id, position, {_element("a", "item")} AS title, {_link("regexp_extract(item, '(?is)<a[^>]*>')")} AS link
    FROM (SELECT page_id, unnest(items) AS item, (generate_subscripts(items, 1) - 1)::INTEGER AS position FROM (
        SELECT page_id, list_filter(list_transform(string_split(regexp_replace(page, '(?is)<li(?:\\s[^>]*)?>', chr(1), 'g'), chr(1))[2:],
            lambda s: ltrim(s)), lambda s: regexp_matches(s, '(?is)^[^<]*<a\\s[^>]*>.*</a\\s*>')) AS items FROM {_PAGES}))"""

BODY_BY_SELECTOR = f"""SELECT page_id, {_element("article")} AS body, {_element("div")} AS ad FROM {_PAGES}"""
