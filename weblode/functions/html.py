"""HTML to body text and to link targets, with built-in regular expressions.

Every helper uses its argument once, so composing them never evaluates the
page twice. Quantifiers over attributes are possessive: matching stays linear
in the page and does not recurse, whatever the page holds.
"""

from __future__ import annotations

import json
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_ATTR_VALUE = r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+"""
_ATTR = r"[^\s/>][^\s/>=]*+" + _ATTR_VALUE
_ATTRS = r"(?:[\s/]++|" + _ATTR + r")*+"
_NAME_END = r"(?=[\s/>]|\z)"
_TAG_END = r"(?:>|\z)"

# Comments, scripts and style sheets in one left-to-right pass, so that "<!--"
# inside a script and "<script" inside a comment are both taken literally. The
# closing tag stays behind, because it separates words.
_INVISIBLE = (
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))"
    r"|<(script|style)" + _NAME_END + r".*?(</\1" + _NAME_END + r"|\z)"
)

# Everything before the body: up to <body>, else up to </head>, else up to the
# end of a <title> that only other head elements precede.
_HEAD_TAG = r"</?(?:html|head|base|link|meta|noscript|script|style)" + _NAME_END
_BEFORE_BODY = (
    r"(?is)\A(?:"
    r".*?<body" + _NAME_END + _ATTRS + _TAG_END + r"|"
    r".*?</head" + _NAME_END + r"[^>]*+" + _TAG_END + r"|"
    r"(?:\s++|(?:<[!?]|" + _HEAD_TAG + r")[^>]*+>)*+<title" + _NAME_END + r"[^>]*+>"
    r".*?(?:</title" + _NAME_END + r"[^>]*+" + _TAG_END + r"|\z))"
)

# Tags that separate words, as the usual HTML parsers class them.
BLOCK_TAGS = """
address article aside audio blockquote body br canvas caption center col
colgroup dd del details div dl dt fieldset figcaption figure footer form frame
frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html ins li link main math
menu meta nav noframes noscript ol p plaintext pre script section style svg
table tbody td template tfoot th thead title tr ul video
""".split()

_BLOCK = r"(?i)</?(?:" + "|".join(BLOCK_TAGS) + ")" + _NAME_END + _ATTRS + _TAG_END
_MARKUP = r"</?[a-zA-Z]" + _ATTRS + _TAG_END + r"|<[!?/][^>]*+" + _TAG_END
_SPACE = r"[ \t\n\f\r\x{A0}]+"
_ZERO_WIDTH_SPACE, _SOFT_HYPHEN = "\u200b", "\u00ad"

# Elements whose content is text only, so that an <a> in them is no link.
_TEXT_ONLY = (
    r"(?is)<(textarea|title|xmp|iframe|noembed|noframes)" + _NAME_END
    + r".*?(?:</\1" + _NAME_END + r"|\z)"
)
_ANCHOR = r"(?i)<a" + _NAME_END + _ATTRS + _TAG_END
_HREF = (
    r"(?i)\A<a(?:[\s/]++|(?!href[\s=/>])" + _ATTR + r")*+"
    r"""href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
)

_REFERENCE = r"\A(?:#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z]+[0-9]*);?"
# In an attribute, "&copy=" is a query parameter and no character reference.
_REFERENCE_IN_ATTR = (
    r"\A(?:#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z]+[0-9]*+(?:;|(?![a-zA-Z0-9=_-])));?"
)
_COMMON = ("amp;", "nbsp;", "lt;", "gt;", "quot;", "copy;", "middot;", "apos;")
_C1 = "".join(map(chr, range(0x80, 0xA0)))
_C1_AS_CP1252 = "".join(
    bytes([b]).decode("cp1252", errors="replace") for b in range(0x80, 0xA0)
)


@cache
def _entity_json() -> str:
    """Named references as JSON, frequent ones first (map lookup is a scan)."""
    names = list(_COMMON) + [n for n in html5 if n not in _COMMON]
    return json.dumps({name: html5[name] for name in names})


def _code_point(ref: Column) -> Column:
    """The character of ``#65;`` or ``#x41;``; U+FFFD if there is none."""
    digits = F.regexp_extract(ref, r"\A#[xX]?0*+([0-9a-fA-F]*)", 1)
    number = F.when(
        F.length(digits) <= 8,
        F.when(ref.rlike(r"\A#[xX]"), F.conv(digits, 16, 10)).otherwise(digits),
    ).try_cast("bigint")
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    utf32 = F.unhex(F.lpad(F.hex(number), 8, "0"))
    char = F.when(valid, F.decode(utf32, "UTF-32")).otherwise(F.lit("\ufffd"))
    return F.translate(char, _C1, _C1_AS_CP1252)


def decode_entities(text: Column, in_attribute: bool = False) -> Column:
    """Replace character references; unknown ones stay as they are."""
    pattern = _REFERENCE_IN_ATTR if in_attribute else _REFERENCE
    named = F.from_json(F.lit(_entity_json()), "map<string,string>")

    def split_reference(part: Column, index: Column) -> Column:
        ref = F.when(index > 0, F.regexp_extract(part, pattern, 0)).otherwise("")
        return F.struct(part.alias("part"), ref.alias("ref"), index.alias("index"))

    def replace_reference(piece: Column) -> Column:
        part, ref, index = piece["part"], piece["ref"], piece["index"]
        value = F.when(ref.startswith("#"), _code_point(ref)).when(
            ref != "", F.element_at(named, ref)
        )
        rest = F.substring(part, F.length(ref) + 1, F.length(part))
        return (
            F.when(index == 0, part)
            .when(value.isNull(), F.concat(F.lit("&"), part))
            .otherwise(F.concat(value, rest))
        )

    pieces = F.transform(F.split(text, "&"), split_reference)
    return F.array_join(F.transform(pieces, replace_reference), "")


def body_html(html: Column) -> Column:
    """The page from the start of its body on, without invisible content."""
    visible = F.regexp_replace(html, _INVISIBLE, "$2")
    return F.regexp_replace(visible, _BEFORE_BODY, "")


def body_text(html: Column) -> Column:
    """Visible text of the body of a page."""
    return text_of(body_html(html))


def text_of(body: Column) -> Column:
    """Text of ``body_html``: block tags separate words, inline tags do not,
    and white space collapses to single spaces."""
    text = F.regexp_replace(body, _BLOCK, " ")
    text = F.regexp_replace(text, _MARKUP, "")
    text = decode_entities(text)
    for invisible in (_ZERO_WIDTH_SPACE, _SOFT_HYPHEN):
        text = F.replace(text, F.lit(invisible), F.lit(""))
    return F.trim(F.regexp_replace(text, _SPACE, " "))


def body_links(body: Column) -> Column:
    """Array of the targets of all links of ``body_html``, in order."""
    return F.transform(_anchors(body), anchor_href)


def anchor_tags(html: Column) -> Column:
    """Array of the body's ``<a …>`` start tags, in document order. A tag that
    the page ends in does not count."""
    return _anchors(body_html(html))


def _anchors(body: Column) -> Column:
    tags = F.regexp_extract_all(F.regexp_replace(body, _TEXT_ONLY, ""), F.lit(_ANCHOR), 0)
    return F.filter(tags, lambda tag: tag.endswith(">"))


def anchor_href(tag: Column) -> Column:
    """``href`` value of an ``<a …>`` start tag; empty if it has none."""
    value = F.regexp_extract(tag, _HREF, 1)
    bare = F.regexp_replace(value, r"""(?s)\A(["'])(.*)\1\z""", "$2")
    return decode_entities(bare, in_attribute=True)
