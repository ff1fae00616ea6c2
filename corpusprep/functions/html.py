"""Headline and article text of a page: a scan for tags by one regular expression, and
a fold over what lies between article tags, both in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusprep.functions.strings import _col

# The named references that are decoded.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ",
    "ndash": "\u2013", "mdash": "\u2014", "lsquo": "\u2018", "rsquo": "\u2019", "ldquo": "\u201c", "rdquo": "\u201d",
    "hellip": "\u2026", "bull": "\u2022", "middot": "\u00b7", "laquo": "\u00ab", "raquo": "\u00bb",
    "copy": "\u00a9", "reg": "\u00ae", "trade": "\u2122", "deg": "\u00b0", "sect": "\u00a7", "times": "\u00d7",
    "euro": "\u20ac", "pound": "\u00a3", "cent": "\u00a2",
    "agrave": "\u00e0", "aacute": "\u00e1", "acirc": "\u00e2", "auml": "\u00e4", "ccedil": "\u00e7", "egrave": "\u00e8",
    "eacute": "\u00e9", "ecirc": "\u00ea", "iacute": "\u00ed", "ntilde": "\u00f1", "oacute": "\u00f3", "ocirc": "\u00f4",
    "ouml": "\u00f6", "szlig": "\u00df", "uacute": "\u00fa", "ugrave": "\u00f9", "uuml": "\u00fc",
}

# A scan finds comments, scripts, styles and tags, whatever comes first, and leaves a
# mark with the tag's name in their place, so that what looks like a tag inside an
# attribute, a script or a comment is none. Every pattern passes a page once, however
# broken it is: what is never closed reaches to the end of the page, as in a browser; a
# tag holds no "<" outside of quotes; possessive and atomic groups try nothing twice.
_VALUE = r"""=\s*+(?:"[^"]*+"|'[^']*+')?+"""
_SCAN = (
    r"(?is)<(?:script\b.*?(?:</script\s*>|\z)|style\b.*?(?:</style\s*>|\z)|!--.*?(?:-->|\z)|[!?][^<>]*+>"
    rf"|(/?[a-z][a-z0-9]*+)(?:[^<>=]++|{_VALUE})*+>)|[\x01-\x04]"
)
_MARK = "\x01$1\x02"
_TITLE = r"(?is)\A(?>.*?\x01title\x02)(.*?)\x01/title\x02"
_ARTICLE = r"(?i)(?=\x01/?article\x02)"

# Elements that start a paragraph, and those that start a line.
PARAGRAPHS = (
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr legend main menu nav ol p pre search section summary table ul"
)
LINES = "br caption li optgroup option tbody tfoot thead tr"
_PARAGRAPH = rf"(?i)\x01/?(?:{'|'.join(PARAGRAPHS.split())})\x02"
_LINE = rf"(?i)\x01/?(?:{'|'.join(LINES.split())})\x02"
_CELL = r"(?i)\x01/?t[dh]\x02"
_ANY_MARK = r"\x01[^\x02]*+\x02"
# A run of breaks and blanks, seen from its start only.
_PARAGRAPH_BREAK = r"(?<![\x03\x04 ])[\x04 ]*+\x03[\x03\x04 ]*+"
_LINE_BREAK = r"(?<![\x04 ]) *+\x04[\x04 ]*+"
# A single space needs no replacement.
_BLANKS = r"[ \t\n\r\f]{2,}|[\t\n\r\f]"
_BLANKS_IN_LINE = r"[ \t\r\f]{2,}|[\t\r\f]"


# What may stand between "&" and ";".
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _reference(part: Column) -> Column:
    """The text after an "&", with the reference that it begins with decoded."""

    def decoded(name: Column) -> Column:
        digits = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(F.substring(name, 2, 8))
        code = F.when(name.startswith("#"), digits).cast("bigint")
        # Characters outside of the code space, and halves of pairs, stay as they are.
        known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        numeric = F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        names = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])
        char = F.coalesce(F.try_element_at(names, name), numeric)
        rest = F.substr(part, F.length(name) + 2)
        return F.when(char.isNull(), F.concat(F.lit("&"), part)).otherwise(F.concat(char, rest))

    return _let(F.regexp_extract(part, REFERENCE, 1), decoded)


def decode_references(text: Column) -> Column:
    """Named and numeric references as their characters, each once: "&amp;lt;" becomes
    "&lt;". Unknown ones stay."""

    def joined(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), _reference)
        return F.concat(F.get(parts, 0), F.array_join(rest, ""))

    return F.when(F.instr(text, "&") > 0, _let(F.split(text, "&"), joined)).otherwise(text)


def _flat(marked: Column) -> Column:
    """One line of text; every tag counts as a blank."""
    stripped = F.regexp_replace(marked, _ANY_MARK, " ")
    return F.trim(F.regexp_replace(_let(stripped, decode_references), _BLANKS, " "))


def _paragraphs(marked: Column) -> Column:
    """Paragraphs with an empty line between them, lines where the page breaks them;
    other tags take no room."""
    broken = F.regexp_replace(F.regexp_replace(F.regexp_replace(marked, _PARAGRAPH, "\x03"), _LINE, "\x04"), _CELL, " ")
    text = F.regexp_replace(F.regexp_replace(broken, _ANY_MARK, ""), _BLANKS, " ")
    text = F.regexp_replace(F.regexp_replace(text, _PARAGRAPH_BREAK, "\n\n"), _LINE_BREAK, "\n")
    return F.trim(F.regexp_replace(_let(text, decode_references), _BLANKS_IN_LINE, " "), F.lit(" \n"))


def scan_tags(html: Column | str) -> Column:
    """The page with a mark for every tag, and an empty one for each script, style and
    comment."""
    return F.regexp_replace(_col(html), _SCAN, _MARK)


def _first_article(marked: Column) -> Column:
    """What the first article holds, others inside it included: it ends where as many
    have ended as have begun. If they never have, the last end counts."""
    i32 = lambda n: F.lit(n).cast("int")

    def inside(parts: Column) -> Column:
        start = F.struct(i32(0).alias("at"), i32(0).alias("open"), i32(0).alias("first"), i32(0).alias("last"), F.lit(False).alias("done"))

        def step(state: Column, part: Column) -> Column:
            at = state["at"] + 1
            # A part begins with its mark, but for what comes before the first one.
            begins = F.lower(F.substring(part, 1, 9)) == "\x01article\x02"
            ends = (F.lower(F.substring(part, 1, 10)) == "\x01/article\x02") & (state["open"] > 0)
            open_ = F.when(begins, state["open"] + 1).when(ends, state["open"] - 1).otherwise(state["open"])
            after = F.struct(
                at.alias("at"),
                open_.alias("open"),
                F.when(begins & (state["first"] == 0), at).otherwise(state["first"]).alias("first"),
                F.when(ends, at).otherwise(state["last"]).alias("last"),
                (ends & (open_ == 0)).alias("done"),
            )
            return F.when(state["done"], state).otherwise(after)

        found = F.aggregate(parts, start, step)
        return _let(found, lambda f: F.when(f["last"] > 0, F.array_join(F.slice(parts, f["first"], F.greatest(f["last"] - f["first"], i32(0))), "")).otherwise(F.when(marked.isNotNull(), "")))

    return _let(F.split(marked, _ARTICLE), inside)


def page_title(html: Column | str) -> Column:
    """Text of the first ``<title>``; empty when there is none."""
    return _flat(F.regexp_extract(scan_tags(html), _TITLE, 1))


def article_text(html: Column | str, paragraphs: bool = True) -> Column:
    """Text of the first ``<article>``, in paragraphs or as one line; empty when there
    is none."""
    return _let(_first_article(scan_tags(html)), _paragraphs if paragraphs else _flat)


def article_fields(html: Column | str, paragraphs: bool = True) -> Column:
    """One struct of ``title`` and ``text``, in an array of length 1 (for
    ``inline``): the page is scanned once for both."""

    def fields(page: Column) -> Column:
        title = _flat(F.regexp_extract(page, _TITLE, 1)).alias("title")
        return F.struct(title, _let(_first_article(page), _paragraphs if paragraphs else _flat).alias("text"))

    return F.transform(F.array(scan_tags(html)), fields)
