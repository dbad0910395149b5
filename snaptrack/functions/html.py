"""Fields out of raw registry pages, with array and regex built-ins only."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrack import constants as K
from snaptrack.functions.text import or_empty, strip

_INVISIBLE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!doctype[^>]*>"
_TAG = r"(?s)</?[A-Za-z][^>]*>"
# A character reference, or what lies between two.
_PIECES = r"[^&]+|&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);|&"


def _named_characters() -> Column:
    pairs = [*sorted(name2codepoint.items()), ("apos", 39)]
    return F.create_map(*[F.lit(x) for n, p in pairs for x in (n, chr(p))])


def _once(c: Column, use) -> Column:
    """`use(c)` with `c` evaluated a single time however often `use` refers to it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def _character(reference: Column) -> Column:
    """The character a reference stands for; one that stands for none is left as it is."""
    body = F.substring(reference, F.lit(2), F.length(reference) - 2)
    digits = F.regexp_replace(body, "^#[xX]?0*", "")
    fits = F.length(digits).between(1, 7)
    hexadecimal = F.lower(body).startswith("#x")
    number = F.when(fits, F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits))
    code = number.try_cast("int")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    numbered = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    found = F.when(body.startswith("#"), numbered).otherwise(_named_characters()[body])
    return F.coalesce(found, reference)


def decode_entities(c: Column) -> Column:
    """Named, decimal and hexadecimal character references, each decoded once, in one pass."""

    def decoded(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))
        each = F.transform(pieces, lambda p: F.when(p.startswith("&") & (F.length(p) > 1), _character(p)).otherwise(p))
        return F.when(F.contains(text, F.lit("&")), F.array_join(each, "")).otherwise(text)

    return _once(c, decoded)


def visible_html(html: Column) -> Column:
    """The page with a bare line break in place of every comment, script and style."""
    return F.regexp_replace(html, _INVISIBLE, "<br>")


def text_lines(html: Column) -> Column:
    """Non-blank, stripped text lines; every tag ends a line."""
    text = decode_entities(F.regexp_replace(visible_html(html), _TAG, "\n"))
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda line: line != "")


def explode_lines(df: DataFrame, lines: str, *keep: str) -> DataFrame:
    """One row per line. The outer form spares the size test that would parse each page twice."""
    exploded = df.select(*keep, F.posexplode_outer(lines).alias("pos", "line"))
    return exploded.where(F.col("pos").isNotNull())


def _column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def value_after_label(
    lines: Column, label: Column | str, previous: Column | str | None = None
) -> Column:
    """The line that follows a label line (any case); '' if no label has a line after it.

    `lines` holds no blank line, so the next line is the value. With a non-blank `previous`
    only a label whose preceding line equals it counts; other occurrences are passed over.
    """
    label = F.lower(_column(label))
    wanted = None if previous is None else F.lower(_column(previous))

    def is_label(line: Column, i: Column) -> Column:
        hit = (F.lower(line) == label) & (i + 1 < F.size(lines))
        if wanted is None:
            return hit
        before = F.when(i > 0, F.lower(F.get(lines, i - 1))).otherwise(F.lit(""))
        return hit & ((or_empty(wanted) == "") | (before == wanted))

    # Filtering positions keeps the work linear in the number of lines.
    positions = F.filter(
        F.transform(lines, lambda line, i: F.when(is_label(line, i), i + 1)),
        lambda p: p.isNotNull(),
    )
    return or_empty(F.get(lines, F.get(positions, F.lit(0))))


def title_after_marker(lines: Column, marker: Column | str = K.TITLE_MARKER) -> Column:
    """First title-like line among the few that follow the first marker line."""
    at = F.array_position(lines, _column(marker))

    def title_like(line: Column) -> Column:
        return (
            (F.length(line) > K.TITLE_MIN_LENGTH)
            & (line != K.TITLE_SKIP)
            & ~F.contains(F.lower(line), F.lit(K.TITLE_SKIP_WORD))
        )

    window = F.filter(F.slice(lines, at.cast("int") + 1, F.lit(K.TITLE_WINDOW)), title_like)
    return or_empty(F.when(at > 0, F.get(window, F.lit(0))))


def link_texts(html: Column) -> Column:
    """Text of every anchor that has an href, in page order."""
    inner = F.regexp_extract_all(
        visible_html(html), F.lit(r"(?is)<a\s(?:[^>]*\s)?href\b[^>]*>(.*?)</a\s*>"), F.lit(1)
    )
    return F.transform(
        inner, lambda t: strip(decode_entities(F.regexp_replace(t, r"(?s)\s*<[^>]*>\s*", "")))
    )


def first_link_matching(html: Column, pattern: str, own: Column | None = None) -> Column:
    """First anchor text that matches the pattern and is not the page's own key."""

    def wanted(text: Column) -> Column:
        hit = text.rlike(pattern)
        return hit if own is None else hit & (text != or_empty(strip(own)))

    return or_empty(F.get(F.filter(link_texts(html), wanted), F.lit(0)))


def count_in_phrase(lines: Column, pattern: str = K.LINKED_PATTERN) -> Column:
    """First number of a phrase such as '12 CUP collegati'; '' when absent."""
    return or_empty(F.regexp_extract(F.array_join(lines, "\n"), pattern, 1))


def registry_fields(
    html: Column,
    lines: Column,
    own: Column | None = None,
    *,
    marker: Column | str = K.TITLE_MARKER,
    labels: dict[str, Column | str] | None = None,
    category: Column | str = K.CATEGORY_LABEL,
    link_pattern: str = K.PROJECT_KEY_PATTERN,
    phrase: str = K.LINKED_PATTERN,
) -> dict[str, Column]:
    """All record fields of a page, by entity column name. `lines` should be a computed column."""
    labels = K.PAGE_LABELS if labels is None else labels
    fields = {name: value_after_label(lines, label) for name, label in labels.items()}
    subsector = fields["subsector"]
    return {
        "official_name": title_after_marker(lines, marker),
        **fields,
        "sector_category": value_after_label(lines, category, previous=subsector),
        "parent_key": first_link_matching(html, link_pattern, own),
        "linked_keys": count_in_phrase(lines, phrase),
    }
