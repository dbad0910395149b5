"""Fields out of the raw pages.

The given pages carry none of the registry's own labels, so the rules run on landmarks the
pages do have: the title line as marker, frequent menu words as labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrack.functions import html as H
from snaptrack.plans import tables as t
from snaptrack.plans.registry import query
from snaptrack.sources import landing
from snaptrack.sources.shared import new_folder

LINK = r"^[A-Za-z]+,$"
PHRASE = r"(?i)(\d+)\s*(?:CUP\s+)?the"
LABELS = {
    "decision_year": "the", "province": "and", "municipalities": "de", "typology": "la",
    "sector": "der", "subsector": "to",
}
CATEGORY = "of"


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return t.spread(t.table(spark, sf, "pages")).select(
        "page_id", "html", H.text_lines(F.col("html")).alias("lines")
    )


_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"

_SQL_LINES = rf"""
  plain AS (
    SELECT page_id, html,
      regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!doctype[^>]*>',
                     '<br>', 'g') AS visible FROM pages),
  decoded AS (
    SELECT page_id, visible,
      replace(replace(replace(replace(replace(replace(replace(
        regexp_replace(visible, '(?s)</?[A-Za-z][^>]*>', chr(10), 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'),
        '&nbsp;', chr(160)), '&amp;', '&') AS txt FROM plain),
  lined AS (
    SELECT page_id, visible, list_filter(list_transform(string_split(txt, chr(10)),
        lambda x: trim(x, {_SPACE})), lambda x: x <> '') AS lines FROM decoded),
  numbered AS (
    SELECT page_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos,
      len(lines) AS n FROM lined)"""

_LINED = f"WITH {_SQL_LINES}"


@query(
    "html_text_lines",
    _LINED + " SELECT page_id, CAST(pos AS INTEGER) AS pos, line FROM numbered",
)
def html_text_lines(spark, sf):
    return H.explode_lines(pages(spark, sf), "lines", "page_id").select(
        "page_id", (F.col("pos") + 1).alias("pos"), "line"
    )


def _sql_after(label: str, extra: str = "TRUE") -> str:
    """Scalar SQL: line after the first label line of the page that has a line after it."""
    return (
        "coalesce((SELECT arg_min(v.line, v.pos) FROM numbered k JOIN numbered v"
        " ON v.page_id = k.page_id AND v.pos = k.pos + 1"
        f" WHERE k.page_id = lined.page_id AND lower(k.line) = {label} AND {extra}), '')"
    )


def _sql_preceded(previous: str) -> str:
    return (
        f"(({previous}) = '' OR lower(({previous})) = (SELECT lower(b.line) FROM numbered b"
        " WHERE b.page_id = k.page_id AND b.pos = k.pos - 1))"
    )


_REFERENCES = "L&#x27;A&#39;b&apos; &amp;#38;x &#038; &#X41;&#0065; &eacute;&nope; &#x110000; & &lt;"
_DECODED = "L''A''b'' &#38;x & AA é&nope; &#x110000; & <"


@query("html_references", f"SELECT page_id, '{_DECODED}' || page_id || '&' AS text FROM pages")
def html_references(spark, sf):
    """Every kind of character reference, each decoded once."""
    text = F.concat(F.lit(_REFERENCES), t.text("page_id"), F.lit("&amp;"))
    return t.table(spark, sf, "pages").select("page_id", H.decode_entities(text).alias("text"))


@query(
    "html_value_after_label",
    _LINED
    + f""" SELECT page_id, {_sql_after("'the'")} AS after_the,
          {_sql_after("lower(lined.lines[1])")} AS after_title,
          {_sql_after("lower(lined.lines[1])", "k.pos > 1")} AS after_heading
          FROM lined""",
)
def html_value_after_label(spark, sf):
    lines = F.col("lines")
    title = F.get(lines, F.lit(0))
    # The title text comes twice: in the page's title and, below the menu, in its heading.
    at_heading = F.array_position(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), title)
    above = F.get(lines, at_heading.cast("int") - 1)
    return pages(spark, sf).select(
        "page_id",
        H.value_after_label(lines, "the").alias("after_the"),
        H.value_after_label(lines, title).alias("after_title"),
        F.when(at_heading > 0, H.value_after_label(lines, title, previous=above))
        .otherwise(F.lit("")).alias("after_heading"),
    )


_SQL_TITLE = """
  coalesce((SELECT arg_min(line, pos) FROM numbered v WHERE v.page_id = lined.page_id
    AND v.pos > 1 AND v.pos <= 8 AND length(line) > 10 AND line <> 'CUP:'
    AND NOT contains(lower(line), 'version')), '')"""


@query("html_title_rule", _LINED + f" SELECT page_id, {_SQL_TITLE} AS title FROM lined")
def html_title_rule(spark, sf):
    lines = F.col("lines")
    title = H.title_after_marker(lines, F.get(lines, F.lit(0)))
    return pages(spark, sf).select("page_id", title.alias("title"))


_SQL_LINK = r"""
  coalesce(list_filter(list_transform(
      regexp_extract_all(visible, '(?is)<a\s[^>]*\bhref\b[^>]*>(.*?)</a\s*>', 1),
      lambda x: replace(trim(regexp_replace(x, '(?s)\s*<[^>]*>\s*', '', 'g')), '&amp;', '&')),
      lambda x: regexp_matches(x, '^[A-Za-z]+,$') AND x <> 'the,')[1], '')"""


@query(
    "html_first_link_matching",
    _LINED + f" SELECT page_id, {_SQL_LINK} AS link FROM lined",
)
def html_first_link_matching(spark, sf):
    link = H.first_link_matching(F.col("html"), LINK, own=F.lit("the, "))
    return pages(spark, sf).select("page_id", link.alias("link"))


_SQL_PHRASE = (
    r"regexp_extract(array_to_string(lines, chr(10)), '(?i)(\d+)\s*(?:CUP\s+)?the', 1)"
)


@query("html_count_phrase", _LINED + f" SELECT page_id, {_SQL_PHRASE} AS number FROM lined")
def html_count_phrase(spark, sf):
    number = H.count_in_phrase(F.col("lines"), PHRASE)
    return pages(spark, sf).select("page_id", number.alias("number"))


@query(
    "html_record",
    _LINED
    + f""" SELECT page_id, {_SQL_TITLE} AS official_name, """
    + ", ".join(f"""{_sql_after(f"'{v}'")} AS {k}""" for k, v in LABELS.items())
    + f""", {_sql_after(f"'{CATEGORY}'", _sql_preceded(_sql_after("'to'").replace("numbered k", "numbered k2").replace("k.", "k2.").replace("numbered v", "numbered v2").replace("v.", "v2.")))}
            AS sector_category,
          {_SQL_LINK} AS parent_key, {_SQL_PHRASE} AS linked_keys FROM lined""",
)
def html_record(spark, sf):
    lines = F.col("lines")
    fields = H.registry_fields(
        F.col("html"), lines, F.lit("the,"),
        marker=F.get(lines, F.lit(0)), labels=LABELS, category=CATEGORY,
        link_pattern=LINK, phrase=PHRASE,
    )
    return pages(spark, sf).select("page_id", *[c.alias(n) for n, c in fields.items()])


@query(
    "scan_pages_as_landed",
    "SELECT md5(html) AS html_md5, length(html) AS chars, count(*) AS pages, count(*) AS project_keys FROM pages"
    " WHERE html IS NOT NULL GROUP BY html",
)
def scan_pages_as_landed(spark, sf):
    """Every page landed as a file of its own and read back, keyed by the file's name."""
    folder = new_folder(spark, "pages")
    given = t.table(spark, sf, "pages").select("html").where(F.col("html").isNotNull())
    given.write.option("maxRecordsPerFile", 1).text(folder)
    # The writer ends a file with a line break.
    html = F.expr("left(html, length(html) - 1)")
    found = landing.scan_pages(spark, f"{folder}/*.txt").select("project_key", html.alias("html"))
    return found.groupBy(F.md5("html").alias("html_md5"), F.length("html").cast("long").alias("chars")).agg(
        F.count("*").alias("pages"), F.count_distinct("project_key").alias("project_keys")
    )
