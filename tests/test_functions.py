"""Scalar functions, case by case."""

import random

import pytest
from pyspark.sql import functions as F

from snaptrack.functions import geo, html, numbers, segments, text, times


def apply(spark, make, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


AMOUNTS = {
    "23.532.434,20": 23532434.2, "2.3532434E7": 23532434.0, "9532434.2": 95324342.0,
    "12,5E3": 12500.0, "": None, "None": None, "nan": None, "null": None, "abc": None, None: None,
    " 10 ": 10.0, "1,2,3": None, "-5,5": -5.5, "inf": None, "12d": None, "NaN": None, "1e2": 100.0,
}


def test_parse_amount(spark):
    assert apply(spark, numbers.parse_amount, list(AMOUNTS)) == list(AMOUNTS.values())


def test_parse_amount_strict_reads_a_lone_dot_as_decimal(spark):
    values = ["9532434.2", "1.000", "23.532.434,20", "5.1234"]
    assert apply(spark, numbers.parse_amount_strict, values) == [9532434.2, 1000.0, 23532434.2, 5.1234]


PERCENTS = {"45%": 45.0, "45.0": 45.0, "5,67": 5.67, "": None, "x": None, None: None, " 7 % ": 7.0,
            "nan": None, "12d": None}


def test_parse_pct(spark):
    assert apply(spark, numbers.parse_pct, list(PERCENTS)) == list(PERCENTS.values())


@pytest.mark.parametrize(
    "now, before, shown",
    [(5.67, 5.67, "0%"), (1.04, 1.0, "+0.0%"), (1.0, 1.04, "-0.0%"), (None, 1.0, ""), (1.0, None, "")],
)
def test_format_delta(spark, now, before, shown):
    row = spark.createDataFrame([(now, before)], "n double, b double")
    assert row.select(numbers.format_delta(F.col("n"), F.col("b"))).first()[0] == shown


def test_format_delta_rounds_like_exact_binary_half_even(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(10001) / 100, rng.randrange(10001) / 100) for _ in range(5000)]
    pairs += [(45.25, 0.0), (0.0, 72.05), (0.25, 0.0), (0.35, 0.0)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, n double, b double")
    got = rows.select("i", numbers.format_delta(F.col("n"), F.col("b")).alias("s")).orderBy("i").collect()

    def expected(n, b):
        d = n - b
        return "0%" if d == 0 else f"{'+' if d > 0 else ''}{d:.1f}%"

    assert [r.s for r in got] == [expected(*p) for p in pairs]


def test_amount_text_has_no_exponent(spark):
    assert apply(spark, numbers.amount_text, [23532434.2, 5.0, 0.1], "double") == ["23532434.2", "5.0", "0.1"]


@pytest.mark.parametrize(
    "lat, lng, shown",
    [(38.701, 16.472, "38.701000, 16.472000"), (0.0, 0.0, ""), (0.0, 16.0, "0.000000, 16.000000"),
     (None, 1.0, "")],
)
def test_format_coordinate(spark, lat, lng, shown):
    row = spark.createDataFrame([(lat, lng)], "a double, b double")
    assert row.select(geo.format_coordinate(F.col("a"), F.col("b"))).first()[0] == shown


def test_coordinate_link(spark):
    link = "https://www.google.com/maps?q="
    values = ["37.0, 14.6", "37.0", "a, b", "37;14", "", None]
    assert apply(spark, geo.coordinate_link, values) == [link + "37.0,14.6", "", "", link + "37,14", "", ""]


def test_blanks(spark):
    values = [None, "", " ", "None", " nan ", "0.000000, 0.000000", "NaN", "x"]
    with_coordinate = apply(spark, lambda c: text.is_blank(c, "0.000000, 0.000000"), values)
    assert with_coordinate == [True] * 6 + [False, False]
    assert apply(spark, text.is_blank, values) == [True] * 5 + [False] * 3


def test_strip_knows_every_whitespace(spark):
    assert apply(spark, text.strip, [" 　x y \x1c\n"]) == ["x y"]


def test_clean_text(spark):
    assert apply(spark, text.clean_text, ["a\r\n\tb ", None, "\n"]) == ["a b", "", ""]


def test_first_token(spark):
    values = ["Catania, Messina", "Roma; Latina", "", None, "A;B,C"]
    assert apply(spark, text.first_token, values) == ["Catania", "Roma", "", "", "A"]


def test_legacy_flag(spark):
    values = ["Si", "sì", " TRUE ", "1", "yes", "no", "", None]
    assert apply(spark, text.legacy_flag_to_tag, values) == ["In VTiger"] * 5 + [""] * 3


def test_run_ids(spark):
    shown = apply(
        spark, lambda c: F.date_format(times.parse_run_id(c), "yyyy-MM-dd HH:mm"),
        ["Avanz_01-07-2026_0900", "Avanz_01-07-2026", "2026-07-01", "Avanz_x", None],
    )
    assert shown == ["2026-07-01 09:00", "2026-07-01 00:00", "2026-07-01 00:00", None, None]
    stamp = apply(
        spark, lambda c: F.date_format(times.parse_run_file(c), "yyyy-MM-dd HH:mm:ss"),
        ["works_20260701_090015.csv", "works.csv"],
    )
    assert stamp == ["2026-07-01 09:00:15", None]


def test_dates_in_both_spellings(spark):
    got = apply(spark, lambda c: times.parse_date(c).cast("string"), ["01-07-2026", "2026-07-02", "x", ""])
    assert got == ["2026-07-01", "2026-07-02", None, None]


def test_numeric_label(spark):
    values = ["+1.0%", "-1.0%", "0%", "Obra Nueva", "", None]
    assert apply(spark, numbers.is_numeric_label, values) == [True] * 3 + [False] * 3


def test_segments(spark):
    kind = "array<struct<CODICE_STRADA:string,DALKM:string,ALKM:string>>"
    lists = [[("A1", "1", "2"), ("B2", None, "4")], [], None]
    assert apply(spark, segments.segments_text, lists, kind) == ["A1 1–2; B2 –4", "", ""]
    assert apply(spark, lambda c: segments.first_of(c, "DALKM"), lists, kind) == ["1", "", ""]


PAGE = """<!DOCTYPE html><html><head><title>Registro</title><style>p{}</style>
<script>var x = "<p>Comune</p>";</script></head><body><!-- Provincia --><h1>Dettaglio Progetto</h1>
<p>CUP:</p><p>short</p><p>version 1 of the page</p><p>Strada statale n. 106 &egrave; &#8220;nuova&#8221; &amp;lt;</p>
<dl><dt>Anno decisione</dt><dd>2019</dd><dt>PROVINCIA</dt><dd> Catania </dd><dt>Comune</dt>
<dd>Catania<br>Messina</dd><dt>Settore</dt><dd>Trasporti</dd><dt>Categoria</dt><dd>wrong</dd>
<dt>Sottosettore</dt><dd>Strade</dd><dt>Categoria</dt><dd>right</dd></dl>
<a href="/x">F12C34567890123</a><a name="n">J11H00000000001</a><a class="k" href="/y"><b>J22</b>H98765432101</a>
<p>Sono 12 CUP collegati</p><p>Tipologia</p></body></html>"""


def test_page_record(spark):
    page = spark.createDataFrame([("F12C34567890123", PAGE)], "k string, html string")
    lined = page.withColumn("lines", html.text_lines(F.col("html")))
    fields = html.registry_fields(F.col("html"), F.col("lines"), F.col("k"))
    record = lined.select(*[c.alias(n) for n, c in fields.items()]).first().asDict()
    assert record == {
        "official_name": "Strada statale n. 106 è “nuova” &lt;", "decision_year": "2019",
        "province": "Catania", "municipalities": "Catania", "typology": "", "sector": "Trasporti",
        "subsector": "Strade", "sector_category": "right", "parent_key": "J22H98765432101",
        "linked_keys": "12",
    }
    assert "Registro" in lined.first().lines and "Comune" in lined.first().lines


def test_category_needs_its_context(spark):
    lines = spark.createDataFrame([(["Strade", "Categoria", "a", "x", "Categoria", "b"],)], "l array<string>")

    def after(previous):
        return lines.select(html.value_after_label(F.col("l"), "categoria", previous)).first()[0]

    assert (after("strade"), after("X"), after("none"), after(""), after(None)) == ("a", "b", "", "a", "a")
