from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.functions import dates, flights, numbers, text


@pytest.mark.parametrize("value, whole", [
    ("12.7", 12), ("-12.7", -12), ("1,5", 0), ("", 0), (" ", 0), (" 12 ", 12), ("1e3", 1000), ("12d", 0), ("nan", 0), ("inf", 0),
    ("0x10", 0), (None, 0), ("+5", 5), (".5", 0), ("7.", 7),
])
def test_whole_or_zero(one, value, whole):
    assert one(lambda c: numbers.whole_or_zero(c.cast("string")), value) == whole


def test_whole_keeps_null(one):
    assert one(numbers.whole, "x") is None
    assert one(numbers.whole, "3.9") == 3


@pytest.mark.parametrize("value, comma, whole", [
    ("446,50", True, 446), ("447,50", True, 448), ("1.234,50", True, 1234), ("x", True, None), ("620.0", False, 620),
    ("0.5", False, 0), ("1.5", False, 2), (" 10 ", False, 10),
])
def test_fare(one, value, comma, whole):
    assert one(lambda c: numbers.fare(c, comma), value) == whole


def test_load_factor_is_exact(spark):
    """Equal to the rounding of the double for every load of up to 600 seats."""
    pairs = spark.range(1, 601).select(F.col("id").alias("seats")).select(
        "seats", F.explode(F.sequence(F.lit(0), F.col("seats") + 20)).alias("pax")
    ).select("pax", "seats", flights.load_factor(F.col("pax"), F.col("seats")).alias("x")).collect()
    assert [(p, s, x) for p, s, x in pairs if x != round(p / s, 4)] == []


def test_load_factor_without_seats(one):
    assert one(flights.load_factor, 5, 0) is None
    assert one(flights.load_factor, 1, 32) == 0.0312
    assert one(flights.load_factor, 1, 160) == 0.0063


PROBES = ["PASSO D'OESTE", "SP/RJ", "737-800", "A1B2", "são joão_del-rei 2x", "ÉVORA éa", "", "  a  b ", "o'NEIL’s café", "1ºABC", "a\tb"]


def test_proper_case_probes(spark):
    rows = spark.createDataFrame([(p,) for p in PROBES], "s string").select("s", text.proper_case(F.col("s")).alias("t")).collect()
    assert [r.t for r in rows] == [p.title() for p in PROBES]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abzABZéÉçãÕ'/-. 0129_", max_size=12), min_size=20, max_size=40))
def test_proper_case_any(spark, words):
    rows = spark.createDataFrame([(w,) for w in words], "s string").select("s", text.proper_case(F.col("s")).alias("t")).collect()
    assert [r.t for r in rows] == [r.s.title() for r in rows]


def test_keys_are_null_with_a_null_part(one):
    assert one(text.leg_key, "G3", "1", "2026-01-01", "SBPA", "SBGR") == "G3-1-2026-01-01-SBPA-SBGR"
    assert one(lambda a: text.leg_key(a, F.lit(None).cast("string")), "G3") is None
    assert one(lambda a: text.flight_label(a, F.lit(None).cast("string"), null_as_blank=True), "G3") == "G3"


@pytest.mark.parametrize("value, month", [("1", "01"), ("01", "01"), ("12", "12"), ("x", None), ("123", "123")])
def test_two_digits(one, value, month):
    assert one(lambda c: text.two_digits(text.month_number(c)), value) == month


@pytest.mark.parametrize("line, pax, cargo, seats, group", [
    ("DOMÉSTICA CARGUEIRA", 5, 0, 5, "Cargo"), ("INTERNACIONAL MISTA", 0, 5, 0, "Pax"), ("X", 1, 1, 1, "Pax"),
    ("X", 0, 1, 1, "Cargo"), ("X", 0, 0, 1, "Pax"), ("X", 0, 0, 0, "Others"), (None, 0, 0, 0, "Others"),
])
def test_traffic_group(one, line, pax, cargo, seats, group):
    assert one(lambda a, b, c, d: flights.traffic_group(a.cast("string"), b, c, d), line, pax, cargo, seats) == group


@pytest.mark.parametrize("value, expected", [
    ("REGULAR DE PASSAGEIROS DOMÉSTICA", ("Regular De Passageiros", "Passageiros", "Doméstica", "Pax")),
    ("não regular de carga internacional", ("Não Regular De Carga", "Carga", "Internacional", "Cargo")),
    ("CORREIO", ("Correio", "Carga", "Doméstica", "Cargo")),
    ("TRANSLADO", ("Translado", "Others", "Doméstica", "Others")),
    (None, (None, None, None, "Others")),
])
def test_flight_type(spark, value, expected):
    df = spark.createDataFrame([(value,)], "s string")
    parts = flights.flight_type_parts(F.col("s"))
    row = df.select(*[parts[name].alias(name) for name in ("Id Voo", "Id Linha", "Natureza", "Group")]).head()
    assert tuple(row) == expected


@pytest.mark.parametrize("value, hours", [
    ("-03:00", -3), ("−05:30", -5), ("+02:00", 2), ("4", 4), ("", -3), ("UTC", -3), (None, -3), (" -4 ", -4),
])
def test_offset(one, value, hours):
    assert one(lambda c: dates.offset_hours(c.cast("string")), value) == hours


def test_stamp(one):
    assert one(dates.stamp, "28/02/2026 23:15:00") == dt.datetime(2026, 2, 28, 23, 15)
    assert one(dates.stamp, "31/02/2026 10:00:00") is None
    assert one(dates.stamp, "2026-02-28 10:00:00") is None
    assert one(lambda c: dates.shifted(dates.stamp(c), F.lit(-3)), "01/03/2026 01:00:00") == dt.datetime(2026, 2, 28, 22)


@pytest.mark.parametrize("value, day", [
    ("2026-03-04", dt.date(2026, 3, 4)), ("04/03/2026", dt.date(2026, 3, 4)), ("4/3/2026", dt.date(2026, 3, 4)),
    ("2026-03-04 10:00:00", dt.date(2026, 3, 4)), ("31/02/2026", None), ("x", None), (" 2026-03-04 ", dt.date(2026, 3, 4)),
])
def test_tolerant_date(one, value, day):
    assert one(dates.tolerant_date, value) == day


@pytest.mark.parametrize("name, period, kind, clean", [
    ("202605 (1).CSV", dt.date(2026, 5, 1), "dom", "202605.CSV"), ("a/INTERNACIONAL_2025-12(01).CSV", dt.date(2025, 12, 1), "int", "INTERNACIONAL_2025-12.CSV"),
    ("basica2026-05.txt", dt.date(2026, 5, 1), None, "basica2026-05.txt"), ("combinada202606.txt", dt.date(2026, 6, 1), None, "combinada202606.txt"),
    ("leia.csv", None, None, "leia.csv"), ("202601", dt.date(2026, 1, 1), None, "202601"),
])
def test_file_names(spark, name, period, kind, clean):
    c = F.lit(name)
    row = spark.range(1).select(text.period_in_name(c), text.fare_kind(c), text.without_copy_suffix(c)).head()
    assert tuple(row) == (period, kind, clean)


@pytest.mark.parametrize("href, page, link", [
    ("x.zip?a=1", "https://h.example/a/b", "https://h.example/a/x.zip"), ("/x.zip", "https://h.example/a/b", "https://h.example/x.zip"),
    ("../x.zip", "https://h.example/a/b/c", "https://h.example/a/x.zip"), ("http://o.example/x.zip", "https://h.example/a", "http://o.example/x.zip"),
    ("//o.example/x", "https://h.example/a", "https://o.example/x"), ("x", "https://h.example", "https://h.example/x"),
    ("./a/../b/x.zip", "https://h.example/q/", "https://h.example/q/b/x.zip"),
])
def test_links(one, href, page, link):
    from urllib.parse import urljoin

    assert urljoin(page, href.split("?")[0]) == link
    assert one(text.absolute_link, href, page) == link


@pytest.mark.parametrize("value", ["Mês Referência", " AÇÃO ", "naïve Œuvre Ÿ", "Tarífa", "İstanbul", "e\u0301tude", "Ñandú ø đ"])
def test_folded(one, value):
    import unicodedata

    plain = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c)).lower().strip()
    assert one(text.folded, value) == plain


@pytest.mark.parametrize("label, theme", [
    ("TARIFAS AÉREAS DOMÉSTICAS", "dom"), ("Tarifas Internacionais", "int"), ("tarifa nacional", "dom"), ("Microdados domésticos", None), ("Tarifas", None),
])
def test_fare_theme(one, label, theme):
    assert one(text.fare_theme, label) == theme


def test_routes(one):
    assert one(lambda k: text.route_of(k, "processed"), "siros/mensal/2026-01") == "siros_mensal"
    assert one(lambda k: text.route_of(k, "raw_mode"), "siros/voos") == "replace"
    with pytest.raises(Exception, match="no route for outra/1"):
        one(lambda k: text.route_of(k, "raw"), "outra/1")


def test_layout_sizes():
    assert (len(L.LEG_COLUMNS), len(set(L.MART_COLUMNS)), len(L.FARE_COLUMNS), len(L.SCHEDULE_COLUMNS)) == (79, 99, 13, 31)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 10**9), min_size=10, max_size=30))
def test_expected_passengers(spark, seats):
    rows = spark.createDataFrame([(s,) for s in seats], "s bigint").select("s", flights.expected_passengers(F.col("s")).alias("p")).collect()
    assert all(r.p == round(0.8 * r.s) for r in rows)


def test_proper_case_marks_only_what_stands_before_a_letter(spark):
    texts = ["a\x01 b-c", "PAÍS-12", "x\x01y-Z", "(ab) cD", "-", "é-1 b", "A-"]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select(text.proper_case(F.col("s")).alias("t"))
    assert [r.t for r in got.collect()] == [t.title() for t in texts]
