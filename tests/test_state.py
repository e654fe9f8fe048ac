from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from skyledger.plans import runs, state
from skyledger.sinks.tables import Snapshots


def manifest(spark, **entries):
    names = list(state.FIELDS)
    rows = [(key.replace("__", "/"), *[entry.get(n) for n in names]) for key, entry in entries.items()]
    return spark.createDataFrame(rows, state.MANIFEST)


def inventory(spark, segment, refs, size=None):
    return spark.createDataFrame([(segment, r, f"u{r}", size) for r in refs], "segment string, ref string, url string, bytes bigint")


def refs(df):
    return sorted(r["ref"] for r in df.collect())


MONTHS = [f"2026{m:02d}" for m in range(1, 13)] + [f"2027{m:02d}" for m in range(1, 9)]


def test_from_json(spark):
    doc = json.dumps({"gerado_em": "x", "arquivos": {"basica/202601": {"situacao": "novo", "bytes_zip": 7},
                                                     "tarifas/dom/2026": {"meses": {"01": "02/02/2026 10:00"}}}}, indent=1)
    rows = {r["key"]: r for r in state.from_json(spark.createDataFrame([(doc,)], "value string")).collect()}
    assert rows["basica/202601"]["bytes_zip"] == 7 and rows["tarifas/dom/2026"]["meses"] == {"01": "02/02/2026 10:00"}


def test_first_run_takes_the_last_months(spark):
    inv = inventory(spark, "basica", MONTHS)
    assert refs(state.refs_to_collect(inv, manifest(spark))) == MONTHS[-12:]
    assert refs(state.refs_to_collect(inv, manifest(spark), backfill=True)) == MONTHS


def test_later_runs_take_what_is_newer(spark):
    inv = inventory(spark, "basica", ["202512", *MONTHS])
    known = manifest(spark, basica__202603={"situacao": "novo"}, basica__202702={"situacao": "inalterado"}, basica__202703={"situacao": "erro"},
                     basica__202512={"situacao": "novo"}, basica__209901={"situacao": "novo"})
    assert refs(state.refs_to_collect(inv, known)) == MONTHS[14:]
    assert [tuple(r) for r in state.older_gaps(inv, known).collect()] == [("basica", 12)]
    assert len(refs(state.refs_to_collect(inv, known, backfill=True))) == 18


def test_changed_size(spark):
    inv = inventory(spark, "basica", ["202601", "202602", "202603", "202604"], 10).unionByName(inventory(spark, "basica", ["202605"]))
    known = manifest(spark, basica__202601={"situacao": "novo", "bytes_zip": 10}, basica__202602={"situacao": "novo", "bytes_zip": 9},
                     basica__202603={"situacao": "novo"}, basica__202604={"situacao": "erro", "bytes_zip": 9},
                     basica__202605={"situacao": "novo", "bytes_zip": 9})
    assert refs(state.changed_size(inv, known)) == ["202602"]


def test_page_gate(spark):
    now = spark.createDataFrame([("a", "2"), ("b", "1"), ("c", ""), ("d", None), ("e", "1")], "page string, updated string")
    before = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("d", "1")], "page string, updated string")
    got = {r["page"]: r["sweep"] for r in state.page_changed(now, before).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False, "e": True}
    assert state.page_changed(now, before, forced=True).where("not sweep").count() == 0


@pytest.mark.parametrize("print_, failure, changed, expected", [
    ("x", None, "republicado", "inalterado"), ("y", None, "republicado", "republicado"), ("y", None, "atualizado", "atualizado"),
    (None, "indisponivel", "republicado", "indisponivel"),
])
def test_classify(spark, print_, failure, changed, expected):
    known = manifest(spark, siros__voos={"impressao": "x"})
    candidate = spark.createDataFrame([("siros/voos", print_, failure), ("new/1", "z", None)], "key string, impressao string, failure string")
    got = {r["key"]: r["situacao"] for r in state.classify(candidate, known, changed).collect()}
    assert got == {"siros/voos": expected, "new/1": "novo"}


def test_month_changes(spark):
    known = manifest(spark, tarifas__dom__2026={"meses": {"01": "a", "02": "b", "03": "c"}}, tarifas__int__2025={"meses": {"12": "a"}})
    now = spark.createDataFrame([
        ("tarifas/dom/2026", {"01": "a", "02": "B", "04": "d"}), ("tarifas/int/2025", {"12": "a"}), ("tarifas/dom/2027", {"01": "x"}), ("tarifas/int/2026", {}),
    ], "key string, meses map<string,string>")
    got = {r["key"]: (r["situacao"], r["new_months"], r["changed_months"]) for r in state.month_changes(now, known).collect()}
    assert got == {
        "tarifas/dom/2026": ("atualizado", {"04": "d"}, {"02": "B"}), "tarifas/int/2025": ("inalterado", {}, {}),
        "tarifas/dom/2027": ("novo", {"01": "x"}, {}), "tarifas/int/2026": ("indisponivel", {}, {}),
    }


def test_last_published_compares_times(spark):
    row = spark.createDataFrame([({"01": "28/02/2026 10:00", "02": "03/03/2026 09:00:01", "03": "x"},)], "m map<string,string>")
    assert str(row.select(state.last_published(F.col("m"))).head()[0]) == "2026-03-03 09:00:01"


@pytest.mark.parametrize("date, size, forced, skip", [
    ("d", 5, False, True), ("e", 5, False, False), ("d", 6, False, False), (None, 5, False, True), (None, None, False, False), ("d", 5, True, False),
])
def test_schedule_skip(spark, date, size, forced, skip):
    known = manifest(spark, siros__voos={"publicado_em": "d", "bytes_zip": 5})
    listing = spark.createDataFrame([("siros/voos", date, size)], "key string, published_at string, bytes bigint")
    assert state.schedule_skippable(listing, known, forced).head()["skip"] is skip


def test_years_to_check(spark):
    offered = spark.createDataFrame([(s, y) for s, ys in {
        "tarifas/dom": (2026, 2027), "tarifas/int": (2026,), "tarifas/x": (2026, 2028), "tarifas/old": (2025,), "tarifas/y": (2026, 2027)}.items() for y in ys],
        "segment string, year int")
    known = manifest(spark, tarifas__dom__2026={"meses": {"12": "a", "02": "b"}}, tarifas__int__2026={"meses": {"12": "a"}},
                     tarifas__y__2026={"meses": {"05": "a"}}, tarifas__x__2025={"meses": {"05": "a"}})
    got = {r["segment"]: r["year"] for r in state.years_to_check(known, offered).collect()}
    # December known: the next year, but only if offered; no history above the floor: the newest year
    assert got == {"tarifas/dom": 2027, "tarifas/x": 2028, "tarifas/y": 2026}


def test_register_keeps_the_first_sighting(spark):
    known = manifest(spark, a__1={"coletado_em": "t0", "verificado_em": "t0", "situacao": "novo", "bytes_zip": 1}, a__2={"coletado_em": "t0", "verificado_em": "t0"})
    update = spark.createDataFrame([("a/1", "inalterado"), ("b/1", "novo")], "key string, situacao string")
    once = state.register(known, update, F.lit("t1"))
    got = {r["key"]: (r["coletado_em"], r["verificado_em"], r["situacao"], r["bytes_zip"]) for r in once.collect()}
    assert got == {"a/1": ("t0", "t1", "inalterado", 1), "a/2": ("t0", "t0", None, None), "b/1": ("t1", "t1", "novo", None)}
    again = state.register(once, update, F.lit("t1"))
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


def test_register_sets_nulls_and_takes_the_last_update(spark):
    known = manifest(spark, a__1={"publicado_em": "d1", "situacao": "novo", "coletado_em": "t0"}, a__2={"publicado_em": "d2", "coletado_em": "t0"})
    updates = spark.createDataFrame([("a/1", None, 2), ("a/1", "d9", 1), ("b/1", "x", 1), ("b/1", "y", 2)], "key string, publicado_em string, n int")
    got = {r["key"]: (r["publicado_em"], r["situacao"]) for r in state.register(known, updates, F.lit("t1"), ["n"]).collect()}
    assert got == {"a/1": (None, "novo"), "a/2": ("d2", None), "b/1": ("y", None)}
    assert state.register(known, updates.drop("n"), F.lit("t1")).count() == 3


def test_collection_run_twice(spark, folder):
    offer = spark.createDataFrame([("basica", f"2026{m:02d}", 10 + m) for m in range(1, 7)], "segment string, ref string, bytes bigint")
    first = sorted(map(tuple, runs.collect(spark, folder, offer).collect()))
    assert first == [("basica", f"2026{m:02d}", "first run") for m in range(1, 7)]
    got = spark.createDataFrame(
        [(f"basica/2026{m:02d}", f"h{m}", None, 10 + m) for m in range(1, 5)] + [("basica/202605", None, "erro", None)],
        "key string, impressao string, failure string, bytes_zip bigint")
    for _ in range(2):  # the second time changes nothing
        plan = sorted(map(tuple, runs.collect(spark, folder, offer, got).collect()))
        assert plan == [("basica", "202605", "new"), ("basica", "202606", "new")]
    states = {r["key"]: r["situacao"] for r in Snapshots(spark, f"{folder}/manifest").read().collect()}
    assert states == {**{f"basica/2026{m:02d}": "inalterado" for m in range(1, 5)}, "basica/202605": "erro"}
    larger = offer.withColumn("bytes", F.col("bytes") + F.when(F.col("ref") == "202602", 5).otherwise(0))
    assert ("basica", "202602", "size") in list(map(tuple, runs.collect(spark, folder, larger).collect()))


def test_forget_presets(spark):
    known = manifest(spark, **{k: {"situacao": "novo"} for k in ("basica__202605", "basica__202606", "combinada__202606", "siros__voos", "tarifas__dom__2026", "tarifas__int__2025")})
    today = F.to_date(F.lit("2027-01-15"))
    left = state.forget(known, state.current_month_keys(known, today))
    assert sorted(r["key"] for r in left.collect()) == ["basica/202605", "tarifas/int/2025"]
    empty = sorted(r["key"] for r in state.current_month_keys(known.where("false"), today).collect())
    assert empty == ["siros/voos", "tarifas/dom/2027"]
    year = state.forget(known, state.year_keys(spark.createDataFrame([(2026,)], "year int")))
    assert [r["key"] for r in year.collect()] == ["tarifas/int/2025"]
    assert state.year_keys(spark.createDataFrame([(2026,)], "year int")).count() == 27
    assert state.forget(left, state.current_month_keys(known, today)).count() == left.count()


def test_pairs_and_pending(spark):
    months = "year int, month int"
    legs = spark.createDataFrame([(2026, 1), (2026, 2)], months)
    combined = spark.createDataFrame([(2026, 2), (2026, 3)], months)
    assert [tuple(r) for r in state.complete_pairs(legs, combined).collect()] == [(2026, 2)]
    assert sorted(map(tuple, state.incomplete_pairs(legs, combined).collect())) == [(2026, 1, "combinada"), (2026, 3, "basica")]
    available = spark.createDataFrame([(2026, 1, "x"), (2026, 2, "y")], months + ", impressao string")
    finished = spark.createDataFrame([(2026, 1, "x"), (2026, 2, "old")], months + ", impressao string")
    assert [tuple(r) for r in state.pending(available, finished).collect()] == [(2026, 2, "y")]
    assert state.pending(available, available).count() == 0
    assert state.pending(available, available, forced=True).count() == 2


def test_status(spark):
    known = manifest(
        spark, basica__202605={"situacao": "republicado", "bytes_zip": 5}, basica__202606={"situacao": "indisponivel", "detalhe": "404"},
        combinada__202605={"situacao": "novo"}, tarifas__dom__2025={"situacao": "novo", "meses": {"11": "a", "12": "b"}, "bytes_zip": 1},
        tarifas__dom__2026={"situacao": "erro", "meses": {"01": "c"}})
    assert {r["segment"]: r["ref"] for r in state.latest_collected(known).collect()}["basica"] == "202605"
    fare = state.latest_fare_month(known).head()
    assert (fare["month"], fare["published_at"], fare["bytes_zip"], fare["situacao"]) == ("202601", "c", 1, "novo")
    totals = state.inventory_totals(inventory(spark, "basica", ["202605", "202606"]).unionByName(inventory(spark, "other", ["1"])))
    assert sorted(map(tuple, state.coverage(known, totals).collect())) == [("basica", "202606", 1, 2), ("other", "1", 0, 1)]
    assert tuple(state.tracked(known).head()) == (5, 2, 1)
    assert [r["key"] for r in state.republished(known).collect()] == ["basica/202605"]
    assert sorted((r["key"], r["detalhe"]) for r in state.problems(known).collect()) == [("basica/202606", "404"), ("tarifas/dom/2026", None)]
