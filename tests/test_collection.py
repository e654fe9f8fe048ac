"""The collection run over all publishers, twice and after failures."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from skyledger.plans import collection, runs, state
from skyledger.sinks.tables import Snapshots

OFFER = "segment string, ref string, bytes bigint, page string"
SHOWN = "page string, published string, updated string"
TABLE = "segment string, year int, month string, published_at string"


def _seen(spark, updated="10/02/2026", sizes=10, december="01/02/2026 10:00", listed=((("voos.zip", "2/1/2026 1:00 AM", 7)),)):
    offer = [("basica", f"2026{m:02d}", sizes if m == 2 else 10, "movements") for m in range(1, 6)] + [("combinada", "202601", 10, "movements"), ("basica", "201912", 9, "movements")]
    months = [("tarifas/dom", 2026, "01", "01/03/2026 10:00"), ("tarifas/dom", 2026, "02", "01/04/2026 10:00:00"), ("tarifas/dom", 2026, "02", "01/05/2026 09:00"),
              ("tarifas/dom", 2026, "total", "01/05/2026 09:00"), ("tarifas/int", 2025, "12", december)]
    years = [("tarifas/dom", 2025), ("tarifas/dom", 2026), ("tarifas/int", 2026), ("tarifas/int", 2027)]
    return spark.createDataFrame(offer, OFFER), {
        "pages": spark.createDataFrame([("movements", None, updated)], SHOWN), "offered": spark.createDataFrame(years, "segment string, year int"),
        "publications": spark.createDataFrame(months, TABLE), "listing": spark.createDataFrame(list(listed), "name string, published_at string, bytes bigint"),
    }


def _got(spark, plan, sizes=10, broken=()):
    rows = []
    for segment, ref, _ in plan:
        key = f"{segment}/{ref}"
        months = {"01": "01/03/2026 10:00", "02": "01/05/2026 09:00"} if segment == "tarifas/dom" else None
        size = 7 if segment == "siros" else sizes if ref == "202602" else 10
        rows.append((key, f"h{size}", "erro" if key in broken else None, size, months, "2/1/2026 1:00 AM" if segment == "siros" else None))
    return spark.createDataFrame(rows, "key string, impressao string, failure string, bytes_zip bigint, meses map<string,string>, publicado_em string")


def _plan(frame):
    return sorted(map(tuple, frame.collect()))


def _states(spark, root):
    return {r["key"]: r["situacao"] for r in Snapshots(spark, f"{root}/manifest").read().collect()}


def test_all_publishers_in_one_run(spark, folder):
    offer, seen = _seen(spark)
    plan = _plan(runs.collect(spark, folder, offer, **seen))
    assert plan == [("basica", f"2026{m:02d}", "first run") for m in range(1, 6)] + [
        ("combinada", "202601", "first run"), ("siros", "voos", "announced"), ("tarifas/dom", "2026", "months")]
    # the newest international year has an empty table
    assert _states(spark, folder) == {"tarifas/int/2027": "indisponivel"}
    months = Snapshots(spark, f"{folder}/collection_plan").read().where("reason = 'months'").head()["months"]
    assert months == ["01", "02"]

    # all of it is fetched: nothing is left, and running again changes nothing
    for turn in range(2):
        fetched = _got(spark, plan) if not turn else None
        assert _plan(runs.collect(spark, folder, offer, fetched, **seen)) == []
        states = _states(spark, folder)
        assert states["tarifas/dom/2026"] == states["siros/voos"] == "inalterado" and states["basica/202601"] == "novo"
    assert Snapshots(spark, f"{folder}/pages").read().head()["swept"] == "10/02/2026"

    # another size while the page has its old date is not looked at; with a new date it is, until the fetch succeeds
    larger, same_page = _seen(spark, sizes=11)
    assert _plan(runs.collect(spark, folder, larger, **same_page)) == []
    assert _plan(runs.collect(spark, folder, larger, forced=True, **same_page)) == [("basica", "202602", "size"), ("siros", "voos", "announced")]
    larger, new_page = _seen(spark, updated="11/02/2026", sizes=11)
    again = [("basica", "202602", "size")]
    assert _plan(runs.collect(spark, folder, larger, **new_page)) == again
    assert Snapshots(spark, f"{folder}/pages").read().head()["swept"] == "10/02/2026"
    broken = _got(spark, again, 11, broken=["basica/202602"])
    assert _plan(runs.collect(spark, folder, larger, broken, **new_page)) == [] and _states(spark, folder)["basica/202602"] == "erro"
    # a ref that failed is no longer known, so it is not a size that moved; a backfill finds it
    assert _plan(runs.collect(spark, folder, larger, backfill=True, **new_page)) == [("basica", "201912", "backfill"), ("basica", "202602", "backfill")]
    good = _got(spark, again, 11)
    assert _plan(runs.collect(spark, folder, larger, good, **new_page)) == [] and _states(spark, folder)["basica/202602"] == "republicado"


def test_schedule_and_fare_rules(spark, folder):
    offer, seen = _seen(spark)
    plan = _plan(runs.collect(spark, folder, offer, **seen))
    runs.collect(spark, folder, offer, _got(spark, plan), **seen)
    # a listing without the schedule announces nothing, so the size decides, and there is none
    _, unlisted = _seen(spark, listed=(("other.zip", "2/1/2026 1:00 AM", 7),))
    assert _plan(runs.collect(spark, folder, offer, **unlisted)) == [("siros", "voos", "announced")]
    _, moved = _seen(spark, listed=(("VOOS.ZIP", "2/2/2026 1:00 AM", 7),))
    assert _plan(runs.collect(spark, folder, offer, **moved)) == [("siros", "voos", "announced")]
    # a table that nobody opened
    later = {**seen, "publications": None}
    assert _plan(runs.collect(spark, folder, offer, **later)) == [("tarifas/dom", "2026", "look"), ("tarifas/int", "2027", "look")]
    # one month with another time
    other = seen["publications"].withColumn("published_at", F.regexp_replace("published_at", "^01/05", "02/05"))
    assert _plan(runs.collect(spark, folder, offer, **{**seen, "publications": other})) == [("tarifas/dom", "2026", "months")]
    book = Snapshots(spark, f"{folder}/collection_plan").read()
    assert [r["months"] for r in book.collect()] == [["02"]]
    # all years above the floor
    assert _plan(runs.collect(spark, folder, offer, complete=True, **{**seen, "publications": other})) == [("tarifas/dom", "2026", "months")]
    assert _states(spark, folder)["tarifas/int/2026"] == "indisponivel"


def test_states_of_what_was_fetched(spark):
    known = spark.createDataFrame(
        [("siros/voos", "a", None), ("basica/1", "a", None), ("tarifas/dom/2026", "a", {"01": "x"}), ("tarifas/int/2026", "a", None)],
        "key string, impressao string, meses map<string,string>")
    fetched = spark.createDataFrame([
        ("siros/voos", "b", None, None), ("basica/1", "b", None, None), ("basica/2", "b", None, None), ("basica/3", "b", "erro", None),
        ("tarifas/dom/2026", "b", None, {"01": "x"}), ("tarifas/int/2026", "a", None, {"01": "x"}), ("tarifas/dom/2025", "b", "indisponivel", {"01": "x"}), ("tarifas/dom/2024", "b", None, {}),
    ], "key string, impressao string, failure string, meses map<string,string>")
    found = {r["key"]: r["situacao"] for r in collection.classified(fetched, known).collect()}
    assert found == {
        "siros/voos": "atualizado", "basica/1": "republicado", "basica/2": "novo", "basica/3": "erro", "tarifas/dom/2026": "inalterado",
        "tarifas/int/2026": "novo", "tarifas/dom/2025": "indisponivel", "tarifas/dom/2024": "indisponivel"}


def test_status_run_and_forgetting(spark, folder):
    offer, seen = _seen(spark)
    plan = _plan(runs.collect(spark, folder, offer, **seen))
    runs.collect(spark, folder, offer, _got(spark, plan, broken=["basica/202605"]), **seen)
    rows = {r["segment"]: r for r in runs.report(spark, folder, offer).collect()}
    basica, fares = rows["basica"], rows["tarifas/dom"]
    assert (basica["ref"], basica["tracked"], basica["collected"], basica["problems"], basica["total"], basica["first"]) == ("202604", 5, 4, 1, 6, "201912")
    assert (fares["fare_month"], fares["fare_published_at"], fares["total"]) == ("202602", "01/05/2026 09:00", None)
    assert rows["tarifas/int"]["ref"] is None and rows["tarifas/int"]["problems"] == 1
    assert {r["key"]: r["situacao"] for r in Snapshots(spark, f"{folder}/to_look_at").read().collect()} == {"basica/202605": "erro", "tarifas/int/2027": "indisponivel"}
    assert Snapshots(spark, f"{folder}/status").version() == 1
    tracked = Snapshots(spark, f"{folder}/manifest").read().count()
    # the newest tracked leg month is the one that failed, with the schedule and the domestic fares of its year
    assert runs.forget(spark, folder, date(2026, 5, 1)) == 3
    assert runs.forget(spark, folder, date(2026, 5, 1), keys=spark.createDataFrame([("tarifas/int/2027",)], "key string")) == 1
    assert runs.forget(spark, folder, date(2026, 5, 1), year=2026) == tracked - 4
    assert runs.report(spark, folder, offer).select(F.sum("tracked")).head()[0] == 0


@pytest.mark.parametrize("rows", [[], [("", "x")]])
def test_status_of_little(spark, rows):
    known = spark.createDataFrame([(k, s) for k, s in rows], "key string, situacao string")
    for name, kind in state.FIELDS.items():
        if name not in known.columns:
            known = known.withColumn(name, F.lit(None).cast(kind))
    offer = spark.createDataFrame([], "segment string, ref string, bytes bigint")
    assert state.status(known, offer).count() == len(rows)
