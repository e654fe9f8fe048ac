"""Routed tables, two writers, counts of runs, and months that rates and dimensions open again."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, date, datetime
from pathlib import Path

import pytest
from skyledger import layout as L
from skyledger.plans import history, runs
from skyledger.sinks.tables import ConcurrentWrite, Snapshots, read_routed, write_routed
from skyledger.sources import archives
from tests.test_plans import fare, flight
from tests.test_runs import inbox, land_all, month, put, root, schedule_file  # noqa: F401


def _rows(frame, *names):
    return sorted(tuple(row[name] for name in names) for row in frame.collect())


def test_routed_tables(spark, folder):
    ddl = "key string, v int"
    first = [("basica/202601", 1), ("basica/202602", 2), ("siros/voos", 3), ("siros/old", 4), ("siros/mensal/2026-01", 5)]
    assert write_routed(spark.createDataFrame(first, ddl), folder) == ["movimentacao", "siros", "siros_mensal"]
    second = [("basica/202602", 7), ("combinada/202602", 8), ("siros/voos", 9), ("siros/mensal/2026-02", 6)]
    write_routed(spark.createDataFrame(second, ddl), folder)
    assert _rows(read_routed(spark, folder, "movimentacao", "accumulate"), "key", "v") == [("basica/202601", 1), ("basica/202602", 7), ("combinada/202602", 8)]
    assert _rows(read_routed(spark, folder, "siros", "replace"), "key", "v") == [("siros/voos", 9)]
    assert _rows(read_routed(spark, folder, "siros_mensal", "accumulate"), "key", "v") == [("siros/mensal/2026-01", 5), ("siros/mensal/2026-02", 6)]
    # an unknown origin stops the write before anything is changed
    with pytest.raises(Exception, match="no route for other/1"):
        write_routed(spark.createDataFrame([("basica/202601", 0), ("other/1", 0)], ddl), folder)
    assert read_routed(spark, folder, "movimentacao", "accumulate").where("v = 0").count() == 0
    assert write_routed(spark.createDataFrame([], ddl), folder) == []
    # raw rows of a frozen month replace the table of the schedule's raw rows
    write_routed(spark.createDataFrame([("siros/voos", 1)], ddl), f"{folder}/raw", "raw")
    write_routed(spark.createDataFrame([("siros/mensal/2026-01", 2)], ddl), f"{folder}/raw", "raw")
    assert _rows(read_routed(spark, f"{folder}/raw", "siros_raw", "replace"), "v") == [(2,)]


def test_of_two_writers_one_wins(spark, folder):
    one, other = Snapshots(spark, folder + "/t"), Snapshots(spark, folder + "/t")
    one.replace(spark.range(3))
    assert other.read().count() == 3
    one.replace(one.read().where("id > 0"))
    with pytest.raises(ConcurrentWrite):
        other.replace(spark.range(10))
    assert other.read().count() == 2 and other.version() == 2
    other.replace(spark.range(5))  # what is there now has been read
    assert one.read().count() == 5 and one.version() == 3

    # a writer that stops half way leaves a name and no version
    (Path(folder) / "t/names/v4").write_text("v4")
    one.replace(spark.range(2))
    assert one.version() == 4 and one.read().count() == 2 and list(Path(folder, "t").glob("v4-*"))
    assert one.retire(1) == 3 and one.read().count() == 2 and one.version() == 4


def test_writers_at_the_same_time(spark, folder):
    Snapshots(spark, folder + "/t").replace(spark.range(1))
    books = [Snapshots(spark, folder + "/t") for _ in range(4)]
    assert {book.version() for book in books} == {1}

    def write(book: Snapshots) -> bool:
        try:
            book.replace(spark.range(9))
            return True
        except ConcurrentWrite:
            return False

    with ThreadPoolExecutor(4) as pool:
        won = list(pool.map(write, books))
    assert any(won) and Snapshots(spark, folder + "/t").version() == 2
    assert Snapshots(spark, folder + "/t").read().count() == 9


def test_a_month_that_loses_matches(spark, folder):
    ddl = "year int, month int, Tipo string, `Tkt Avg` double"
    full = [(2026, 1, "DEP", 1.0), (2026, 1, "ARR", 1.0), (2026, 2, "DEP", 2.0), (2026, 3, "DEP", 1.0), (2026, 3, "ARR", None)]
    history.note(spark.createDataFrame(full, ddl), f"{folder}/h", datetime(2026, 5, 1, tzinfo=UTC))
    later = [(2026, 1, "DEP", 1.0), (2026, 1, "ARR", None), (2026, 2, "DEP", 2.0), (2026, 3, "DEP", 1.0)]
    history.note(spark.createDataFrame(later, ddl), f"{folder}/h", datetime(2026, 5, 2, tzinfo=UTC))
    rows = history.compared(history.history(spark, f"{folder}/h"))
    told = {(r["run"].day, r["month"]): (r["share"], r["share_before"], r["fell"]) for r in rows.collect()}
    assert told == {
        (1, 1): (1.0, None, False), (1, 2): (1.0, None, False), (1, 3): (0.5, None, False),
        (2, 1): (0.5, 1.0, True), (2, 2): (1.0, 1.0, False), (2, 3): (1.0, 0.5, True)}  # the last lost a row


def _international(box, rate_month, m):
    put(box, f"int{m}.zip", f"INTERNACIONAL_2026-{m:02d}.CSV", L.FARE_RAW, fare(nr_mes_referencia=str(rate_month), nr_tarifa="100.0", sg_icao_destino="KMIA", cd_classe_ida="Y"))


def test_rates_and_dimensions_open_months_again(spark, root):
    first = inbox(root, "in1")
    for m in (1, 2):
        month(first, m)
    _international(first, 1, 1)
    land_all(spark, root, first)
    assert runs.fill_in(spark, root)["rows"] == 8 and runs.fill_in(spark, root)["rows"] == 0
    assert [tuple(r) for r in Snapshots(spark, f"{root}/rate_use").read().select("month", "rate_key").collect()] == [(1, "2026 - 01")]
    before = spark.read.parquet(f"{root}/fares").where("kind = 'int'").head()["Tkt Max"]
    # a rate that no month needs opens none; the rate of a month opens that month
    runs.land_rates(spark, root, spark.createDataFrame([('{"value":[{"VALDATA":"2026-02-01","VALVALOR":5.0}]}',)], "value string"))
    assert runs.fill_in(spark, root)["rows"] == 0
    runs.land_rates(spark, root, spark.createDataFrame([('{"value":[{"VALDATA":"2026-01-01","VALVALOR":11.0}]}',)], "value string"))
    assert runs.fill_in(spark, root)["rows"] == 4
    assert spark.read.parquet(f"{root}/fares").where("kind = 'int'").head()["Tkt Max"] == pytest.approx(2 * before, abs=0.01)
    assert runs.fill_in(spark, root)["rows"] == 0
    # another airport opens every month with movements
    airports = "`OD ICAO` string, `OD IATA` string, `State/Country` string, Region string, `UTC Offset` string, line bigint"
    spark.createDataFrame([("SBGR", "GRU", "Brazil", "Southeast", "-03:00", 3)], airports).write.mode("append").parquet(f"{root}/dims/airports")
    assert runs.fill_in(spark, root)["rows"] == 8 and runs.fill_in(spark, root)["rows"] == 0
    assert history.history(spark, f"{root}/history").count() == 5 and runs.fallen(spark, root).count() == 0


def test_exports_of_a_run(spark, root):
    first = inbox(root, "in1")
    month(first, 1)
    land_all(spark, root, first)
    runs.fill_in(spark, root)
    runs.export(spark, root, f"{root}/out", year=2026)
    written = [p.read_bytes().decode("utf-8-sig").split("\n")[0] for p in Path(root, "out/mart/year=2026/month=1").glob("*.csv")]
    assert written and all(head.split(";") == [f'"{n}"' if '"' in n else n for n in L.MART_COLUMNS] for head in written)
    runs.export(spark, root, f"{root}/none", year=1999)
    assert not list(Path(root, "none").rglob("*.csv"))


def test_a_day_in_one_run(spark, root, monkeypatch):
    first = inbox(root, "in1")
    month(first, 1)
    schedule_file(first, flight())
    today = date(2026, 3, 10)
    files = lambda: archives.files(spark, str(first))
    done = runs.daily(spark, root, files(), today)
    assert done["land"] == 3 and done["land_schedule"] and done["fill_in"]["rows"] == 4 and done["running_year"] == {"after_cutoff": 2, "added": 2}
    assert done["failed"] == []
    again = runs.daily(spark, root, files(), today)
    assert (again["land"], again["land_schedule"], again["fill_in"]["rows"]) == (0, False, 0)
    # a step that fails is noted, and the others go on
    monkeypatch.setattr(runs, "refresh_schedule", lambda *_: 1 / 0)
    broken = runs.daily(spark, root, files(), today)
    assert broken["failed"] == ["refresh_schedule"] and broken["running_year"] == {"after_cutoff": 2, "added": 2}
    assert spark.read.parquet(f"{root}/run_issues").where("path = 'refresh_schedule'").count() == 1
    assert "running_year" not in runs.daily(spark, root, files(), today, year=2025)
