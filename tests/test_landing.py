"""Landing: what is opened, which publication counts, and text that is parsed after the split."""

from __future__ import annotations

import csv
import io
import os
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.plans import runs
from skyledger.sinks.tables import Snapshots
from skyledger.sources import archives
from skyledger.streaming.landing import land_new_files
from tests.test_files import pack
from tests.test_plans import flight, leg
from tests.test_runs import inbox, land_all, put, root, schedule_file  # noqa: F401


def _legs(spark, root):
    return sorted(r["nr_voo"] for r in spark.read.parquet(f"{root}/landed/legs").collect())


def _put(folder, name, number, when, member="basica2026-01.txt"):
    put(folder, name, member, L.LEG_RAW, leg(nr_voo=number))
    os.utime(folder / name, (when, when))


def test_a_second_landing_opens_nothing(spark, root, monkeypatch):
    first = inbox(root, "in1")
    _put(first, "a.zip", "1", 1_500_000_000)
    (first / "page.zip").write_bytes(b"<html>")
    opened = []
    plain = archives.reread
    monkeypatch.setattr(archives, "reread", lambda spark, paths: opened.append(sorted(p.rsplit("/", 1)[-1] for p in paths)) or plain(spark, paths))
    assert land_all(spark, root, first) == 1
    assert opened == [["a.zip", "page.zip"], ["a.zip"]]
    for _ in range(2):
        assert land_all(spark, root, first) == 0
    assert len(opened) == 2 and spark.read.parquet(f"{root}/run_issues").count() == 1
    # the same path with other content is opened, and no other
    _put(first, "a.zip", "22", 1_600_000_000)
    assert land_all(spark, root, first) == 1 and opened[2:] == [["a.zip"], ["a.zip"]]
    assert _legs(spark, root) == ["22"]
    # names with marks of patterns
    _put(first, "b[1]{x}*.zip", "3", 1_700_000_000)
    assert land_all(spark, root, first) == 1 and _legs(spark, root) == ["3"]


def test_an_older_publication_lands_nothing_later(spark, root):
    boxes = [inbox(root, f"in{k}") for k in range(6)]
    _put(boxes[0], "a.zip", "1", 1_700_000_000)
    _put(boxes[1], "b.zip", "2", 1_600_000_000)  # older, and it comes later
    _put(boxes[2], "c.zip", "3", 1_800_000_000, "basica202601.txt")  # newer, but the plain name goes behind
    _put(boxes[3], "d.zip", "1", 1_900_000_000)  # the content known, published anew
    _put(boxes[4], "e.zip", "5", 1_850_000_000)  # newer than the first, older than that
    _put(boxes[5], "f.zip", "6", 1_950_000_000)
    assert [land_all(spark, root, box) for box in boxes] == [1, 0, 0, 0, 0, 1]
    assert _legs(spark, root) == ["6"]
    entry = Snapshots(spark, f"{root}/index").read().head()
    assert entry["dashed"] and entry["modified"].year == 2031


def test_batches_of_a_stream_in_the_wrong_order(spark, root, folder):
    box = inbox(root, "in1")
    for name, number, when in (("a.zip", "1", 1_700_000_000), ("b.zip", "2", 1_600_000_000)):
        _put(box, name, number, when)
        land_new_files(spark, str(box), root, f"{root}/ck").awaitTermination(120)
    assert _legs(spark, root) == ["1"]


def test_a_known_schedule_is_not_opened(spark, root, monkeypatch):
    plans = inbox(root, "in1")

    def publish(name, number, when):
        (plans / name).mkdir(exist_ok=True)
        schedule_file(plans / name, flight(flight=number))
        os.utime(plans / name / "voos.zip", (when, when))

    def land():
        return runs.land_schedule(spark, root, archives.files(spark, str(plans)))

    publish("a", "8", 1_700_000_000)
    assert land()
    monkeypatch.setattr(archives, "archive_members", lambda *_: pytest.fail("opened"))
    assert not land()
    monkeypatch.undo()
    publish("b", "9", 1_600_000_000)  # an older one
    assert not land()
    publish("c", "8", 1_800_000_000)  # the same content
    assert not land()
    publish("d", "10", 1_900_000_000)
    assert land()
    landed = Snapshots(spark, f"{root}/landed/schedule")
    assert landed.version() == 2 and [r[L.SCHEDULE_RAW["flight"]] for r in landed.read().collect()] == ["10"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.text(alphabet=st.sampled_from('ab";\n é'), max_size=5), min_size=1, max_size=4), max_size=6), st.integers(1, 4))
def test_records_of_quoted_text(rows, step):
    out = io.StringIO()
    csv.writer(out, delimiter=";", lineterminator="\n", quoting=csv.QUOTE_ALL).writerows(rows)
    lines = out.getvalue().split("\n")
    found, counts, rest = [], [], None
    for at in range(0, len(lines), step):
        some, cells, rest = archives._records(lines[at : at + step], rest)
        found += some
        counts += cells
    assert rest is None and counts == [len(row) for row in rows]
    assert [next(csv.reader(io.StringIO(record), delimiter=";")) for record in found] == rows


def test_quotes_and_widths(spark, folder):
    body = 'a;"b";c\n"x;1";"say ""hi""";2\n"two\nlines";3;\n5" pipe;6" pipe;"q"\n;;\n\n"";NA;"NA"\nl;o;n;g\n'
    pack(Path(folder) / "z.zip", {"m.csv": body.encode(), "wide.csv": b"c;d;e;f;a\n1;2;3;4;5\n", "open.csv": b'a;c\n1;2\n3;"4\n5;6\n'})
    rows = archives.file_rows(archives.files(spark, folder), ["a", "c", "b"]).collect()
    got = [(r["line"], r["problem"], r["a"], r["b"], r["c"]) for r in sorted(rows, key=lambda r: r["line"] or 0) if r["member"] == "m.csv"]
    assert got == [
        (0, None, "x;1", 'say "hi"', "2"), (1, None, "two\nlines", "3", None), (2, None, '5" pipe', '6" pipe', "q"), (3, None, None, None, None),
        (4, None, None, None, None), (5, "too many cells", None, None, None)]
    assert [(r["a"], r["b"], r["c"]) for r in rows if r["member"] == "wide.csv"] == [("5", None, "1")]
    assert [(r["line"], r["problem"]) for r in rows if r["member"] == "open.csv" and r["problem"]] == [(None, "open quote")]


def test_a_record_has_a_bound(spark, folder, monkeypatch):
    monkeypatch.setattr(archives, "LONGEST", 50)
    monkeypatch.setattr(archives, "CHUNK", 16)
    pack(Path(folder) / "z.zip", {"m.csv": b'a;b\n1;"' + b"x\n" * 200 + b'"\n2;3\n', "n.csv": b"a;b\n" + b"".join(b"%d;y\n" % k for k in range(100))})
    rows = archives.file_rows(archives.files(spark, folder), ["a", "b"]).collect()
    assert [(r["problem"]) for r in rows if r["member"] == "m.csv"] == ["open quote"]
    assert sorted((r["line"], r["a"]) for r in rows if r["member"] == "n.csv") == [(k, str(k)) for k in range(100)]


def test_a_huge_member_is_parsed_by_many_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(archives, "SPLIT", 64 << 10)
    line = ";".join(["text of a cell"] * 8)
    pack(Path(folder) / "in.zip", {"m.csv": "\n".join([";".join("abcdefgh")] + [f"{k};{line[15:]}" for k in range(400_000)]).encode()})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        rows = archives.file_rows(archives.files(spark, folder, "*.zip"), ["a", "h"])
        tasks = rows.groupBy(F.spark_partition_id().alias("task")).count().where("count > 1").count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tasks > 2 and rows.agg(F.count("a"), F.count_distinct("line"), F.max("h")).head()[:] == (400_000, 400_000, "text of a cell")
