from __future__ import annotations

import hashlib
import zipfile
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyledger.operators.shape import trimmed_header
from skyledger.sinks.tables import BOM, NothingToWrite, Snapshots, exists, export_text, rate_table, write_periods
from skyledger.sources import archives, landing, pages, tables


def pack(path: Path, members: dict[str, bytes], when=(2026, 1, 1, 0, 0, 0)) -> Path:
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in members.items():
            archive.writestr(zipfile.ZipInfo(name, when), body)
    return path


def members_of(spark, folder):
    return {r["path"].rsplit("/", 1)[-1]: r for r in archives.archive_members(archives.files(spark, folder)).collect()}


def test_status_of_archives(spark, folder):
    root = Path(folder)
    pack(root / "ok.zip", {"d/": b"", "d/a.TXT": b"x", "b.pdf": b"y"})
    pack(root / "none.zip", {"b.pdf": b"y"})
    pack(root / "empty.zip", {})
    (root / "page.zip").write_bytes(b"<html>error</html>")
    broken = bytearray(pack(root / "broken.zip", {"a.csv": b"hello hello hello" * 50}).read_bytes())
    broken[45] ^= 0xFF
    (root / "broken.zip").write_bytes(bytes(broken))
    got = members_of(spark, folder)
    assert {name: r["status"] for name, r in got.items() if name != "broken.zip"} == {
        "ok.zip": "ok", "none.zip": "no_target", "empty.zip": "empty", "page.zip": "bad_zip"}
    assert got["broken.zip"]["status"] in ("corrupt_member", "bad_zip")
    assert (got["ok.zip"]["member"], got["ok.zip"]["bytes"]) == ("a.TXT", 1)


def test_fingerprint_ignores_times_and_order(spark, folder):
    root = Path(folder)
    pack(root / "a.zip", {"x.csv": b"1", "y.csv": b"2"})
    pack(root / "b.zip", {"y.csv": b"2", "x.csv": b"1"}, (2027, 5, 5, 1, 1, 0))
    pack(root / "c.zip", {"x.csv": b"1", "y.csv": b"3"})
    rows = archives.archive_members(archives.files(spark, folder)).select("path", "fingerprint").distinct().collect()
    prints = {r["path"][-5]: r["fingerprint"] for r in rows}
    assert prints["a"] == prints["b"] != prints["c"]
    crc = [(n, 1, zlib.crc32(b)) for n, b in (("x.csv", b"1"), ("y.csv", b"2"))]
    assert prints["a"] == hashlib.sha256("\n".join(f"{n}|{s}|{c}" for n, s, c in crc).encode()).hexdigest()


def test_rows_by_header_name(spark, folder):
    root = Path(folder)
    text = "b ; a;x\r\nsão – 1;NA;9\r\n\"q;r\";2;9\r\nshort\r\n1;2;3;4\r\nNAN; ;\r\n"
    pack(root / "z.zip", {"in/m.csv": text.encode("cp1252"), "e.csv": b"", "h.txt": b"a;b\r\n"})
    (root / "bare.txt").write_bytes("a;b\nü;null\n".encode("cp1252"))
    (root / "bad.zip").write_bytes(b"no")
    rows = archives.file_rows(archives.files(spark, folder), ["a", "b", "gone"]).collect()
    good = sorted((r["member"], r["a"], r["b"], r["gone"]) for r in rows if r["problem"] is None and r["member"] == "m.csv" and r["a"] is not None)
    assert good == [("m.csv", " ", "NAN", None), ("m.csv", "2", "q;r", None)]
    assert ("m.csv", None, "são – 1") in [(r["member"], r["a"], r["b"]) for r in rows]
    assert ("m.csv", None, "short") in [(r["member"], r["a"], r["b"]) for r in rows]
    assert [(r["a"], r["b"]) for r in rows if r["member"] == "bare.txt"] == [("ü", None)]
    issues = archives.run_issues(archives.file_rows(archives.files(spark, folder), ["a"])).collect()
    assert sorted((r["path"].rsplit("/", 1)[-1], r["problem"], r["lines"]) for r in issues) == [
        ("bad.zip", "bad_zip", 1), ("z.zip", "no rows", 1), ("z.zip", "no rows", 1), ("z.zip", "too many cells", 1)]
    lines = {r["line"]: r["problem"] for r in rows if r["member"] == "m.csv"}
    assert lines == {0: None, 1: None, 2: None, 3: "too many cells", 4: None}


def test_one_bad_file_stops_no_other(spark, folder):
    pack(Path(folder) / "z.zip", {
        "ok.csv": b"a;b\r\n1;2\r\n", "byte.csv": b"a;b\r\n1;\x81\r\n", "less.csv": b"a\r\n1\r\n", "empty.csv": b"a;b\r\n", "skipped.csv": b"a;b\r\n8;8\r\n"})
    source = archives.files(spark, folder).withColumn("members", F.array(*map(F.lit, ["ok.csv", "byte.csv", "less.csv", "empty.csv"])))
    rows = archives.file_rows(source, ["a", "b"], required=["a", "b"]).collect()
    assert sorted((r["member"], r["a"], r["problem"], r["line"]) for r in rows if r["member"] == "ok.csv") == [("ok.csv", "1", None, 0)]
    assert {r["member"]: (r["problem"], r["line"]) for r in rows if r["problem"]} == {
        "byte.csv": ("undecodable", None), "less.csv": ("missing columns: b", None), "empty.csv": ("no rows", None)}


def test_lines_keep_their_place(spark, folder):
    body = "a;b\n" + "".join("1;2;3\n" if k % 1000 == 7 else "short\n" if k % 500 == 9 else f"{k};x\n" for k in range(300_000))
    pack(Path(folder) / "z.zip", {"m.csv": body.encode()})
    rows = archives.file_rows(archives.files(spark, folder), ["a", "b"])
    assert rows.where("b = 'x' and cast(a as bigint) <> line").count() == 0
    assert rows.where("a = 'short' and line % 500 <> 9 or problem is not null and line % 1000 <> 7").count() == 0
    assert rows.select("line").distinct().count() == 300_000


def test_large_member_comes_in_batches(spark, folder):
    lines = "a;b\n" + "".join(f"{i};v{i}\n" for i in range(200_000))
    pack(Path(folder) / "z.zip", {"m.csv": lines.encode()})
    rows = archives.good_rows(archives.file_rows(archives.files(spark, folder), ["a", "b"]))
    row = rows.agg(F.count("*"), F.sum(F.col("a").cast("bigint")), F.count_distinct("line"), F.max("line")).head()
    assert tuple(row) == (200_000, sum(range(200_000)), 200_000, 199_999)


def test_schedule_file(spark, folder):
    path = Path(folder) / "voos.csv"
    path.write_bytes("﻿Aviso: dados previstos;x\nSigla ;Voo\nGLO;1000\nNA;\nTAM;2\n".encode("utf-8"))
    rows = tables.schedule_file(spark, str(path))
    assert rows.columns == ["Sigla", "Voo"]
    assert sorted(map(tuple, rows.collect()), key=str) == [("GLO", "1000"), ("TAM", "2"), (None, None)]


def test_delimited(spark, folder):
    (Path(folder) / "a.csv").write_text(" k ;v\n1;NA\n2;x\n")
    rows = tables.delimited(spark, folder)
    assert rows.columns == ["k", "v", "file"] and sorted((r["k"], r["v"]) for r in rows.collect()) == [("1", None), ("2", "x")]
    (Path(folder) / "b.csv").write_text("v;k\n1;2\n")
    with pytest.raises(Exception):
        tables.delimited(spark, folder).collect()


def test_rates_file_and_payload(spark, folder):
    (Path(folder) / "rates.csv").write_text("KeyDolar;taxa\n2026 - 01;5,84\n2026 - 02;x\n2026 - 01;5.9\n")
    from skyledger.plans.dimensions import rates

    assert [(r.rate_key, str(r.rate)) for r in rates(tables.rates_file(spark, folder)).collect()] == [("2026 - 01", "5.900000")]
    doc = '{"value":[{"VALDATA":"2026-03-01T00:00:00-03:00","VALVALOR":5.5},{"VALDATA":"2026-04-01","VALVALOR":null},{"VALVALOR":1.0}]}'
    got = tables.rate_payload(spark.createDataFrame([(doc,)], "value string")).collect()
    assert [(r.rate_key, str(r.rate)) for r in got] == [("2026 - 03", "5.500000")]
    assert rate_table(spark.createDataFrame([("b", 1.23456789), ("a", 2.0)], "rate_key string, rate double")).collect()[0]["rate_key"] == "a"


def test_discover_prefers_the_dashed_name(spark):
    names = ["in/basica202605.txt", "in/basica2026-05.txt", "combinada202605.TXT", "202605 (1).CSV", "INTERNACIONAL_2025-12.CSV", "readme.txt", "voos.csv"]
    got = landing.discover(spark.createDataFrame([(n,) for n in names], "path string")).collect()
    assert sorted((r["kind"], r["year"], r["month"], r["path"]) for r in got) == [
        ("basica", 2026, 5, "in/basica2026-05.txt"), ("combinada", 2026, 5, "combinada202605.TXT"),
        ("tarifas/dom", 2026, 5, "202605 (1).CSV"), ("tarifas/int", 2025, 12, "INTERNACIONAL_2025-12.CSV")]


def test_discover_takes_the_newest_publication(spark):
    rows = [("b.zip", "basica2026-05.txt", 2), ("a.zip", "basica2026-05.txt", 1), ("c.zip", "basica202605.txt", 3), ("z.zip", "voos.csv", 9)]
    files = spark.createDataFrame(rows, "path string, member string, t int").withColumn("modificationTime", F.timestamp_seconds("t"))
    got = landing.discover(files, "member").collect()
    assert [(r["path"], r["member"]) for r in got] == [("b.zip", "basica2026-05.txt")]


def test_page_with_a_slash_at_its_end(spark):
    html = "<a href='x/basica2026-05.zip'>a</a><a href='../combinada202605.zip'>b</a>"
    pages_table = spark.createDataFrame([(1, html, "https://h.example/p/q/")], "id int, html string, url string")
    got = {r["segment"]: r["url"] for r in pages.inventory(pages_table, "id").collect()}
    assert got == {"basica": "https://h.example/p/q/x/basica2026-05.zip", "combinada": "https://h.example/p/combinada202605.zip"}


def test_pages(spark):
    html = ("<a href='x/basica2026-05.zip?v=1'>a</a><A HREF=\"/y/Basica202605.ZIP\">b</A><a href='combinada2026-05.zip'>c</a>"
            "<a href='basica.zip'>d</a><p>Atualizado  em: <b>01/02/2026</b> às 10:30</p><p>publicado em 1/1/2026</p>")
    page = spark.createDataFrame([(1, html, "https://h.example/p/q")], "id int, html string, url string")
    got = {r["segment"]: (r["ref"], r["url"]) for r in pages.inventory(page, "id").collect()}
    assert got == {"basica": ("202605", "https://h.example/y/Basica202605.ZIP"), "combinada": ("202605", "https://h.example/p/q/combinada2026-05.zip")}
    row = pages.page_dates(page, ["id"]).head()
    assert (row["published"], row["updated"]) == ("1/1/2026", "01/02/2026 10:30")
    assert pages.page_dates(page.withColumn("html", F.lit("none")), ["id"]).head()["updated"] is None


def test_snapshots(spark, folder):
    book = Snapshots(spark, folder + "/t")
    assert not book.present()
    with pytest.raises(NothingToWrite):
        book.replace(spark.range(0))
    assert not book.present()
    book.replace(spark.range(3))
    book.replace(book.read().where("id > 0"))  # made from itself
    assert book.read().count() == 2 and book.version() == 2
    with pytest.raises(NothingToWrite):
        book.replace(spark.range(0))
    assert book.read().count() == 2


def test_old_versions_are_retired(spark, folder):
    book = Snapshots(spark, folder + "/t")
    for n in range(1, 6):
        book.replace(spark.range(n))
    assert book.retire(2) == 3 and book.retire(2) == 0
    assert book.read().count() == 5 and not (Path(folder) / "t/v3").exists() and (Path(folder) / "t/v4").exists()


def test_a_damaged_table_is_not_an_absent_one(spark, folder):
    assert not exists(spark, folder + "/none")
    (Path(folder) / "bad").mkdir()
    (Path(folder) / "bad/part-0.parquet").write_bytes(b"this is no table at all")
    with pytest.raises(Exception):
        exists(spark, folder + "/bad")


def test_periods_are_replaced_one_by_one(spark, folder):
    path = folder + "/p"
    ddl = "year int, month int, v int"
    write_periods(spark.createDataFrame([(2026, 1, 1), (2026, 2, 2)], ddl), path)
    write_periods(spark.createDataFrame([(2026, 2, 3), (2026, 2, 4)], ddl), path)
    write_periods(spark.createDataFrame([], ddl), path)
    assert sorted((r["month"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 3), (2, 4)]


def test_export_text(spark, folder):
    df = spark.createDataFrame([(2026, 1, "é", 1)], "year int, month int, a string, `b c` int")
    export_text(df, folder + "/x", period=["year", "month"])
    written = next(Path(folder + "/x/year=2026/month=1").glob("*.csv")).read_bytes()
    assert written.decode("utf-8") == f"{BOM}a;b c\né;1\n"
    export_text(df.drop("year", "month"), folder + "/y", separator=",", bom=False)
    assert [tuple(r) for r in spark.read.csv(folder + "/y", header=True).collect()] == [("é", "1")]
    assert all(part.read_text().startswith("a,b c\n") for part in Path(folder + "/y").glob("*.csv"))


def test_trimmed_header(spark):
    assert trimmed_header(spark.createDataFrame([(1, 2)], "` a ` int, b int")).columns == ["a", "b"]
