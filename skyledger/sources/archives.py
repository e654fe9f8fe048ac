"""ZIP archives and bare delimited files to rows, in two steps.

Spark lists the files and hands each one to a task (``binaryFile``). Inside the task a member is only unpacked, turned into
UTF-8 and cut into numbered records, because Spark has no reader for ZIP files; what comes out is a table of text. It is
written before it is parsed, by Spark's ``from_csv``: a ZIP file cannot be split, its text can, so the records of a huge
member are parsed by as many tasks as they fill.
"""

from __future__ import annotations

import csv
import hashlib
import io
import re
import sys
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.numbers import null_tokens
from skyledger.operators.lookup import lookup_join
from skyledger.session import scratch_folder

# tasks get the functions below by value, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMBERS = (
    "path string, member string, bytes bigint, crc bigint, sha256 string, fingerprint string, status string"
)
_TARGETS = (".csv", ".txt")
#: Records of text: the header of a member has line -1, problems of a whole file have no line.
RECORDS = "path string, member string, line bigint, cells int, record string, header array<string>, problem string"
#: Characters that are read at once, and the longest record: a quote that is not closed by then makes its member unreadable.
CHUNK, LONGEST = 1 << 22, 1 << 20
#: Bytes of packed text in a row group: what a task can take at least.
SPLIT = 16 << 20
_QUOTED, _OPEN = r'(^|;)"(?:[^"]|"")*"', r'(^|;)"'
#: What reading a damaged member raises.
UNREADABLE = (zipfile.BadZipFile, zlib.error, EOFError, OSError, NotImplementedError, RuntimeError)


def files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Whole files."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def listed(files: DataFrame) -> DataFrame:
    """``path, modified, bytes`` of files: what a file system tells without opening one."""
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def reread(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """These files and no others, so none but these is opened."""
    return spark.read.format("binaryFile").load([re.sub(r"([\\{}\[\]*?^])", r"\\\1", path) for path in paths])


def _directory_hash(archive: zipfile.ZipFile) -> str:
    """Content hash of an archive from names, sizes and checksums, whatever the times in it."""
    entries = sorted((i.filename, i.file_size, i.CRC) for i in archive.infolist() if not i.is_dir())
    return hashlib.sha256("\n".join("|".join(map(str, entry)) for entry in entries).encode()).hexdigest()


def _open(content: bytes) -> tuple[zipfile.ZipFile | None, str]:
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
        return archive, "ok" if archive.namelist() else "empty"
    except (zipfile.BadZipFile, EOFError, OSError):
        return None, "bad_zip"


def _stream_hash(archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> str:
    """Content hash of a member, read as a stream; reading to its end also tests its checksum."""
    digest = hashlib.sha256()
    with archive.open(info) as stream:
        while chunk := stream.read(1 << 20):
            digest.update(chunk)
    return digest.hexdigest()


def _targets(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    return [i for i in archive.infolist() if not i.is_dir() and i.filename.lower().endswith(_TARGETS)]


def archive_members(archives: DataFrame) -> DataFrame:
    """One row per data member of each archive, or one row that tells why there is none.

    ``sha256`` is the content of the member, ``fingerprint`` that of the whole archive. A bare file
    is its own only member. A member whose checksum fails makes its archive ``corrupt_member``. Other
    columns of ``archives``, such as the time of a file, are kept.
    """
    kept = [name for name in archives.columns if name not in ("path", "content", "length")]
    kinds = dict(archives.dtypes)
    fields = MEMBERS + "".join(f", `{name}` {kinds[name]}" for name in kept)

    def found(path: str, body: bytes) -> list[tuple]:
        if path.lower().endswith(_TARGETS):
            own = hashlib.sha256(body).hexdigest()
            return [(path.rsplit("/", 1)[-1], len(body), None, own, own, "ok")]
        archive, status = _open(body)
        digest = _directory_hash(archive) if archive else None
        if status == "ok":
            targets = _targets(archive)
            try:
                rows = [
                    (info.filename.rsplit("/", 1)[-1], info.file_size, info.CRC, _stream_hash(archive, info), digest, "ok")
                    for info in targets
                ]
            except UNREADABLE:
                rows, status = [], "corrupt_member"
            else:
                status = "no_target"
            if rows:
                return rows
        return [(None, None, None, None, digest, status)]

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        names = ["path", "member", "bytes", "crc", "sha256", "fingerprint", "status"]
        for batch in batches:
            for at in range(batch.num_rows):
                path = batch.column("path")[at].as_py()
                rows = [(path, *row) for row in found(path, batch.column("content")[at].as_py())]
                columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
                same = [batch.column(name).take(pa.array([at] * len(rows))) for name in kept]
                yield pa.RecordBatch.from_arrays([*columns, *same], names=[*names, *kept])

    return archives.select("path", "content", *kept).mapInArrow(members, fields)


def _cells(lines: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Cells of each line, and whether it ends inside of a quoted cell."""
    bare = pc.replace_substring_regex(lines, _QUOTED, r"\1")
    return pc.add(pc.count_substring(bare, ";"), 1), pc.match_substring_regex(bare, _OPEN)


def _records(lines: list[str], before: str | None) -> tuple[list[str], list[int], str | None]:
    """Records of some lines that follow an unfinished one, their cells, and what is unfinished at their end."""
    if before is None and not any('"' in line for line in lines):
        kept = [line for line in lines if line]
        return kept, pc.add(pc.count_substring(pa.array(kept, pa.large_string()), ";"), 1).to_pylist(), None
    cells, unfinished = (column.to_pylist() for column in _cells(pa.array(lines, pa.large_string())))
    records, counts = [], []
    for line, n, more in zip(lines, cells, unfinished):
        if before is not None:
            line = f"{before}\n{line}"
            n, more = (column[0].as_py() for column in _cells(pa.array([line], pa.large_string()))) if '"' in line[len(before) :] else (0, True)
            before = None
        if more:
            if len(line) > LONGEST:
                raise ValueError("open quote")
            before = line
        elif line:
            records.append(line)
            counts.append(n)
    return records, counts, before


def records(source: DataFrame, encoding: str = "cp1252", skip: int = 0, required: Sequence[str] = ()) -> DataFrame:
    """The text of all data members of archives, and of bare files, cut into records (``RECORDS``).

    A record ends with a line unless a quoted cell is open there; empty lines are none. A record too long to hold and a
    quote that is never closed are problems of their member, like a member that cannot be read or decoded. With a column
    ``members`` in ``source`` only the members named there are read.
    """
    chosen = "members" in source.columns
    schema = pa.schema([
        ("path", pa.string()), ("member", pa.string()), ("line", pa.int64()), ("cells", pa.int32()), ("record", pa.string()),
        ("header", pa.list_(pa.string())), ("problem", pa.string()),
    ])

    def streams(path: str, content: bytes):
        if path.lower().endswith(_TARGETS):
            yield path.rsplit("/", 1)[-1], io.BytesIO(content), None
            return
        archive, status = _open(content)
        targets = _targets(archive) if status == "ok" else []
        if not targets:
            yield None, None, "no_target" if status == "ok" else status
        for info in targets:
            yield info.filename.rsplit("/", 1)[-1], archive.open(info), None

    def member_records(path: str, member: str, stream) -> Iterator[pa.RecordBatch]:
        text = io.TextIOWrapper(stream, encoding, newline=None)
        for _ in range(skip):
            text.readline()
        header = [name.strip() for name in next(csv.reader([text.readline()], delimiter=";"), [])]
        lacking = [name for name in required if name not in header]
        if lacking:
            raise ValueError(f"missing columns: {', '.join(lacking)}")
        yield pa.RecordBatch.from_pylist([{"path": path, "member": member, "line": -1, "header": header}], schema)
        line, rest, unfinished, last = 0, "", None, False
        while header and not last:
            chunk = text.read(CHUNK)
            last = not chunk
            lines = (rest + chunk).split("\n")
            rest = "" if last else lines.pop()
            found, cells, unfinished = _records(lines, unfinished)
            n = len(found)
            for at in range(0, n, 1 << 16):
                part = slice(at, at + (1 << 16))
                size = len(found[part])
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(path, size), pa.repeat(member, size), pa.array(range(line + at, line + at + size), pa.int64()),
                    pa.array(cells[part], pa.int32()), pa.array(found[part], pa.string()), pa.nulls(size, schema.field("header").type), pa.nulls(size, pa.string()),
                ], schema=schema)
            line += n
        if unfinished is not None:
            raise ValueError("open quote")
        if not line:
            raise ValueError("no rows")

    def rows(path: str, content: bytes, wanted: set[str] | None) -> Iterator[pa.RecordBatch]:
        for member, stream, trouble in streams(path, content):
            if wanted is not None and member is not None and member not in wanted:
                continue
            if not trouble:
                try:
                    yield from member_records(path, member, stream)
                except UnicodeDecodeError:
                    trouble = "undecodable"
                except UNREADABLE:
                    trouble = "unreadable"
                except ValueError as error:
                    trouble = str(error).splitlines()[0]
            if trouble:
                yield pa.RecordBatch.from_pylist([{"path": path, "member": member, "problem": trouble}], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                wanted = set(batch.column("members")[at].as_py() or ()) if chosen else None
                yield from rows(batch.column("path")[at].as_py(), batch.column("content")[at].as_py(), wanted)

    return source.select("path", "content", *["members"] * chosen).mapInArrow(run, RECORDS)


def parsed(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Records that have been written, as text columns by header name: ``path, member, line, problem`` and ``columns``.

    The widest header is looked up first; each record is parsed once, into as many cells, and the places of the
    columns come with the header of its member.
    """
    headers = stored.where("line = -1").select("path", "member", F.size("header").alias("_width"), *[
        F.array_position("header", name).cast("int").alias(f"_at{i}") for i, name in enumerate(columns)
    ])
    width = headers.agg(F.max("_width")).head()[0] or 1
    cells = ", ".join(f"c{k} string" for k in range(width))
    row = F.from_csv("record", cells, {"sep": ";", "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    found = stored.where("line >= 0").select("path", "member", "line", "cells", row.alias("_row"))
    found = found.select("path", "member", "line", "cells", F.array(*[F.col(f"_row.c{k}") for k in range(width)]).alias("_cells"))
    placed = lookup_join(found, headers, {"path": "path", "member": "member"}, "inner")
    problem = F.when(F.col("cells") > F.col("_width"), "too many cells")
    values = [
        null_tokens(F.when(F.col("problem").isNull(), F.get("_cells", F.col(f"_at{i}") - 1))).alias(name) for i, name in enumerate(columns)
    ]
    good = placed.withColumn("problem", problem).select("path", "member", "line", "problem", *values)
    whole = stored.where(F.col("problem").isNotNull()).select("path", "member", "line", "problem")
    return good.unionByName(whole, allowMissingColumns=True)


def file_rows(
    source: DataFrame, columns: Sequence[str], encoding: str = "cp1252", skip: int = 0, required: Sequence[str] = (), place: str | None = None
) -> DataFrame:
    """Rows of all data members of archives, and of bare files, as text columns by header name.

    Adds ``path``, ``member``, ``line`` (position below the header, from 0) and ``problem``. A row with a
    problem has no values; its ``line`` is null if the problem is that of a whole file: an archive that
    cannot be opened, a member that cannot be read or decoded to its end, that has no rows, or that
    lacks one of the ``required`` columns. One bad file never stops the others. A short line is filled
    up with nulls, a line with too many cells is a problem. With a column ``members`` in ``source`` only
    the members named there are read. The text is written to ``place``, or a new folder of the shared one.
    """
    spark = source.sparkSession
    path = place or scratch_folder(spark, "records")
    text = records(source, encoding, skip, required)
    writing = text.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    writing.option("parquet.block.size", SPLIT).parquet(path)
    return parsed(spark.read.schema(RECORDS).parquet(path), list(columns))


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("problem").isNull()).drop("problem")


def run_issues(rows: DataFrame) -> DataFrame:
    """Problems per file: the run goes on, and is judged by this table at its end."""
    return rows.where(F.col("problem").isNotNull()).groupBy("path", "member", "problem").agg(F.count("*").alias("lines"))
