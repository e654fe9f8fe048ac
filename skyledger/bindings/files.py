"""Archives made of the documents, taken apart again."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.bindings.raw import table
from skyledger.sources import archives

#: Bytes of archives that are handed on at once.
FULL = 1 << 20


def _archives(documents: DataFrame, body: Column, encoding: str = "utf-8") -> DataFrame:
    """One archive per document: a member under a folder, a file that is no table, and a folder.

    French members are no tables, and a Spanish archive is no archive. With an ``encoding`` other than UTF-8 a
    German member ends with a byte that the code page does not have, and that of every tenth document is empty.
    """

    def zipped(member: str, content: str) -> bytes:
        extra = b"\x81;\r\n" if encoding != "utf-8" and member.endswith(".de.csv") else b""
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("data/", "")
            archive.writestr(f"data/{member}", content.encode(encoding) + extra)
            archive.writestr("leia-me.pdf", b"%PDF")
        return out.getvalue()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, contents, size = [], [], 0
            for at in range(batch.num_rows):
                path, member, content, bare = (column[at].as_py() for column in batch.columns)
                paths.append(path)
                contents.append(content.encode() if bare else zipped(member, content))
                size += len(contents[-1])
                if size >= FULL or at == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], names=["path", "content"])
                    paths, contents, size = [], [], 0

    number = F.col("doc_id").cast("string")
    ending = F.when(F.col("lang") == "en", ".TXT").when(F.col("lang") == "fr", ".bin").otherwise(F.concat(F.lit("."), F.col("lang"), F.lit(".csv")))
    bare = F.coalesce(F.col("lang") == "es", F.lit(False))
    return documents.select(
        F.concat(F.lit("in/"), number, F.lit(".zip")).alias("path"), F.concat(F.lit("doc"), number, ending).alias("member"),
        F.when(bare, F.col("text")).otherwise(body).alias("content"), bare.alias("bare"),
    ).mapInArrow(packed, "path string, content binary")


def archive_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members, their content hash, and the status of every archive."""
    documents = table(spark, sf_dir, "documents")
    return archives.archive_members(_archives(documents, F.col("text"))).select("path", "member", "bytes", "sha256", "status")


def archive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of delimited members in a Windows code page, with their line: a full line, a line with null tokens, a short
    one and one with too many cells; members without rows and with a byte that cannot be decoded."""
    documents = table(spark, sf_dir, "documents")
    number = F.col("doc_id").cast("string")
    header = F.lit("língua ;doc; size;n")
    body = F.concat_ws(
        "\r\n", header, F.concat_ws(";", F.lit("são – é"), number, F.col("n_chars").cast("string"), F.col("source")),
        F.concat_ws(";", F.lit("NA"), number, F.lit(""), F.lit("NAN")), F.concat_ws(";", F.lit("short"), number),
        F.concat_ws(";", F.lit("long"), number, F.lit("3"), F.lit("4"), F.lit("5")), F.lit(""),
    )
    body = F.when(F.col("doc_id") % 10 == 0, F.concat(header, F.lit("\r\n"))).otherwise(body)
    return archives.file_rows(_archives(documents, body, "cp1252"), ["doc", "língua", "size", "n", "absent"], required=["doc", "n"])


QUERIES = {"archive_unpack": archive_unpack, "archive_rows": archive_rows}

_STATUS = "case lang when 'fr' then 'no_target' when 'es' then 'bad_zip' else 'ok' end"
_MEMBER = "'doc' || doc_id || case lang when 'en' then '.TXT' else '.' || lang || '.csv' end"
_LINE = f"""
  select 'in/' || doc_id || '.zip' as path, {_MEMBER} as member, cast(doc_id as varchar) as doc, *
  from documents where lang not in ('fr', 'es', 'de') and doc_id % 10 <> 0"""
SQL = {
    "archive_unpack": f"""
        select 'in/' || doc_id || '.zip' as path, case when lang not in ('fr', 'es') then {_MEMBER} end as member,
          case when lang not in ('fr', 'es') then cast(octet_length(encode(text)) as bigint) end as bytes,
          case when lang not in ('fr', 'es') then sha256(text) end as sha256, {_STATUS} as status
        from documents""",
    "archive_rows": f"""
        with d as ({_LINE})
        select path, member, 0 as line, cast(null as varchar) as problem, doc, 'são – é' as "língua", cast(n_chars as varchar) as size, source as n,
          cast(null as varchar) as absent from d
        union all select path, member, 1, null, doc, null, null, 'NAN', null from d
        union all select path, member, 2, null, doc, 'short', null, null, null from d
        union all select path, member, 3, 'too many cells', null, null, null, null, null from d
        union all select 'in/' || doc_id || '.zip', case when lang not in ('fr', 'es') then {_MEMBER} end, null,
            case lang when 'fr' then 'no_target' when 'es' then 'bad_zip' when 'de' then 'undecodable' else 'no rows' end,
            null, null, null, null, null
          from documents where lang in ('fr', 'es', 'de') or doc_id % 10 = 0""",
}
