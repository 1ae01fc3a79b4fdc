"""WARC archives of pages: written as one gzip stream a file, then normalised to one member a record with an index.

1. ``write_archives`` turns pages into WARC records with SQL and lets Spark's text writer store them: the separator of
   rows is the end of a record (two line ends), the compression is gzip, so every file is a WARC of one gzip member.
   Pages with equal payloads are written once; the others become revisit records.
2. ``normalise`` reads such files, its own or anybody's, inflates each once from beginning to end, whatever its size with one
   record in memory, writes every record as a gzip member of its own, and stores a sidecar index of where they begin.
3. ``read_records`` opens the members that an index names, in any order and in parallel, and gives their records.

Files written by a worker carry the attempt that wrote them. The index holds only rows of attempts that Spark
committed, so a lost executor or a repeated task leaves files that nobody reads, never half an archive.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardloom.llm.common import stored, text_of

_CRLF = "\r\n"
_END = "\r\n\r\n"
_RECORD_ID = "urn:page:"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages say nothing about when they were fetched.
UNDATED = "1970-01-01T00:00:00Z"
_READ_BYTES = 8 << 20  # payloads of an output batch


def base32_sha1(data: Column) -> Column:
    """SHA-1 of a binary column in upper-case base 32: 40 bits at a time."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _payloads(pages: DataFrame, id_col: str, url_col: str, html_col: str, revisit_bytes: int) -> DataFrame:
    """(id, url, payload, bytes, refers_to) with ``refers_to`` set for pages whose payload another one holds."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), text_of(html_col).alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "sha": F.unhex(F.sha2("payload", 256))})
    large = rows.filter(F.col("bytes") >= revisit_bytes)
    # groups of one page need no row here; the largest id counts, null ids only where there is no other
    kept = large.groupBy("sha").agg(F.max("id").alias("kept"), F.count("*").alias("n")).filter("n > 1").select(F.col("sha").alias("of"), "kept")
    joined = rows.join(kept, F.col("sha") == F.col("of"), "left")
    other = F.col("kept").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept"))
    return joined.select("id", "url", "payload", "bytes", F.when(other, F.col("kept")).alias("refers_to"))


def _urn(name: str) -> Column:
    return F.concat(F.lit(f"<{_RECORD_ID}"), F.url_encode(F.col(name).cast("string")), F.lit(">"))


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat_ws("", *[F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF)) for name, value in fields])


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   revisit_bytes: int = 0, date: str = UNDATED) -> None:
    """One WARC record per page into ``folder``, files of one gzip stream each.

    The payload is the html in UTF-8, null counts as empty. Of equal payloads of at least ``revisit_bytes`` the page with
    the largest id is the response and the others revisit it; rows that repeat that id and payload are responses too; null ids
    are smaller than any other, and a group of null ids has responses only. A null id has a record id without a page; a
    null address has no target. Tabs and line ends in addresses go, as in browsers. Other columns are ignored, an empty
    table gives an archive without records.
    """
    rows = _payloads(pages, id_col, url_col, html_col, revisit_bytes)
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(_END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    fields = _lines(
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", F.coalesce(_urn("id"), F.lit(f"<{_RECORD_ID}>"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.translate("url", "\t\r\n", "")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload").cast("binary")))),
        ("WARC-Profile", F.when(revisit, _REVISIT_PROFILE)),
        ("WARC-Refers-To", _urn("refers_to")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length("block").cast("string")))
    record = F.concat(F.lit(f"WARC/1.1{_CRLF}"), fields, F.lit(_CRLF), F.col("block"))
    rows.withColumn("block", block).select(record.alias("value")).write.mode("overwrite").options(
        lineSep=_END, compression="gzip").text(folder)


# --- streams of records --------------------------------------------------------------------------
def _fields(head: bytes) -> dict[str, str]:
    """Header fields by name in lower case; a line that begins with a blank goes on the one before."""
    fields: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\n")[1:]:
        if line[:1] in (" ", "\t"):
            fields[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


class Records:
    """Cuts a stream that arrives in pieces into records: (fields, bytes of the whole record without its end)."""

    def __init__(self, source: str):
        self.source, self.held, self.fields, self.size = source, bytearray(), None, 0

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        held = self.held
        searched = max(len(held) - 3, 0)
        held += data
        while True:
            if self.fields is None:
                blank = len(held) - len(held.lstrip(b"\r\n"))
                if blank:  # ends of the record before
                    del held[:blank]
                    searched = 0
                end = held.find(_END.encode(), searched)
                if end < 0:
                    return
                if not held.startswith(b"WARC/"):
                    raise ValueError(f"{self.source}: no WARC record at {bytes(held[:40])!r}")
                self.fields = _fields(bytes(held[:end]))
                length = self.fields.get("content-length", "")
                if not length.isdecimal():
                    raise ValueError(f"{self.source}: a record without its length at {bytes(held[:40])!r}")
                self.size = end + 4 + int(length)
            if len(held) < self.size:
                return
            yield self.fields, bytes(held[:self.size])
            del held[:self.size]
            self.fields, searched = None, 0

    def end(self) -> None:
        if self.fields is not None or self.held.strip(b"\r\n"):
            raise ValueError(f"{self.source}: ends within a record")


def _file_system(folder: str):
    """The file system of a folder and its path there, as workers open it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (fs.LocalFileSystem(), folder)


def _of_urn(value: str | None) -> str | None:
    """The page of a record id of ``write_archives``; other ids are given whole."""
    from urllib.parse import unquote_plus

    if value is None:
        return None
    value = value.strip("<>")
    return unquote_plus(value[len(_RECORD_ID):]) or None if value.startswith(_RECORD_ID) else value


_INDEX = "archive string, record long, offset long, length long, type string, id string, url string"


def normalise(spark: SparkSession, source: str, target: str, level: int = 6) -> DataFrame:
    """Rewrite the gzipped WARC files of ``source`` with one member a record; the index, stored in ``target/index``.

    Each file is read as one stream by Spark, so ``source`` may be any path Spark reads. It need not come from
    ``write_archives``: one member or many, records of any type, payloads that hold record ends. A file that ends within a
    record or holds something else is an error that names it. ``target`` must be reachable by workers through pyarrow.
    """
    pieces = spark.read.option("lineSep", _END).option("pathGlobFilter", "*.gz").text(source)
    pieces = pieces.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _file_system(target)
        files.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        open_file, rows = None, []

        def begin(path: str):
            name = f"{path.rsplit('/', 1)[1].split('.')[0]}-{attempt}.warc.gz"
            return {"path": path, "name": name, "records": Records(path), "out": files.open_output_stream(f"{root}/{name}", compression=None), "at": 0, "n": 0}

        def write(f: dict, found) -> None:
            for fields, record in found:
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(record + _END.encode()) + packer.flush()
                f["out"].write(member)
                rows.append((f["name"], f["n"], f["at"], len(member), fields.get("warc-type"),
                             _of_urn(fields.get("warc-record-id")), fields.get("warc-target-uri")))
                f["at"] += len(member)
                f["n"] += 1

        def taken() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), *[pa.int64()] * 3, *[pa.string()] * 3))],
                names=["archive", "record", "offset", "length", "type", "id", "url"])
            rows.clear()
            return batch

        for batch in batches:
            for path, piece in zip(batch.column("file").to_pylist(), batch.column("piece").to_pylist()):
                if open_file is None or open_file["path"] != path:
                    if open_file:
                        open_file["records"].end()
                        open_file["out"].close()
                    open_file = begin(path)
                write(open_file, open_file["records"].feed(piece + _END.encode()))
            if len(rows) >= 4096:
                yield taken()
        if open_file:
            open_file["records"].end()
            open_file["out"].close()
        if rows:
            yield taken()

    return stored(pieces.mapInArrow(run, _INDEX), target, "index")


def read_records(index: DataFrame, target: str) -> DataFrame:
    """(archive, record, type, id, url, refers_to, digest, http_bytes, payload) of the records an index names.

    ``payload`` is what follows the HTTP header, empty for revisits; ``http_bytes`` the length that header states, ``digest``
    the digest the record states, without its algorithm. Members are read by their offsets, so any rows of an index
    will do. Neighbours of an archive are dealt to one task; an archive of many records is dealt to several.
    """
    schema = ("archive string, record long, type string, id string, url string, refers_to string, digest string, "
              "http_bytes long, payload binary")
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]

    def record(archive: str, number: int, data: bytes) -> tuple:
        (fields, whole), = list(Records(archive).feed(data))
        block = whole[len(whole) - int(fields["content-length"]):]
        head, _, payload = block.partition(_END.encode())
        stated = _fields(head).get("content-length")
        return (archive, number, fields.get("warc-type"), _of_urn(fields.get("warc-record-id")), fields.get("warc-target-uri"),
                _of_urn(fields.get("warc-refers-to")), fields.get("warc-payload-digest", "").rpartition(":")[2] or None,
                None if stated is None else int(stated), payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _file_system(target)
        name, file, rows, size = None, None, [], 0
        packed = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        for batch in batches:
            for archive, number, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "record", "offset", "length"))):
                if archive != name:
                    name, file = archive, files.open_input_file(f"{root}/{archive}")
                file.seek(offset)
                rows.append(record(archive, number, zlib.decompress(file.read(length), 31)))
                size += len(rows[-1][-1])
                if size >= _READ_BYTES:
                    yield packed()
                    rows, size = [], 0
        if rows:
            yield packed()

    parts = max(index.select("archive").distinct().count(), index.sparkSession.sparkContext.defaultParallelism)
    dealt = index.select("archive", "record", "offset", "length").repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(run, schema)
