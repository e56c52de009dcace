"""Operator 11: WARC archives that are read through their index.

Writing.  Each page becomes one record in a gzip member of its own.  While a task writes an archive it
returns the index rows (file, offset, length, URL, digest, page) of its records; Spark
commits them as a table.  The index is what counts: archives of failed or repeated tasks
have names of their own and no index rows, so nothing has to be undone.

Of records with equal payloads (at least ``least`` bytes) the one with the largest page id is the
``response``; the others are ``revisit`` records, which refer to it and carry no payload.  Roles are
decided on page id, URL and digest alone.  Payloads are only moved between
tasks where repeated rows have to become one record, or where the rows that differ from plain
responses are too many to be broadcast.

Reading.  The caller selects index rows.  They are dealt by ranges of (file, offset) and sorted; rows of a
file whose gap is at most ``gap`` bytes are read as one byte range of at most ``span`` bytes, and
each record is cut out of it and checked against its digest.

Archives are files below a folder that all executors share, opened with ``pyarrow.fs`` (local or
mounted paths, and the remote stores that pyarrow knows).

Defined cases: null payloads are empty; null URLs have no target field, and control characters and
blanks in URLs are percent-encoded in the record (the index holds them as they are); null ids come
after all others and are read as null.  Rows with the largest id of a payload but different URLs:
the larger URL is the response.  Repeated rows become one record each, the first of them is the
response where its group has one, the others revisit it.  An empty table gives an empty index.
Long payloads are held one at a time besides their Arrow batch.  Other columns are not archived, so
their names do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from clockroll.llm.common import on_workers, shared_files, sized, staged

CRAWLED = "1970-01-01T00:00:00Z"
FILE_BYTES = 256 << 20
GAP, SPAN = 64 << 10, 8 << 20
INDEX = "file string, offset long, length long, page string, url string, digest string, record_type string"
RECORD = "file string, offset long, record_type string, page string, url string, payload_bytes long, payload_digest string, refers_to string"
PAYLOAD = ", payload binary"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_KEY = ["page", "url", "sha"]


# --- records -----------------------------------------------------------------------------

def record_id(page: str | None, url: str | None, copy: int, digest: str) -> str:
    """``page`` and ``url`` tell records of one payload apart, ``copy`` repeated rows."""
    page = "" if page is None else "=" + quote(page, safe="")
    return f"<urn:clockroll:{page}:{zlib.crc32((url or '').encode()):08x}:{copy}:{digest}>"


def page_of(record: str) -> str | None:
    page = record.split(":")[2]
    return unquote(page[1:]) if page else None


def _target(url: str) -> str:
    return "".join(quote(c) if c <= " " or c == "\x7f" else c for c in url)


def _record(kind: str, fields: list[tuple[str, str]], block: bytes, date: str) -> bytes:
    head = [("WARC-Type", kind), *fields, ("WARC-Date", date), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(row: dict, date: str) -> bytes:
    digest = base64.b32encode(bytes.fromhex(row["sha"])).decode()
    fields = [("WARC-Record-ID", record_id(row["page"], row["url"], row["copy"], digest))]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", _target(row["url"])))
    fields += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    if row["kind"] == "response":
        return _record("response", fields, block + (row["payload"] or b""), date)
    fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(row["head_page"], row["head_url"], 0, digest))]
    if row["head_url"] is not None:
        fields.append(("WARC-Refers-To-Target-URI", _target(row["head_url"])))
    return _record("revisit", fields, block, date)


def parse_record(data: bytes) -> dict:
    """Kind, page, URL, payload, size, digest and reference of an unpacked record."""
    head, block = data.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = len(payload)
    if kind == "response":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"{fields['WARC-Record-ID']} does not match its digest")
    else:  # the length of the payload that was met again
        size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")).split(": ")[1])
    refers = fields.get("WARC-Refers-To")
    return {"record_type": kind, "page": page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": digest, "refers_to": None if refers is None else page_of(refers), "payload": payload if kind == "response" else None}


# --- writing -----------------------------------------------------------------------------

def _packed(data: bytes) -> bytes:
    c = zlib.compressobj(5, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class _Archive:
    """The archive a task is writing; full ones are closed and followed by a new one."""

    def __init__(self, root: str, file_bytes: int, date: str):
        self.fs, self.path = shared_files(root)
        self.name, self.number, self.out = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}", 0, None
        self.file_bytes, self.date = file_bytes, date

    def add(self, record: bytes) -> tuple[str, int, int]:
        if self.out is not None and self.out.tell() >= self.file_bytes:
            self.close()
        if self.out is None:
            self.file = f"{self.name}-{self.number:04d}.warc.gz"
            self.out, self.number = self.fs.open_output_stream(posixpath.join(self.path, self.file), compression=None), self.number + 1
            info = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Filename", self.file), ("Content-Type", "application/warc-fields")]
            self.out.write(_packed(_record("warcinfo", info, b"format: WARC File Format 1.1\r\n", self.date)))
        at, data = self.out.tell(), _packed(record)
        self.out.write(data)
        return self.file, at, len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
        self.out = None


def _writer(root: str, file_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, rows = _Archive(root, file_bytes, date), []
        names = [c.split()[0] for c in INDEX.split(", ")]
        for b in batches:
            cols = [b.column(i) for i in range(b.num_columns)]
            for i in range(b.num_rows):
                row = {n: c[i].as_py() for n, c in zip(b.schema.names, cols, strict=True)}
                digest = base64.b32encode(bytes.fromhex(row["sha"])).decode()
                rows.append((*archive.add(page_record(row, date)), row["page"], row["url"], digest, row["kind"]))
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], _ARROW_INDEX)
                rows = []
        archive.close()  # before the index rows are committed
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], _ARROW_INDEX)
    return run


_ARROW_INDEX = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in INDEX.split(", ")])


def _same(a: DataFrame, b: DataFrame):
    out = a["sha"] == b["sha"]
    for c in ("page", "url"):
        out = out & a[c].eqNullSafe(b[c])
    return out


def _roles(src: DataFrame, id_col: str, least: int) -> DataFrame:
    """One row per (page, url, sha): ``n`` rows of it, whether its first is a response (``own``), whether all
    are, and the head of its payload's group."""
    groups = staged(src.groupBy("id", *_KEY).agg(F.count("*").alias("n"), F.first("size").alias("size")), "warc-groups")
    order = F.struct(F.col("id").isNotNull().alias("known"), "id", F.col("url").isNotNull().alias("named"), "url", "page")
    shared = groups.where(F.col("size") >= least).groupBy("sha").agg(F.max(order).alias("h"), F.count("*").alias("m")).where("m > 1")
    heads = staged(shared.select("sha", F.col("h.page").alias("head_page"), F.col("h.url").alias("head_url"), F.lit(True).alias("many")), "warc-heads")
    met = groups.join(sized(heads), "sha", "left")
    alone = F.col("many").isNull()
    own = alone | (F.col("page").eqNullSafe(F.col("head_page")) & F.col("url").eqNullSafe(F.col("head_url")))
    return staged(met.select(*_KEY, "n", "size", own.alias("own"), (F.col("size") < least).alias("every"),
                             F.when(alone, F.col("page")).otherwise(F.col("head_page")).alias("head_page"),
                             F.when(alone, F.col("url")).otherwise(F.col("head_url")).alias("head_url")), "warc-roles")


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0,
          file_bytes: int = FILE_BYTES, date: str = CRAWLED) -> DataFrame:
    """Write one record per row of ``pages`` below ``path``; returns the index (``INDEX``)."""
    spark = on_workers(pages).sparkSession
    body = F.coalesce(pages[f"`{payload_col}`"].cast("binary"), F.lit(b""))
    src = pages.select(pages[f"`{id_col}`"].alias("id"), pages[f"`{id_col}`"].cast("string").alias("page"),
                       pages[f"`{url_col}`"].cast("string").alias("url"), body.alias("payload"))
    src = src.select("id", "page", "url", F.sha1("payload").alias("sha"), F.octet_length("payload").cast("long").alias("size"), "payload")
    roles = _roles(src.select("id", *_KEY, "size"), id_col, least)
    plain = F.col("own") & (F.col("n") == 1)
    special = staged(roles.where(~plain), "warc-special")
    # Nearly all pages are plain responses: they are written where they are read.
    keys = sized(special.select(*_KEY))
    once = src.join(keys, _same(src, keys), "left_anti")
    # Repeated responses meet once, with a partial aggregate; their copies follow as narrow rows.
    firsts = special.where("own").select(*_KEY, "n", "every", "head_page", "head_url")
    keys = sized(staged(firsts.select(*_KEY), "warc-firsts"))
    first = src.join(keys, _same(src, keys), "left_semi").groupBy(*_KEY, "size").agg(F.first("payload").alias("payload"))
    # (with ``least`` all copies of a short payload are responses and carry it)
    f = firsts
    again = first.join(f.where("every").select(F.col("page").alias("p"), F.col("url").alias("u"), F.col("sha").alias("s"), "n"),
                       F.col("page").eqNullSafe(F.col("p")) & F.col("url").eqNullSafe(F.col("u")) & (F.col("sha") == F.col("s")), "left")
    again = again.withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n") - 1, F.lit(0)).cast("int"))))
    begin = F.when(F.col("own"), 1).otherwise(0)
    visits = (special.where("NOT every AND (NOT own OR n > 1)")
              .withColumn("copy", F.explode(F.sequence(begin, (F.col("n") - 1).cast("int"))))
              .repartition("page", "url", "sha", "copy"))
    none, no = F.lit(None).cast("binary").alias("payload"), F.lit(None).cast("string")
    head = [no.alias("head_page"), no.alias("head_url")]
    response = lambda df, copy: df.select(*_KEY, "size", "payload", copy.alias("copy"), F.lit("response").alias("kind"), *head)
    records = (response(once, F.lit(0)).unionByName(response(again, F.col("copy")))
               .unionByName(visits.select(*_KEY, "size", none, "copy", F.lit("revisit").alias("kind"), "head_page", "head_url")))
    archives = path.rstrip("/") + "/archives"
    fs, where = shared_files(archives)
    fs.create_dir(where, recursive=True)
    records.mapInArrow(_writer(archives, file_bytes, date), INDEX).write.parquet(path.rstrip("/") + "/index")
    return index(spark, path)


def index(spark, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(path.rstrip("/") + "/index")


# --- reading -----------------------------------------------------------------------------

def ranges(entries: Iterator[tuple[str, int, int]], gap: int, span: int) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted (file, offset, length) coalesced to (file, begin, end, their (offset, length))."""
    file, begin, end, inside = None, 0, 0, []
    for f, at, n in entries:
        if inside and (f != file or at - end > gap or at + n - begin > span):
            yield file, begin, end, inside
            inside = []
        if not inside:
            file, begin, end = f, at, at
        inside.append((at, n))
        end = max(end, at + n)
    if inside:
        yield file, begin, end, inside


def _reader(root: str, gap: int, span: int, payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = shared_files(root)
        entries = (e for b in batches for e in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
        kinds = [c.split() for c in (RECORD + (PAYLOAD if payload else "")).split(", ")]
        schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in kinds])
        opened, source = None, None
        for file, begin, end, inside in ranges(entries, gap, span):
            if file != opened:
                if source is not None:
                    source.close()
                opened, source = file, fs.open_input_file(posixpath.join(path, file))
            data, rows = source.read_at(end - begin, begin), []
            for at, n in inside:
                rec = parse_record(zlib.decompress(data[at - begin:at - begin + n], 31))
                rows.append({"file": file, "offset": at, **{k: v for k, v in rec.items() if payload or k != "payload"}})
            yield pa.RecordBatch.from_pylist(rows, schema)
        if source is not None:
            source.close()
    return run


def read(selected: DataFrame, path: str, payload: bool = True, gap: int = GAP, span: int = SPAN) -> DataFrame:
    """The records of the index rows ``selected``, each row once (``RECORD``, with ``payload`` if asked for)."""
    spark = on_workers(selected).sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = selected.select("file", "offset", "length").repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(_reader(path.rstrip("/") + "/archives", gap, span, payload), RECORD + (PAYLOAD if payload else ""))


def digests(records: DataFrame, id_type: str = "long") -> DataFrame:
    return records.select(F.col("page").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))


#: Equal payloads, their largest page, and base32 of the SHA-1 taken five bits at a time.
SQL = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, h,
    list_transform(range(0, 32), lambda i: 16 * (instr('0123456789abcdef', h[((5 * i) // 4 + 1):((5 * i) // 4 + 1)]) - 1)
      + CASE WHEN (5 * i) // 4 + 2 <= 40 THEN instr('0123456789abcdef', h[((5 * i) // 4 + 2):((5 * i) // 4 + 2)]) - 1 ELSE 0 END) AS two FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((two[i + 1] >> (3 - ((5 * i) % 4))) & 31) AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM r"""
