"""WARC archives of web pages, and the assembly of their records into captures.

Writing: a capture is a request, a response (or a revisit, if an earlier page
has the same payload) and a metadata record; request and metadata name the
response by WARC-Concurrent-To. Archives are gzipped text files that Spark's
writer commits: the record separator of the format is the writer's line
separator, so one row of records is one row written.

Reading: archive files are parsed record by record; the records are joined
through their concurrent-to identifiers into one nested row per capture.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.llm.common import land

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed values: the alphabet of RFC 4648
MIDDLE = 32  # captures in a file of the middle size class
_CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # the digits of conv(..., 32)


def base32_sha1(payload):
    """Bare base32 SHA-1 of a string or binary column (160 bits: 32 characters)."""
    digest = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _CONV32, _BASE32)


def _uuid(*parts):
    h = F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind, headers: list[tuple], block):
    """A record without its end; headers with a null value are left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines += [F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(RECORD_END), block)


def write_archives(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit: int = 0, date: str = "2024-01-01T00:00:00Z", captures_per_file: int = 2000, file_bytes: int = 128 << 20) -> None:
    """Write a capture per row of ``df`` under ``path``.

    A file holds at most ``captures_per_file`` captures and ``file_bytes`` of
    payload, or one capture with a larger payload: captures of like payload
    sizes are written together, one pass over the payloads per size class that
    occurs (under 1/2,000 of the bytes, under 1/32, larger). One payload must
    fit a Spark string (2 GB).

    Of the rows with equal payloads of at least ``min_revisit`` bytes the one
    with the smallest id (then url; null ids last) is a response and the others
    revisit it; smaller payloads are all responses. A null payload is empty; a
    null url has no target; repeated rows are captures of their own, one of
    them the response at most. Payloads travel once per distinct payload."""
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    base = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("body"))
    base = base.select("id", "url", "body", base32_sha1(F.col("body")).alias("sha"), F.octet_length("body").cast("long").alias("n"))
    small = F.when(F.col("n") < min_revisit, F.col("body")).alias("small")
    seen = base.select("id", "url", "sha", "n", small).groupBy("id", "url", "sha", "n", "small").agg(F.count(F.lit(1)).alias("copies"))
    seen = land(seen, "captures")
    who = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("url").alias("url"))
    first = land(seen.filter(F.col("n") >= min_revisit).groupBy("sha").agg(F.min(who).alias("first"), F.sum("copies").alias("rows"))
                 .filter("rows > 1").select(F.col("sha").alias("first_sha"), "first"), "first-captures")
    rows = (seen.join(first, F.col("sha") == F.col("first_sha"), "left")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
    lone = F.col("first").isNull() | ((F.col("first.id").eqNullSafe(F.col("id"))) & (F.col("first.url").eqNullSafe(F.col("url"))) & (F.col("copy") == 1))
    rows = rows.withColumn("is_response", lone)
    rid = lambda kind, i=F.col("id"), u=F.col("url"), c=F.col("copy"): _uuid(F.lit(kind), i, u, F.col("sha"), c)
    payloads = base.filter(F.col("n") >= min_revisit)

    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    shared = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", target)]
    kind = F.when(F.col("is_response"), F.lit("response")).otherwise(F.lit("revisit"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n").cast("string"), F.lit(RECORD_END))
    refers = F.when(~F.col("is_response"), rid("capture", F.col("first.id"), F.col("first.url"), F.lit(1)))
    profile = F.when(~F.col("is_response"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    capture = _record(kind, [("WARC-Record-ID", rid("capture")), *shared, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha"))),
                             ("WARC-Refers-To", refers), ("WARC-Profile", profile), ("Content-Type", F.lit("application/http;msgtype=response"))],
                      F.concat(http, F.when(F.col("is_response"), F.coalesce("body", "small")).otherwise(F.lit(""))))
    asked = F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(f" HTTP/1.1{RECORD_END}"))
    request = _record(F.lit("request"), [("WARC-Record-ID", rid("request")), *shared, ("WARC-Concurrent-To", rid("capture")),
                                         ("Content-Type", F.lit("application/http;msgtype=request"))], asked)
    fields = F.coalesce(F.concat(F.lit("pageId: "), F.col("id").cast("string"), F.lit(CRLF)), F.lit(""))
    metadata = _record(F.lit("metadata"), [("WARC-Record-ID", rid("metadata")), *shared, ("WARC-Concurrent-To", rid("capture")),
                                           ("Content-Type", F.lit("application/warc-fields"))], fields)
    records = F.concat_ws(RECORD_END, request, capture, metadata).alias("value")
    # A class holds the payloads below a size; files of its captures stay below file_bytes.
    bounds = [-1, *sorted({file_bytes // captures_per_file, file_bytes // min(captures_per_file, MIDDLE)}), None]
    classes = list(zip(bounds, bounds[1:]))
    held = seen.agg(*(F.coalesce(F.bool_or(_between("n", a, b)), F.lit(False)) for a, b in classes)).first()
    chosen = [c for c, h in zip(classes, held) if h] or classes[:1]  # an empty table is an empty archive
    for i, (a, b) in enumerate(chosen):
        part = payloads.filter(_between("n", a, b)).groupBy(F.col("sha").alias("body_sha")).agg(F.first("body").alias("body"))
        per_file = max(1, min(captures_per_file, file_bytes // b)) if b else 1
        (rows.filter(_between("n", a, b)).join(part, (F.col("sha") == F.col("body_sha")) & F.col("is_response"), "left").select(records)
         .write.mode("append" if i else "errorifexists").option("lineSep", RECORD_END).option("compression", "gzip")
         .option("maxRecordsPerFile", per_file).text(path))


def _between(column: str, low: int, high: int | None):
    """Sizes above ``low`` and up to ``high``."""
    above = F.col(column) > low
    return above if high is None else above & (F.col(column) <= high)


RECORD = "file string, at long, warc_type string, record_id string, headers map<string,string>, head string, payload binary"


def _inflated(data: bytes):
    """The bytes of a file, gzipped (one or more members) or not, in pieces."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    while data:
        member = zlib.decompressobj(31)
        while data and not member.eof:
            piece = member.decompress(data, 1 << 20)
            data = member.unconsumed_tail or member.unused_data
            if not piece and not data and not member.eof:
                raise ValueError("an archive ends within a gzip member")
            yield piece
        data = member.unused_data


class _Reader:
    """Sequential reads over pieces."""

    def __init__(self, pieces):
        self._pieces, self._buffer, self.at = pieces, bytearray(), 0

    def _fill(self) -> bool:
        for piece in self._pieces:
            self._buffer += piece
            return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """The bytes before ``mark``, which is passed; None at the end of the file."""
        start = 0
        while (i := self._buffer.find(mark, start)) < 0:
            start = max(0, len(self._buffer) - len(mark) + 1)
            if not self._fill():
                if bytes(self._buffer).strip():
                    raise ValueError("an archive ends within a record header")
                return None
        return self.take(i + len(mark))[:-len(mark)]

    def take(self, n: int) -> bytes:
        while len(self._buffer) < n:
            if not self._fill():
                raise ValueError("an archive ends within a record")
        out = bytes(self._buffer[:n])
        del self._buffer[:n]
        self.at += n
        return out


def parse(data: bytes):
    """(offset, headers, block) of every record of an archive file."""
    reader = _Reader(_inflated(data))
    while True:
        at = reader.at
        head = reader.until(RECORD_END.encode())
        if head is None:
            return
        lines = head.decode("utf-8", "replace").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        block = reader.take(int(headers["Content-Length"]))
        if reader.take(4) != RECORD_END.encode():
            raise ValueError(f"the record at byte {at} has another length than it says")
        yield at, headers, block


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``: its headers and, for
    HTTP messages, the message head apart from the payload, with the payload's
    size and digest. A malformed archive is an error, never a shorter result."""
    def run(batches):
        names = [x.split()[0] for x in RECORD.split(", ")]
        schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("warc_type", pa.string()), ("record_id", pa.string()),
                            ("headers", pa.map_(pa.string(), pa.string())), ("head", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                for at, headers, block in parse(content.as_py()):
                    head, payload = "", block
                    if headers.get("Content-Type", "").startswith("application/http"):
                        top, _, payload = block.partition(RECORD_END.encode())
                        head = top.decode("utf-8", "replace")
                    rows.append((file.as_py(), at, headers.get("WARC-Type"), headers.get("WARC-Record-ID"), list(headers.items()), head, payload))
                    size += len(block)
                    if size > 4 << 20 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, RECORD).withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})


def without_payloads(records: DataFrame) -> DataFrame:
    """Records whose HTTP messages keep their sizes and digests but no payload:
    what assembly needs when the payloads themselves do not travel on."""
    http = F.coalesce(F.element_at("headers", "Content-Type").startswith("application/http"), F.lit(False))
    return records.withColumn("payload", F.when(~http, F.col("payload")))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its identifier, the response or revisit, the
    requests and the metadata records concurrent to it. Records concurrent to
    no response make a capture without one. Records without an identifier, and
    of other types, are in no capture."""
    part = F.struct("record_id", "warc_type", "headers", "head", "payload", "payload_bytes", "payload_digest")
    main = records.filter(F.col("warc_type").isin("response", "revisit") & F.col("record_id").isNotNull()).select(
        F.col("record_id").alias("capture_id"), part.alias("response"))

    def beside(kind: str, name: str) -> DataFrame:
        to = F.element_at("headers", "WARC-Concurrent-To")
        return (records.filter((F.col("warc_type") == kind) & to.isNotNull()).groupBy(to.alias("capture_id"))
                .agg(F.collect_list(part).alias(name)))

    # The small records meet first, so payloads are shuffled once.
    small = beside("request", "requests").join(beside("metadata", "metadata"), "capture_id", "full_outer")
    return main.join(small, "capture_id", "full_outer")


def page_report(captures: DataFrame) -> DataFrame:
    """Rows (page_id, payload_bytes, payload_digest, record_type, refers_to)
    from assembled captures of ``write_archives``. A response's size and digest
    are taken from its payload, and a digest that differs from its header is an
    error; a revisit's from its headers, its page from the record it refers to."""
    r = F.col("response")
    header = lambda name: F.element_at(r["headers"], name)
    is_response = r["warc_type"] == "response"
    fields = F.element_at("metadata", 1)["payload"].cast("string")
    page = F.regexp_extract(fields, r"(?m)^pageId: (-?\d+)", 1)
    claimed = F.regexp_replace(header("WARC-Payload-Digest"), "^sha1:", "")
    checked = F.when(~is_response | (r["payload_digest"] == claimed), claimed).otherwise(F.raise_error(F.concat(F.lit("digest of "), F.col("capture_id"))))
    length = F.regexp_extract(r["head"], r"(?mi)^Content-Length: (\d+)", 1).cast("long")
    rows = land(captures.filter(r.isNotNull()).select(
        "capture_id", F.when(page != "", page).cast("long").alias("page_id"),
        F.when(is_response, r["payload_bytes"]).otherwise(length).alias("payload_bytes"),
        checked.alias("payload_digest"), r["warc_type"].alias("record_type"), header("WARC-Refers-To").alias("to")), "report")
    known = rows.filter("record_type = 'response'").select(F.col("capture_id").alias("to"), F.col("page_id").alias("refers_to"))
    return rows.join(known, "to", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
