"""WARC archives written and read as streams, with oversized payloads cut into chunks.

Writing: a record's payload becomes rows of at most `chunk` characters, by record and chunk number. The first chunk is a
`response` record, the others are `continuation` records, the standard's way to segment a record. Spark's text writer
ends each record by its line separator, so archives go wherever Spark writes. Archives are compressed, hence read by one
task each, from the first line to the last.

Reading: lines pass through a parser that holds one header at most. It counts the content's bytes down, carries the
payload's digest and length from chunk to chunk, and emits a row per chunk; the last chunk of a record has the digest of
the whole payload. Neither side needs a whole record at once beyond the row that the payload came in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import small_batches
from lagline.session import work_dir

CHUNK = 1 << 16
LEAST = 1000
EOL = "\r\n"


def _header(*fields: tuple[str, Column | str | None]) -> Column:
    """Header lines of a record; a field without a value is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value)) for name, value in fields]
    return F.concat(F.concat_ws(EOL, F.lit("WARC/1.1"), *lines), F.lit(EOL + EOL))


def decided(pages: DataFrame, key: str = "page_id", payload: str = "html", least: int = LEAST) -> DataFrame:
    """The rows with `_digest`, `_bytes` and `_refers`: the key of the record that a row's payload repeats, else null.

    Of rows with equal payloads of at least `least` bytes the one with the largest key is kept, and any other that has
    the same key; a null key never is the largest, unless all are null.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("_id"), "_url", body.alias("_body"), F.octet_length(body).alias("_bytes"),
        F.sha1(body.cast("binary")).alias("_digest"), F.sha2(body, 256).alias("_same"),
    )
    kept = rows.where(F.col("_bytes") >= least).groupBy("_same").agg(F.max("_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
    known = rows.join(kept.where("_n > 1"), "_same", "left")
    refers = F.when(F.col("_last").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_last")), F.col("_last"))
    return known.withColumn("_refers", refers).drop("_same", "_last", "_n")


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", chunk: int = CHUNK) -> None:
    """Write one record per row: a response with its payload, or a revisit that names the response it repeats."""
    target = F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), r"[\x00-\x20\x7F]", "%20")
    rows = decided(pages.withColumn("_url", target), key, payload)
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    digest = F.concat(F.lit("sha1:"), F.col("_digest"))
    place = F.when(F.col("_url") != "", F.concat(F.lit("WARC-Target-URI: "), F.col("_url"), F.lit(EOL))).otherwise("")
    date = ("WARC-Date", "2000-01-01T00:00:00Z")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("_bytes").cast("string"),
        F.lit(EOL + EOL),
    )
    revisit = F.col("_refers").isNotNull()
    cut = F.when(F.octet_length("_body") <= chunk, F.array("_body"))
    cut = cut.otherwise(F.regexp_extract_all("_body", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)))
    rows = rows.withColumn("_parts", F.when(revisit, F.array(F.lit(""))).otherwise(cut)).drop("_body")
    chunks = rows.select("*", F.size("_parts").alias("_of"), F.posexplode("_parts").alias("_nr", "_part")).drop("_parts")
    chunks = chunks.withColumn("_nr", F.col("_nr") + 1)
    block = F.when(F.col("_nr") == 1, F.concat(http, F.col("_part"))).otherwise(F.col("_part"))
    chunks = chunks.withColumn("_block", block).drop("_part")
    length = F.octet_length("_block").cast("string")
    number = F.col("_nr").cast("string")
    response = _header(
        ("WARC-Type", "response"), ("WARC-Record-ID", urn(F.col("_id"))), date, ("WARC-Payload-Digest", digest),
        ("WARC-Segment-Number", F.when(F.col("_of") > 1, number)), ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", length),
    )
    more = _header(
        ("WARC-Type", "continuation"), ("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("_id").cast("string"), F.lit("null")), F.lit(":"), number, F.lit(">"))),
        date, ("WARC-Segment-Origin-ID", urn(F.col("_id"))), ("WARC-Segment-Number", number),
        ("WARC-Segment-Total-Length", F.when(F.col("_nr") == F.col("_of"), F.col("_bytes").cast("string"))), ("Content-Length", length),
    )
    again = _header(
        ("WARC-Type", "revisit"), ("WARC-Record-ID", urn(F.col("_id"))), date, ("WARC-Refers-To", urn(F.col("_refers"))),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Payload-Digest", digest),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", length),
    )
    head = F.when(revisit, again).when(F.col("_nr") == 1, response).otherwise(more)
    # the target goes after the version line, so that it needs no place of its own in each kind of header
    head = F.concat(F.lit("WARC/1.1" + EOL), F.when(F.col("_nr") == 1, place).otherwise(""), F.substring(head, F.lit(11), F.length(head)))
    text = F.concat(head, F.col("_block"))
    # blocks hold line breaks of their own; the separator only ends the record
    chunks.select(text.alias("value")).write.option("lineSep", EOL + EOL).option("compression", "gzip").text(path)


class Parser:
    """Reads records from the lines of one archive and gives a chunk for each."""

    def __init__(self, keep: bool):
        self.keep = keep
        self.head: dict[str, str] | None = None
        self.left = 0  # bytes of content still to come
        self.http = False
        self.pieces: list[bytes] = []
        self.state = None  # digest, bytes and record of the payload in progress

    def line(self, data: bytes) -> tuple | None:
        """Takes a line without its line feed; gives a chunk when a record's content ends with it."""
        if self.left:
            return self.content(data + b"\n")
        if self.head is None:
            if data.rstrip(b"\r"):
                self.head = {}
            return None
        text = data.rstrip(b"\r")
        if text:
            name, _, value = text.partition(b":")
            self.head[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
            return None
        self.left = int(self.head.get("content-length", 0))
        if self.head["warc-type"] != "continuation":
            self.state = [hashlib.sha1(), 0, self.head, None]
            self.http = self.head.get("content-type", "").startswith("application/http")
        return None if self.left else self.chunk()

    def content(self, data: bytes) -> tuple | None:
        data = data[: self.left]
        self.left -= len(data)
        if self.http:  # the HTTP header is no payload
            name, _, value = data.partition(b":")
            if name.lower() == b"content-length":
                self.state[3] = int(value)
            self.http = data not in (b"\r\n", b"\n")
            if not self.left:
                self.http = False
        else:
            self.state[0].update(data)
            self.state[1] += len(data)
            if self.keep:
                self.pieces.append(data)
        return None if self.left else self.chunk()

    def chunk(self) -> tuple:
        head, origin = self.head, self.state[2]
        number = int(head.get("warc-segment-number", 1))
        last = "warc-segment-number" not in head or "warc-segment-total-length" in head
        row = (
            origin["warc-record-id"], number, last, origin["warc-type"], origin.get("warc-target-uri"), origin.get("warc-refers-to"),
            origin.get("warc-payload-digest"), b"".join(self.pieces) if self.keep else None, self.state[1], self.state[0].hexdigest(),
            self.state[3],
        )
        self.head, self.pieces = None, []
        return row


CHUNKS = (
    "record_id string, chunk_no int, last boolean, type string, target string, refers_to string, declared string, "
    "payload binary, running_bytes long, running_digest string, "
    "entity_bytes long"
)


def read_archives(spark, path: str, payload: bool = True) -> DataFrame:
    """The chunked record table of archives: a row per record and chunk number.

    `running_bytes` and `running_digest` (SHA-1) cover the payload up to the end of the chunk, hence all of it in the
    row that is `last`. With payload=False the bytes are digested and not kept.
    """
    small_batches(spark)
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "long": pa.int64()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in CHUNKS.split(", ")])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, parser, rows, held = None, None, [], 0
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != file:
                    file, parser = name, Parser(payload)
                row = parser.line(data)
                if row is not None:
                    rows.append(row)
                    held += 256 + len(row[7] or b"")
                if held >= 4 << 20:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("value")).mapInArrow(parse, CHUNKS)


def archived_pages(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", path: str | None = None) -> DataFrame:
    """Write the archives, read them back, and report one row per page: `page_id`, `payload_bytes`, `payload_digest`,
    `record_type`, `refers_to`.

    A revisit record has no payload of its own: its digest is the one it declares, its length the one in its HTTP
    header, both of the payload it refers to. Null payloads are empty; a page without an id is a record `null`, read
    back as null. Repeated rows are records of their own.
    """
    spark = pages.sparkSession
    path = path or work_dir(spark, "archives")
    write_archives(pages, path, key, url, payload)
    chunks = read_archives(spark, path, payload=False).where("last")
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    as_id = lambda c: F.when(number(c) != "", number(c)).cast("long")
    again = F.col("type") == "revisit"
    return chunks.select(
        as_id(F.col("record_id")).alias("page_id"),
        F.when(again, F.col("entity_bytes")).otherwise(F.col("running_bytes")).alias("payload_bytes"),
        F.when(again, F.substring("declared", 6, 40)).otherwise(F.col("running_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), as_id(F.col("refers_to")).alias("refers_to"),
    )
