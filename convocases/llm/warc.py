"""WARC: archives as single gzip streams, normalised to one member for each record, with an offset index."""

import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from convocases.sources.scratch import new_path

#: Payloads shorter than this are never revisits.
LEAST_REVISIT = 100

#: Records in an archive, at most.
RECORDS = 2_000

_CRLF = "\r\n"
#: An empty gzip member. Spark's text writer puts it behind each record's member in place of a line feed.
_EMPTY = gzip.compress(b"", mtime=0)
_URI = "urn:page:"


def responses(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, payload (binary), payload_bytes, payload_digest, refers_to.

    Of pages with equal payloads of at least `least` bytes the smallest page_id is the response and the others refer to
    it; refers_to is null for responses. Digests are combined within each task before they meet, and adaptive execution
    splits the join at a digest with many pages. Payloads are told apart by their SHA-256.
    """
    known = pages.select(
        pages["page_id"].cast("long").alias("page_id"), F.coalesce(pages["url"].cast("string"), F.lit("")).alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    known = known.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    firsts = (
        known.where(F.octet_length("payload") >= least).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    later = known.where(F.octet_length("payload") >= least).select("page_id", "digest").join(firsts, "digest")
    later = later.where("page_id <> first").select("page_id", "digest", F.col("first").alias("refers_to")).distinct()
    return known.join(later, ["page_id", "digest"], "left").select(
        "page_id", "url", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.lower(F.hex("digest")).alias("payload_digest"), "refers_to",
    )


def record(row_id: Column, url: Column, payload: Column, payload_bytes: Column, digest: Column, refers_to: Column) -> Column:
    """The record as bytes without the two line ends behind it. A revisit has no payload, but its size and digest."""
    revisit = refers_to.isNotNull()
    clean = F.regexp_replace(url, "[\\r\\n]", "")
    head = F.concat(
        F.lit(f"WARC/1.1{_CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{_CRLF}WARC-Record-ID: <{_URI}"), F.coalesce(row_id.cast("string"), F.lit("")),
        F.lit(f">{_CRLF}WARC-Date: 1970-01-01T00:00:00Z{_CRLF}WARC-Target-URI: "), clean,
        F.lit(f"{_CRLF}WARC-Payload-Digest: sha256:"), digest,
        F.lit(f"{_CRLF}WARC-Payload-Length: "), payload_bytes.cast("string"),
        F.when(revisit, F.concat(
            F.lit(f"{_CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{_CRLF}WARC-Refers-To: <{_URI}"),
            refers_to.cast("string"), F.lit(">"))).otherwise(""),
        F.lit(f"{_CRLF}Content-Type: application/http; msgtype=response{_CRLF}Content-Length: "),
    )
    http = F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}{_CRLF}").cast("binary")
    block = F.concat(http, F.when(revisit, F.lit(b"")).otherwise(payload))
    return F.concat(head.cast("binary"), F.octet_length(block).cast("string").cast("binary"), F.lit(f"{_CRLF}{_CRLF}").cast("binary"), block)


def write_monolithic(rows: DataFrame, path: str, records: int = RECORDS) -> None:
    """`rows` as `responses` gives them, to gzipped WARC files in `path`: each file is one gzip stream of many records.

    Spark's text writer commits whole files only, so a lost executor leaves no half archive behind. A record is one row
    whatever bytes it holds, and what the writer puts between rows is the end of a WARC record.
    """
    bytes_ = record(*[F.col(c) for c in ("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")])
    (
        rows.select(bytes_.cast("string").alias("value")).write.option("lineSep", _CRLF * 2).option("compression", "gzip")
        .option("maxRecordsPerFile", records).text(path)
    )


def _inflate(data: memoryview) -> Iterator[tuple[bytes, int]]:
    """The contents of the first gzip member, piece by piece, with 0; at the end the member's length."""
    stream, at = zlib.decompressobj(31), 0
    while not stream.eof and at < len(data):
        feed: bytes | memoryview = data[at:at + 65_536]
        at += len(feed)
        while len(feed) and not stream.eof:
            piece = stream.decompress(feed, 1 << 20)
            feed = stream.unconsumed_tail
            yield piece, 0
    if not stream.eof:
        raise ValueError("a gzip member is cut off")
    yield b"", at - len(stream.unused_data)


def inflated(data: bytes) -> Iterator[bytes]:
    """The contents of a gzip file of any number of members, piece by piece."""
    left = memoryview(data)
    while len(left):
        for piece, size in _inflate(left):
            if piece:
                yield piece
        left = left[size:]


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and contents of each gzip member that isn't empty."""
    left, at = memoryview(data), 0
    while len(left):
        pieces = []
        for piece, size in _inflate(left):
            pieces.append(piece)
        whole = b"".join(pieces)
        if whole:
            yield at, size, whole
        left, at = left[size:], at + size


class _Reader(io.RawIOBase):
    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.rest = pieces, b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.rest:
            self.rest = next(self.pieces, None)
            if self.rest is None:
                self.rest = b""
                return 0
        n = min(len(into), len(self.rest))
        into[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


def records(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Header fields (names in lower case), head and block of each record of an inflated stream."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        head, fields = [line], {}
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise ValueError("a WARC head is cut off")
            head.append(line)
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("a WARC block is cut off")
        yield fields, b"".join(head), block


def normalise(spark: SparkSession, source: str, target: str, level: int = 6) -> DataFrame:
    """Rewrites the archives in `source` to `target`/archives with one gzip member for each record; returns the index.

    Each file is inflated once, as a stream, and gives one file in a folder archive=name; memory holds its compressed
    bytes before and after and one record. Behind a file's last member the text writer puts an empty member, which any
    reader of gzip skips. The sidecar index in `target`/index is taken from the files as they were written: archive,
    record_offset and record_length of the member, record_id, record_type.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                out = io.BytesIO()
                for _, head, block in records(io.BufferedReader(_Reader(inflated(content)), 65_536)):
                    out.write(gzip.compress(head + b"\r\n" + block + b"\r\n\r\n", level, mtime=0))
                yield pd.DataFrame({"path": [path], "content": [out.getvalue()]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path", "content")
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(\.txt|\.warc)?\.gz$", "")
    (
        files.mapInPandas(run, "path string, content binary")
        .select(F.col("content").cast("string").alias("value"), name.alias("archive"))
        .write.partitionBy("archive").option("lineSep", _EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1").text(f"{target}/archives")
    )
    index = read_archives(spark, target, with_payload=False).select(
        "archive", "record_offset", "record_length", "record_id", "record_type")
    index.write.parquet(f"{target}/index")
    return spark.read.schema(index.schema).parquet(f"{target}/index")


def _page_of(uri: str | None) -> int | None:
    number = (uri or "").removeprefix(f"<{_URI}").removesuffix(">")
    return int(number) if number else None


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a member that holds one record; the payload of a response is held against its digest."""
    found = list(records(io.BufferedReader(io.BytesIO(member))))
    if len(found) != 1:
        raise ValueError(f"a member holds {len(found)} records")
    fields, _, block = found[0]
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["warc-type"] == "response" and f"sha256:{hashlib.sha256(payload).hexdigest()}" != fields["warc-payload-digest"]:
        raise ValueError(f"the digest of {fields['warc-record-id']} is wrong")
    return fields, payload


def read_archives(spark: SparkSession, target: str, with_payload: bool = True) -> DataFrame:
    """The records of normalised archives: archive, record_offset, record_length, record_id, record_type, page_id, url,
    payload_bytes, payload_digest, refers_to, and the payload of responses. Sizes and digests of responses are taken
    from their payload; a revisit has those of the payload it refers to.
    """
    names = ["archive", "record_offset", "record_length", "record_id", "record_type", "page_id", "url", "payload_bytes",
             "payload_digest", "refers_to"] + ["payload"] * with_payload

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["archive"], batch["content"]):
                rows: list[tuple] = []
                for at, size, member in members(content):
                    fields, payload = parse(member)
                    kind = fields["warc-type"]
                    row = (
                        archive, at, size, fields["warc-record-id"], kind, _page_of(fields["warc-record-id"]), fields["warc-target-uri"],
                        len(payload) if kind == "response" else int(fields["warc-payload-length"]),
                        fields["warc-payload-digest"].removeprefix("sha256:"), _page_of(fields.get("warc-refers-to")),
                    )
                    rows.append(row + ((payload if kind == "response" else None),) * with_payload)
                    if len(rows) == 500:
                        yield _frame(rows, names)
                        rows = []
                if rows:
                    yield _frame(rows, names)

    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary, archive string").format(
        "binaryFile").option("basePath", f"{target}/archives").load(f"{target}/archives")
    return files.select("archive", "content").mapInPandas(
        run, "archive string, record_offset long, record_length long, record_id string, record_type string, page_id long,"
        " url string, payload_bytes long, payload_digest string, refers_to long" + ", payload binary" * with_payload)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})


def archive_pages(pages: DataFrame, folder: str | None = None, least: int = LEAST_REVISIT, with_payload: bool = False) -> DataFrame:
    """Writes `pages` to WARC files of one gzip stream each, normalises them, and reads the normalised archives back.

    `folder` gets monolithic/, normal/archives/ and normal/index/; without it a new one in the shared folder is taken.
    Null html and null urls count as empty, and null html is a response. A page_id that repeats gives a record for each
    row; rows that repeat the smallest page_id of a payload are responses all. An empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    write_monolithic(responses(pages, least), f"{folder}/monolithic")
    normalise(spark, f"{folder}/monolithic", f"{folder}/normal")
    return read_archives(spark, f"{folder}/normal", with_payload)
