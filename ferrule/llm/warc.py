"""WARC archives with an index: records are written with offset, length, URL and digest; selected records are read back
by sorted byte ranges, neighbouring ones in one read.

Of pages with equal payloads the one with the largest page_id is a response record, the others are revisits that name
it. Each task writes archives of its own, of at most about ARCHIVE_BYTES, into the folder that all executors share,
and passes on only index rows. A task that runs again writes new archives under other names; the index, written before
anything is read, names the files of the tasks that counted.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.llm.common import new_path, saved

ARCHIVE_BYTES = 64_000_000
#: A read spans at most so many bytes, and gaps between selected records of at most so many.
READ_BYTES, GAP_BYTES = 8_000_000, 65_536
#: Compressed bytes of an archive that one task reads.
UNIT_BYTES = 16_000_000
#: Pieces into which the pages of one payload are cut for the join with the payload's holder.
SALTS = 16
DATE = "2024-01-01T00:00:00Z"

INDEX = "archive string, offset long, length long, page_id string, url string, digest string, record_type string, refers_to string"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(path: str):
    """pyarrow's file system for a path or URI, and the path in it."""
    from pyarrow import fs

    path = re.sub("^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def record(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object = None) -> bytes:
    """A whole record, compressed on its own. A revisit keeps the HTTP header, not the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parsed(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields of a compressed record and of its HTTP header, and the payload."""
    whole = zlib.decompress(raw, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode("latin-1").split("\r\n")[1:])}, payload


def write(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes pages (page_id, url, html) as archives; the index, one row per page.

    A null html is an empty payload. Rows with equal payload and the same page_id are all responses if theirs is the
    largest. A null page_id is smaller than any other; it stays null, and its record's id is random. A page of any length
    is one record; other columns are ignored. Without any page no archive is written and the index is empty.
    """
    spark, folder = pages.sparkSession, new_path(pages.sparkSession, "warc")
    kind = dict(pages.dtypes)["page_id"]
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary"))).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)))
    holders = rows.groupBy("sha").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).where("n > 1 and holder is not null").drop("n")
    holders = holders.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    placed = rows.join(holders, ["sha", "salt"], "left").select(F.col("page_id").cast("string").alias("page_id"), "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder").cast("string")).alias("refers_to"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = filesystem(folder)
        store.create_dir(top, recursive=True)
        name, out, at, index = "", None, 0, []

        def done() -> pd.DataFrame:
            out.close()
            return pd.DataFrame(index, columns=["archive", "offset", "length", "page_id", "url", "digest", "record_type", "refers_to"])

        for batch in batches:
            for page, url, html, refers in zip(batch["page_id"], batch["url"], batch["html"], batch["refers_to"], strict=True):
                if out is None:
                    name, at, index = f"{uuid.uuid4().hex}.warc.gz", 0, []
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                payload = html.encode("utf-8", "surrogatepass")
                digest = digest_of(payload)
                raw = record(uuid.uuid4() if page is None else page, url, payload, digest, refers)
                out.write(raw)
                index.append((f"{folder}/{name}", at, len(raw), page, url, digest, "response" if refers is None else "revisit", refers))
                at += len(raw)
                if at >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    index = placed.mapInPandas(run, INDEX)
    return saved(index.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")}), "warc-index")


def ranges(rows: list[tuple[str, int, int]], most: int = READ_BYTES, gap: int = GAP_BYTES) -> Iterator[tuple[int, int]]:
    """Slices of rows (archive, offset, length; sorted) that one read serves."""
    start = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i][0] != rows[start][0] or rows[i][1] - rows[i - 1][1] - rows[i - 1][2] > gap or rows[i][1] + rows[i][2] - rows[start][1] > most:
            yield start, i
            start = i


def read(index: DataFrame) -> DataFrame:
    """The selected records: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload (null for
    revisits). Lengths and digests are those of the full payload; a response's digest is computed from what was read."""
    kind = dict(index.dtypes)["page_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: tuple = ("", None)
        for batch in batches:
            rows = list(zip(batch["archive"], batch["offset"], batch["length"], strict=True))
            for a, b in ranges(rows):
                name, start, end = rows[a][0], rows[a][1], rows[b - 1][1] + rows[b - 1][2]
                if opened[0] != name:
                    store, path = filesystem(name)
                    opened = (name, store.open_input_file(path))
                span = opened[1].read_at(end - start, start)
                found = []
                for (_, offset, length), page, kept in zip(rows[a:b], batch["page_id"].iloc[a:b], batch["refers_to"].iloc[a:b], strict=True):
                    fields, http, payload = parsed(span[offset - start : offset - start + length])
                    digest = fields["warc-payload-digest"].partition(":")[2]
                    revisit = fields["warc-type"] == "revisit"
                    if not revisit and digest_of(payload) != digest:
                        raise ValueError(f"the payload of {fields['warc-record-id']} differs from its digest")
                    if page is not None and fields["warc-record-id"] != f"<urn:page:{page}>":
                        raise ValueError(f"the index points at {fields['warc-record-id']}")
                    size = int(http["content-length"]) if revisit else len(payload)
                    found.append((page, fields.get("warc-target-uri"), fields["warc-type"], kept if revisit else None, size, digest, None if revisit else payload))
                yield pd.DataFrame(found, columns=["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])

    schema = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"
    ids = {c: F.col(c).cast("string") for c in ("page_id", "refers_to")}
    # tasks by bytes to read, not by the few bytes of their index rows, which the adaptive planner would join to one task
    total = index.agg(F.sum("length")).first()[0] or 0
    chosen = index.select("archive", "offset", "length", "page_id", "refers_to").withColumns(ids)
    sorted_index = chosen.repartition(int(total // UNIT_BYTES) + 1, "archive", F.floor(F.col("offset") / UNIT_BYTES)).sortWithinPartitions("archive", "offset")
    return sorted_index.mapInPandas(run, schema).withColumns({c: F.col(c).cast(kind) for c in ids})


def query(spark, sf_dir: str) -> DataFrame:
    found = read(write(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS holder, sha1(t) AS h FROM p)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> holder THEN holder END AS refers_to FROM d
"""
