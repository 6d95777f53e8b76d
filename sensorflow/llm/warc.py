"""WARC archives: deterministic sharded writer with manifests, and a reader of what it committed."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound, shared_folder, written

#: Payload bytes aimed at per shard, and compressed bytes after which a shard's file is closed.
SHARD_BYTES = 64 << 20
FILE_BYTES = 16 << 20
#: Ranges of ids at most, and rows of the sample whose quantiles cut them.
MOST_RANGES = 4_096
SAMPLE = 200_000
#: Tasks that write at most.
MOST_TASKS = 50_000
#: Payloads of at least this many bytes are revisits where another record holds the same ones.
REVISIT_BYTES = 1_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Regenerated headers carry this date, so that equal input gives equal files.
DATE = "1970-01-01T00:00:00Z"
READ_BYTES = 1 << 20


def revisits(rows: DataFrame) -> DataFrame:
    """(id, digest, refers_to) of the rows (id, digest, bytes) that revisit another: of equal
    payloads of at least REVISIT_BYTES the one with the largest id is the response."""
    rows = rows.filter((F.col("bytes") >= REVISIT_BYTES) & F.col("id").isNotNull())
    groups = (rows.groupBy("digest", "bytes").agg(F.max("id").alias("last"), F.min("id").alias("first"))
              .filter("last <> first"))
    # a new key, so that AQE may split the rows of one large group
    groups = groups.select(F.struct("digest", "bytes").alias("_k"), "last")
    return (rows.withColumn("_k", F.struct("digest", "bytes")).join(groups, "_k").filter("id <> last")
            .select("id", "digest", F.col("last").alias("refers_to")).distinct())


def places(rows: DataFrame, shard_bytes: int) -> tuple[list[int], int, int]:
    """Where ids are cut: the least id and the last id of each range; shards in a range; shards of rows
    without id.

    Cuts are quantiles of payload bytes over ids of a sample that depends on content alone (by
    a hash of id and digest), so equal input is cut alike; the driver gets SAMPLE rows or so.
    """
    size = F.col("bytes") + 500
    known = F.col("id").isNotNull()
    total, none, count, low, high = rows.agg(F.sum(F.when(known, size)), F.sum(F.when(~known, size)), F.count("id"),
                                             F.min("id"), F.max("id")).first()
    wanted = -(-(total or 0) // shard_bytes)
    ranges = min(wanted, MOST_RANGES)
    share = min(1.0, SAMPLE / max(count, 1))
    drawn = F.shiftrightunsigned(F.xxhash64("id", "digest"), 11) < int(share * (1 << 53))
    sample = sorted(tuple(r) for r in rows.filter(known & drawn).select("id", size).collect()) if ranges > 1 else []
    mass, seen, cuts = sum(b for _, b in sample), 0, []
    for i, b in sample:
        seen += b
        if seen * ranges >= mass * (len(cuts) + 1) and len(cuts) + 1 < ranges and i < high and (not cuts or i > cuts[-1]):
            cuts.append(i)
    return [low or 0, *cuts, high or 0], max(1, -(-wanted // max(ranges, 1))), -(-(none or 0) // shard_bytes)


def shard_of(edges: list[int], pieces: int, nulls: int) -> Column:
    """The shard of ``id``: by binary search in the cuts, then by equal widths where a range is more than
    one shard; rows without id come last, by digest."""
    last = len(edges) - 2  # the last range; range r > 0 holds edges[r] < id <= edges[r + 1]
    held = F.array(*[F.lit(e).cast("bigint") for e in edges])
    steps = [1 << k for k in reversed(range(max(last, 1).bit_length()))]
    at = F.aggregate(F.lit(steps), F.lit(0), lambda r, s: F.when(
        (r + s <= last) & (F.col("id") > F.get(held, F.least(r + s, F.lit(last)))), r + s).otherwise(r))
    if pieces > 1:
        def inner(r: Column) -> Column:
            lo, hi = (F.get(held, r + k).cast("decimal(20,0)") for k in (0, 1))
            part = (F.col("id").cast("decimal(20,0)") - lo) * F.lit(pieces) / (hi - lo + 1)
            return r * pieces + F.least(F.floor(part).cast("int"), F.lit(pieces - 1))
        at = bound(at, inner)
    return F.when(F.col("id").isNull(), F.lit((last + 1) * pieces) + F.pmod(F.xxhash64("digest"), F.lit(max(nulls, 1))).cast("int")).otherwise(at)


def record(number: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: regenerated headers and, for a response, the payload as its block."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    headers = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
               f"WARC-Record-ID: {record_id(number, digest)}", f"WARC-Date: {DATE}"]
    if url:
        headers.append("WARC-Target-URI: " + "".join(c if " " < c < "\x7f" else
                                                     "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if number is not None:
        headers.append(f"X-Page-ID: {number}")
    if revisit:
        headers += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                    f"X-Refers-To-Page-ID: {refers_to}",
                    f"X-Payload-Length: {len(payload)}"]
    headers += [f"WARC-Payload-Digest: sha1:{base32(digest)}",
                f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).hexdigest())}",
                "Content-Type: text/html", f"Content-Length: {len(block)}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record_id(number: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{number}/{digest}')}>"


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Any file system that Arrow knows, by the uri's scheme; a bare path is a shared mount."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class ShardFiles:
    """Writes the records of one shard to files that close beyond a compressed size."""

    def __init__(self, folder: str, shard: int, file_bytes: int):
        self.fs, self.folder = filesystem(folder)
        self.shard, self.file_bytes, self.rolls, self.out = shard, file_bytes, 0, None
        self.done: list[dict] = []

    def add(self, data: bytes) -> None:
        member = gzip.compress(data, 6, mtime=0)
        if self.out is not None and self.bytes + len(member) > self.file_bytes:
            self.close()
        if self.out is None:
            self.temporary = f"{self.folder}/_temporary/{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.bytes, self.records, self.sha = 0, 0, hashlib.sha1()
        self.out.write(member)
        self.sha.update(member)
        self.bytes += len(member)
        self.records += 1

    def close(self) -> None:
        """Moves the file to its final name: a retried task writes the same bytes there."""
        if self.out is None:
            return
        self.out.close()
        self.out = None
        name = f"part-{self.shard:06d}-{self.rolls:04d}.warc.gz"
        self.fs.move(self.temporary, f"{self.folder}/{name}")
        self.done.append({"file": name, "records": self.records, "bytes": self.bytes,
                          "sha1": self.sha.hexdigest()})
        self.rolls += 1


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", shard_bytes: int = SHARD_BYTES,
               file_bytes: int = FILE_BYTES) -> str:
    """Writes the archive to ``folder`` and returns it.

    Rows go to shards of neighbouring ids and are sorted within them by id, then url, then
    digest; equal input gives the same files whatever the cluster.  A file is written under a
    temporary name and moved when it is complete; ``_manifest`` lists the committed files with
    their records, bytes and SHA-1, and only files in it count.

    Ids may be any 64-bit integers.  NULL html is an empty payload; NULL ids come last, spread
    over shards by digest, and are never referred to; repeated rows give a record each, and of
    equal payloads all rows with the largest id are responses.  Rows of one id share a shard.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("digest"))
    narrow = written(pages.select(F.col(id_col).cast("bigint").alias("id"), F.octet_length(payload).alias("bytes"),
                                  F.sha1(payload).alias("digest")), "digests")
    edges, pieces, nulls = places(narrow, shard_bytes)
    shards = (len(edges) - 1) * pieces + max(nulls, 1)
    # What a row refers to travels to its shard and is sorted right before it, so payloads are
    # shuffled once and need no join.
    rows = rows.unionByName(revisits(narrow), allowMissingColumns=True).withColumn("shard", shard_of(edges, pieces, nulls))
    local, path = filesystem(folder)
    local.create_dir(f"{path}/_temporary", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: ShardFiles | None = None
        about, refers = None, {}  # of the current id: what its digests refer to

        def manifest(done: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(done, schema=pa.schema(
                [("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())]))

        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if files is None or files.shard != r["shard"]:
                    if files is not None:
                        files.close()
                        yield manifest(files.done)
                    files = ShardFiles(folder, r["shard"], file_bytes)
                if r["id"] != about:
                    about, refers = r["id"], {}
                if r["refers_to"] is not None:
                    refers[r["digest"]] = r["refers_to"]
                else:
                    files.add(record(r["id"], r["url"], r["payload"], r["digest"], refers.get(r["digest"])))
        if files is not None:
            files.close()
            yield manifest(files.done)

    (rows.repartition(min(shards, MOST_TASKS), "shard")
     .sortWithinPartitions("shard", F.col("id").asc_nulls_last(), F.col("refers_to").asc_nulls_last(), "url", "digest")
     .mapInArrow(write, "file string, records long, bytes long, sha1 string")
     .write.mode("overwrite").parquet(f"{folder}/_manifest"))
    local.delete_dir(f"{path}/_temporary")
    return folder


def records_of(folder: str, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file, one at a time."""
    fs, path = filesystem(folder)
    unzip = zlib.decompressobj(31)
    data = b""
    with fs.open_input_stream(f"{path}/{name}", compression=None) as f:
        while chunk := f.read(READ_BYTES):
            while chunk:
                data += unzip.decompress(chunk)
                chunk = unzip.unused_data if unzip.eof else b""
                if unzip.eof:  # one gzip member holds one record
                    head, _, rest = data.partition(b"\r\n\r\n")
                    lines = head.decode().split("\r\n")
                    headers = dict(x.split(": ", 1) for x in lines[1:])
                    yield headers, rest[:int(headers["Content-Length"])]
                    data, unzip = b"", zlib.decompressobj(31)
    if data:
        raise ValueError(f"{name} ends inside a record")


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the committed files: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest, payload (NULL for revisits).  Digests of blocks and payloads
    are computed again; a record that does not match its headers is an error."""
    files = spark.read.parquet(f"{folder}/_manifest").select("file", "records")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, expected in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist()):
                found, held, seen = [], 0, 0
                for headers, block in records_of(folder, name):
                    revisit = headers["WARC-Type"] == "revisit"
                    digest = hashlib.sha1(block).hexdigest()
                    declared = base64.b32decode(headers["WARC-Payload-Digest"][5:]).hex()
                    if headers["WARC-Block-Digest"] != f"sha1:{base32(digest)}" or not revisit and declared != digest:
                        raise ValueError(f"{name}: a record's digest does not match")
                    number, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
                    found.append({"page_id": number and int(number), "url": headers.get("WARC-Target-URI"),
                                  "record_type": headers["WARC-Type"], "refers_to": refers and int(refers),
                                  "payload_bytes": int(headers["X-Payload-Length"]) if revisit else len(block),
                                  "payload_digest": declared, "payload": None if revisit else block})
                    held += len(block)
                    seen += 1
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(found, schema=schema)
                        found, held = [], 0
                if seen != expected:
                    raise ValueError(f"{name} has {seen} records, the manifest {expected}")
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    n = max(1, files.count())
    return (files.repartition(n, "file").mapInArrow(read, "page_id long, url string, record_type string, refers_to long,"
                                                    " payload_bytes long, payload_digest string, payload binary"))


def resolved(records: DataFrame) -> DataFrame:
    """Records as read, the payload length of each revisit taken from the response that it refers to;
    one that the archive does not hold, or with another digest, is an error."""
    columns = records.columns
    responses = (records.filter("record_type = 'response' AND page_id IS NOT NULL").groupBy("page_id", "payload_digest")
                 .agg(F.max("payload_bytes").alias("_bytes")))
    # a new key, so that AQE may split the revisits of one response
    responses = responses.select(F.struct(F.col("page_id").alias("p"), F.col("payload_digest").alias("d")).alias("_k"), "_bytes")
    missing = F.raise_error(F.concat(F.lit("a revisit refers to a response that is not there: page "),
                                     F.col("refers_to").cast("string"))).cast("bigint")
    revisits = (records.filter("record_type = 'revisit'")
                .withColumn("_k", F.struct(F.col("refers_to").alias("p"), F.col("payload_digest").alias("d")))
                .join(responses, "_k", "left").withColumn("payload_bytes", F.coalesce("_bytes", missing)))
    return records.filter("record_type <> 'revisit'").unionByName(revisits.select(columns))


def warc_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/warc"
