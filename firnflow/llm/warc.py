"""Deterministic sharded WARC writer, and the reader of what it wrote.

Records are range-sorted by (page id, payload digest).  The splitters come from a sample that a hash of the key picks, so they,
the files and every byte in them follow from the rows alone, not from partitions, retries or the cluster.  A shard's task
writes one gzip member per record and starts a new file when the compressed size reaches a bound.  Headers and digests are
made anew from the payload.  Every attempt of a task writes under names of its own in a temporary folder and reports its
files as rows; Spark commits the rows of one attempt only.  These rows are the manifest: a second job renames the files in
it, idempotently, then the manifest is written, and the temporary folder goes.  Readers open only what the manifest lists.

Which records repeat an earlier payload is found on narrow rows of ids and digests, and sent into the same shards ahead of the
record concerned, so whole pages are shuffled once.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnflow.llm.common import stored, whole

LEAST_REVISITED = 100  # bytes of a payload that a revisit may stand for
ROLL_BYTES = 64 << 20  # compressed, after which a file is closed
SHARD_BYTES = 8 << 20, 1 << 30  # of payload: the least and the most of a shard, which between them is 1/10,000 of the input
SAMPLED = 32  # keys looked at per shard to place the splitters
RECORD_BYTES = 512  # of headers, as an estimate for the sizes of shards
DATE = "1970-01-01T00:00:00Z"  # of every record, as pages carry no date
LEVEL = 6
BATCH_BYTES = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format

MANIFEST = "name string, temporary string, shard long, part long, records long, bytes long, sha256 string"


def _located(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that driver and executors share."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))


def record_id(page: str | None, digest: str, ordinal: int) -> str:
    """Name of the ordinal-th record of this page id and payload; the page id can be read back from it."""
    return f"urn:page:{'' if page is None else 'id=' + quote(page, safe='')}:{digest[:32]}:{ordinal}"


def _page_of(name: str) -> str | None:
    page = name.strip("<>").split(":")[2]
    return unquote(page.removeprefix("id=")) if page else None


def _headers(kind: str, name: str, fields: list[tuple[str, str]], content: str, block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", DATE), *fields,
             ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Type", content),
             ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"


def record(page: str | None, url: str | None, payload: bytes, ordinal: int = 0, refers: str | None = None) -> bytes:
    """A response, or where ``refers`` names another record a revisit of it, whose block is the HTTP headers alone."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    # An address is written as a URI: what may not stand in one is percent-encoded.
    fields = [] if url is None else [("WARC-Target-URI", quote(url, safe="%/:?#[]@!$&'()*+,;=-._~"))]
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if refers is not None:
        fields += [("WARC-Refers-To", f"<{refers}>"), ("WARC-Profile", PROFILE)]
    block = http if refers is not None else http + payload
    head = _headers("response" if refers is None else "revisit", record_id(page, digest, ordinal), fields, "application/http; msgtype=response", block)
    return head + block + b"\r\n\r\n"


def _info(name: str) -> bytes:
    block = b"software: firnflow\r\nformat: WARC File Format 1.1\r\n"
    return _headers("warcinfo", f"urn:file:{name}", [("WARC-Filename", name)], "application/warc-fields", block) + block + b"\r\n\r\n"


class _Files:
    """Files of one shard, rolled by compressed size, under temporary names of this attempt."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.system, self.folder = _located(folder)
        self.shard, self.roll_bytes, self.attempt = shard, roll_bytes, uuid.uuid4().hex
        self.part, self.out, self.done = 0, None, []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"{self.name}.{self.attempt}"
            self.system.create_dir(self.folder, recursive=True)
            self.out = self.system.open_output_stream(f"{self.folder}/{self.temporary}", compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
            self._put(_info(self.name))
        self._put(data)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _put(self, data: bytes) -> None:
        member = gzip.compress(data, LEVEL, mtime=0)
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.temporary, self.shard, self.part, self.records, self.size, self.sha.hexdigest()))
            self.out, self.part = None, self.part + 1


def _write(batches: Iterator[pa.RecordBatch], folder: str, roll_bytes: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows of shards: a row without ``whole_page`` says where the payload of the records that follow is to be found."""
    files, done, last, ordinal, first = None, [], None, 0, None
    for b in batches:
        for shard, page, digest, whole_page, url, payload, target in zip(*(b.column(n).to_pylist() for n in _ROW)):
            if files is None or files.shard != shard:
                if files is not None:
                    files.close()
                    done += files.done
                files = _Files(folder, shard, roll_bytes)
            if (page, digest) != last:
                last, ordinal, first = (page, digest), 0, None
            if not whole_page:
                first = target
                continue
            refers = None if first is None or (first == page and ordinal == 0) else record_id(first, digest, 0)
            files.add(record(page, url, payload, ordinal, refers))
            ordinal += 1
    if files is not None:
        files.close()
        done += files.done
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=_MANIFEST_NAMES)


_ROW = ["shard", "page", "digest", "whole_page", "url", "payload", "target"]
_MANIFEST_NAMES = [f.split()[0] for f in MANIFEST.split(", ")]


def _rename(batches: Iterator[pa.RecordBatch], source: str, folder: str) -> Iterator[pa.RecordBatch]:
    """Moves the files of the manifest to their names; one that is there already, from an attempt that was lost, is left."""
    system, target = _located(folder)
    _, temporary = _located(source)
    for b in batches:
        for name, made, size in zip(*(b.column(c).to_pylist() for c in ("name", "temporary", "bytes"))):
            if system.get_file_info(f"{temporary}/{made}").type != pafs.FileType.NotFound:
                system.move(f"{temporary}/{made}", f"{target}/{name}")
            elif system.get_file_info(f"{target}/{name}").size != size:
                raise FileNotFoundError(f"{name}: neither the temporary nor the whole file is there")
        yield b


def _splitters(rows: DataFrame, shards: int, count: int) -> list[tuple]:
    """Keys (page, digest) at which shards begin, of near equal bytes; at most some ``SAMPLED`` keys a shard reach the driver."""
    every = max(1, count // (shards * SAMPLED))
    picked = rows.where(F.col("page_id").isNotNull() & (F.pmod(F.xxhash64("page_id", "digest"), F.lit(every)) == 0))
    keys = picked.groupBy("page_id", "digest").agg(F.sum(F.col("bytes") + RECORD_BYTES).alias("bytes")).toArrow()
    sample = sorted(zip(*(keys.column(c).to_pylist() for c in ("page_id", "digest", "bytes"))))
    total, before, found = sum(s[2] for s in sample), 0, []
    for page, digest, size in sample:
        if before * shards >= total * (len(found) + 1):
            found.append((page, digest))
        before += size
    return found


def written(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, shard_bytes: tuple[int, int] = SHARD_BYTES,
            least_revisited: int = LEAST_REVISITED) -> DataFrame:
    """Writes a record for every row of ``pages`` (page_id, url, html) into archives in the new ``folder``; the manifest.

    Of rows with equal payloads of at least ``least_revisited`` bytes the one of the smallest page_id is a response and the
    others revisit it; of rows that repeat that page_id too, one is.  A null html is an empty payload.  A null page_id comes
    after all others, spread over the shards by its payload, and refers to the smallest page_id of its payload if there is
    one.  A null url gives a record without address.  The empty table gives an empty manifest and no file.  Other columns are
    ignored and may have any name.  ``folder`` must be one that driver and executors share.
    """
    spark = pages.sparkSession
    rows = pages.select(pages["page_id"], pages["url"].cast("string").alias("url"), F.encode(whole(pages["html"]), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    narrow = stored(rows.select("page_id", "digest", F.octet_length("payload").cast("long").alias("bytes")), "warc-digests")
    size = narrow.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bytes") + RECORD_BYTES).alias("bytes")).first()
    least, most = shard_bytes
    shards = -(-(size["bytes"] or 0) // min(max(least, (size["bytes"] or 0) // 10_000), most)) or 1

    repeated = narrow.where(F.col("bytes") >= least_revisited).groupBy("digest").agg(F.min("page_id").alias("target"), F.count(F.lit(1)).alias("n"))
    repeated = repeated.where("n > 1 AND target IS NOT NULL").drop("n")
    ahead = narrow.join(repeated, "digest").groupBy("page_id", "digest").agg(F.first("target").alias("target"))
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("url", "string"), ("payload", "binary"))]
    ahead = ahead.select("page_id", "digest", F.lit(False).alias("whole_page"), *nothing, F.col("target").cast("string").alias("target"))
    all_rows = ahead.unionByName(rows.select("page_id", "digest", F.lit(True).alias("whole_page"), "url", "payload", F.lit(None).cast("string").alias("target")))

    starts = spark.sparkContext.broadcast(_splitters(narrow, shards, size["n"]))

    @F.pandas_udf("int")
    def shard_of(known: pd.Series, page: pd.Series, digest: pd.Series) -> pd.Series:
        # A null page id comes as any value; ``known`` tells.
        return pd.Series(
            [bisect_right(starts.value, (p, d)) if k else int(d[:8], 16) % shards for k, p, d in zip(known, page, digest)], dtype="int32"
        )

    kind = pages.schema["page_id"].dataType.simpleString()
    filled = F.coalesce("page_id", F.lit("0").cast(kind))
    placed = all_rows.withColumn("shard", shard_of(F.col("page_id").isNotNull(), filled, "digest")).withColumn("page", F.col("page_id").cast("string"))
    sorted_rows = placed.repartitionById(shards, "shard").sortWithinPartitions(F.col("page_id").asc_nulls_last(), "digest", "whole_page", "url")
    temporary = f"{folder.rstrip('/')}/_temporary"
    claimed = stored(sorted_rows.select(*_ROW).mapInArrow(lambda b: _write(b, temporary, roll_bytes), MANIFEST), "warc-files")
    files = claimed.count()
    named = claimed.repartition(max(1, min(files, 10_000))).mapInArrow(lambda b: _rename(b, temporary, folder), MANIFEST)
    named.drop("temporary").write.parquet(f"{folder.rstrip('/')}/_manifest")
    system, path = _located(temporary)
    if system.get_file_info(path).type == pafs.FileType.Directory:
        system.delete_dir(path)
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """name, shard, part, records, bytes, sha256 of every file."""
    shape = ", ".join(f for f in MANIFEST.split(", ") if not f.startswith("temporary"))
    return spark.read.schema(shape).parquet(f"{folder.rstrip('/')}/_manifest")


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case name, and block of each record of a compressed archive."""
    with io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 16) as text:
        while line := text.readline():
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a record: {line[:40]!r}")
            fields = {}
            while (line := text.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().partition(":")
                fields[name.strip().lower()] = value.strip()
            length = int(fields["content-length"])
            block = text.read(length)
            if len(block) != length or text.read(4) != b"\r\n\r\n":
                raise ValueError("a record is cut off")
            yield fields, block


def _rows(batches: Iterator[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    system, path = _located(folder)
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    for b in batches:
        for name, count in zip(b.column("name").to_pylist(), b.column("records").to_pylist()):
            found, held, size = 0, [], 0
            with system.open_input_stream(f"{path}/{name}", compression=None) as stream:
                for fields, block in records(stream):
                    if fields["warc-type"] == "warcinfo":
                        continue
                    if "sha256:" + hashlib.sha256(block).hexdigest() != fields["warc-block-digest"]:
                        raise ValueError(f"{name}: block of {fields['warc-record-id']} does not fit its digest")
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(re.search(rb"(?mi)^content-length:\s*(\d+)", http)[1])
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    revisit = fields["warc-type"] == "revisit"
                    if not revisit and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{name}: payload of {fields['warc-record-id']} does not fit its digest")
                    refers = _page_of(fields["warc-refers-to"]) if revisit else None
                    held.append((_page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), fields["warc-type"], refers, length, digest,
                                 payload if payloads and not revisit else None))
                    found += 1
                    size += len(block) + RECORD_BYTES
                    if size >= BATCH_BYTES:
                        yield batch(held)
                        held, size = [], 0
            if found != count:
                raise ValueError(f"{name} holds {found} records, its manifest says {count}")
            if held:
                yield batch(held)


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Every record of the archives in the manifest: page_id (string), url (as the URI written), record_type, refers_to (page id
    of the response), payload_bytes, payload_digest (both of the full payload) and, unless left out, payload, which is null for
    revisits.  Blocks, payloads and the number of records are checked against the headers and the manifest; what does not fit
    raises.
    """
    files = manifest(spark, folder).select("name", "records")
    shape = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"
    dealt = files.repartition(max(1, min(files.count(), 100_000)))
    rows = dealt.mapInArrow(lambda b: _rows(b, folder, payloads), shape)
    return rows if payloads else rows.drop("payload")
