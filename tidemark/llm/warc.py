"""WARC archives: writing pages as gzip members, one record each, and reading them back sequentially.

Writing.  Records of equal payload are found by SHA-1 and length; the one with the largest id is stored as
``response``, the others as ``revisit`` records that refer to it and store no payload.  Only digests are grouped;
the join that brings the group's original back to the pages is a sort-merge join on the digest whose hot partitions
adaptive execution may split.  Each attempt of a task writes its rows to files of its own in a shared folder, under a temporary
name, and renames them when whole.  The manifest names the files of the attempts that count, with their records and bytes; what another
attempt left behind is never read, and a file that isn't what the manifest says raises.

Reading.  A reader task streams a file in small chunks: one ``zlib`` object a member, WARC headers up to the blank
line, then exactly Content-Length bytes, then the closing CRLF CRLF; the block digest and the payload digest are
computed while the bytes pass and a mismatch raises.  One record's payload is the most that is held.  ``checked`` compares what revisits
say of their payload with the response they refer to.

Defined cases: a null payload counts as empty; a null id is kept (its record is a revisit if an equal payload has an
id, else a response); rows repeated with the largest id are all responses; a null URL leaves the header out; an empty
table gives no archive and no rows; further columns of the pages are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

MANIFEST = "path string, records long, bytes long"
ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 16


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id, url, payload: bytes, original, is_response: bool) -> bytes:
    """One uncompressed WARC/1.1 record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if is_response else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if is_response else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest32(payload)}",
        f"WARC-Block-Digest: sha1:{digest32(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if not is_response:
        head += [f"WARC-Refers-To: <urn:x-page:{original}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def _writer(out_dir: str, level: int, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, root = common.open_fs(out_dir)
        done, out, n, size, temp = [], None, 0, 0, ""

        def close() -> None:
            nonlocal out
            out.close()
            out = None
            final = f"{root}/pages-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):05d}.warc.gz"
            fs.move(temp, final)
            done.append((f"{out_dir}/{final.rsplit('/', 1)[1]}", n, size))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "original", "is_response")), strict=True):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    temp, n, size = f"{root}/.tmp-{task.taskAttemptId()}-{len(done)}", 0, 0
                    out = fs.open_output_stream(temp, compression=None)
                data = member(record_bytes(row[0], row[1], row[2], row[3], row[4]), level)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= roll_bytes:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], names=["path", "records", "bytes"])

    return write


def write_archives(pages: DataFrame, out_dir: str, *, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url", min_payload: int = 0, level: int = 4, roll_bytes: int = 64 << 20) -> DataFrame:
    """Write every page to archives under ``out_dir`` and return the manifest (path, records, bytes), one row a file."""
    keyed = pages.select(
        F.col(id_col).cast("long").alias("id"),
        (F.col(url_col) if url_col else F.lit(None)).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumns({"sha": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    originals = keyed.filter(F.col("size") >= min_payload).groupBy("sha", "size").agg(F.max("id").alias("original")).withColumnRenamed("size", "osize").withColumnRenamed("sha", "osha")
    # The key of the join is the digest alone: its own exchange on either side lets adaptive execution split a hot digest.
    marked = keyed.join(originals, (F.col("sha") == F.col("osha")) & (F.col("size") - F.col("osize") == 0), "left")
    marked = marked.select("id", "url", "payload", "original", (F.col("original").isNull() | F.coalesce(F.col("id") == F.col("original"), F.lit(False))).alias("is_response"))
    manifest_dir = f"{out_dir}/_manifest"
    marked.mapInArrow(_writer(out_dir, level, roll_bytes), MANIFEST).write.mode("overwrite").parquet(manifest_dir)
    return pages.sparkSession.read.schema(MANIFEST).parquet(manifest_dir)


class _Stream:
    """Exact reads from one gzip member after another, fed by chunks."""

    def __init__(self, source):
        self.source, self.raw, self.out, self.z = source, b"", bytearray(), None

    def next_member(self) -> bool:
        """Open the next member; False at the end of the file."""
        if not self.raw:
            self.raw = self.source.read(CHUNK)
        self.z, self.out = zlib.decompressobj(31), bytearray()
        return bool(self.raw)

    def _more(self) -> bool:
        if self.z.eof:
            return False
        if not self.raw:
            self.raw = self.source.read(CHUNK)
            if not self.raw:
                raise ValueError("a gzip member is cut off")
        self.out += self.z.decompress(self.raw, CHUNK)
        self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        while (at := self.out.find(mark)) < 0:
            if not self._more():
                raise ValueError("a header has no end")
        found = bytes(self.out[:at])
        del self.out[: at + len(mark)]
        return found

    def some(self, most: int) -> bytes:
        while not self.out:
            if not self._more():
                raise ValueError("a block is shorter than its Content-Length")
        found = bytes(self.out[:most])
        del self.out[:most]
        return found

    def end(self) -> None:
        while self._more():
            pass
        if bytes(self.out) != b"\r\n\r\n":
            raise ValueError("a record doesn't end where its Content-Length says")


def _headers(text: bytes) -> tuple[str, dict[str, str]]:
    first, *rest = text.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest)}


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def records(source, with_payload: bool) -> Iterator[tuple]:
    """The records of an open archive, as rows of ``ROWS``."""
    stream = _Stream(source)
    while stream.next_member():
        version, head = _headers(stream.until(b"\r\n\r\n"))
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        left = int(head["content-length"])
        block, payload, kept = hashlib.sha1(), hashlib.sha1(), []
        http = stream.until(b"\r\n\r\n") + b"\r\n\r\n"
        block.update(http)
        left -= len(http)
        stored = left
        while left:
            data = stream.some(left)
            block.update(data)
            payload.update(data)
            if with_payload:
                kept.append(data)
            left -= len(data)
        stream.end()
        for kind, seen in (("block", block), ("payload", payload)):
            if head["warc-type"] == "revisit" and kind == "payload":
                continue
            if head[f"warc-{kind}-digest"] != "sha1:" + base64.b32encode(seen.digest()).decode():
                raise ValueError(f"the {kind} digest of {head['warc-record-id']} doesn't hold")
        told = int(_headers(http)[1]["content-length"])
        if head["warc-type"] == "response" and told != stored:
            raise ValueError("the HTTP length differs from the payload's")
        yield _page(head["warc-record-id"]), told, head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"], _page(head.get("warc-refers-to")), head.get("warc-target-uri"), b"".join(kept) if with_payload and head["warc-type"] == "response" else None


def _reader(with_payload: bool):
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path, told, size in zip(*(batch.column(c).to_pylist() for c in ("path", "records", "bytes")), strict=True):
                fs, at = common.open_fs(path)
                if fs.get_file_info(at).size != size:
                    raise ValueError(f"{path} isn't as long as the manifest says")
                n = 0
                with fs.open_input_stream(at, compression=None) as source:
                    for r in records(source, with_payload):
                        n += 1
                        rows.append(r)
                        held += len(r[6] or b"")
                        if len(rows) >= 2000 or held >= 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if n != told:
                    raise ValueError(f"{path} doesn't hold the records that the manifest says")
        yield batch_of(rows)

    return read


def read_archives(manifest: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """The records of the manifest's archives; a file is read by one task."""
    # The manifest is a written table of one row a file.  With a number of partitions given they aren't merged.
    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(_reader(with_payload), ROWS)


def checked(found: DataFrame) -> DataFrame:
    """The records, settled, after each revisit's digest and length were compared with its response's; a revisit that differs or refers to none raises."""
    found = common.settled(found)
    response = F.col("record_type") == "response"
    groups = found.filter(~response | F.col("page_id").isNotNull()).groupBy(F.when(response, F.col("page_id")).otherwise(F.col("refers_to")).alias("of"))
    told = groups.agg(F.count_if(response).alias("responses"), F.count_if(~response).alias("revisits"), *(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("payload_digest", "payload_bytes")))
    differs = (F.col("min_payload_digest") != F.col("max_payload_digest")) | (F.col("min_payload_bytes") != F.col("max_payload_bytes"))
    if bad := told.filter((F.col("revisits") > 0) & (F.col("of").isNull() | (F.col("responses") == 0) | differs)).select("of").limit(3).collect():
        raise ValueError(f"revisits differ from their response: {[r['of'] for r in bad]}")
    return found
