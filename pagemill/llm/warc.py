"""Dictionary-compressed WARC archives of pages, and their reader.

An archive starts with a skippable frame that holds a Zstandard dictionary built from the archive's own
records, itself compressed; after it every record is a frame of its own, compressed with that dictionary, so that any
record can be read alone. Pages with equal payloads are found by digest, in rows without payloads,
before anything is written: the one with the smallest id is a response and the others revisit it.

Archives are files of bounded size and number of records in the shared folder, each written under a name of its task attempt;
the same attempt writes their rows of the index, and only what a committed attempt lists is read, so a lost executor costs its tasks alone.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, schema_of

#: Fixed values of the format: the dictionary frame's magic number and the profile of revisits.
DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of records, and records, from which the next archive begins; bytes of a dictionary and of its samples.
ARCHIVE_BYTES, ARCHIVE_RECORDS, DICTIONARY_BYTES, SAMPLE_BYTES, SAMPLE_RECORD = 16 << 20, 20_000, 16 << 10, 1 << 20, 16 << 10
LEVEL = 3
#: Archives of a reading task, where there are enough for all cores.
TASK_ARCHIVES = 32


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has no block."""
    block = payload if kind == "response" else b""
    url = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{digest}')}>", f"WARC-Target-URI: {url}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", f"X-Page-Id: {'' if page_id is None else page_id}", f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from a bounded sample of the records, spread over all of them; records too few or too unlike to train one are its content as they stand."""
    step = max(1, sum(min(len(r), SAMPLE_RECORD) for r in records) // SAMPLE_BYTES)
    sample = [r[:SAMPLE_RECORD] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=200, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(sample)[:DICTIONARY_BYTES]


def archive(records: list[bytes]) -> Iterator[bytes]:
    """The frames of a whole archive: the compressed dictionary's skippable one, and one per record."""
    words = build_dictionary(records)
    held = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress(words)
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words), write_content_size=True).compress
    yield struct.pack("<II", DICTIONARY_MAGIC, len(held)) + held
    yield from map(press, records)


def read_archive(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, read once from a stream of bytes and held one by one."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("an archive begins with its dictionary")
    words = zstandard.ZstdDecompressor().decompress(source.read(size))
    with zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words)).stream_reader(source, read_across_frames=True, closefd=False) as plain, io.BufferedReader(plain, 1 << 18) as lines:
        while first := lines.readline():
            if not first.startswith(b"WARC/"):
                raise ValueError("not a WARC record")
            headers = {}
            while line := lines.readline().rstrip(b"\r\n"):
                key, _, value = line.decode("utf-8").partition(":")
                headers[key] = value.strip(" ")
            block = lines.read(int(headers["Content-Length"]))
            if lines.read(4) != b"\r\n\r\n":
                raise ValueError("a record of another length than it says")
            yield headers, block


def find_revisits(pages: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """Rows (id, digest, refers_to) of pages whose payload another page with a smaller id has."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = pages.where(F.octet_length(text) >= least).select(F.col(id_col).alias("id"), F.sha2(text.cast("binary"), 256).alias("digest"))
    first = marked.groupBy("digest").agg(F.min("id").alias("refers_to"), F.max("id").alias("last")).where("last > refers_to").drop("last")
    # The digest in two parts: else the groups would share the join's stage, and a hot digest could not be split.
    first = first.withColumn("digest", F.concat(F.substring("digest", 1, 32), F.substring("digest", 33, 32)))
    return marked.join(first, "digest").where("id > refers_to").select("id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", least: int = 100) -> DataFrame:
    """Write all pages as ``folder``/*.warc.zst; rows (path, records, bytes) of the archives.

    Null payloads are empty. Payloads under ``least`` bytes are always responses, as are rows with a null
    id and rows that repeat the smallest id of their payload. An id with several payloads is judged
    payload by payload. An empty table writes no archive.
    """
    refs = find_revisits(pages, id_col, text_col, least)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).join(refs, ["id", "digest"], "left").select("id", "url", "payload", "digest", "refers_to")

    def write(batches):
        records, size = [], 0
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)

        def flush() -> pa.RecordBatch:
            name, n = f"{uuid.uuid4().hex}.warc.zst", 0
            with store.open_output_stream(f"{root}/{name}") as out:
                for frame in archive(records):
                    n += out.write(frame)
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(records)], pa.int64()), pa.array([n], pa.int64())], ["path", "records", "bytes"])

        for batch in batches:
            for i in range(batch.num_rows):
                id_, url, payload, digest, refers_to = (c[i].as_py() for c in batch.columns)
                own = record("response" if refers_to is None else "revisit", id_, url, payload, digest, refers_to)
                if records and (size + len(own) > ARCHIVE_BYTES or len(records) >= ARCHIVE_RECORDS):
                    yield flush()
                    records, size = [], 0
                records.append(own)
                size += len(own)
        if records:
            yield flush()

    # A task's archives and its rows of the index are one attempt's: no shuffle comes between, and the index is committed task by task.
    return Scratch(pages.sparkSession, "warc-index").put(rows.mapInArrow(write, schema_of("path string, records bigint, bytes bigint")))


def read_archives(index: DataFrame) -> DataFrame:
    """Rows (id, payload_bytes, payload_digest, record_type, refers_to, block) of the archives listed in ``index``.

    Each block is checked against its digest. Archives are dealt out evenly, to all cores at least.
    """

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_stream(name) as f:
                    rows, size = [], 0
                    for head, block in read_archive(f):
                        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                        kind = head["WARC-Type"]
                        if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
                            raise ValueError(f"a record of {path} is damaged")
                        ref = head.get("X-Refers-To-Page-Id")
                        rows.append((int(head["X-Page-Id"]) if head["X-Page-Id"] else None, int(head["X-Payload-Length"]), digest, kind, int(ref) if ref else None, block))
                        size += len(block)
                        if size > 4 << 20 or len(rows) >= 10_000:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)

    archives = index.count()
    parts = max(1, min(archives, index.sparkSession.sparkContext.defaultParallelism), archives // TASK_ARCHIVES)
    dealt = index.select("path").repartition(parts)
    return dealt.mapInArrow(read, schema_of("id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, block binary"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to", "block"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", least: int = 100) -> DataFrame:
    """Archive all pages in the shared folder and read them back: one row per page, see ``read_archives``."""
    folder = Scratch(pages.sparkSession, "warc").path("archives")
    return read_archives(write_archives(pages, folder, id_col, url_col, text_col, least)).withColumnRenamed("id", id_col)
