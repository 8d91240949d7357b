"""WARC archives compressed record by record with a shared Zstandard dictionary."""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.common import materialise
from vaultline.session import qualified, scratch_dir

# Fixed values of the format: the magic number of the skippable frame that holds the dictionary.
DICTIONARY_MAGIC = (0x184D2A5D).to_bytes(4, "little")
# Payloads below this size are never revisits.
SMALL = 100
# The dictionary is built from the first responses by digest, at most so many and so many bytes of each.
SAMPLES = 512
SAMPLE_BYTES = 8 << 10
DICTIONARY_BYTES = 32 << 10
# An archive is closed once it has so many compressed bytes.
ARCHIVE_BYTES = 16 << 20
LEVEL = 3

_NAMESPACE = "urn:page:"
_DATE = "1970-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

ROWS = "url string, payload_bytes bigint, payload_digest string, record_type string"


def record_id(page: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{_NAMESPACE}{page}')}>"


def record(page: object, url: str | None, payload: bytes, digest: str, size: int, refers_to: object) -> bytes:
    """One WARC record; a revisit has ``refers_to`` and leaves the payload out."""
    revisit = refers_to is not None
    block = _HTTP if revisit else _HTTP + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page)}",
        f"WARC-Date: {_DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Page: {'' if page is None else page}",
        f"WARC-Payload-Length: {size}",
    ]
    if url is not None:
        # Header lines are text of one line each; other characters are escaped, as in URLs.
        safe = "".join(c if " " < c < "\x7f" and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    if revisit:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """The headers and the block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if len(block) != int(headers["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    return headers, block


def build_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of at most ``DICTIONARY_BYTES`` from records; empty if they are too few to learn from."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def archive_head(dictionary: bytes) -> bytes:
    """The skippable frame that must lead each archive."""
    return DICTIONARY_MAGIC + len(dictionary).to_bytes(4, "little") + dictionary if dictionary else b""


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive, by the dictionary it carries itself."""
    import zstandard

    start, known = 0, None
    if data[:4] == DICTIONARY_MAGIC:
        start = 8 + int.from_bytes(data[4:8], "little")
        known = zstandard.ZstdCompressionDict(data[8:start])
    reader = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    view = memoryview(data)
    while start < len(data):
        unpacker = reader.decompressobj()
        parts, at = [], start
        while not unpacker.eof:
            step = view[at : at + (1 << 13)]
            if not step:
                raise ValueError("an archive is cut short")
            parts.append(unpacker.decompress(step))
            at += len(step)
        start = at - len(unpacker.unused_data)
        yield parse(b"".join(parts))


def judged_pages(pages: DataFrame, small: int = SMALL) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, refers_to) of each page; ``refers_to`` makes it a revisit.

    Of records with equal payloads of at least ``small`` bytes the smallest id is the response. Only ids and digests
    are shuffled. Repeated rows with that id are all responses, and so are pages without an id.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(
        "page_id", F.octet_length(payload).cast("bigint").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest")
    )
    rows = materialise(rows, "payloads")
    groups = rows.filter(F.col("payload_bytes") >= small).groupBy("payload_digest")
    firsts = materialise(groups.agg(F.min("page_id").alias("first")), "responses")
    found = rows.join(firsts, "payload_digest", "left")
    refers = F.when(F.col("first") < F.col("page_id"), F.col("first"))
    return found.select("page_id", "payload_bytes", "payload_digest", refers.alias("refers_to"))


def sampled_pages(keyed: DataFrame, known: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """The start of at most ``samples`` responses of ``keyed`` (page_id, url, html, digest), one of each payload, the first by digest.

    The pages are chosen by their ids and digests in ``known``: a filter on the digest leaves about four times as many as
    needed, so no task gets many from each of the others. Only of those is the html read, and cut before anything is collected.
    """
    chosen = known.filter("refers_to is null").groupBy("payload_digest").agg(F.min("id").alias("id"))
    share = min(1.0, 4 * samples / max(1, known.count()))
    below = F.conv(F.substring("payload_digest", 1, 8), 16, 10).cast("bigint") <= int(share * 0xFFFFFFFF)
    chosen = materialise(chosen.filter(below).orderBy("payload_digest").limit(samples), "sampled")
    same = (keyed["digest"] == chosen["payload_digest"]) & keyed["page_id"].eqNullSafe(chosen["id"])
    pages = keyed.join(F.broadcast(chosen), same).select("page_id", "url", F.substring("html", 1, SAMPLE_BYTES).alias("html"), "digest")
    # Repeated rows have one id and digest.
    return materialise(pages, "samples").dropDuplicates(["digest"]).orderBy("digest")


def write_archives(pages: DataFrame, folder: str, small: int = SMALL, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns (path, records) of the archives.

    Each task writes archives of its own of about ``archive_bytes``, first under a temporary name and then
    renamed, so that a task that runs again replaces what it wrote. ``folder`` is a URI that every executor
    reaches. The dictionary is built once from a bounded sample of the records and embedded in each archive.
    Null payloads count as empty; null ids and urls are kept as null. An empty table gives no archives.
    """
    verdicts = judged_pages(pages, small)
    known = verdicts.select(F.col("page_id").alias("id"), "payload_digest", "payload_bytes", "refers_to").distinct()
    known = materialise(known, "verdicts")
    html = F.coalesce("html", F.lit("")).alias("html")
    keyed = pages.select("page_id", "url", html).withColumn("digest", F.sha2(F.encode("html", "utf-8"), 256))
    same = keyed["page_id"].eqNullSafe(known["id"]) & (keyed["digest"] == known["payload_digest"])
    records = keyed.join(known, same).select(
        "page_id", "url", "html", "payload_digest", "payload_bytes", "refers_to"
    )
    # In a fixed order, a task that runs again writes the same archives.
    records = records.sortWithinPartitions("page_id", "payload_digest", "url")
    sample = sampled_pages(keyed, known).collect()
    dictionary = build_dictionary(
        [record(r["page_id"], r["url"], r["html"].encode(), r["digest"], len(r["html"]), None) for r in sample]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext
        from pyarrow import fs

        packer = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        )
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        context = TaskContext.get()
        paths: list[str] = []
        numbers: list[int] = []
        buffer, number = io.BytesIO(), 0

        def close() -> None:
            nonlocal buffer, number
            name = f"part-{context.partitionId():06d}-{len(paths):05d}.warc.zst"
            part = f"{base}/.{name}.{context.taskAttemptId()}"
            with store.open_output_stream(part) as out:
                out.write(archive_head(dictionary))
                out.write(buffer.getbuffer())
            store.move(part, f"{base}/{name}")
            paths.append(name)
            numbers.append(number)
            buffer, number = io.BytesIO(), 0

        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(6)), strict=True):
                page, url, text, digest, size, refers_to = (value.as_py() for value in row)
                buffer.write(packer.compress(record(page, url, text.encode(), digest, size, refers_to)))
                number += 1
                if buffer.tell() >= archive_bytes:
                    close()
        if number:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(numbers, pa.int64())], ["path", "records"])

    return materialise(records.mapInArrow(run, "path string, records bigint"), "archives")


def read_archives(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """A row per record of the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    The digest of a response is computed from the payload that was read and must equal its header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import unquote

        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for item in batch.column(0):
                rows = []
                for headers, block in read_archive(item.as_buffer().to_pybytes()):
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    size, kind = int(headers["WARC-Payload-Length"]), headers["WARC-Type"]
                    if kind == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                            raise ValueError(f"payload of page {headers['WARC-Page']} differs from its digest")
                    url = headers.get("WARC-Target-URI")
                    refers = headers.get("WARC-Refers-To-Page")
                    rows.append((headers["WARC-Page"] or None, url and unquote(url), size, digest, kind, refers))
                columns = list(zip(*rows, strict=True)) or [[] for _ in names]
                types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
                arrays = [pa.array(values, kind) for values, kind in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    rows = files.mapInArrow(run, f"page_id string, {ROWS}, refers_to string")
    return rows.withColumns({name: F.col(name).cast(id_type) for name in ("page_id", "refers_to")})


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = qualified(spark, scratch_dir(spark, "warc"))
    if write_archives(pages, folder).isEmpty():
        schema = f"page_id bigint, {ROWS}, refers_to bigint"
        return spark.createDataFrame([], schema)
    return read_archives(spark, folder, pages.schema["page_id"].dataType.simpleString())
