"""WARC archives whose records are Zstandard frames that share one dictionary.

The dictionary is built from records of the archive. Each file starts with a skippable frame that
embeds it, so a file can be read alone; each record is a frame of its own, so it can be read at its
offset. Records with equal payloads of ``least_bytes`` or more are written once: the one with the
largest page_id is the response and the others revisit it.

Writing tasks name their files by partition and attempt and report them in a manifest. Readers go
by the manifest, so files of lost or repeated attempts are never read.

Defined results: a null html is an empty payload; a null url gives a record without target; a null
page_id stays null and never is the response that others revisit, unless all are null; repeated
rows of the largest page_id are all responses; an empty table gives no files and no records. Only
the named columns are read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit.session import durable, ensure_checkpoint_dir

#: Frame magics of the Zstandard format; the dictionary frame of .warc.zst files.
DICTIONARY_FRAME = (0x184D2A5D).to_bytes(4, "little")
FRAME = (0xFD2FB528).to_bytes(4, "little")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

TASK_BYTES = 128 << 20
MANIFEST = "path string, n_records long, n_bytes long"
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)


# --- one record


def encode_record(
    page_id, url, kind: str, refers_to, payload: bytes, digest: str, n_bytes: int
) -> bytes:
    """Header lines, then the block: the HTTP head, and for a response the payload."""
    block = HTTP_HEAD + (payload if kind == "response" else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{_id(page_id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {n_bytes}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{_id(refers_to)}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(record: bytes) -> tuple:
    """A tuple in the order of RECORD; the digest of a response is taken from its payload anew."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(
        line.split(": ", 1) for line in head.decode().split("\r\n")[1:]
    )
    kind = fields["WARC-Type"]
    block = rest[: int(fields["Content-Length"])]
    n_bytes, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"][5:]
    payload = block[len(HTTP_HEAD) :] if kind == "response" else None
    if payload is not None and (len(payload), hashlib.sha1(payload).hexdigest()) != (n_bytes, digest):
        raise ValueError(f"record {fields['WARC-Record-ID']}: payload does not match its digest")
    url = fields.get("WARC-Target-URI")
    return (
        _page(fields["WARC-Record-ID"]),
        None if url is None else _many_lines(url),
        kind,
        _page(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None,
        n_bytes,
        digest,
        payload,
    )


def _id(page_id) -> str:
    return "none" if page_id is None or pd.isna(page_id) else str(int(page_id))


def _page(urn: str) -> int | None:
    value = urn[len("<urn:page:") : -1]
    return None if value == "none" else int(value)


def _one_line(url: str) -> str:
    return url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _many_lines(url: str) -> str:
    return url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


# --- one file


def frames(data: bytes) -> Iterator[bytes]:
    """Records of a file: the dictionary from the leading frame, then one frame after another."""
    dictionary, at = None, 0
    if data[:4] == DICTIONARY_FRAME:
        size = int.from_bytes(data[4:8], "little")
        dictionary, at = zstandard.ZstdCompressionDict(data[8 : 8 + size]), 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    view, step = memoryview(data), 1 << 16
    while at < len(data):
        if view[at : at + 4] != FRAME:
            raise ValueError(f"no frame at byte {at}")
        one, parts = reader.decompressobj(), []
        while not one.eof:
            if at >= len(data):
                raise ValueError("the file ends inside a frame")
            parts.append(one.decompress(view[at : at + step]))
            at += min(step, len(data) - at) - len(one.unused_data)
        yield b"".join(parts)


# --- tables


def decide(
    pages: DataFrame, least_bytes: int = 1000,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"),
    )
    keyed = rows.select(
        "page_id", F.sha1("payload").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    # counts per payload are combined before they are shuffled; only repeated payloads are kept
    shared = (
        keyed.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    rows = rows.select(
        "*", F.sha1("payload").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    ).join(shared, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def train_dictionary(
    pages: DataFrame, n_rows: int, id_col: str = "page_id", html_col: str = "html", sample_rows: int = 400,
    sample_chars: int = 8192, dictionary_bytes: int = 65536,
) -> bytes:
    """A dictionary from a bounded sample: the first characters of ``sample_rows`` records.

    Rows are taken whose hash lies below a bound that leaves about twice as many as wanted, so no
    task sends more than a few. Too small a sample gives an empty dictionary; files then have none.
    """
    texts = pages.where(F.col(html_col).isNotNull())
    share = min(1.0, 2 * sample_rows / max(1, n_rows))
    place = F.pmod(F.xxhash64(F.col(id_col), F.col(html_col)), F.lit(1 << 40))
    sample = texts.select(
        place.alias("place"), F.substring(F.col(html_col), 1, sample_chars).alias("start")
    ).where(F.col("place") < int(share * (1 << 40)))
    sample = sorted(sample.collect(), key=lambda row: (row["place"], row["start"]))[:sample_rows]
    texts = [HTTP_HEAD + row["start"].encode() for row in sample]
    try:
        return zstandard.train_dictionary(dictionary_bytes, texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(decided: DataFrame, folder: str, dictionary: bytes, file_bytes: int = 16 << 20) -> DataFrame:
    """Write the records below ``folder`` and return the manifest, which is checkpointed.

    A file is closed when it holds ``file_bytes`` compressed bytes, so readers never load more.
    """
    sent = decided.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        context, data = TaskContext.get(), sent.value
        attempt = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        known = zstandard.ZstdCompressionDict(data) if data else None
        if known:
            known.precompute_compress(level=3)
        packer = zstandard.ZstdCompressor(level=3, dict_data=known, write_checksum=True)
        head = DICTIONARY_FRAME + len(data).to_bytes(4, "little") + data if data else b""
        done, out, path, count, size = [], None, "", 0, 0

        def close():
            out.close()
            done.append((path, count, size))

        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    path = f"{root}/part-{attempt}-{len(done):04d}.warc.zst"
                    out, count, size = store.open_output_stream(path, compression=None), 0, len(head)
                    out.write(head)
                frame = packer.compress(
                    encode_record(
                        row.page_id, row.url, row.record_type, row.refers_to, row.payload or b"",
                        row.payload_digest, row.payload_bytes,
                    )
                )
                out.write(frame)
                count, size = count + 1, size + len(frame)
                if size >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        scheme = folder.partition("://")[0] + "://" if "://" in folder else ""
        yield pd.DataFrame(
            [(scheme + p, n, s) for p, n, s in done], columns=["path", "n_records", "n_bytes"]
        )

    return durable(decided.mapInPandas(run, MANIFEST))


def read(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """All records of the files that the manifest names."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = RECORD_NAMES
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for record in frames(content):
                    rows.append(decode_record(record))
                    size += len(record)
                    if size > 4 << 20:
                        yield _frame(rows, names)
                        rows, size = [], 0
                yield _frame(rows, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    named = manifest.select(name.alias("name"))
    files = files.select(name.alias("name"), "content").join(named, "name", "left_semi")
    return files.select("content").mapInPandas(run, RECORD)


RECORD_NAMES = [part.split()[0] for part in RECORD.split(", ")]


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})


def archive(
    pages: DataFrame, folder: str | None = None, least_bytes: int = 1000,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> tuple[DataFrame, str]:
    """Write all pages; returns the manifest and the folder.

    Without ``folder`` a new one is taken below the shared checkpoint folder.
    """
    spark = pages.sparkSession
    if folder is None:
        ensure_checkpoint_dir(spark)
        folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/warc-{uuid.uuid4().hex}"
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    size = pages.agg(
        F.count(html_col).alias("rows"), F.sum(F.octet_length(html_col)).alias("bytes")
    ).first()
    dictionary = train_dictionary(pages, size["rows"], id_col, html_col)
    decided = decide(pages, least_bytes, id_col, url_col, html_col)
    # tasks by bytes: many shuffle partitions with little in them would each start a file
    tasks = max(2 * spark.sparkContext.defaultParallelism, (size["bytes"] or 0) // TASK_BYTES)
    decided = decided.coalesce(tasks)
    return write(decided, folder, dictionary), folder
