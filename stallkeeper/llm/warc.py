"""Archives of web records: a Zstandard frame per record, and a shared dictionary in front.

Spark's own text writer writes the archives, one row per frame, so nothing holds a whole archive and a
lost task is written again.  What it puts after every row is an empty skippable frame, which readers of
such archives pass over.  A payload that several records share is stored once: the others revisit it.
Which payloads are shared is found on digests alone; payloads are shuffled once, by record.

The reader takes archives of any writer: it loads the dictionary, walks from frame to frame, decodes
one frame per record and checks headers, lengths and digests.  What does not hold is a row with an
``error``, never a missing row.
"""

from __future__ import annotations

import base64
import hashlib
import string
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallkeeper.llm.text import slices
from stallkeeper.session import Cut, table_cut

# Fixed values of the formats: frame magics, the least payload worth a revisit, and the revisit profile.
FRAME_MAGIC = 0xFD2FB528
SKIPPABLE_MAGIC = 0x184D2A50
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
END = b"\r\n\r\n"

# An empty skippable frame, as text: "P*M\x18" is its magic, four zeros its length.
BETWEEN_FRAMES = struct.pack("<II", SKIPPABLE_MAGIC, 0).decode("ascii")

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20  # payload of one archive at most, about
LEVEL = 3
# The dictionary learns from about so many payloads of at most so many bytes, on the driver.
SAMPLE_ROWS, SAMPLE_ROW_BYTES, DICTIONARY_BYTES = 400, 16 << 10, 32 << 10
# A digest's rows are dealt to so many tasks when they meet the record they revisit.
SALTS = 32
# A record that claims to be larger is not decoded.
MAX_RECORD_BYTES = 1 << 30
BYTES_AT_ONCE = 16 << 20

RECORD = (
    "archive string, frame int, record_id string, record_type string, target_uri string, date string, "
    "payload_bytes bigint, payload_digest string, refers_to string, payload binary, error string"
)


# ---- writing


def record_uri(record_id: str | None) -> str:
    return f"<urn:page:{quote(record_id or '', safe='')}>"


def record_bytes(
    record_id: str | None, uri: str | None, date: str, payload: bytes | None, size: int, digest: str, refers_to: str | None
) -> bytes:
    """One record: a response with its payload, or a revisit with the response's head only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}".encode() + END
    block = http if revisit else http + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_uri(record_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        # Whatever is not printable ASCII is escaped; the rest of a url stays as it is.
        head.append(f"WARC-Target-URI: {quote(uri, safe=string.punctuation)}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_uri(refers_to)}"]
    return "\r\n".join(head).encode() + END + block + END


def trained_dictionary(samples: list[bytes]) -> bytes | None:
    """A dictionary for payloads like these; none if they are too few to learn from."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else None
    except zstandard.ZstdError:
        return None


def _frames(dictionary: bytes | None, date: str):
    """Rows of a task to the frames of its archive, the dictionary's first."""

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True)
        first = True
        for batch in batches:
            if first and batch.num_rows and dictionary:
                packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
                yield _binary([struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed])
            first = first and not batch.num_rows
            for start, end in slices(batch.column("size").to_pylist(), BYTES_AT_ONCE):
                rows = zip(*[batch.column(c).slice(start, end - start).to_pylist() for c in _WRITTEN], strict=True)
                yield _binary([packer.compress(record_bytes(i, uri, date, *rest)) for i, uri, *rest in rows])

    return written


_WRITTEN = ("id", "uri", "payload", "size", "digest", "refers_to")


def _binary(frames: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
    cut: Cut | None = None,
) -> None:
    """Write a record for every row of ``pages`` to archives below ``folder``.

    Of rows with equal payloads of at least ``min_revisit_bytes``, those with the smallest id are
    responses, all others revisit that id; shorter payloads are responses always.  Every archive is one
    file of ``archive_bytes`` of payload or less, about (more if a single payload is larger).

    - Null or empty payload: a response without bytes.  Null url: no target; an empty one is written.
    - Null id: never the one revisited while an id exists; if none does, all are responses.
    - Repeated rows are a record each, of the same kind; no rows give no records.
    - Other columns of ``pages`` are not looked at, whatever their names.
    """
    cut = cut or table_cut(pages.sparkSession)
    payload = F.coalesce(pages[payload_col].cast("binary"), F.lit(b""))
    rows = pages.select(pages[id_col].alias("id"), pages[uri_col].cast("string").alias("uri"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("digest"))

    # One narrow row per payload: enough to know the archives' number and which payloads are shared.
    groups = rows.groupBy("digest", "size").agg(F.min("id").alias("kept"), F.count("*").alias("n"))
    groups = cut(groups, "payloads")
    total, n_rows = groups.agg(F.coalesce(F.sum(F.col("size") * F.col("n")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # Not fewer than other shuffles have tasks: Spark would deal payloads to those first, then to fewer.
    least = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_archives = max(least, -(-int(total) // archive_bytes))

    key = F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("id").isNull().cast("string"), "digest")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    shared = groups.where((F.col("n") > 1) & (F.col("size") >= min_revisit_bytes) & F.col("kept").isNotNull())
    shared = shared.select("digest", "kept", salts.alias("salt"))
    narrow = rows.where(F.col("size") >= min_revisit_bytes).select("id", "digest")
    narrow = narrow.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    revisits = narrow.join(shared, ["digest", "salt"]).where(~F.col("id").eqNullSafe(F.col("kept")))
    revisits = revisits.select(key.alias("key"), F.col("kept").cast("string").alias("refers_to")).distinct()

    # Payloads are dealt by record, so equal ones are spread; what a record revisits comes to it.
    dealt = rows.withColumn("key", key).repartition(n_archives, "key")
    met = dealt.join(revisits.hint("shuffle_hash"), "key", "left")
    met = met.select(
        F.col("id").cast("string").alias("id"),
        "uri",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
        "size",
        "digest",
        "refers_to",
    )
    share = min(1.0, SAMPLE_ROWS / max(int(n_rows), 1))
    sample = rows.where(F.col("size").between(1, SAMPLE_ROW_BYTES) & (F.pmod(F.xxhash64("digest"), F.lit(1 << 31)) < int(share * (1 << 31))))
    dictionary = trained_dictionary([r.payload for r in sample.select("payload").limit(2 * SAMPLE_ROWS).collect()])
    frames = met.mapInArrow(_frames(dictionary, date), "frame binary")
    # The bytes of a frame pass through a text column unchanged.
    frames.select(F.col("frame").cast("string")).write.option("lineSep", BETWEEN_FRAMES).text(folder)


# ---- reading


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that starts at ``at`` ends; ValueError when it is cut short."""
    head = zstandard.get_frame_parameters(data[at : at + 18])
    at += zstandard.frame_header_size(data[at : at + 18])
    last = False
    while not last:
        if at + 3 > len(data):
            raise ValueError("frame is cut short")
        block = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        # A run-length block holds one byte, whatever the size that it stands for.
        at += 3 + (1 if kind == 1 else size)
    at += 4 if head.has_checksum else 0
    if at > len(data):
        raise ValueError("frame is cut short")
    return at


def loaded_dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    """The dictionary of a leading skippable frame, which may be compressed itself."""
    if content[:4] == struct.pack("<I", FRAME_MAGIC):
        content = zstandard.ZstdDecompressor().decompress(content, max_output_size=MAX_RECORD_BYTES)
    return zstandard.ZstdCompressionDict(content)


@dataclass
class Record:
    record_id: str | None = None
    record_type: str | None = None
    target_uri: str | None = None
    date: str | None = None
    payload_bytes: int | None = None
    payload_digest: str | None = None
    refers_to: str | None = None
    payload: bytes | None = None
    error: str | None = None


def header_fields(lines: list[bytes]) -> dict[str, str]:
    """Named fields of a head, names in lower case; a line that starts with a blank continues the one before."""
    fields: dict[str, str] = {}
    name = None
    for line in lines:
        text = line.decode("utf-8")
        if text[:1] in (" ", "\t") and name:
            fields[name] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        name = name.strip().lower()
        if not colon or not name:
            raise ValueError(f"header line without a name: {text[:80]}")
        fields[name] = value.strip()
    return fields


def _digest_of(given: str, payload: bytes) -> str:
    """What ``given`` should be for this payload, in the same notation; itself for unknown algorithms."""
    algorithm, _, value = given.partition(":")
    if algorithm.lower() == "sha256":
        return f"{algorithm}:{hashlib.sha256(payload).hexdigest()}"
    if algorithm.lower() == "sha1":
        made = hashlib.sha1(payload)
        return f"{algorithm}:{base64.b32encode(made.digest()).decode() if len(value) == 32 else made.hexdigest()}"
    return given


def parsed_record(data: bytes) -> Record:
    """The record that a frame holds; ``error`` says what is wrong with it."""
    out = Record()
    try:
        head, found, rest = data.partition(END)
        version, *lines = head.split(b"\r\n")
        if version not in VERSIONS or not found:
            raise ValueError("no WARC version line or no end of the head")
        fields = header_fields(lines)
        missing = [n for n in ("warc-type", "warc-record-id", "warc-date", "content-length") if n not in fields]
        if missing:
            raise ValueError(f"missing {', '.join(missing)}")
        out.record_type, out.date = fields["warc-type"], fields["warc-date"]
        out.record_id, out.refers_to = fields["warc-record-id"], fields.get("warc-refers-to")
        out.target_uri = fields.get("warc-target-uri")
        length = fields["content-length"]
        if not (length.isascii() and length.isdigit()) or len(rest) != int(length) + len(END):
            raise ValueError("Content-Length is not the block's length")
        if not rest.endswith(END):
            raise ValueError("no end of the record")
        _read_block(out, fields, rest[: -len(END)])
    except ValueError as wrong:
        out.payload, out.error = None, str(wrong)
    return out


def _read_block(out: Record, fields: dict[str, str], block: bytes) -> None:
    payload, promised = block, None
    if fields.get("content-type", "").startswith("application/http"):
        head, found, payload = block.partition(END)
        if not found:
            raise ValueError("no end of the HTTP head")
        promised = header_fields(head.split(b"\r\n")[1:]).get("content-length")
    given = fields.get("warc-payload-digest")
    if out.record_type == "revisit":
        if payload and promised is not None:
            raise ValueError("a revisit with a payload")
        if not out.refers_to or promised is None or not promised.isdigit():
            raise ValueError("a revisit without what it refers to, or without its length")
        out.payload_bytes = int(promised)
    else:
        if promised is not None and promised != str(len(payload)):
            raise ValueError("the payload's length is not the promised one")
        if given is not None and _digest_of(given, payload).lower() != given.lower():
            raise ValueError("the payload does not have its digest")
        out.payload_bytes, out.payload = len(payload), payload
    out.payload_digest = given.partition(":")[2].lower() if given else hashlib.sha256(payload).hexdigest()


def archive_records(content: bytes) -> Iterator[Record]:
    """Records of one archive in order; a frame that cannot be read is a record with an ``error``."""
    data, at = memoryview(content), 0
    dictionary = None
    while at < len(data):
        if at + 8 > len(data):
            yield Record(error="archive is cut short")
            return
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
            if at + 8 + size > len(data):
                yield Record(error="skippable frame is cut short")
                return
            if magic == DICTIONARY_MAGIC and at == 0:
                try:
                    dictionary = loaded_dictionary(bytes(data[8 : 8 + size]))
                except zstandard.ZstdError as wrong:
                    yield Record(error=f"dictionary: {wrong}")
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            # Without a frame's head there is no way to the next one.
            yield Record(error="no frame where one should start")
            return
        try:
            end = frame_end(data, at)
        except (ValueError, zstandard.ZstdError) as wrong:
            yield Record(error=str(wrong))
            return
        yield _decoded(bytes(data[at:end]), dictionary)
        at = end


def _decoded(frame: bytes, dictionary: zstandard.ZstdCompressionDict | None) -> Record:
    try:
        size = zstandard.frame_content_size(frame)
        if size > MAX_RECORD_BYTES:
            return Record(error="record is too large")
        unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
        # A frame of unknown size is decoded as a stream, a bounded step at a time.
        return parsed_record(unpacker.decompress(frame) if size >= 0 else _streamed(unpacker, frame))
    except zstandard.ZstdError as wrong:
        return Record(error=f"frame: {wrong}")


def _streamed(unpacker: zstandard.ZstdDecompressor, frame: bytes) -> bytes:
    parts, total = [], 0
    for part in unpacker.read_to_iter(frame):
        total += len(part)
        if total > MAX_RECORD_BYTES:
            raise zstandard.ZstdError("record is too large")
        parts.append(part)
    return b"".join(parts)


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """Records of all archives below ``folder``: see ``RECORD`` for the columns.

    ``frame`` numbers an archive's records from 0.  A revisit has the payload's length and digest and
    what it refers to, but no payload.  ``error`` is null for a sound record.  With ``payload`` false,
    payloads are checked but not returned.  A task holds one archive at a time; no archive gives no rows.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    schema = pa.schema(
        [
            ("archive", pa.string()), ("frame", pa.int32()), ("record_id", pa.string()), ("record_type", pa.string()),
            ("target_uri", pa.string()), ("date", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("refers_to", pa.string()), ("payload", pa.binary()), ("error", pa.string()),
        ]
    )

    def batch_of(archive: str, first: int, records: list[Record]) -> pa.RecordBatch:
        held = [[getattr(r, name) for r in records] for name in schema.names[2:]]
        if not payload:
            held[schema.names.index("payload") - 2] = [None] * len(records)
        columns = [[archive] * len(records), list(range(first, first + len(records))), *held]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column("path"), batch.column("content"), strict=True):
                records, first, size = [], 0, 0
                for record in archive_records(content.as_py()):
                    records.append(record)
                    size += len(record.payload or b"") if payload else 0
                    if len(records) == 10_000 or size > BYTES_AT_ONCE:
                        yield batch_of(archive.as_py(), first, records)
                        records, first, size = [], first + len(records), 0
                if records:
                    yield batch_of(archive.as_py(), first, records)

    return files.mapInArrow(read, RECORD)


def record_ids(column: str):
    """The id that a record uri of :func:`write_archives` stands for, as text; null for a row without id."""
    escaped = F.regexp_extract(F.col(column), "^<urn:page:(.*)>$", 1)
    return F.url_decode(F.regexp_replace(F.nullif(escaped, F.lit("")), r"\+", "%2B"))
