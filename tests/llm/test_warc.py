"""Archives of web records: round trip, revisits, and every kind of damage."""

from __future__ import annotations

import hashlib
import random
import struct

import pytest
import zstandard

from stallkeeper.llm import warc

SCHEMA = "page_id bigint, url string, html string"


def plain_roles(rows):
    """(id, payload bytes, digest, type, refers to) of every row, in plain Python."""
    digests = [hashlib.sha256((html or "").encode()).hexdigest() for _, _, html in rows]
    kept = {}
    for (page, _, _), digest in zip(rows, digests, strict=True):
        kept[digest] = min((p for p in (kept.get(digest), page) if p is not None), default=None)
    out = []
    for (page, _, html), digest in zip(rows, digests, strict=True):
        size, first = len((html or "").encode()), kept[digest]
        revisit = size >= 100 and first is not None and page != first
        out.append((page, size, digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def read_back(spark, rows, folder, **options):
    # Columns that no one asked for may have any name.
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as digest", "'x' as id", "2 as payload", "3 as salt")
    warc.write_archives(pages, folder, **options)
    return warc.read_archives(spark, folder)


def roles(records):
    chosen = records.select(
        warc.record_ids("record_id").cast("long"), "payload_bytes", "payload_digest", "record_type",
        warc.record_ids("refers_to").cast("long"),
    )
    return sorted((tuple(r) for r in chosen.collect()), key=str)


def test_odd_rows(spark, tmp_path):
    long = "Lang, läng, 長い. " * 20_000
    rows = [
        (1, "http://a/ü x\n", "p" * 150), (2, None, "p" * 150), (2, "", "p" * 150), (None, "http://b/?q=a%20b", "p" * 150),
        (3, "c", None), (4, "c", ""), (5, "d", "short"), (6, "d", "short"), (7, "e", long), (9, "e", long),
        (None, "f", "q" * 150), (None, "f", "q" * 150), (10, "g", "r" * 99), (11, "g", "r" * 99),
        (12, "g", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (13, "g", "P*M\x18\0\0\0\0" * 20),
    ]
    records = read_back(spark, rows, str(tmp_path / "a"), archive_bytes=1000)
    assert roles(records) == plain_roles(rows)
    found = records.collect()
    assert all(r.error is None for r in found)
    assert len({r.archive for r in found}) > 3
    texts = {r.record_id: r.payload.decode() for r in found if r.record_type == "response"}
    assert texts["<urn:page:7>"] == long and texts["<urn:page:3>"] == ""
    assert all(r.payload is None for r in found if r.record_type == "revisit")
    targets = {(r.record_id, r.target_uri) for r in found}
    assert ("<urn:page:1>", "http://a/%C3%BC%20x%0A") in targets and ("<urn:page:2>", None) in targets
    assert ("<urn:page:2>", "") in targets and ("<urn:page:>", "http://b/?q=a%20b") in targets


def test_a_payload_of_most_rows(spark, tmp_path):
    random.seed(3)
    rows = [(i, "u", random.choice(["hot" * 50, "hot" * 50, f"{i % 7}" * 120])) for i in random.sample(range(1000), 600)]
    records = read_back(spark, rows, str(tmp_path / "a"), archive_bytes=5000)
    assert roles(records) == plain_roles(rows)
    # The common payload's records are spread over the archives.
    assert len({r.archive for r in records.where("payload_bytes = 150").select("archive").collect()}) > 5


def test_no_rows_and_few_archives(spark, tmp_path):
    assert read_back(spark, [], str(tmp_path / "none")).count() == 0
    records = read_back(spark, [(i, "u", f"page {i} " * 30) for i in range(300)], str(tmp_path / "few"))
    frames = {}
    for r in records.collect():
        frames.setdefault(r.archive, []).append(r.frame)
    assert len(frames) == 4 and all(sorted(f) == list(range(len(f))) for f in frames.values())


def made(payload=b"<p>hello</p>", **changes):
    digest = hashlib.sha256(payload).hexdigest()
    given = {"record_id": "1", "uri": "http://a/", "date": "2024-01-01T00:00:00Z", "payload": payload}
    return warc.record_bytes(**(given | {"size": len(payload), "digest": digest, "refers_to": None} | changes))


def archive(*records, dictionary=None, packed_dictionary=False, **options):
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    packer = zstandard.ZstdCompressor(dict_data=held, **options)
    head = b""
    if dictionary:
        content = zstandard.compress(dictionary) if packed_dictionary else dictionary
        head = struct.pack("<II", warc.DICTIONARY_MAGIC, len(content)) + content
    return head + b"".join(packer.compress(r) for r in records)


@pytest.fixture(scope="module")
def dictionary():
    random.seed(1)
    letters = "abcdefghij"
    samples = [made("".join(random.choices(letters, k=400)).encode()) for _ in range(300)]
    return warc.trained_dictionary(samples)


@pytest.mark.parametrize("packed", [False, True])
def test_dictionary_of_the_leading_frame(dictionary, packed):
    whole = archive(made(), made(b"x" * 300_000), dictionary=dictionary, packed_dictionary=packed)
    assert [len(r.payload) for r in warc.archive_records(whole)] == [12, 300_000]
    # Without it, its frames cannot be decoded, and each of them says so.
    size = struct.unpack_from("<I", whole, 4)[0]
    assert [r.error is None for r in warc.archive_records(whole[8 + size :])] == [False, False]
    assert warc.trained_dictionary([b"too", b"few"]) is None


def test_frames_of_other_writers():
    random.seed(2)
    noise = random.randbytes(400_000)  # stored as raw blocks
    for options in ({"write_content_size": False}, {"write_checksum": True}, {"level": 19}):
        whole = archive(made(noise), made(b"a" * 500_000), made(), **options)
        skip = struct.pack("<II", 0x184D2A57, 3) + b"abc"
        records = list(warc.archive_records(skip + whole + skip))
        assert [len(r.payload) for r in records] == [400_000, 500_000, 12]
        assert not any(r.error for r in records)


def test_sha1_digests_and_other_kinds():
    head = "WARC/1.0\r\nwarc-type: {}\r\nWARC-Record-ID: <a>\r\nWARC-Date: d\r\nX-Long: a\r\n b\r\nContent-Length: 3\r\n{}\r\n"
    sha1 = "WARC-Payload-Digest: sha1:VGMT4NSHA2AWVOR6EVYXQUGCNSONBWE5\r\n"  # of "abc"
    info = warc.parsed_record(head.format("warcinfo", "").encode() + b"abc" + warc.END)
    good = warc.parsed_record(head.format("resource", sha1).encode() + b"abc" + warc.END)
    bad = warc.parsed_record(head.format("resource", sha1).encode() + b"abd" + warc.END)
    assert info.error is None and info.payload == b"abc" and info.payload_digest == hashlib.sha256(b"abc").hexdigest()
    assert good.error is None and "digest" in bad.error


def test_damaged_records():
    good = made()
    assert warc.parsed_record(good).error is None
    for changed, says in (
        (good.replace(b"WARC/1.1", b"WARC/9.9"), "version"),
        (good.replace(b"WARC-Date", b"No-Date"), "warc-date"),
        (good.replace(b"WARC-Date: 2024-01-01T00:00:00Z", b"WARC-Date"), "without a name"),
        (good[:-1], "Content-Length"),
        (good + b"x", "Content-Length"),
        (good[:-4] + b"....", "end of the record"),
        (good.replace(b"hello", b"hallo"), "digest"),
        (good.replace(b"html; charset=utf-8\r\nContent-Length: 12", b"html; charset=utf-8\r\nContent-Length: 13"), "promised"),
        (made(refers_to="2").replace(b"WARC-Refers-To", b"WARC-Refers-At"), "revisit"),
        (b"", "version"),
        (b"\xff\xfe", "version"),
    ):
        record = warc.parsed_record(changed)
        assert says in record.error and record.payload is None


def test_damaged_archives():
    whole = archive(made(), made(b"other"), write_checksum=True)
    first = warc.frame_end(memoryview(whole), 0)
    broken = bytearray(whole)
    broken[first - 1] ^= 1  # checksum of the first frame
    found = list(warc.archive_records(bytes(broken)))
    assert [r.error is None for r in found] == [False, True] and found[1].payload == b"other"
    for cut in range(1, len(whole)):
        found = list(warc.archive_records(whole[:cut]))
        assert [r.error is None for r in found] == ([True] if cut > first else []) + ([] if cut == first else [False]) or cut == first
    assert list(warc.archive_records(b"")) == []
    assert "no frame" in next(warc.archive_records(b"plain text, not an archive")).error
