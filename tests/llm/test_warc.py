import io
import random
import zipfile
from collections import defaultdict

import pytest

from kgspark.llm import warc

PAGES = "page_id long, url string, html string"


def expected(rows, least=0):
    ids = defaultdict(list)
    for page_id, _, html in rows:
        ids[html or ""].append(page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = ids[html or ""]
        head = max((x for x in same if x is not None), default=None)
        revisit = len(payload) >= least and len(same) > 1 and head is not None and page_id != head
        out.append((page_id, len(payload), warc.digest(payload), "revisit" if revisit else "response", head if revisit else None))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    bodies = [f"<p>{i} é {'x' * rng.randrange(3000)}\r\n\r\n</p>" for i in range(40)] + ["", None, "dup", "WARC/1.1\r\n\r\n"]
    rows = [(i, None if i % 17 == 4 else f"http://h{i % 5}/é a?b={i}\n", rng.choice(bodies)) for i in range(300)]
    return rows + [(None, "http://n/", bodies[0]), (None, None, "alone"), (None, None, "twice"), (None, None, "twice"), rows[7], rows[299], (10**12, "u", "y" * 2_000_000)]


def test_round_trip(spark, rows, same):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, PAGES).repartition(5).withColumns({n: F.lit("x") for n in ("payload", "key", "head", "revisit")})
    same(warc.op9_warc(df), expected(rows))


def test_small_archives_and_payloads(spark, rows, same):
    df = spark.createDataFrame(rows, PAGES).repartition(2)
    archives = warc.write_archives(df, warc.new_folder(spark), least=4, archive=1_000)
    assert archives.count() > 10
    read = warc.read_records(archives)
    same(read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), expected(rows, 4))
    kept = {r["payload_digest"]: bytes(r["payload"]) for r in read.where("record_type = 'response'").collect()}
    assert all(warc.digest(p) == d for d, p in kept.items())
    assert set(kept) == {x[2] for x in expected(rows)}


def test_empty_table(spark):
    assert warc.op9_warc(spark.createDataFrame([], PAGES)).collect() == []


def zipped(comment=b"", wide=False, method=zipfile.ZIP_STORED, many=0):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", method) as z:
        with z.open("a/é.bin", "w", force_zip64=wide) as member:
            member.write(b"payload " * 10)
        for i in range(many):
            z.writestr(f"m{i}", f"{i}")
        z.comment = comment
    return buffer


@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 not the end", b"c" * 65_000])
@pytest.mark.parametrize("wide", [False, True])
def test_directories(comment, wide):
    buffer = zipped(comment, wide)
    found = warc.members(buffer, len(buffer.getvalue()))
    start, end = warc.stored_range(buffer, found["a/é.bin"])
    assert buffer.getvalue()[start:end] == b"payload " * 10


def test_zip64_directory_of_many_members():
    buffer = zipped(many=66_000)
    assert b"PK\x06\x06" in buffer.getvalue()
    found = warc.members(buffer, len(buffer.getvalue()))
    assert len(found) == 66_001
    for i in (0, 65_535, 65_999):
        start, end = warc.stored_range(buffer, found[f"m{i}"])
        assert buffer.getvalue()[start:end] == str(i).encode()


def test_zip64_fields_of_an_entry(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 50)  # sizes and offsets go to the extra field
    buffer = zipped(wide=True, many=3)
    found = warc.members(buffer, len(buffer.getvalue()))
    for name, value in (("a/é.bin", b"payload " * 10), ("m2", b"2")):
        start, end = warc.stored_range(buffer, found[name])
        assert buffer.getvalue()[start:end] == value


def test_what_cannot_be_read_is_refused():
    buffer = zipped(method=zipfile.ZIP_DEFLATED)
    found = warc.members(buffer, len(buffer.getvalue()))
    with pytest.raises(ValueError, match="compressed"):
        warc.stored_range(buffer, found["a/é.bin"])
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.members(io.BytesIO(b"x" * 100), 100)
