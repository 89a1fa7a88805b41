import base64
import hashlib
import zlib

import pytest

from panelcraft.llm import warc

PAGES = [(5, "http://a.example/x y", "<p>same</p>", 1), (3, "http://a.example/\r\nX: 1", "<p>same</p>", 2), (9, None, "<p>same</p>", 3),
         (7, "http://b.example/", None, 4), (8, "", "", 5), (2, "http://ü.example/日", "é日本" * 3, 6), (None, "http://c", "<p>same</p>", 7),
         (None, "http://d", "alone", 8), (4, "http://e", "twice", 9), (4, "http://e", "twice", 9), (6, "http://long", "long " * 400_000, 10)]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string, first int")


def want(rows, least=0):
    smallest = {}
    for i, _, html, _ in rows:
        if i is not None:
            smallest[html or ""] = min(i, smallest.get(html or "", i))
    out = []
    for i, _, html, _ in rows:
        payload = (html or "").encode()
        first = smallest.get(html or "")
        again = first is not None and first != i and len(payload) >= least
        out.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if again else "response",
                    first if again else None))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("split_bytes", [97, 1000, 1 << 25])
def test_archives_of_odd_rows_come_back_at_any_split(spark, pages, tmp_path, split_bytes):
    path = str(tmp_path / "w")
    warc.write(pages, path)
    assert found(warc.read(spark, path, payload=False, split_bytes=split_bytes)) == want(PAGES)
    texts = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read(spark, path, split_bytes=split_bytes).collect()
             if r["record_type"] == "response"}
    assert texts[2] == "é日本" * 3 and texts[6] == "long " * 400_000 and texts[7] == "" and 8 not in texts


def test_small_payloads_are_no_revisits(spark, pages, tmp_path):
    warc.write(pages, str(tmp_path / "w"), least=11)
    assert found(warc.read(spark, str(tmp_path / "w"))) == want(PAGES, 11)


def test_empty_table(spark, pages, tmp_path):
    assert warc.digest(pages.limit(0), str(tmp_path / "none")).count() == 0


def member(page, payload, level=6):
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    plain = zlib.decompress(warc.record(page, "u", payload, None, False, len(payload), digest), 31)
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(plain) + pack.flush()


def test_members_inside_a_stored_payload_are_nobodys(spark, tmp_path):
    inner = b"".join(member(1000 + i, b"inner %d" % i) for i in range(40))
    outer = [member(1, b"before"), member(2, b"\0" * 5 + inner + b"\xff" * 30, level=0), member(3, b"after"), member(4, inner, level=0)]
    assert inner in outer[3]  # stored: a task that starts inside sees whole members
    (tmp_path / "n.warc.gz").write_bytes(b"".join(outer))
    for split_bytes in (61, 500, 4000, 1 << 20):
        got = warc.read(spark, str(tmp_path), split_bytes=split_bytes).collect()
        assert sorted(r["page_id"] for r in got) == [1, 2, 3, 4]
        assert {r["page_id"]: r["offset"] for r in got}[3] == len(outer[0] + outer[1])


def test_damage_is_skipped(spark, tmp_path):
    a, b, c = member(1, b"one" * 50), member(2, b"two" * 50), member(3, b"three" * 50)
    (tmp_path / "d.warc.gz").write_bytes(b"junk" + warc.MAGIC + a + b[:40] + b"\0" * 9 + c + a[:30])
    got = warc.read(spark, str(tmp_path), split_bytes=64).collect()
    assert sorted(r["page_id"] for r in got) == [1, 3]


def test_wrong_digest_is_refused(spark, tmp_path):
    (tmp_path / "x.warc.gz").write_bytes(warc.record(1, "u", b"payload", None, False, 7, "A" * 32))
    with pytest.raises(Exception, match="digest"):
        warc.read(spark, str(tmp_path)).collect()


def test_files_read_as_plain_gzip(spark, pages, tmp_path):
    import gzip

    warc.write(pages, str(tmp_path / "w"))
    text = b"".join(gzip.open(f).read() for f in (tmp_path / "w").glob("*.warc.gz"))
    assert text.count(b"WARC/1.1\r\n") == len(PAGES) and b"\r\nX: 1" not in text
