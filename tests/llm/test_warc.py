import gzip
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orrery.llm import warc as A

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (9, "http://a/\r\n3", "<p>one</p>"), (4, None, None), (5, "http://b/5", ""),
    (6, "http://b/6", "é漢" * 200_000), (7, "http://b/7", "x\r\n\r\ny"), (7, "http://b/7", "x\r\n\r\ny"), (None, "http://c", "<p>one</p>"), (None, "http://d", "none"),
]
SCHEMA = "page_id long, url string, html string, last long, payload string, record_type string"


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, 0, "x", "y") for p in PAGES], SCHEMA)


def test_round_trip(pages):
    want = Counter()
    for page, _, html in PAGES:
        body = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        again = bool(same) and page != max(same)
        want[page, len(body), A.digest(body), "revisit" if again else "response", max(same) if again else None] += 1
    assert Counter(map(tuple, A.round_trip(pages).collect())) == want
    small = [r for r in A.round_trip(pages, min_bytes=11).collect() if r["record_type"] == "revisit"]
    assert not small  # the shared payload has 10 bytes
    assert A.round_trip(pages.limit(0)).count() == 0


def test_digest_column(spark):
    got = spark.createDataFrame([("a",), ("",), ("漢",)], "t string").withColumn("__hex", F.sha1("t")).select("t", A.base32_digest(F.col("t"))).collect()
    assert all(d == A.digest(t.encode()) for t, d in got)


def test_payloads_filters_and_rolling_files(spark, pages, tmp_path):
    folder = str(tmp_path / "w")
    A.register(spark)
    A.archive_rows(pages).coalesce(1).write.format("warc").option("fileBytes", "400").mode("append").save(folder)
    names = [n for n, _ in A.files(folder)]
    assert len(names) > 2
    (tmp_path / "w" / "part-lost.warc.gz").write_bytes(b"left by a lost attempt")
    back = spark.read.format("warc").load(folder)
    got = {r["record_id"]: bytes(r["payload"]) for r in back.where("record_type = 'response'").collect()}
    assert got["urn:page:6"] == PAGES[5][2].encode() and got["urn:page:7"] == b"x\r\n\r\ny" and got["urn:page:9"] == b"<p>one</p>"
    assert back.where("record_type = 'revisit' AND target_uri LIKE 'http://a/%'").count() == 2
    plan = back.where("record_type = 'revisit'").select("record_id")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"^\W*(\*\(\d+\) )?Filter", plan, re.M)  # decided by the source
    raw = b"".join(gzip.decompress((tmp_path / "w" / n).read_bytes()) for n in names)
    assert raw.count(b"WARC/1.1\r\n") == len(PAGES) and b"\r\n3\r\n" not in raw


def test_headers_alone_leave_payloads_packed(spark, tmp_path):
    class Stream:
        def __init__(self, data):
            self.data, self.read = data, 0

        def size(self):
            return len(self.data)

        def read_at(self, n, at):
            self.read += n
            return self.data[at : at + n]

    import random

    body = random.Random(1).randbytes(500_000)
    row = {"payload": body, "record_type": "response", "content_type": None, "payload_bytes": len(body), "record_id": "urn:page:1", "date": None,
           "target_uri": "http://x", "payload_digest": A.digest(body), "refers_to": None}
    stream = Stream(A._member(A._record(row, "1970-01-01T00:00:00Z")) * 3)
    rows = [A._parsed(m.front()) for m in A._Members(stream)]
    assert [r["payload_bytes"] for r in rows] == [500_000] * 3 and stream.read < 20_000


def test_damage_is_found(spark, pages, tmp_path):
    folder = tmp_path / "d"
    A.write_pages(pages.where("page_id = 1"), str(folder))
    name = A.files(str(folder))[0][0]
    data = bytearray((folder / name).read_bytes())
    data[len(data) - 9] ^= 0xFF  # in the packed text
    (folder / name).write_bytes(bytes(data))
    with pytest.raises(Exception):
        spark.read.format("warc").option("verify", "true").load(str(folder)).collect()
