"""Sources that read by ranges: archives, pages of a service, image headers."""

from __future__ import annotations

import io
import json
import random
import struct
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from millrace.sources import files as X
from millrace.sources import images as I


def test_archives_by_ranges(spark, tmp_path):
    """One large member among many small ones, packed and stored; every task has nearly the same bytes, and reads no others."""
    rng = random.Random(1)
    content = {f"set/{k}.bin": rng.randbytes(rng.randrange(2000)) for k in range(60)} | {"set/large.bin": rng.randbytes(30_000), "set/é.txt": "é".encode() * 999, "set/empty": b""}
    with zipfile.ZipFile(tmp_path / "set.zip", "w") as z:
        for k, (n, c) in enumerate(content.items()):
            z.writestr(n, c, zipfile.ZIP_DEFLATED if k % 2 else zipfile.ZIP_STORED)
        z.writestr("set/folder/", "")
        z.writestr("__MACOSX/x", "y")
    spark.dataSource.register(X.ArchiveSource)
    for path in (str(tmp_path / "set.zip"), f"file://{tmp_path}/set.zip"):
        rows = spark.read.format("zip_members").option("path", path).option("partitions", 3).load()
        assert rows.rdd.getNumPartitions() == 3
        assert {r.name: bytes(r.content) for r in rows.collect()} == {n.removeprefix("set/"): c for n, c in content.items()}
    parts = X._ArchiveReader({"path": str(tmp_path / "set.zip"), "partitions": "3"}).partitions()
    sizes = sorted(sum(m[2] for m in p.members) for p in parts)
    assert sizes[-1] < 1.2 * sizes[0] and len(parts) == 3
    raw = bytearray((tmp_path / "set.zip").read_bytes())
    at = raw.index(content["set/0.bin"][:50])
    raw[at] ^= 1
    (tmp_path / "bad.zip").write_bytes(raw)
    with pytest.raises(Exception, match="damaged"):
        spark.read.format("zip_members").option("path", str(tmp_path / "bad.zip")).load().collect()
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    assert spark.read.format("zip_members").option("path", str(tmp_path / "none.zip")).load().collect() == []


@pytest.mark.parametrize("counted", [True, False])
def test_pages_past_the_end(spark, counted):
    """A service that has no page past its last one: four tasks, every result once, no page twice but the first one that tells the count."""
    asked, lock = [], threading.Lock()
    size = {"1": 10, "2": 3, "3": 0}

    class Service(BaseHTTPRequestHandler):
        def log_message(self, *_):
            pass

        def do_GET(self):
            q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
            page, n, each = int(q["page"]), size[q["project"]], int(q["page_size"])
            with lock:
                asked.append((q["project"], page))
            if page > max(1, -(-n // each)):
                self.send_response(404)
                self.send_header("Content-Length", "0")
                return self.end_headers()
            found = [{"id": k, "p": q["project"]} for k in range((page - 1) * each, min(n, page * each))]
            body = json.dumps({"results": found, "next": page * each < n or None} | ({"count": n} if counted else {})).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        spark.dataSource.register(X.PagesSource)
        read = lambda parts: spark.read.format("task_pages").options(base_url=f"http://127.0.0.1:{server.server_port}", project="1, 2,3", page_size="2", partitions=str(parts), pushdown="true").load()
        every = [(p, k) for p, n in size.items() for k in range(n)]
        for parts in (4, 1):
            got = [(r.project, json.loads(r.task)["id"]) for r in read(parts).collect()]
            assert sorted(got) == every
        asked.clear()
        assert [(r.project, json.loads(r.task)["id"]) for r in read(1).where("project = '2'").orderBy("task").collect()] == [("2", k) for k in range(3)]
        assert {p for p, _ in asked} == {"2"}  # the condition is the service's
        asked.clear()
        assert read(4).where(F.col("project").isin("1", "3")).count() == 10
        assert {p for p, _ in asked} == {"1", "3"}
        if counted:
            assert max(k for p, k in asked if p == "1") == 5
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
        server.shutdown()


class Counted(io.BytesIO):
    """Counts the bytes that are read."""

    count = 0

    def read(self, n=-1):
        got = super().read(n)
        self.count += len(got)
        return got


def jpeg(segments, width=1234, height=777, size=60_000):
    parts = [b"\xff\xd8"]
    for k in range(segments):
        parts.append(b"\xff" * (k % 3) + b"\xff\xe1" + struct.pack(">H", size) + bytes(size - 2))
    return b"".join(parts) + b"\xff\xd0\xff\xc2" + struct.pack(">HBHH", 17, 8, height, width) + bytes(9)


def test_headers_are_read_alone(spark, tmp_path):
    for n in (0, 1, 70, 5000):
        f = Counted(jpeg(n, size=60_000 if n < 100 else 400))
        assert I.header_size(f) == (1234, 777)
        assert f.count <= 32 + 9 * (2 * n + 4)
    assert I.header_size(io.BytesIO(b"\xff\xd8\xff\xda\x00\x04")) is None and I.header_size(io.BytesIO(b"\xff\xd8\xff\xe1\x00\x00")) is None
    assert I.header_size(io.BytesIO(b"GIF89a" + struct.pack("<HH", 5, 6))) == (5, 6)
    (tmp_path / "a.jpg").write_bytes(jpeg(70, size=500))
    (tmp_path / "b.txt").write_bytes(b"text")
    rows = spark.createDataFrame([(str(tmp_path / n), 9) for n in ("a.jpg", "b.txt", "none.png")], "image_path string, width int")
    got = {r.image_path.rsplit("/", 1)[1]: (r.width, r.height, (r.size_error or "")[:17]) for r in I.with_sizes(rows).collect()}
    assert got == {"a.jpg": (1234, 777, ""), "b.txt": (None, None, "no image header"), "none.png": (None, None, "FileNotFoundError")}
    both = spark.createDataFrame([(bytearray(jpeg(70, size=300)),), (None,)], "c binary").select(I.image_size(F.col("c")).alias("s")).collect()
    assert [tuple(r.s) for r in both] == [(1234, 777), (None, None)]
