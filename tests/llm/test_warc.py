import base64
import glob
import gzip
import hashlib

import pytest

from pixelchange.llm import warc
from pixelchange.session import scratch_path
from tests.llm.helpers import table

SCHEMA = "page_id long, url string, html string"
PAGES = [(1, "http://a/b c\r\nX: y", "<p>one</p>"), (2, None, "<p>one</p>"), (9, "http://z", "<p>one</p>"), (3, "http://n", None), (4, "u", ""),
         (5, "é", "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"), (6, "u", "x" * 3_000_000), (7, "u", "日本" * 1000), (None, "u", "no id"),
         (None, "u", "<p>one</p>"), (10, "u", "twice"), (10, "u", "twice")]


def expected(pages, least=0):
    first = {}
    for p, _, h in pages:
        if p is not None:
            first[h or ""] = max(p, first.get(h or "", p))
    out = []
    for p, _, h in pages:
        body = (h or "").encode()
        again = len(body) >= least and first.get(h or "", p) != p
        out.append((p is None, p or 0, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else -1))
    return sorted(out)


def rows(df):
    return sorted((r["page_id"] is None, r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], -1 if r["refers_to"] is None else r["refers_to"])
                  for r in df.collect())


@pytest.mark.parametrize("least", [0, 9, 11])
def test_round_trip(spark, least):
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.payload_roles(table(spark, PAGES, SCHEMA), least), folder)
    assert rows(warc.read_records(manifest, folder)) == expected(PAGES, least)


def test_query(spark):
    assert rows(warc.op8_warc(table(spark, [(*p, 1, "d") for p in PAGES], SCHEMA + ", n_bytes int, digest string"))) == expected(PAGES)
    assert warc.op8_warc(table(spark, [], SCHEMA)).collect() == []


def test_chunks_and_payloads(spark):
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.payload_roles(table(spark, PAGES, SCHEMA)), folder, archive_bytes=200)
    chunks = warc.read_chunks(manifest, folder, chunk_bytes=1 << 16).where("page_id = 6").orderBy("chunk_no").collect()
    assert len(chunks) == -(-3_000_000 // (1 << 16)) and [c["last"] for c in chunks] == [False] * (len(chunks) - 1) + [True]
    sha, size = hashlib.sha1(), 0
    for c in chunks:            # digests and lengths go along
        sha.update(c["data"])
        size += len(c["data"])
        assert (c["payload_bytes"], c["payload_digest"]) == (size, base64.b32encode(sha.digest()).decode())
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_payloads(manifest, folder).collect()}
    assert {p: got[p] for p in (4, 5, 6, 7, 9, 10)} == {4: "", 5: PAGES[5][2], 6: PAGES[6][2], 7: PAGES[7][2], 9: "<p>one</p>", 10: "twice"}


def test_archives_are_warc_and_only_listed_ones_are_read(spark):
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.payload_roles(table(spark, PAGES, SCHEMA)), folder)
    path = folder.removeprefix("file:").replace("///", "/")
    with open(f"{path}/left-by-a-lost-task.warc.gz", "wb") as f:
        f.write(b"not an archive")
    assert rows(warc.read_records(manifest, folder)) == expected(PAGES)
    names = [r["archive"] for r in manifest.collect()]
    raw = b"".join(gzip.open(f"{path}/{n}").read() for n in names)
    assert raw.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES) and b"X: y" not in raw.replace(b"%0D%0AX:%20y", b"")
    assert not glob.glob(f"{path}/*.part")
