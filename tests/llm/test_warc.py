import hashlib
import re

from lagline.llm.warc import archived_pages, read_archives, write_archives

BIG = "ab\r\n\r\nWARC/1.1\r\né" * 200
ROWS = [
    (1, "http://a/x y", BIG), (2, None, BIG), (3, "http://b\r\nX: y", BIG), (4, "u", "small"), (5, "u", "small"), (6, "u", None),
    (7, "u", ""), (8, "u", "\n"), (9, "u", "x" * 1000), (10, "u", "x" * 999), (11, "u", "x" * 999), (12, "u", "x" * 1000),
    (None, "u", "y" * 2000), (13, "u", "y" * 2000), (14, "u", "tail\r\n\r\n"), (15, "u", "long\n" * 30_000 + "é" * 3000),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, _digest string")


def plain(rows):
    out = []
    for key, _, body in rows:
        data = (body or "").encode()
        same = [k for k, _, b in rows if (b or "").encode() == data and k is not None] if len(data) >= 1000 else []
        last = max(same, default=None)
        again = last is not None and last != key
        out.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", last if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    df = pages(spark, ROWS)
    assert sorted(map(tuple, archived_pages(df).collect()), key=repr) == plain(ROWS)
    assert archived_pages(df.limit(0)).count() == 0


def test_chunks_carry_the_digest(spark, tmp_path):
    write_archives(pages(spark, ROWS), f"{tmp_path}/warc", chunk=1000)
    rows = read_archives(spark, f"{tmp_path}/warc").orderBy("record_id", "chunk_no").collect()
    text = {f"<urn:page:{'null' if k is None else k}>": (b or "").encode() for k, _, b in ROWS}
    for name, data in text.items():
        chunks = [r for r in rows if r.record_id == name]
        assert [r.chunk_no for r in chunks] == list(range(1, len(chunks) + 1)) and [r.last for r in chunks][-1]
        if chunks[0].type == "revisit":
            continue
        seen = b""
        for r in chunks:
            assert len(r.payload) <= 4000
            seen += bytes(r.payload)
            assert r.running_bytes == len(seen) and r.running_digest == hashlib.sha1(seen).hexdigest()
        assert seen == data and chunks[0].declared == "sha1:" + hashlib.sha1(data).hexdigest()
    assert max(r.chunk_no for r in rows) > 100


def test_files_are_archives(spark, tmp_path):
    import glob
    import gzip

    write_archives(pages(spark, ROWS[:6]), f"{tmp_path}/warc")
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{tmp_path}/warc/*.gz"))
    n = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert rest[size : size + 4] == b"\r\n\r\n"
        data, n = rest[size + 4 :], n + 1
    assert n == 6
