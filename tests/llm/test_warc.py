import hashlib

from larder.llm import warc as A

LONG = "<p>é😀</p>" * 30
SCHEMA = "page_id long, url string, html string, digest string, size int"


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_round_trip(spark):
    rows = [(5, "https://a/é b?x=1%20\r\ny", LONG), (2, None, LONG), (9, "u", LONG), (1, "u", "short"), (3, "u", "short"), (4, "u", None),
            (6, "u", ""), (7, "u", "\r\n\r\nWARC/1.1\r\n" * 20), (2, "again", LONG), (None, "u", LONG), (8, "u", "y" * 200_000)]
    got = A.read(A.bundles(A.plan(make(spark, rows)), frame_bytes=1000)).collect()
    want = []
    for page, url, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 100 and html == LONG and page is not None and page > 2
        want.append((None if page is None else str(page), url and url.replace("\r\n", "%0D%0A"), "revisit" if revisit else "response", "2" if revisit else None, len(data), hashlib.sha256(data).hexdigest()))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r["record_id"], r["url"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got), key=key) == sorted(want, key=key)


def test_seek_one_record_and_files(spark, tmp_path):
    rows = [(i, f"u{i}", f"page {i} " * 50) for i in range(60)]
    archives = A.bundles(A.plan(make(spark, rows)).coalesce(1), frame_bytes=2000, bundle_bytes=3000)
    made = archives.collect()
    assert len(made) > 1
    for r in made:
        content = bytes(r["content"])
        frames, index = A.seek_table(content)
        assert len(frames) > 1 and sum(f[1] for f in frames) < len(content)
        import zstandard
        whole = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(content)
        assert whole == b"".join(A.read_frame(content, f) for f in frames)
        for rid, ((frame, at, length),) in index.items():
            (record,) = A.lookup(content, rid)
            assert len(record) == length and f"WARC-Record-ID: <{rid}>".encode() in record
            assert record == A.read_frame(content, frames[frame])[at:at + length]
    paths = [r["path"] for r in A.save_files(archives, f"file://{tmp_path}/out").collect()]
    assert sorted(open(p.removeprefix("file://"), "rb").read() for p in paths) == sorted(bytes(r["content"]) for r in made)
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    assert sorted(map(tuple, A.read_files(files).collect())) == sorted(map(tuple, A.read(archives).collect()))


class Counted:
    """A file that notes which bytes were read."""

    def __init__(self, content):
        self.content, self.spans = content, []

    def size(self):
        return len(self.content)

    def read_at(self, n, at):
        self.spans.append((at, at + n))
        return self.content[at:at + n]


def test_one_record_is_sought_in_a_file(spark, tmp_path):
    import random
    rng = random.Random(3)
    rows = [(i, f"u{i}", "".join(rng.choices("abcdefghijklmnop", k=5000))) for i in range(80)]
    archives = A.bundles(A.plan(make(spark, rows)).coalesce(1), frame_bytes=20_000)
    (path,) = [r["path"] for r in A.save_files(archives, f"file://{tmp_path}/out").collect()]
    (record,) = A.lookup_file(path, A.URN + "41")
    assert record.endswith(rows[41][2].encode() + b"\r\n\r\n") and A.lookup_file(path, A.URN + "999") == []
    file = Counted(open(path.removeprefix("file://"), "rb").read())
    assert A.lookup(file, A.URN + "41") == [record]
    frames, index = A.seek_table(file.content)
    at, packed, _ = frames[index[A.URN + "41"][0][0]]
    data = sum(f[1] for f in frames)
    assert [s for s in file.spans if s[0] < data and s[1] <= data] == [(at, at + packed)]       # of the data, one frame
    assert sum(b - a for a, b in file.spans) < file.size() / 4


def test_repeated_and_missing_ids_are_all_in_the_index(spark):
    rows = [(1, "a", "x" * 10), (1, "b", "y" * 10), (None, "c", "z"), (None, "d", "w")]
    (bundle,) = A.bundles(A.plan(make(spark, rows)).coalesce(1)).collect()
    content = bytes(bundle["content"])
    assert sum(map(len, A.seek_table(content)[1].values())) == 4
    assert [len(A.lookup(content, A.URN + i)) for i in ("1", "", "2")] == [2, 2, 0]


def test_empty_table(spark):
    assert A.read(A.bundles(A.plan(make(spark, [])))).count() == 0
