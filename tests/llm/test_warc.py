import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from quillmine.llm import warc as W


def test_round_trip_nulls_repeats_and_clashing_columns(spark, tmp_path):
    long = "é" * 700
    rows = [(1, "http://a", long), (2, None, long), (3, "http://b\r\nX: y", "short"), (4, "http://c", "short"), (5, "u", None), (6, "u", "x" * 3_000_000), (7, "u", ""), (7, "u", ""), (None, "u", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", F.lit("other").alias("payload"), F.lit("other").alias("HTML"))
    manifest = W.write_archives(df, f"file://{tmp_path}/out", archive_bytes=1000)
    got = W.read_archives(manifest).collect()
    assert sum(r.records for r in manifest.collect()) == len(got) == len(rows) and all(r.error is None for r in got)
    by = sorted((str(r.page_id), r.type, r.payload_bytes, r.digest, r.refers_to) for r in got)
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = sorted((str(i), "revisit" if i == 1 else "response", len((t or "").encode()), sha(t), 2 if i == 1 else None) for i, _, t in rows)
    assert by == want
    assert all(r.payload.decode() == next((t or "") for i, _, t in rows if i == r.page_id) for r in got if r.type == "response")
    empty = W.write_archives(df.limit(0))
    assert empty.count() == 0 and W.read_archives(empty).count() == 0


def archive(dictionary: bytes, records: list[bytes]) -> bytes:
    codec = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, zstandard.DICT_TYPE_RAWCONTENT))
    return W.leading_frame(dictionary) + b"".join(codec.compress(r) for r in records)


def test_raw_dictionary_small_chunks_and_damage():
    sha1 = hashlib.sha1(b"hello").digest()
    good = W.make_record(1, "http://a", 5, sha1, b"hello")
    held = archive(b"WARC/1.1 some dictionary of plain text", [good] * 3)
    for chunk in (1, 7, 1 << 18):
        stream = io.BytesIO(held)
        assert list(W.frames(stream, W.load_dictionary(stream), chunk)) == [good] * 3
    with pytest.raises(ValueError, match="cut short"):
        stream = io.BytesIO(held[:-3])
        list(W.frames(stream, W.load_dictionary(stream)))
    with pytest.raises(ValueError, match="leading"):
        W.load_dictionary(io.BytesIO(held[8:]))
    assert W.parse_record(good)["payload"] == b"hello"
    for bad in (good[:-1], good.replace(b"hello", b"hallo"), good.replace(b"WARC-Type", b"WARC-Typo"), b"", good.replace(b"sha1:", b"md5:"), good.replace(b"Length: 5", b"Length: 6")):
        with pytest.raises(ValueError):
            W.parse_record(bad)


def test_damaged_records_are_reported(spark, tmp_path):
    good = W.make_record(1, "http://a", 5, hashlib.sha1(b"hello").digest(), b"hello")
    (tmp_path / "x.warc.zst").write_bytes(archive(b"a dictionary of plain text", [good, good[:-2], good])[:-4])
    got = W.read_archives(spark.createDataFrame([(f"file://{tmp_path}/x.warc.zst",)], "archive string")).collect()
    assert [r.error is None for r in got] == [True, False, False]


def test_query_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet'")
    want = sorted(map(str, con.execute(W.OP10_SQL).fetchall()))
    assert sorted(str(tuple(r)) for r in W.op10_warc_zstd(spark, "/root/testdata/sf0.001").collect()) == want


def test_rows_of_one_id_with_different_payloads_are_kept_apart(spark, tmp_path):
    a, b, c = "a" * 2000, "b" * 2000, "c" * 2000
    rows = [(1, "u", a), (1, "u", c), (2, "u", a), (3, "u", b), (3, "u", c), (4, "u", b), (5, "u", c)]
    got = W.read_archives(W.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{tmp_path}/out")).collect()
    last = {a: 2, b: 4, c: 5}
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    want = sorted((i, sha(t), "response" if i == last[t] else "revisit", 0 if i == last[t] else last[t]) for i, _, t in rows)
    assert sorted((r.page_id, r.digest, r.type, r.refers_to or 0) for r in got) == want
