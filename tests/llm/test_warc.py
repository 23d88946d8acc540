import base64
import gzip
import hashlib
import random

from pyspark.sql import functions as F

from rolepulse.llm import warc


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).withColumns(
        {"payload": F.lit("clash"), "value": F.lit(1), "original": F.lit(None).cast("int"), "refers_to": F.lit("x")})


def expected(rows, least=0):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = max(same, default=None)
        again = len(data) >= least and first is not None and (page is None or page < first)
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def rows():
    rng = random.Random(2)
    body = ["<p>a</p>", "", None, "x\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\n\r\n", "\r\n\r\n", "ä€😀\0" * 9, "y" * 300_000, " ", "\n"]
    out = [(i, rng.choice(["http://a.b/c", None, "http://a b/\r\nWARC-Type: x", ""]), rng.choice(body + [f"own {i}"])) for i in range(80)]
    return out + [out[3], out[79], (None, None, "<p>a</p>"), (None, "u", "only here"), (None, "u", "only here")]


def test_round_trip(spark, tmp_path):
    for least in (0, 5):
        path = str(tmp_path / f"w{least}")
        archive = warc.write(pages_of(spark, rows()), path, least)
        found = warc.read(spark, path, archive).collect()
        assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found], key=str) == expected(rows(), least)
        kept = sorted((str(r.page_id), r.html) for r in found if r.record_type == "response")
        html = {(str(p), h or "") for p, _, h in rows()}
        assert kept and all(k in html for k in kept)


def test_archives_follow_the_format(spark, tmp_path):
    """Record after record by their lengths, as any reader of the format goes."""
    archive = warc.write(pages_of(spark, rows()), str(tmp_path / "w"))
    assert list((tmp_path / "w").glob("part-*.gz"))
    ids, refers = set(), set()
    for file in (tmp_path / "w").glob("part-*"):
        data, at = gzip.decompress(file.read_bytes()), 0
        while at < len(data):
            head = data[at:data.index(b"\r\n\r\n", at)]
            lines = head.split(b"\r\n")
            fields = dict(line.split(b": ", 1) for line in lines[1:])
            assert lines[0] == b"WARC/1.1" and len(fields) == len(lines) - 1 and fields[b"WARC-Warcinfo-ID"].decode() == archive
            at += len(head) + 4 + int(fields[b"Content-Length"])
            assert data[at:at + 4] == b"\r\n\r\n"
            at += 4
            (refers if fields[b"WARC-Type"] == b"revisit" else ids).add(fields.get(b"WARC-Refers-To", fields[b"WARC-Record-ID"]))
    assert ids and refers and refers <= ids


def test_splits_and_empty_table(spark, tmp_path):
    path = str(tmp_path / "w")
    archive = warc.write(pages_of(spark, rows()).coalesce(1), path, compression="none")
    whole = sorted(map(str, warc.read(spark, path, archive).collect()))
    for size in (1000, 4099):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert sorted(map(str, warc.read(spark, path, archive).collect())) == whole
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    archive = warc.write(pages_of(spark, rows()).limit(0), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none"), archive).count() == 0


def test_only_pages_with_repeated_payloads_are_shuffled(spark):
    """The exchange of payloads lies above the bitmap; pages outside of it have no exchange."""
    pages = pages_of(spark, [(i, "u", f"<p>{i // 2 if i < 6 else i}</p>") for i in range(3000)])
    found = warc.resolved(pages)
    assert found.where("refers_to IS NOT NULL").count() == 3 and found.count() == 3000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("Join LeftOuter") == 3  # the bitmap on both sides, the originals on one
