"""Following growing raw logs: appended lines, half lines, restarts, rotation, bounded batches, pieces."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from rolepulse.sources import flowfiles
from rolepulse.sources.formatlog import read_growing_stream
from rolepulse.sources.growing import lines_between
from rolepulse.streaming import ingest


def append(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "a") as f:
        f.write(text)


class Follower:
    """Runs of one stream; remembers each line it got, with its path, batch by batch."""

    def __init__(self, spark, tmp_path, **options):
        self.spark, self.root, self.check, self.options = spark, str(tmp_path / "raw"), str(tmp_path / "check"), options
        self.got, self.batches = [], []

    def run(self, fail=False):
        def handle(df, n):
            if fail:
                raise RuntimeError("crash")
            rows = df.withColumn("row", F.monotonically_increasing_id()).collect()
            rows.sort(key=lambda r: (r["modified"], r["path"], r["block"], r["row"]))
            self.batches.append((n, len(rows)))
            self.got += [(os.path.basename(r["path"]), r["value"]) for r in rows]

        before = len(self.got)
        while True:
            done = len(self.batches)
            lines = read_growing_stream(self.spark, self.root, zones=["1004", "1005"], **self.options)
            q = lines.writeStream.foreachBatch(handle).option("checkpointLocation", self.check).trigger(availableNow=True).start()
            try:
                q.awaitTermination()
            except Exception:
                return None
            if len(self.batches) == done:
                return [v for _, v in self.got[before:]]


A, B = "1004/2016-11-10/world2.formatlog", "1005/2016-11-10/world2.formatlog"


def test_appended_lines_come_once_and_whole(spark, tmp_path):
    f = Follower(spark, tmp_path)
    os.makedirs(f.root)
    assert f.run() == []
    append(f.root, A, "one\ntwo\nhal")
    append(f.root, "1009/2016-11-10/world2.formatlog", "other zone\n")
    append(f.root, "1004/2016-11-10/world2.test", "other name\n")
    append(f.root, "misc/world2.formatlog", "no zone\n")
    assert f.run() == ["one", "two"]
    assert f.run() == []
    append(f.root, A, "f\r\n\nlast\n")
    append(f.root, B, "äöü 日本\n")
    assert sorted(f.run()) == ["", "half", "last", "äöü 日本"]
    append(f.root, A, "no end yet")
    assert f.run() == []
    with open(os.path.join(f.root, B), "ab") as b:
        b.write(b"\xff\xfe broken\n")
    assert f.run() == ["�� broken"]


def test_a_batch_that_failed_is_repeated_as_it_was(spark, tmp_path):
    f = Follower(spark, tmp_path)
    append(f.root, A, "one\ntwo\n")
    assert f.run(fail=True) is None
    append(f.root, A, "three\n")
    append(f.root, B, "four\n")
    assert f.run() == ["one", "two", "three", "four"] and f.batches[0] == (0, 2)
    assert f.run() == []


def test_rotated_files_are_read_to_their_end(spark, tmp_path):
    f = Follower(spark, tmp_path)
    path = os.path.join(f.root, A)
    append(f.root, A, "a1\na2\n")
    assert f.run() == ["a1", "a2"]
    append(f.root, A, "a3\n")
    os.rename(path, path + ".1")  # not a name the stream looks for
    os.utime(path + ".1", (1e9, 1e9))
    append(f.root, A, "b1\n")
    assert f.run() == ["a3", "b1"]
    append(f.root, A + ".1", "a4, late\n")
    append(f.root, A, "b2\n")
    assert sorted(f.run()) == ["a4, late", "b2"]
    shutil.copy(path, path + ".2")  # copied and cut
    with open(path, "w") as cut:
        cut.write("c1\n")
    assert f.run() == ["c1"] and f.run() == []
    os.remove(path)
    assert f.run() == []
    append(f.root, A, "d1, shorter or not\n")
    assert f.run() == ["d1, shorter or not"]


def test_rotation_while_a_batch_waits_to_be_repeated(spark, tmp_path):
    f = Follower(spark, tmp_path)
    path = os.path.join(f.root, A)
    append(f.root, A, "a1\na2\n")
    assert f.run(fail=True) is None
    os.rename(path, path + ".1")
    append(f.root, A, "b1\n")
    assert f.run() == ["a1", "a2", "b1"]
    append(f.root, A, "b2\n")
    assert f.run(fail=True) is None
    os.remove(path)
    assert f.run() is None  # lines are lost: an error, not silence


def test_batches_are_bounded_and_oldest_first(spark, tmp_path):
    f = Follower(spark, tmp_path, max_bytes=700)
    names = [f"1004/2016-11-{d:02d}/world2.formatlog" for d in range(10, 13)]
    want = []
    for n, name in enumerate(reversed(names)):
        lines = [f"{n} {i} " + "x" * (i % 17) for i in range(40)]
        append(f.root, name, "\n".join(lines) + "\n")
        os.utime(os.path.join(f.root, name), (1e9 + n, 1e9 + n))
        want += lines
    want.append("y" * 2000)  # longer than a batch
    append(f.root, names[0], "y" * 2000 + "\n")
    assert f.run() == want
    assert len(f.batches) > 3 and [n for n, _ in f.batches] == list(range(len(f.batches)))


def test_a_file_that_has_ended_needs_no_line_end(spark, tmp_path):
    f = Follower(spark, tmp_path, idle=100)
    append(f.root, A, "one\ntwo, the end")
    append(f.root, B, "young\nand not en")
    os.utime(os.path.join(f.root, A), (1e9, 1e9))
    assert f.run() == ["one", "two, the end", "young"]
    assert f.run() == []


@pytest.mark.parametrize("piece", [1, 3, 7, 64, 10_000])
def test_pieces_share_out_every_line(tmp_path, piece, monkeypatch):
    from rolepulse.sources import growing

    monkeypatch.setattr(growing, "READ_BYTES", 5)
    rng = random.Random(piece)
    for ended in (True, False):
        lines = ["z" * rng.choice([0, 0, 1, 2, 5, 30]) + str(i) * rng.randrange(2) for i in range(60)]
        data = ("skipped\n" + "\n".join(lines) + ("\n" if ended else "x")).encode()
        (tmp_path / "f").write_bytes(data + b"later")
        first, last = 8, len(data)
        with growing.fs.LocalFileSystem().open_input_file(str(tmp_path / "f")) as f:
            got = [x for at in range(first, last, piece) for block in lines_between(f, at, min(at + piece, last), first, last) for x in block]
        assert b"\n".join(got) + (b"\n" if ended else b"") == data[8:]


def test_pieces_in_a_stream(spark, tmp_path):
    f = Follower(spark, tmp_path, piece_bytes=50)
    lines = [f"line {i} " + "x" * (i % 60) for i in range(200)]
    append(f.root, A, "\n".join(lines) + "\n")
    assert f.run() == lines


def test_ingest_of_growing_files(spark, tmp_path):
    raw, out, check = (str(tmp_path / n) for n in ("raw", "out", "check"))
    line = "2016-11-10 00:0{}:00 gs1 formatlog:levelup_lo:roleid={}:level=2:zone=1:time_used=120:prof=3\n"
    run = lambda **options: ingest.run_once(spark, raw, out, check, growing=True, **options)
    append(raw, A, line.format(1, 11) + "2016-11-10 00:04:00 gs1 formatlog:chat:roleid=11:hello\n" + line.format(2, 12)[:40])
    assert run() == {"read": 2, "written": 1}
    append(raw, A, line.format(2, 12)[40:] + line.format(3, 13))
    append(raw, B, line.format(4, 14))
    assert run(max_bytes=100) == {"read": 3, "written": 3} and run() == {"read": 0, "written": 0}
    rows = flowfiles.read_partitioned(spark, out).orderBy("zone", "ord").collect()
    assert [(r["zone"], r["value"].split()[2]) for r in rows] == [("1004", "11"), ("1004", "12"), ("1004", "13"), ("1005", "14")]
