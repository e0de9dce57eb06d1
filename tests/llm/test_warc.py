"""The audit against a plain comparison; WARC files there and back."""

import random

from pyspark.sql import functions as F

from nodecast.llm import warc

SCHEMA = "file string, offset long, length long, key long, digest string"


def plain(first, second):
    a, b = ({(r[0], r[1]): r for r in side} for side in (first, second))
    found = []
    for place in a.keys() | b.keys():
        r, s = a.get(place), b.get(place)
        if r is None or s is None or r[4] != s[4]:
            state = "missing" if s is None else "extra" if r is None else "differs"
            row = r or s
            found.append((*place, row[3], row[2], state))
    return sorted(found)


def test_audit(spark):
    rnd = random.Random(8)
    first = []
    for f in range(5):
        at = 0
        for key in range(rnd.choice([0, 1, 40, 400])):
            size = rnd.choice([300, 5000, 200_000])
            first.append((f"f{f}", at, size, key, f"d{rnd.random()}"))
            at += size
    second = [r if rnd.random() > 0.02 else (*r[:4], "other") for r in first if rnd.random() > 0.01]
    second += [("new", 0, 10, 1, "x"), ("f0", 10**9, 10, None, "y")]
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (first, second)]
    assert sorted(map(tuple, warc.audit(*frames).collect())) == plain(first, second)
    assert warc.audit(frames[0], frames[0]).collect() == []
    assert warc.audit(frames[0].limit(0), frames[0].limit(0)).collect() == []
    assert warc.audit(frames[0], frames[0].limit(0)).count() == len(first)


def leaves_of(spark, rows):
    """Leaves of (file, key, record), with a column of the same name as one of the tree's."""
    frame = spark.createDataFrame(rows, "file string, key long, record string")
    return warc.leaves(frame).withColumn("place", F.lit("x")).withColumn("hash", F.lit(1))


def test_a_lost_a_longer_and_repeated_records_in_the_middle(spark):
    rows = [("f", k, f"{k} " * (500 + k % 7 * 900)) for k in range(300)]
    rows += [("f", 5, rows[5][2]), ("f", None, "no id"), ("f", None, "no id"), ("f", None, "another")]
    first = leaves_of(spark, rows)
    changed = [(f, k, r + "rot" if k == 200 else r) for f, k, r in rows if k != 40]
    changed.remove(("f", None, "no id"))
    found = warc.audit(first, leaves_of(spark, changed + [("f", 1000, "new")])).collect()
    wanted = {(40, "missing"), (200, "differs"), (None, "missing"), (1000, "extra")}
    assert {(r.key, r.state) for r in found} == wanted and len(found) == 4
    offsets = {r.digest: r.offset for r in first.collect()}
    assert {r.offset for r in found if r.key in (40, 200)} <= set(offsets.values())


def test_records_without_an_id_are_spread(spark):
    rows = spark.range(3000).select(F.concat(F.lit("http://h/"), "id").alias("url"))
    files = rows.select(warc.file_of(F.lit(None).cast("long"), 500, F.col("url")).alias("file"))
    assert files.distinct().count() > 2500


def test_files_there_and_back(spark, tmp_path):
    rows = [(i, f"http://x/{i}" if i % 3 else None, f"<p>é {i}\r\n\r\nWARC/1.1\r\n</p>" * (i % 4)) for i in range(40)]
    rows += [(7, "again", None), (None, None, "no id")]
    frame = spark.createDataFrame(rows, "key long, url string, html string").withColumn("offset", F.lit("x"))
    records = frame.select(
        warc.file_of(F.col("key"), 25, F.col("url")).alias("file"),
        "key",
        warc.record(F.col("key"), F.col("url"), F.col("html"), "2020-01-01T00:00:00Z").alias("record"),
    )
    path = str(tmp_path / "warc")
    warc.write_warc(records, path)
    back = warc.read_warc(spark, path + "/*.txt")
    assert sorted((r.url, r.payload) for r in back.collect()) == sorted((u or "", h or "") for _, u, h in rows)
    leaf = {(r.length, r.digest) for r in warc.leaves(records).collect()}
    assert {(r.length, r.digest) for r in back.collect()} == leaf
