"""WARC files and a Merkle fixity audit of their replicas.

Each record is a leaf: its file, offset, length and SHA-256.  The leaves of a
file are hashed by ordered ranges of offsets (``RANGE`` bytes), those by ranges
``FAN`` times as wide, and so on up to one root a file.  An audit compares the
roots of two replicas and descends only into ranges whose hashes differ.  There
records are aligned: those with the same digest in the same file are intact even
if a lost or longer record before them has moved them; of the others, those with
the same key differ, and the rest are missing or extra.

A range holds a bounded number of records, so no group grows with the data.
All of it is DataFrame work on narrow rows; record bytes are hashed where they
are read.

Records: a null payload is empty, a null address is an empty one.  Repeated
records are separate ones at their own offsets, aligned in their order.  Records
without an id stand in files of their own, spread by the hash of their address.  Only the columns
named are read, others may have any name.  Empty tables give no records and no
findings.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from nodecast.session import materialize

RANGE, FAN = 1 << 16, 16
GAP = "\r\n\r\n"
"""What ends a record, and what ends its header."""


def record(key: Column, url: Column, payload: Column, date: str) -> Column:
    """The text of a WARC resource record, without its ending."""
    body = F.coalesce(payload, F.lit(""))
    head = (
        ("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:", F.coalesce(key.cast("string"), F.lit(""))),
        (f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: ", F.coalesce(url, F.lit(""))),
        ("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ", F.octet_length(body).cast("string")),
    )
    return F.concat(*(part for text, value in head for part in (F.lit(text), value)), F.lit(GAP), body)


def file_of(key: Column, per_file: int, url: Column) -> Column:
    """The file of a record: so many consecutive ids to a file.  Records without
    an id go by their address, which damage to a payload leaves as it is."""
    number = F.lpad(F.floor(key / per_file).cast("string"), 9, "0")
    spread = F.substring(F.sha2(F.coalesce(url, F.lit("")), 256), 1, 4)
    without = F.concat(F.lit("pages-without-id-"), spread, F.lit(".warc"))
    return F.coalesce(F.concat(F.lit("pages-"), number, F.lit(".warc")), without)


def leaves(records: DataFrame) -> DataFrame:
    """``file, offset, length, key, digest`` from ``file, key, record`` (text):
    records stand in their file in the order of key and digest."""
    hashed = records.select(
        "file", "key", (F.octet_length("record") + len(GAP)).cast("long").alias("length"),
        F.sha2(F.col("record"), 256).alias("digest"),
    )
    before = Window.partitionBy("file").orderBy("key", "digest").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    return hashed.select("file", offset, "length", "key", "digest")


def write_warc(records: DataFrame, path: str, per_file: int = 10_000) -> None:
    """WARC files of ``records`` (``file, key, record``) in order within each
    partition.  The line ending of Spark's text files ends the records."""
    ordered = records.repartition("file").sortWithinPartitions("file", "key")
    ordered.select("record").write.option("lineSep", GAP).option("maxRecordsPerFile", per_file).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``file, offset, length, digest, url, payload`` of the records of WARC
    files; a file is read whole by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, at, rows = data.as_py(), 0, []
                while at < len(data):
                    head_end = data.index(b"\r\n\r\n", at)
                    head = dict(line.split(b": ", 1) for line in data[at:head_end].split(b"\r\n")[1:])
                    end = head_end + 4 + int(head[b"Content-Length"])
                    digest = hashlib.sha256(data[at:end]).hexdigest()
                    url = head.get(b"WARC-Target-URI", b"").decode()
                    rows.append((name, at, end + 4 - at, digest, url, data[head_end + 4 : end].decode()))
                    at = end + 4
                columns = [list(c) for c in zip(*rows)] if rows else [[]] * 6
                types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    ["file", "offset", "length", "digest", "url", "payload"],
                )

    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name, "content").mapInArrow(
        run, "file string, offset long, length long, digest string, url string, payload string"
    )


def tree(replica: DataFrame, height: int) -> list[DataFrame]:
    """``file, place, hash`` of each level, from the finest ranges to one a file."""

    def folded(rows: DataFrame, place: Column, part: list[str]) -> DataFrame:
        items = F.sort_array(F.collect_list(F.struct(*part)))
        return rows.groupBy("file", place.alias("place")).agg(F.sha2(F.to_json(items), 256).alias("hash"))

    base = folded(replica, F.floor(F.col("offset") / RANGE), ["offset", "length", "digest"])
    levels = [materialize(base, "ranges")]
    for _ in range(height):
        levels.append(folded(levels[-1], F.floor(F.col("place") / FAN), ["place", "hash"]))
    return levels


def _differing(first: DataFrame, second: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows of either side without an equal one on the other, joined by keys."""
    other = second.withColumnsRenamed({c: f"other_{c}" for c in second.columns})
    same = [F.col(k).eqNullSafe(F.col(f"other_{k}")) for k in keys]
    return first.join(other, same, "full").where(~F.col(value).eqNullSafe(F.col(f"other_{value}")))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """``file, offset, key, length, state`` of the records that are not the same
    in both replicas.  ``state`` is ``differs``, ``missing`` (from the second) or
    ``extra``; offset, key and length are the first's, or the second's for extra ones."""
    sides = [materialize(side, "leaves") for side in (first, second)]
    widest = max(side.agg(F.max("offset")).first()[0] or 0 for side in sides)
    height = 0
    while widest // (RANGE * FAN**height):
        height += 1
    trees = [tree(side, height) for side in sides]
    keys, bad = ["file", "place"], None
    for level in range(height, -1, -1):
        nodes = [t[level] for t in trees]
        if bad is not None:  # only below the ranges that differ
            above = [F.floor(F.col("place") / FAN).alias("above")]
            nodes = [
                n.select("*", *above).join(bad.toDF("file", "above"), ["file", "above"], "left_semi").drop("above")
                for n in nodes
            ]
        found = _differing(*nodes, keys, "hash")
        bad = materialize(found.select(*(F.coalesce(k, f"other_{k}").alias(k) for k in keys)).distinct(), "differing")
    place = F.floor(F.col("offset") / RANGE).alias("place")
    columns = ["file", "offset", "key", "length", "digest"]
    held = [s.select(*columns, place).join(bad, keys, "left_semi").select(*columns) for s in sides]
    for same in (["file", "offset", "digest"], ["file", "digest"]):  # intact in place, intact but moved
        held = _unpaired(*held, same)
    first, second = (_numbered(side, ["file", "key"]) for side in held)
    found = _differing(first, second, ["file", "key", "_nth"], "digest")
    state = F.when(F.col("other_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("differs")
    inner = F.col("digest").isNotNull()  # a key may be null on the side that has the record
    shown = [F.when(inner, F.col(c)).otherwise(F.col(f"other_{c}")).alias(c) for c in ("file", "offset", "key", "length")]
    return found.select(*shown, state.alias("state"))


def _numbered(side: DataFrame, same: list[str]) -> DataFrame:
    """Records that are the same by some columns of a file, numbered in their order."""
    order = Window.partitionBy(*same).orderBy("offset", "digest", "length")
    return side.withColumn("_nth", F.row_number().over(order))


def _unpaired(first: DataFrame, second: DataFrame, same: list[str]) -> list[DataFrame]:
    """The records of either side that have no partner among the other's."""
    sides = [materialize(_numbered(side, same), "numbered") for side in (first, second)]
    pairs = [*same, "_nth"]
    return [
        a.join(b.select(*pairs), pairs, "left_anti").drop("_nth") for a, b in (sides, reversed(sides))
    ]
