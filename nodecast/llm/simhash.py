"""SimHash near-dedup with Pigeonring filtering.

Fingerprints: each text is lower-cased in A-Z, cut into words at ASCII white
space, and the XXH64 hashes (seed 42) of its word shingles vote on 64 bits.

Links: the 64 bits form a ring of ``SEGMENTS`` segments.  If two fingerprints
differ in at most t bits, some start on the ring has, for every length l, at
most ``l * t / SEGMENTS`` differences in the l segments that follow (the
pigeonring principle).  The leading segments of such a chain have a budget
below one: they are equal and serve as the join key.  The longer prefixes
prune the candidates, then the full distance is checked.

A chain that very many fingerprints share (a large group of near copies) would
pair them all.  Beyond ``PAIRED`` members its fingerprints are linked through
midpoints instead: two fingerprints are within two bits exactly if some value
is within one bit of both.  Each fingerprint has 65 such values and each value
at most 65 fingerprints, so that way is linear and just as exact.

Null and empty texts have fingerprint zero and link like any other.  Repeated
rows give repeated rows.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from nodecast.llm.graph import components
from nodecast.llm.tasks import small_batches
from nodecast.session import materialize

BITS, SEGMENTS, PAIRED = 64, 16, 8
WORD = re.compile(rb"[^\x20\x09-\x0d]+")
WORDS_AT_ONCE = 1 << 18


def fingerprint(text: str, shingle: int) -> int:
    """The 64-bit fingerprint as an unsigned number; words are taken in blocks,
    so a long text needs little more memory than itself."""
    found = (m.group() for m in WORD.finditer(text.encode("utf-8").lower()))
    votes, total, words = np.zeros(BITS, np.int64), 0, list(islice(found, WORDS_AT_ONCE))
    if not words:
        return 0
    while True:
        line = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes).tolist()
        ends = ends[min(shingle, len(words)) - 1 :].tolist()
        if len(words) >= shingle or not total:
            hashes = np.array(
                [xxhash.xxh64_intdigest(line[s:e], 42) for s, e in zip(starts, ends)], "<u8"
            )
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        more = list(islice(found, WORDS_AT_ONCE))
        if not more:
            break
        words = words[len(words) - shingle + 1 :] + more
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def fingerprints(
    frame: DataFrame, shingle: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, print``: the fingerprint's bits as a long; ``key`` is a long."""
    small_batches(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py() or "", shingle) for t in batch.column(1)]
            signed = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], [key, "print"])

    return frame.select(key, text).mapInArrow(run, f"`{key}` long, print long")


def _rotated(value: Column, by: Column) -> Column:
    return F.when(by == 0, value).otherwise(
        F.expr("shiftrightunsigned(print, turn) | shiftleft(print, 64 - turn)")
    )


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: pairs of different fingerprints that join all those at most
    ``max_bits`` (0, 1 or 2) apart into the same components.

    ``prints`` has one column ``print``.  Every pair returned is that close;
    within large groups not every close pair is listed.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("max_bits must be 0, 1 or 2")
    distinct = prints.select("print").where("print IS NOT NULL").distinct()
    if not max_bits:
        return distinct.select(F.col("print").alias("a"), F.col("print").alias("b")).where("a < b")
    width = BITS // SEGMENTS
    budget = [length * max_bits // SEGMENTS for length in range(SEGMENTS + 1)]
    equal = width * max(n for n in range(SEGMENTS) if budget[n] == 0)
    chains = (
        distinct.select("print", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1), F.lit(width))).alias("turn"))
        .withColumn("ring", _rotated(F.col("print"), F.col("turn")))
        .withColumn("chain", F.expr(f"shiftleft(bigint(turn), {equal}) + (ring & {(1 << equal) - 1}L)"))
        .select("chain", "ring", "print")
    )
    shared = chains.groupBy("chain").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialize(chains.join(shared, "chain"), "chains")

    few = members.where(F.col("n") <= PAIRED).drop("n")
    other = few.toDF("chain", "other_ring", "b")
    differing = F.expr("ring ^ other_ring")
    within = F.lit(True)
    for allowed in range(1, max_bits):  # the longest prefix with each budget
        length = width * max(n for n in range(SEGMENTS) if budget[n] == allowed)
        mask = F.lit((1 << length) - 1).cast("long")
        within = within & (F.bit_count(differing.bitwiseAND(mask)) <= allowed)
    paired = (
        few.join(other, "chain")
        .where(F.col("print") < F.col("b"))
        .where(within & (F.bit_count(differing) <= max_bits))
        .select(F.col("print").alias("a"), "b")
    )

    many = members.where(F.col("n") > PAIRED).select("print").distinct()
    flips = F.expr(f"transform(sequence(0, {BITS - 1}), i -> print ^ shiftleft(1L, i))")
    around = many.select(
        "print", F.explode(F.concat(F.array("print"), flips)).alias("middle")
    )
    grouped = around.groupBy("middle").agg(F.collect_set("print").alias("near"))  # at most 65
    hub = F.array_min("near") if max_bits == 2 else F.col("middle")
    met = (
        grouped.where(F.size("near") > 1)
        .select(hub.alias("a"), F.col("near"))
        .where(F.array_contains("near", F.col("a")))
        .select("a", F.explode("near").alias("b"))
        .where("a != b")
    )
    return paired.unionAll(met)


def near_duplicates(
    frame: DataFrame, shingle: int, max_bits: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, fingerprint, component_id`` for each row: 16 hex digits, and the
    smallest key reachable over fingerprints at most ``max_bits`` apart."""
    rows = materialize(fingerprints(frame, shingle, key, text), "prints")
    least = rows.groupBy("print").agg(F.min(key).alias("least"))
    grouped = components(links(rows, max_bits)).withColumnRenamed("node", "print")
    linked = grouped.join(least, "print")
    lowest = linked.groupBy("component").agg(F.min("least").alias("lowest"))
    known = materialize(linked.join(lowest, "component").select("print", "lowest"), "components")
    found = least.join(known, "print", "left").select(
        "print", F.coalesce("lowest", "least").alias("component_id")
    )
    return rows.join(found, "print").select(
        key, F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
