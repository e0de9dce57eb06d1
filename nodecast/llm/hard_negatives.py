"""Hard-negative mining with Four-Russians scoring.

Components become integers, floor(256 x).  An anchor's integer vector is cut
into groups of eight dimensions, and for each group a table holds the sum of
every subset of its eight numbers, found by its byte (``subset_sums``).  A
candidate is kept as bit planes: plane k packs bit k of its components, eight
dimensions a byte (``planes``).  The inner product is then

    sum over planes k of +-2^k (sum over groups of table[group][byte of plane k])

by lookups, shifts and additions (``look_up``), exact in whole numbers; the top
plane counts negative (two's complement).  How many planes there are follows
from the numbers themselves, and sums that could pass 64 bits raise an
OverflowError.

Rows stay where they are: every task reads its own rows, block by block, and
scores them against a slice of at most ``SLICE`` anchors, which is broadcast
(one job a slice, so memory does not grow with the anchors).  It keeps the best
few an anchor, and only those are shuffled.  First come the positives of each
anchor (rows of its label only), then, with the bounds that their scores set,
the negatives (rows of other labels).  No score is approximate and nothing is
left out.

Rows with a null id, null label, null vector, or a null or non-finite component
take no part.  A shorter vector has zeros at its end, as against a longer one.
Rows that share an id, copies included, are rows of their own: each is a
candidate, and an anchor's copies can be its positives.  Equal scores are
ordered by id, equal ids by their label and a hash of their vector.  Anchors
without positives, and positives without negatives, give no rows.  An empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from nodecast.session import materialize

SLICE = 8192
"""Anchors that one job broadcasts."""
ROWS = 8192
"""Candidate rows that a task scores at a time."""
TILE, STRIPE = 64, 512
"""Anchors and candidates of one step, so that tables and sums stay in cache."""


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """[group, byte, anchor]: the sum of the anchor's numbers in the group where
    the byte has a bit (lowest bit first)."""
    n, width = anchors.shape
    groups = -(-width // 8)
    padded = np.zeros((n, groups * 8), np.int64)
    padded[:, :width] = anchors
    found = np.zeros((groups, 256, n), np.int64)
    for bit in range(8):
        size = 1 << bit
        column = padded[:, bit::8].T[:, None, :]  # one number a group and anchor
        found[:, size : 2 * size] = found[:, :size] + column
    return found


def planes(candidates: np.ndarray) -> np.ndarray:
    """[plane, group, candidate]: the packed bits, the last plane being the sign."""
    n, width = candidates.shape
    top = int(max(candidates.max(initial=0), ~candidates.min(initial=0))).bit_length() + 1
    groups = -(-width // 8)
    found = np.zeros((top, groups, n), np.uint8)
    for k in range(top):
        bits = ((candidates >> k) & 1).astype(np.uint8)
        found[k] = np.packbits(bits, axis=1, bitorder="little").T
    return found


def number_kind(candidates: np.ndarray, anchors: np.ndarray) -> type:
    """A type that holds every sum on the way to a score of these."""
    high = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    width = max(candidates.shape[1], anchors.shape[1], 1)
    bound = 2 * (high(candidates) + 1) * (high(anchors) + 1) * width
    if bound >= 1 << 63:
        raise OverflowError("scores could pass 64 bits")
    return np.int32 if bound < 1 << 31 else np.int64


def look_up(bits: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """[candidate, anchor]: inner products from packed planes and subset sums.
    Groups that only one side has count nothing: its numbers are zero there."""
    n, k = bits.shape[2], tables.shape[2]
    found = np.zeros((n, k), tables.dtype)
    groups = range(min(bits.shape[1], len(tables)))
    for c in range(0, n, STRIPE):
        total = found[c : c + STRIPE]
        looked = np.empty_like(total)
        for plane in range(len(bits) - 1, -1, -1):
            total <<= 1
            add = np.subtract if plane == len(bits) - 1 else np.add  # the sign plane counts negative
            for group in groups:
                np.take(tables[group], bits[plane, group, c : c + STRIPE], axis=0, out=looked, mode="clip")
                add(total, looked, out=total)
    return found


def whole(vector: Column) -> Column:
    """The components as integers."""
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))


def usable(frame: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``id, label, q, mark`` of the rows that take part."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    named = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()
    return frame.where(named).where(finite).select(
        F.col(key).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        whole(F.col(vector)).alias("q"),
        F.xxhash64(vector).alias("mark"),
    )


def _stack(column: pa.Array) -> np.ndarray:
    """An Arrow column of integer lists as a matrix, with zeros at the ends of short ones."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    width = int(sizes.max(initial=0))
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    found = np.zeros((len(sizes), width), np.int64)
    found[np.arange(width)[None, :] < sizes[:, None]] = values
    return found


class Best:
    """The first ``n`` candidates of each list, over all blocks seen so far."""

    FIELDS = ("score", "id", "label", "mark", "row")

    def __init__(self, lists: int, n: int):
        self.n, self.held = n, [[] for _ in range(lists)]

    def offer(self, at: int, found: list[tuple]) -> None:
        if found:
            self.held[at] = sorted([*self.held[at], *found], key=lambda t: (-t[0], *t[1:]))[: self.n]

    def columns(self) -> tuple[list[int], list[tuple]]:
        lists = [at for at, held in enumerate(self.held) for _ in held]
        return lists, [t for held in self.held for t in held]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task in blocks of about ``ROWS``, ordered by id, label and mark."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= ROWS:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


class Slice:
    """Some anchors, and the scores their negatives have to lie between."""

    def __init__(self, rows: list):
        self.row = np.array([r.row for r in rows], np.int64)
        self.label = np.array([r.label for r in rows], np.int64)
        self.q = _stack(pa.array([r.q for r in rows], pa.list_(pa.int64())))
        self.low = self.high = None  # [anchor, positive]


def first_of(key: np.ndarray, n: int) -> np.ndarray:
    """Indices of the ``n`` greatest of ``key``, ties by index."""
    if len(key) > 4 * n:
        edge = np.partition(key, len(key) - n)[len(key) - n]
        at = np.flatnonzero(key >= edge)
        return at[np.argsort(-key[at], kind="stable")][:n]
    return np.argsort(-key, kind="stable")[:n]


def _task(shared, n: int, negatives: bool):
    """A function on the rows of a task: the best rows of each list.

    A list is an anchor, or one of its positives when ``negatives`` are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Slice = shared.value
        per = anchors.low.shape[1] if negatives else 1
        best = Best(len(anchors.row) * per, n)
        for block in _blocks(batches):
            ids, labels, marks, rows = (block[c].to_numpy() for c in ("id", "label", "mark", "row"))
            order = np.lexsort((rows, marks, labels, ids))
            ids, labels, marks, rows = ids[order], labels[order], marks[order], rows[order]
            q = _stack(block["q"])[order]
            kind, bits = number_kind(q, anchors.q), planes(q)
            for label in np.unique(labels if not negatives else anchors.label):
                mine = np.flatnonzero(labels != label if negatives else labels == label)
                own = np.flatnonzero(anchors.label == label)
                if not len(mine) or not len(own):
                    continue
                packed = np.ascontiguousarray(bits[:, :, mine])
                for start in range(0, len(own), TILE):
                    part = own[start : start + TILE]
                    table = look_up(packed, subset_sums(anchors.q[part]).astype(kind)).T
                    for at, line in zip(part, np.ascontiguousarray(table)):
                        pick = _between if negatives else _others
                        for which, chosen in pick(anchors, at, line, rows[mine], n):
                            places = mine[chosen]
                            found = zip(
                                line[chosen].tolist(), ids[places].tolist(), labels[places].tolist(),
                                marks[places].tolist(), rows[places].tolist(),
                            )
                            best.offer(at * per + which, list(found))
        lists, found = best.columns()
        numbers = np.array(lists, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors.row[numbers // per]), pa.array(numbers % per)]
            + [pa.array([t[i] for t in found], pa.int64()) for i in range(5)],
            ["anchor_row", "which", *Best.FIELDS],
        )

    return run


def _others(anchors: Slice, at: int, line: np.ndarray, rows: np.ndarray, n: int):
    """The first rows but the anchor itself."""
    chosen = first_of(line, n + 1)
    yield 0, chosen[rows[chosen] != anchors.row[at]][:n]


def _between(anchors: Slice, at: int, line: np.ndarray, rows: np.ndarray, n: int):
    """For each positive, the first rows whose score lies between its bounds."""
    low, high = anchors.low[at], anchors.high[at]
    if (low > high).all():
        return
    fit = np.flatnonzero((line >= low.min()) & (line <= high.max()))
    values = line[fit]
    order = np.argsort(-values, kind="stable")
    fit, falling = fit[order], -values[order]
    for which, (lo, hi) in enumerate(zip(low, high)):
        if lo <= hi:
            start = np.searchsorted(falling, -hi)
            end = np.searchsorted(falling, -lo, side="right")
            yield which, fit[start : min(end, start + n)]


FOUND = "anchor_row long, which long, score long, id long, label long, mark long, row long"


def _ranked(found: DataFrame, n: int, name: str) -> DataFrame:
    """The first ``n`` of each list over all tasks, with their rank from 1."""
    order = [F.desc("score"), "id", "label", "mark", "row"]
    place = F.row_number().over(Window.partitionBy("anchor_row", "which").orderBy(*order))
    return materialize(found.withColumn("rank", place).where(F.col("rank") <= n), name)


def mine(
    frame: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` is a condition on ``id``.  Anchors have their first ``positives``
    other rows of the same label; for each, the first ``negatives`` rows of other
    labels whose score is from ``least`` to ``most`` percent of the positive's.
    """
    spark = frame.sparkSession
    rows = usable(frame, key, vector, label).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "rows")
    chosen = materialize(rows.where(anchor).select("row", "id", "label", "q"), "anchors")
    slices = -(-chosen.count() // SLICE)
    mark = F.pmod(F.xxhash64("row"), F.lit(max(1, slices))) if slices > 1 else F.lit(0)
    results = []
    for number in range(slices):
        part = chosen.where(mark == number)
        anchors = Slice(part.collect())  # about SLICE rows
        shared = spark.sparkContext.broadcast(anchors)
        best = rows.mapInArrow(_task(shared, positives, False), FOUND)
        good = _ranked(best, positives, "positives")
        bounds = good.select("anchor_row", "rank", "score").collect()  # a few an anchor of the slice
        _set_bounds(anchors, bounds, positives, least, most)
        shared.unpersist()
        shared = spark.sparkContext.broadcast(anchors)
        bad = _ranked(rows.mapInArrow(_task(shared, negatives, True), FOUND), negatives, "negatives")
        results.append(_joined(part, good, bad))
    if not results:
        empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], empty)
    together = results[0]
    for other in results[1:]:
        together = together.unionAll(other)
    return together


def _set_bounds(anchors: Slice, found: list, positives: int, least: int, most: int) -> None:
    """Bounds of negative scores in whole numbers; none where there is no positive."""
    at = {row: i for i, row in enumerate(anchors.row.tolist())}
    shape = (len(anchors.row), positives)
    anchors.low, anchors.high = np.ones(shape, np.int64), np.zeros(shape, np.int64)
    for row in found:
        place = at[row.anchor_row], row.rank - 1
        anchors.low[place] = -(-least * row.score // 100)
        anchors.high[place] = most * row.score // 100


def _joined(part: DataFrame, good: DataFrame, bad: DataFrame) -> DataFrame:
    anchors = part.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"))
    positives = good.select(
        "anchor_row", (F.col("rank") - 1).cast("long").alias("which"),
        F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    negatives = bad.select(
        "anchor_row", "which", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    found = positives.join(negatives, ["anchor_row", "which"]).join(anchors, "anchor_row")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
