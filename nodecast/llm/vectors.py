"""Embedding near-dedup with an inverted multi-index.

Vectors are scaled to length one and cut into halves.  Each half has its own
codebook of ``codes`` centres (k-means on at most ``SAMPLE`` vectors, a
documented bound); the two form a grid of cells and every vector lies in the
cell of its two nearest centres.  Only one of each group of close sample vectors
counts for the codebooks, so that a large group does not draw the centres to
itself.  A vector looks for neighbours in the cells nearest to it, in order of
the sum of the two distances (multi-sequence traversal).  How many cells it
visits is fitted, without a ceiling, on an eighth of the sample that the
codebooks have not seen: the fewest that find at least ``RECALL`` of made pairs
with a cosine of exactly the bound, one vector of each group counting, and
likewise of the sample's own true pairs, and ``SPARE`` times as many for what
the sample does not show.  So the number does not depend on pairs that happen to
meet in the sample.

Rows with equal vectors are one node with a weight, so copies are compared once.
Cells hold about ``CELL`` nodes each.  Neighbouring cells form a group of about
``MEMBERS`` nodes, and a node is sent to each group it visits once, with the
cells it visits there, in the type it is stored in; there the visited cells are
compared as matrix products, in double precision.  A group with many members or visitors (a large
set of near copies) is cut into blocks of ``MEMBERS`` by a hash, so that no task holds a
whole one.  A pair of blocks gives counts and a spanning forest of its links,
never all pairs.

Vectors that are null, zero, or hold null or non-finite components, or have
another length than most, link with nothing.  Every row counts as a vector of its
own, whether it shares its id with others or has none; a row's component is the
least id reachable, which is null if no row there has one, and then it isn't
kept.  Rows that share an id and lie in components of their own get each their
own result.  Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from nodecast.llm.graph import components
from nodecast.llm.tasks import hashed_sample, small_batches
from nodecast.session import materialize

SAMPLE, RECALL, SPARE = 8192, 0.99, 2
CELL, MEMBERS = 512, 4096
PRODUCT = 1 << 21
"""Entries of one matrix product."""


def centres(x: np.ndarray, codes: int, rounds: int = 12) -> np.ndarray:
    """k-means, started at evenly spaced sample rows."""
    codes = min(codes, len(x))
    found = x[np.linspace(0, len(x) - 1, codes).astype(int)].copy()
    for _ in range(rounds):
        near = np.argmin((found * found).sum(1) - 2 * x @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, near, x)
        sizes = np.bincount(near, minlength=codes)
        found[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return found


def visits(left: np.ndarray, right: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The ``n`` cells with the smallest sum of distances, nearest first."""
    by_left, by_right = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap, seen, found = [(left[by_left[0]] + right[by_right[0]], 0, 0)], {(0, 0)}, []
    while heap and len(found) < n:
        _, i, j = heapq.heappop(heap)
        found.append((int(by_left[i]), int(by_right[j])))
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(left) and b < len(right) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (left[by_left[a]] + right[by_right[b]], a, b))
    return found


def one_of_each(x: np.ndarray, least: float) -> np.ndarray:
    """Rows of which no two have a cosine of ``least``, one near each row of ``x``."""
    found = x[:0]
    for at in range(0, len(x), 512):
        rest = x[at : at + 512]
        rest = rest[~(rest @ found.T >= least).any(axis=1)]
        close, gone, taken = rest @ rest.T >= least, np.zeros(len(rest), bool), []
        for i in range(len(rest)):
            if not gone[i]:
                taken.append(i)
                gone |= close[i]
        found = np.concatenate([found, rest[taken]])
    return found


def made_pairs(x: np.ndarray, least: float, each: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The rows of ``x``, and vectors at a cosine of exactly ``least`` to them in random directions."""
    x = np.repeat(x, each, axis=0)
    aside = np.random.default_rng(0).normal(size=x.shape)
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    aside /= np.maximum(np.sqrt((aside * aside).sum(axis=1, keepdims=True)), 1e-300)
    return x, least * x + np.sqrt(max(0.0, 1 - least * least)) * aside


def true_pairs(queries: np.ndarray, sample: np.ndarray, least: float, each: int = 4) -> list[tuple[np.ndarray, np.ndarray]]:
    """Close pairs of a query and a sample row, at most ``each`` a query, at
    random: those of one query a group, and those of all queries."""
    found = []
    for x in (one_of_each(queries, least), queries):
        rnd, firsts, seconds = np.random.default_rng(0), [], []
        for at in range(0, len(x), 1024):
            product = x[at : at + 1024] @ sample.T
            a, b = np.nonzero((product >= least) & (product < 1 - 1e-9))  # copies share a cell
            order = np.lexsort((rnd.random(len(a)), a))
            a, b = a[order], b[order]
            few = np.arange(len(a)) - np.searchsorted(a, a) < each
            firsts.append(a[few] + at)
            seconds.append(b[few])
        found.append((x[np.concatenate(firsts)], sample[np.concatenate(seconds)]))
    return found


class Grid:
    """Two codebooks and the number of cells to visit."""

    def __init__(self, sample: np.ndarray, codes: int, least: float):
        self.half = sample.shape[1] // 2
        held = np.arange(len(sample)) % 8 == 7  # not seen by the codebooks
        single = one_of_each(sample[~held], least)
        codes = min(codes, max(1, len(single) // 4))
        self.books = [centres(single[:, : self.half], codes), centres(single[:, self.half :], codes)]
        self._order_right()
        self.cells = 1
        queries = sample[held] if held.any() else sample
        for pairs in (made_pairs(one_of_each(queries, least), least), *true_pairs(queries, sample, least)):
            x, y = pairs
            if len(x):
                ranks = np.minimum(self.ranks(x, y), self.ranks(y, x))  # either finds the link
                needed = int(np.sort(ranks)[int(np.ceil(RECALL * len(ranks))) - 1])
                self.cells = max(self.cells, SPARE * needed)

    def _order_right(self) -> None:
        """Numbers the right centres along their main axis, so that cells with near numbers are near."""
        book = self.books[1] - self.books[1].mean(axis=0)
        axis = np.linalg.svd(book, full_matrices=False)[2][0]
        self.books[1] = self.books[1][np.argsort(book @ axis, kind="stable")]

    def group_of(self, cell: np.ndarray) -> np.ndarray:
        """The group of a cell: some neighbouring right centres under one left centre."""
        width, span = len(self.books[1]), max(1, MEMBERS // CELL)
        return cell // width * -(-width // span) + cell % width // span

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        parts = (x[:, : self.half], x[:, self.half :])
        return [(b * b).sum(1) - 2 * p @ b.T + (p * p).sum(1)[:, None] for p, b in zip(parts, self.books)]

    def cell_of(self, x: np.ndarray) -> np.ndarray:
        left, right = (d.argmin(axis=1) for d in self.distances(x))
        return left.astype(np.int64) * len(self.books[1]) + right

    def visited(self, x: np.ndarray, n: int | None = None) -> np.ndarray:
        n = min(n or self.cells, len(self.books[0]) * len(self.books[1]))
        width = len(self.books[1])
        rows = [[a * width + b for a, b in visits(p, q, n)] for p, q in zip(*self.distances(x))]
        return np.array(rows, dtype=np.int64).reshape(len(x), n)

    def ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """At which visit, counted from 1, the rows of ``x`` reach the cells of ``y``."""
        found = []
        for at in range(0, len(x), 256):
            places = (d.argmin(axis=1) for d in self.distances(y[at : at + 256]))
            for left, right, i, j in zip(*self.distances(x[at : at + 256]), *places):
                goal = left[i] + right[j]
                found.append(np.searchsorted(np.sort(right), goal - left + 1e-12, side="right").sum())
        return np.array(found, int)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows of length one; rows that are zero or not finite become NaN."""
    top = np.abs(x).max(axis=1, initial=0)[:, None]
    top = np.where(np.isfinite(top) & (top > 0), top, np.nan)
    x = x / top  # the square of a component cannot overflow or vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def unit(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The usable vectors of an Arrow list column, scaled, and which rows they are."""
    rows, places = [], []
    for i, v in enumerate(column.to_pylist()):
        if v and None not in v and (width is None or len(v) == width):
            rows.append(v)
            places.append(i)
    x = scaled(np.array(rows, dtype=np.float64).reshape(len(rows), width or (len(rows[0]) if rows else 0)))
    good = ~np.isnan(x).any(axis=1)
    return x[good], np.array(places, int)[good]


def build(vectors: DataFrame, vector: str, n: int, least: float) -> tuple[Grid | None, int]:
    """The grid for ``n`` rows, fitted on a bounded sample, and the vector length."""
    usable = vectors.where(F.size(vector) > 1)
    length = usable.groupBy(F.size(vector).alias("width")).count().orderBy(F.desc("count"), "width").first()
    if length is None:
        return None, 0
    mixed = usable.where(F.size(vector) == length.width).select(vector)
    rows = hashed_sample(mixed, F.xxhash64(vector), n, SAMPLE).collect()  # at most SAMPLE vectors
    sample, _ = unit(pa.array([r[0] for r in rows]), length.width)
    if not len(sample):
        return None, 0
    codes = min(4096, max(1, round(np.sqrt(n / CELL))))
    return Grid(sample, codes, least), length.width


def _placed(nodes: DataFrame, grid: Grid, width: int, kind: str) -> DataFrame:
    """``node, weight, cell, g, goals, vec`` of the usable nodes: the group and cell
    they lie in, and by group the cells they visit."""
    spark = small_batches(nodes.sparkSession)
    shared = spark.sparkContext.broadcast(grid)  # two codebooks of at most 4,096 centres
    goals = pa.list_(pa.struct([("g", pa.int64()), ("cells", pa.list_(pa.int64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, places = unit(batch.column(2), width)
            if not len(x):
                continue
            grid, taken = shared.value, pa.array(places)
            cell, visited = grid.cell_of(x), grid.visited(x)
            groups = grid.group_of(visited)
            by_group = []
            for own, cells in zip(groups, visited):
                found: dict[int, list[int]] = {}
                for g, c in zip(own.tolist(), cells.tolist()):
                    found.setdefault(g, []).append(c)
                by_group.append([{"g": g, "cells": cells} for g, cells in found.items()])
            raw = np.array(batch.column(2).take(taken).to_pylist(), dtype=kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(cell), pa.array(grid.group_of(cell)),
                 pa.array(by_group, goals), pa.array([r.tobytes() for r in raw], pa.binary())],
                ["node", "weight", "cell", "g", "goals", "vec"],
            )

    types = "node long, weight long, cell long, g long, goals array<struct<g: long, cells: array<long>>>, vec binary"
    return nodes.select("node", "weight", "v").mapInArrow(run, types)


def forest(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a boolean matrix, the least row of their
    connected component, or -1 without a link."""
    n = len(close)
    rows = np.where(close.any(axis=1), np.arange(n), n)
    while True:
        columns = np.where(close, rows[:, None], n).min(axis=0)
        lower = np.minimum(rows, np.where(close, columns[None, :], n).min(axis=1))
        if (lower == rows).all():
            return np.where(rows < n, rows, -1), np.where(columns < n, columns, -1)
        rows = lower


def _compare(least: float, width: int, kind: str):
    """A function on one group: some members and some visitors of its cells."""

    def stack(rows: pd.DataFrame) -> np.ndarray:
        return scaled(np.frombuffer(b"".join(rows["vec"]), kind).reshape(-1, width).astype(np.float64))

    def run(members: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
        edges: list[tuple[int, int]] = []
        if not len(members) or not len(visitors):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("Int64")
        x, y = stack(members), stack(visitors)
        ids, guests = members["node"].to_numpy(), visitors["node"].to_numpy()
        weights, guest_weights = members["weight"].to_numpy(), visitors["weight"].to_numpy()
        homes = visitors["cell"].to_numpy()
        goals = members["visits"].to_list()
        counts, guest_counts = np.zeros(len(ids), np.int64), np.zeros(len(guests), np.int64)
        sizes = visitors["cells"].map(len).to_numpy()
        asked, who = np.concatenate(visitors["cells"].to_list()), np.repeat(np.arange(len(guests)), sizes)
        by_cell = pd.Series(np.arange(len(asked))).groupby(asked).indices
        for cell, held in members.groupby("cell").indices.items():
            came = who[by_cell[cell]] if cell in by_cell else np.empty(0, np.int64)
            step = max(1, PRODUCT // len(held))
            for at in range(0, len(came), step):
                part = came[at : at + step]
                close = y[part] @ x[held].T >= least
                close &= guests[part][:, None] != ids[held][None, :]
                if not close.any():
                    continue
                guest_counts[part] += close @ weights[held]
                # a member that does not visit the guest's cell does not count the link itself
                for place in np.flatnonzero(close.any(axis=0)):
                    linked = part[close[:, place]]
                    counts[held[place]] += guest_weights[linked][~np.isin(homes[linked], goals[held[place]])].sum()
                by_row, by_column = forest(close)
                for own, roots in ((guests[part], by_row), (ids[held], by_column)):
                    has = roots >= 0
                    edges += zip(own[has].tolist(), guests[part][roots[has]].tolist())
        rows = [(a, b, 0) for a, b in edges if a != b]
        for own, sums in ((ids, counts), (guests, guest_counts)):
            rows += [(a, None, n) for a, n in zip(own.tolist(), sums.tolist()) if n]
        return pd.DataFrame(rows, columns=["a", "b", "n"]).astype("Int64")

    return run


def _links(placed: DataFrame, least: float, width: int, kind: str) -> DataFrame:
    """Counts and links, found group by group.  Large groups are cut into blocks
    of members times blocks of visitors."""
    visits = F.flatten(F.col("goals.cells")).alias("visits")
    own = [F.col(c).alias(c) for c in ("node", "weight", "cell", "vec")]  # columns of its own for the cogroup
    goals = placed.select(*own, F.inline("goals").alias("to", "cells"))
    held = placed.groupBy("g").agg(F.count(F.lit(1)).alias("held"))
    came = placed.select(F.explode("goals.g").alias("to")).groupBy("to").agg(F.count(F.lit(1)).alias("came"))
    blocks = lambda c: F.ceil(F.col(c) / MEMBERS).cast("int")
    sizes = held.join(came, held["g"] == came["to"]).select(
        F.col("g").alias("at"), blocks("held").alias("m_blocks"), blocks("came").alias("v_blocks")
    )
    sizes = materialize(sizes, "groups")
    any_of = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    mine = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    members = (
        placed.select("g", "node", "weight", "cell", visits, "vec")
        .join(sizes, F.col("g") == F.col("at"))
        .withColumn("m", mine("m_blocks"))
        .withColumn("v", any_of("v_blocks"))
        .select("g", "m", "v", "node", "weight", "cell", "visits", "vec")
    )
    visitors = (
        goals.join(sizes, F.col("to") == F.col("at"))
        .withColumn("v", mine("v_blocks"))
        .withColumn("m", any_of("m_blocks"))
        .select(F.col("to").alias("g"), "m", "v", "node", "weight", "cell", "cells", "vec")
    )
    by = ("g", "m", "v")
    grouped = members.groupBy(*by).cogroup(visitors.groupBy(*by))
    return grouped.applyInPandas(_compare(least, width, kind), "a long, b long, n long")


def near_duplicates(
    frame: DataFrame, least: float, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``key, n_links, component_id, kept`` per row: other vectors found with a
    cosine of at least ``least``, the smallest key reachable over links, and
    whether that is the row's own."""
    marks = F.xxhash64(vector).alias("h"), F.xxhash64(F.lit(1), vector).alias("k")  # 128 bits name a vector
    rows = frame.select(F.col(key).alias("id"), F.col(vector).alias("v"), *marks)
    equal = rows.where("v IS NOT NULL").groupBy("h", "k").agg(
        F.first("v").alias("v"), F.count(F.lit(1)).alias("weight"), F.min("id").alias("least")
    )
    nodes = materialize(equal.withColumn("node", F.monotonically_increasing_id()), "vectors")
    n = nodes.count()
    grid, width = build(nodes, "v", n, least)
    alone = rows.select(
        F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
        F.col("id").isNotNull().alias("kept"),
    )
    if grid is None:
        return alone
    kind = "float32" if "float" in nodes.schema["v"].dataType.simpleString() else "float64"
    placed = materialize(_placed(nodes, grid, width, kind), "placed")
    found = materialize(_links(placed, least, width, kind), "links")
    sums = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    groups = components(found.where("b IS NOT NULL").select("a", "b"))
    usable = placed.select("node", F.lit(True).alias("usable"))
    known = nodes.select("node", "h", "k", "weight", "least").join(usable, "node").join(sums, "node", "left").join(groups, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    # only what has a link is looked up again
    linked = materialize(known.where("others > 0 OR weight > 1"), "linked")
    firsts = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(firsts, "component").select(
        "h", "k", "component_id", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("links")
    )
    joined = rows.select("id", "h", "k").join(materialize(named, "named"), ["h", "k"], "left")
    own = F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(own == F.col("id"), F.lit(False)).alias("kept"),
    )
