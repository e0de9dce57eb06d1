"""Exact percentiles, whatever the size of a group.

Where no group has more than ``WHOLE`` values, Spark's own exact ``percentile``
answers, whose state is at most that many values.  Beyond it two passes do.  The
first builds a mergeable quantile sketch of each group and reads off it, for
each wanted percentile, two marks that lie surely below and above it.  The
second counts what lies below the marks, and each value between them, about
``6 / ACCURACY`` of a group's values, equal ones together.  The counted values
are cut again into ``PARTS`` parts; the parts are added up, and only in the part
that holds a wanted rank is that rank read from a running count.  Marks and cuts
are values of the group itself, so neither the spread of the values nor infinite
ones matter, and the number of passes is fixed.  Nothing but the answer and the
size of the largest group reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from nodecast.functions.rowwise import quoted_name
from nodecast.session import materialize

WHOLE = 1_000_000
PARTS = 500
ACCURACY = 10_000
"""The sketch finds a value whose rank is wrong by at most 1 / ACCURACY of the group."""
SKETCH_SIZE, SKETCH_MARGIN, SKETCH_PARTS = 2_000, 0.015, 32
"""Sketches of columns side by side: ranks are wrong by about 0.25 % of the rows, a sixth of the margin."""


def exact_percentiles(
    values: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], largest: int | None = None
) -> DataFrame:
    """Linearly interpolated percentiles of ``value`` per group of ``keys``.

    Returns the keys, ``n`` (values that are there) and ``percentiles`` (array
    in the order asked for).  Missing values do not count; a group without any
    is not listed.  Without keys there is one row, or none without values.
    ``largest`` is a number that no group's values exceed, if one is known.
    """
    keys = list(keys)
    given = values.select(*keys, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    if (_largest(given, keys) if largest is None else largest) <= WHOLE:
        found = F.percentile("_v", F.array(*[F.lit(float(p)) for p in probabilities])).alias("percentiles")
        return given.groupBy(*keys).agg(F.count("_v").alias("n"), found).where("n > 0")
    places = _places(probabilities)
    marks = [(p, F.floor(at), F.ceil(at)) for p, at in places]
    return _interpolated(_at_ranks(given, keys, marks), keys, places)


def column_percentiles(rows: DataFrame, columns: Sequence[str], probability: float) -> DataFrame:
    """(feature, n, percentiles) of every column, as ``exact_percentiles`` of the long table.

    Beyond ``WHOLE`` rows the columns stay side by side: one pass builds a sketch
    of each column, joined in two steps, another counts what lies beyond its
    marks, and only the values between the marks, a few in a hundred, become rows.
    The counts tell whether the marks hold the ranks; if not, the long table answers.
    """
    numbers = rows.selectExpr(*[f"double({quoted_name(c)}) AS {quoted_name(c)}" for c in columns])
    size = rows.count()
    found = _column_counts(numbers, list(columns), probability) if size > WHOLE else None
    if found is None:
        entries = numbers.unpivot([], list(columns), "feature", "value")
        return exact_percentiles(entries, ["feature"], "value", [probability], size)
    keys = ["feature"]
    return _interpolated(_ranked(found, [*keys, "n", "_place", "_first", "_second"]), keys, _places([probability]))


def _column_counts(numbers: DataFrame, columns: list[str], probability: float) -> DataFrame | None:
    """What ``_at_ranks`` counts, for columns side by side; None if a rank lies beyond its marks."""
    lowest, highest = max(0.0, probability - SKETCH_MARGIN), min(1.0, probability + SKETCH_MARGIN)
    named = {f"c{k}": quoted_name(c) for k, c in enumerate(columns)}
    sketches = [F.expr(f"kll_sketch_agg_double(nanvl({c}, double('inf')), {SKETCH_SIZE}) AS {k}") for k, c in named.items()]
    parts = numbers.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_PARTS)).alias("_part")).agg(*sketches)
    joined = parts.unpivot([], list(named), "_at", "_sketch").where("_sketch IS NOT NULL").groupBy("_at").agg(
        F.expr(f"kll_merge_agg_double(_sketch, {SKETCH_SIZE}) AS _sketch")
    )
    read = [f"kll_sketch_get_quantile_double(_sketch, {p!r}D) AS {name}" for p, name in ((lowest, "low"), (highest, "high"))]
    ends = joined.selectExpr("_at", "kll_sketch_get_n_double(_sketch) AS n", "_sketch").where("n > 0").selectExpr("_at", "n", *read)
    ends = {r["_at"]: r for r in ends.collect()}
    if not ends:
        return None
    below = numbers.selectExpr(*[f"count_if({named[k]} < double('{r.low!r}')) AS {k}" for k, r in ends.items()]).first()
    facts = [
        (columns[int(k[1:])], r.n, 0, math.floor((r.n - 1) * probability), math.ceil((r.n - 1) * probability), below[k])
        for k, r in ends.items()
    ]
    spark = numbers.sparkSession
    bracket = ["feature", "n", "_place", "_first", "_second"]
    fields = "feature string, n bigint, _place int, _first bigint, _second bigint, _below bigint"
    known = spark.createDataFrame(facts, fields)  # one row a column
    between = [
        f"CASE WHEN {named[k]} BETWEEN double('{r.low!r}') AND double('{r.high!r}') THEN {named[k]} END AS {named[k]}"
        for k, r in ends.items()
    ]
    held = numbers.selectExpr(*between).unpivot([], [columns[int(k[1:])] for k in ends], "feature", "_at")
    held = materialize(held.where("_at IS NOT NULL").groupBy("feature", "_at").agg(F.count("_at").alias("_held")), "between")
    inside = {r.feature: r.n for r in held.groupBy("feature").agg(F.sum("_held").alias("n")).collect()}
    if any(first < low or second >= low + inside.get(name, 0) for name, _, _, first, second, low in facts):
        return None
    # no wanted rank lies beyond the marks, so what lies there need not be known
    unknown = F.lit(None).cast("double")
    start = known.where("_below > 0").select(
        *bracket, F.lit(-1).alias("_side"), unknown.alias("_at"), F.col("_below").alias("_held"),
        unknown.alias("_least"), unknown.alias("_most"),
    )
    values = held.join(F.broadcast(known), "feature").select(
        *bracket, F.lit(0).alias("_side"), "_at", "_held", F.col("_at").alias("_least"), F.col("_at").alias("_most")
    )
    return values.unionByName(start)


def _places(probabilities: Sequence[float]) -> list[tuple[float, Column]]:
    return [(float(p), (F.col("n") - 1) * F.lit(float(p))) for p in probabilities]


def _interpolated(held: DataFrame, keys: list[str], places: list[tuple[float, Column]]) -> DataFrame:
    """The percentiles between the values at both ranks."""
    share = F.element_at(F.array(*(at for _, at in places)), F.col("_place") + 1) - F.col("_first")
    between = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        F.col("low") + (F.col("high") - F.col("low")) * share
    )
    found = held.select(*keys, "n", "_place", between.alias("_found"))
    ordered = F.sort_array(F.collect_list(F.struct("_place", "_found")))
    gathered = found.groupBy(*keys, "n").agg(ordered.alias("_all"))
    return gathered.select(*keys, "n", F.col("_all._found").alias("percentiles"))


def _largest(given: DataFrame, keys: list[str]) -> int:
    """The number of values in the largest group."""
    sizes = given.groupBy(*keys).agg(F.count("_v").alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def exact_percentile(values: DataFrame, value: str, probability: float) -> float | None:
    """One percentile of one column, as a Python number."""
    found = exact_percentiles(values, [], value, [probability]).first()
    return found and found.percentiles[0]


def values_at_ranks(values: DataFrame, value: str, ranks: Sequence[int], total: int) -> list[float]:
    """The values at 0-based places among the ``total`` sorted values."""
    given = values.select(F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    if total <= WHOLE:
        ordered = F.sort_array(F.collect_list("_v"))
        return list(given.agg(F.array(*[F.get(ordered, F.lit(rank)) for rank in ranks]).alias("held")).first().held)
    marks = [(rank / max(total - 1, 1), F.lit(rank), F.lit(rank)) for rank in ranks]
    found = {row._place: row.low for row in _at_ranks(given, [], marks).collect()}  # one row a rank
    return [found[place] for place in range(len(ranks))]


def _at_ranks(
    values: DataFrame, keys: list[str], marks: Sequence[tuple[float, Column, Column]]
) -> DataFrame:
    """``keys, n, _place, _first, low, high``: for each mark (a share of the group and
    two neighbouring ranks near it, which may depend on ``n``) the values at both."""
    margin = 3 / ACCURACY
    lows = [max(0.0, share - margin) for share, _, _ in marks]
    highs = [min(1.0, share + margin) for share, _, _ in marks]
    sketched = F.percentile_approx("_v", lows + highs, ACCURACY).alias("_marks")
    sketches = values.groupBy(*keys).agg(F.count("_v").alias("n"), sketched).where("n > 0")
    wanted = F.array(
        *[
            F.struct(
                F.lit(place).alias("_place"),
                F.get("_marks", F.lit(place)).alias("_from"),
                F.get("_marks", F.lit(place + len(marks))).alias("_to"),
                first.cast("bigint").alias("_first"),
                second.cast("bigint").alias("_second"),
            )
            for place, (_, first, second) in enumerate(marks)
        ]
    )
    brackets = sketches.select(*keys, "n", F.inline(wanted))
    if keys:
        other = brackets.withColumnsRenamed({k: f"_of_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
        placed = values.join(other, same).drop(*[f"_of_{k}" for k in keys])
    else:
        placed = _beside(values, brackets)
    inside = F.col("_v").between(F.col("_from"), F.col("_to"))
    side = F.when(inside, 0).when(F.col("_v") < F.col("_from"), -1).otherwise(1)
    bracket = [*keys, "n", "_place", "_first", "_second"]
    counted = placed.groupBy(*bracket, side.alias("_side"), F.when(inside, F.col("_v")).alias("_at")).agg(
        F.count("_v").alias("_held"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
    )
    return _ranked(counted, bracket)


def _ranked(counted: DataFrame, bracket: list[str]) -> DataFrame:
    """The values at both ranks of each bracket, from counted values."""
    ranked = _running(materialize(counted, "counted"), bracket)

    def at(rank: str) -> Column:
        """The value at a rank: one between the marks, or the nearest one beyond."""
        here = (F.col(rank) >= F.col("_start")) & (F.col(rank) < F.col("_end"))
        nearest = (
            F.when(F.col("_side") == 0, F.col("_at"))
            .when((F.col("_side") < 0) & (F.col(rank) == F.col("_end") - 1), F.col("_most"))
            .when((F.col("_side") > 0) & (F.col(rank) == F.col("_start")), F.col("_least"))
            .otherwise(F.raise_error(F.lit("a rank lies beyond its marks")).cast("double"))
        )
        return F.max(F.when(here, nearest))

    return ranked.groupBy(*bracket).agg(at("_first").alias("low"), at("_second").alias("high"))


def _running(counted: DataFrame, bracket: list[str]) -> DataFrame:
    """The counted values of the parts that hold a wanted rank, each from ``_start`` to ``_end``.

    What lies below the marks is the first part, what lies above them the last."""
    steps = F.array(*[F.lit(k / PARTS) for k in range(1, PARTS)])
    cuts = counted.where("_side = 0").groupBy(*bracket).agg(F.percentile_approx("_at", steps, 10 * PARTS).alias("_cuts"))
    cuts = cuts.withColumnsRenamed({c: f"_of_{c}" for c in bracket})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in bracket]
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col("_at")))
    part = F.when(F.col("_side") < 0, -1).when(F.col("_side") > 0, PARTS).otherwise(below)
    parted = materialize(counted.join(cuts, same, "left").select(*counted.columns, part.alias("_part")), "parts")

    sums = parted.groupBy(*bracket, "_part").agg(F.sum("_held").alias("_sum"))
    upto = F.sum("_sum").over(Window.partitionBy(*bracket).orderBy("_part"))
    begun = sums.withColumn("_until", upto).withColumn("_from", F.col("_until") - F.col("_sum"))
    holds = [(F.col(rank) >= F.col("_from")) & (F.col(rank) < F.col("_until")) for rank in ("_first", "_second")]
    wanted = begun.where(holds[0] | holds[1]).select(*[F.col(c).alias(f"_of_{c}") for c in [*bracket, "_part"]], "_from")
    chosen = parted.join(wanted, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*bracket, "_part"]])
    inside = F.sum("_held").over(Window.partitionBy(*bracket, "_part").orderBy("_at"))
    return chosen.withColumn("_end", F.col("_from") + inside).withColumn("_start", F.col("_end") - F.col("_held"))


def _beside(values: DataFrame, brackets: DataFrame) -> DataFrame:
    """The brackets of the only group beside each value, as literals."""
    rows = brackets.collect()  # one row a mark
    if not rows:
        return values.limit(0).select("_v", *[F.lit(None).cast(f.dataType).alias(f.name) for f in brackets.schema])
    stated = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(brackets.schema, r)]) for r in rows]
    return values.select("_v", F.inline(F.array(*stated)))
