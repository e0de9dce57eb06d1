"""Language identification by Bayesian evidence fusion.

The score of a language is the sum of log evidence from

* the text: hashed byte trigrams under a model per language, fitted on at most
  ``SAMPLE`` labelled rows per language (a documented bound); long texts count
  as at most ``TEMPER`` trigrams, since neighbouring trigrams are not independent,
* the declared language (of the markup or the record),
* the address suffix,
* the prior of the host, smoothed towards its parent domain, and that towards
  the whole collection (``KAPPA`` pseudo-rows at each step).

How reliable the last three are is counted over all rows by grouped aggregation
against the text's own best language.  Host and suffix tables stay distributed
and are joined; only the languages reach the driver.  Every label that occurs is
a language, whatever their number; a region tag (``en-US``) does not make
another.  The text model takes 256 KB a language on the driver and in each worker.

A row is kept if its text has a letter and the best posterior reaches the
given level; otherwise its language is ``und``.  Null and empty texts give
``und``.  A null declared language, suffix or host is no evidence.  Repeated
rows give repeated rows; only the named columns are read.  Without any labelled
row there are no languages and all rows are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from nodecast.llm.tasks import small_batches
from nodecast.session import materialize

SAMPLE = 1000
BUCKETS, TEMPER, KAPPA, ALPHA = 1 << 16, 100.0, 10.0, 0.5
BLOCK = 1 << 22
OPEN = 64
"""Languages that a task counts at once."""
REGION = r"^\s*([a-z]{2,3}(?:[-_][a-z]{4})?)[-_](?:[a-z]{2}|[0-9]{3})\s*$"


def trigrams(text: str) -> Iterator[np.ndarray]:
    """The buckets of all byte trigrams of the lower-cased text, in blocks.
    Everything but letters is one space; text without a letter has none."""
    for at in range(0, len(text), BLOCK):
        part = "".join(c if c.isalpha() else " " for c in text[at : at + BLOCK].lower())
        part = " ".join(part.split())
        if part:
            raw = np.frombuffer(f" {part} ".encode(), dtype=np.uint8).astype(np.uint32)
            mixed = (raw[:-2] * 31 + raw[1:-1]) * 1021 + raw[2:] * 7919
            yield mixed * np.uint32(2654435761) >> np.uint32(16)


def host_parts(address: Column) -> tuple[Column, Column, Column]:
    """Host, parent domain (its last two labels) and suffix (its last label) of
    an address or a bare host."""
    host = F.lower(F.regexp_extract(address, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#:]*)", 1))
    host = F.when(host != "", host)
    labels = F.split(host, r"\.")
    parent = F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(host)
    suffix = F.when(F.size(labels) > 1, F.element_at(labels, -1))
    return host, parent, suffix


def language_tag(label: Column) -> Column:
    """The label in lower case, without a region."""
    return F.regexp_replace(F.lower(label), REGION, "$1")


def fit(frame: DataFrame, text: str, label: str) -> tuple[list[str], np.ndarray]:
    """The languages, and log P(bucket | language) as an array (bucket, language)."""
    small_batches(frame.sparkSession)
    named = frame.select(language_tag(F.col(label)).alias("label"), F.col(text).alias("text"))
    known = named.where("label IS NOT NULL AND length(text) > 0").withColumn("mark", F.xxhash64("text"))
    marks = materialize(known.select("label", "mark").distinct(), "marks")
    counts = {r[0]: r[1] for r in marks.groupBy("label").count().collect()}  # a row a language
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((BUCKETS, 0), np.float32)
    # marks beyond a bound that leaves a few spare are dropped before they are ordered
    shares = [(x, i, min(1.0, (1.1 * SAMPLE + 100) / counts[x])) for i, x in enumerate(languages)]
    slots = frame.sparkSession.createDataFrame(shares, "label string, slot int, share double")
    low = marks.join(F.broadcast(slots), "label").where(F.col("mark") / F.lit(2.0**64) + 0.5 <= F.col("share"))
    place = F.row_number().over(Window.partitionBy("slot").orderBy("mark"))
    chosen = low.withColumn("place", place).where(F.col("place") <= SAMPLE).select("label", "slot", "mark")
    copies = known.join(F.broadcast(chosen), ["label", "mark"]).select("slot", "mark", "text")  # SAMPLE marks a language

    def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            new = []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(new, pa.bool_()))

    few = copies.mapInArrow(first_of_each, "slot int, mark long, text string")  # a task hands on one of each
    sample = few.groupBy("slot", "mark").agg(F.min("text").alias("text")).select("slot", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}

        def counted() -> pa.RecordBatch:
            parts = [(slot, np.nonzero(n)[0], n) for slot, n in total.items()]
            columns = [
                pa.array([slot for slot, at, _ in parts for _ in at], pa.int32()),
                pa.array([b for _, at, _ in parts for b in at.tolist()], pa.int32()),
                pa.array([x for _, at, n in parts for x in n[at].tolist()], pa.int64()),
            ]
            total.clear()
            return pa.RecordBatch.from_arrays(columns, ["slot", "bucket", "n"])

        for batch in batches:
            for slot, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if slot not in total:
                    if len(total) == OPEN:
                        yield counted()
                    total[slot] = np.zeros(BUCKETS, np.int64)
                # each text counts once per bucket, so copies of long texts do not rule
                for found in trigrams(text.as_py()):
                    total[slot][np.unique(found)] += 1
        yield counted()

    held = sample.mapInArrow(run, "slot int, bucket int, n long").groupBy("slot", "bucket").agg(F.sum("n").alias("n"))
    held = held.toArrow()  # at most BUCKETS counts a language
    slot, bucket, n = (held.column(c).to_numpy() for c in ("slot", "bucket", "n"))
    table = np.full((BUCKETS, len(languages)), 0.5, np.float32)
    order = np.argsort(slot, kind="stable")
    ends = np.searchsorted(slot[order], np.arange(len(languages) + 1))
    for i in range(len(languages)):
        own, mine = np.full(BUCKETS, 0.5), order[ends[i] : ends[i + 1]]
        own[bucket[mine]] += n[mine]
        table[:, i] = np.log(own / own.sum())
    return languages, table


def text_evidence(texts: DataFrame, table: np.ndarray) -> DataFrame:
    """Adds ``evidence`` (log likelihood per language, tempered) and ``n_trigrams``
    to a frame of row parts whose last column is the text, which goes."""
    spark = small_batches(texts.sparkSession)
    shared = spark.sparkContext.broadcast(table)  # BUCKETS floats a language
    step = max(1, BLOCK // max(1, table.shape[1]))  # trigrams looked up at once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            evidence, sizes = [], []
            for text in batch.column(batch.num_columns - 1):
                total, n = np.zeros(table.shape[1]), 0
                for found in trigrams(text.as_py() or ""):
                    for at in range(0, len(found), step):
                        total += table[found[at : at + step]].sum(axis=0, dtype=np.float64)
                    n += len(found)
                evidence.append((total / n * (n / (1 + n / TEMPER)) if n else total).tolist())
                sizes.append(n)
            columns = [*batch.columns[:-1], pa.array(evidence, pa.list_(pa.float64())), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "evidence", "n_trigrams"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema[:-1])
    return texts.mapInArrow(run, f"{fields}, evidence array<double>, n_trigrams long")


def _counts(rows: DataFrame, by: str, n: int) -> DataFrame:
    """Rows of each best language for each value of ``by``, as an array."""
    held = rows.where(F.col(by).isNotNull() & (F.col("n_trigrams") > 0)).groupBy(by, "best").count()
    entry = F.struct("best", F.col("count").cast("double"))
    grouped = held.groupBy(by).agg(F.map_from_entries(F.collect_list(entry)).alias("held"))  # at most one entry a language
    return grouped.select(by, F.expr(f"transform(sequence(0, {n - 1}), i -> coalesce(try_element_at(held, i), 0D))").alias(f"{by}_n"))


def _sum(array: str) -> str:
    return f"aggregate({array}, 0D, (a, x) -> a + x)"


def fuse(rows: DataFrame, languages: list[str]) -> DataFrame:
    """Adds ``posterior`` (array) to rows with ``evidence``, ``n_trigrams``,
    ``declared``, ``suffix``, ``host`` and ``parent``."""
    n = len(languages)
    best = F.array_position("evidence", F.array_max("evidence")).cast("int") - 1
    rows = rows.withColumn("best", best)
    held = {r[0]: r[1] for r in rows.where("n_trigrams > 0").groupBy("best").count().collect()}  # a row a language
    total = [float(held.get(i, 0)) for i in range(n)]
    base = [(x + ALPHA) / (sum(total) + ALPHA * n) for x in total]
    whole = "array(" + ", ".join(f"{x!r}D" for x in base) + ")"
    each = "array(" + ", ".join(f"{x!r}D" for x in total) + ")"
    parents = _counts(rows, "parent", n).withColumn(
        "parent_p", F.expr(f"transform(zip_with(parent_n, {whole}, (x, p) -> x + {KAPPA}D * p), x -> x / ({_sum('parent_n')} + {KAPPA}D))")
    )
    hosts = _counts(rows, "host", n)
    owner = rows.where("host IS NOT NULL").groupBy("host").agg(F.min("parent").alias("parent"))
    hosts = hosts.join(owner, "host").join(parents, "parent").select(
        "host",
        F.expr(f"transform(zip_with(host_n, parent_p, (x, p) -> x + {KAPPA}D * p), x -> ln(x / ({_sum('host_n')} + {KAPPA}D)))").alias("prior"),
    )
    joined = rows.join(hosts, "host", "left")
    parts = [f"coalesce(prior, transform({whole}, x -> ln(x)))"]
    for by in ("declared", "suffix"):
        # P(value | language): the value's rows of that language, smoothed by
        # the value's share of all rows
        counted = _counts(rows, by, n)
        share = f"({_sum(f'{by}_n')} / {max(sum(total), 1.0)!r}D)"
        shown = counted.select(
            by,
            F.expr(f"zip_with({by}_n, {each}, (x, t) -> ln((x + {KAPPA}D * {share}) / (t + {KAPPA}D)))").alias(f"{by}_e"),
        )
        joined = joined.join(shown, by, "left")
        parts.append(f"coalesce({by}_e, array_repeat(0D, {n}))")
    score = "evidence"
    for part in parts:
        score = f"zip_with({score}, {part}, (a, b) -> a + b)"
    scored = joined.withColumn("score", F.expr(score))
    scaled = scored.withColumn("scaled", F.expr("transform(score, x -> exp(x - array_max(score)))"))
    return scaled.withColumn("posterior", F.expr(f"transform(scaled, x -> x / {_sum('scaled')})"))


def identify(
    frame: DataFrame,
    label: str,
    level: float,
    key: str = "doc_id",
    text: str = "text",
    declared: str | None = None,
    address: str | None = None,
) -> DataFrame:
    """``key, language, confidence, n_trigrams, kept`` per row.

    ``label`` is the column to fit the text model on; ``declared`` and
    ``address`` (an address or a host) are evidence."""
    languages, table = fit(frame, text, label)
    host, parent, suffix = host_parts(F.col(address) if address else F.lit(None).cast("string"))
    shown = language_tag(F.col(declared)) if declared else F.lit(None).cast("string")
    texts = frame.select(
        F.col(key).alias("key"), shown.alias("declared"), host.alias("host"), parent.alias("parent"),
        suffix.alias("suffix"), F.col(text).alias("text"),
    )
    rows = materialize(text_evidence(texts, table), "evidence")
    if not languages:
        und = (F.lit("und").alias("language"), F.lit(0.0).alias("confidence"))
        return rows.select(F.col("key").alias(key), *und, "n_trigrams", F.lit(False).alias("kept"))
    names = F.array(*(F.lit(x) for x in languages))
    found = fuse(rows, languages).withColumn("confidence", F.array_max("posterior"))
    kept = (F.col("n_trigrams") > 0) & (F.col("confidence") >= level)
    named = F.element_at(names, F.array_position("posterior", F.col("confidence")).cast("int"))
    return found.select(
        F.col("key").alias(key),
        F.when(kept, named).otherwise("und").alias("language"),
        "confidence",
        "n_trigrams",
        kept.alias("kept"),
    )
