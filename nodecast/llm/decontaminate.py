"""Benchmark decontamination by a prefix-filtered set join.

Every item is cut into windows of ``window`` consecutive words (a shorter item
is one window).  A window is a set of word shingles with their places.  The
shingles are ordered by rarity, counted over all documents; a document that
holds the whole window must hold its rarest shingle, so that prefix alone is
joined.  The shingle's place bounds where the window can start and end; what is
left is compared word by word.  Windows with a shingle that no document holds
are dropped before the join.

All of it is DataFrame work.  The texts are read once to count the shingles and
once to find the prefixes; neither shuffles them while the shingles to count fit
``BROADCAST_TOKENS`` and the prefixes ``BROADCAST_ROWS``.  Beyond these the counts
are added up before they are joined; of the documents only key, place and token
go through the join with the prefixes, dealt over ``SALTS`` tasks a token, and the
words of the candidates are fetched by a second join.  Three tables are written:
the windows as the items give them, the prefixes and the hits (beyond the bound
the candidates too).  Shingles and names follow from the windows each time they
are asked for.

Null, empty and wordless texts have no words: as documents they are clean, as
items they match nothing.  Repeated documents each get their row; repeated
items count once; an item without an id marks words but is not counted.  Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from nodecast.llm.words import gram, n_words, words
from nodecast.session import materialize

SHINGLE = 5
BROADCAST_ROWS, BROADCAST_TOKENS = 500_000, 2_000_000
SALTS = 16


def _join_few(rows: DataFrame, few: DataFrame, n: int, on: str) -> DataFrame:
    """Rows of any number with a side of ``n`` rows, broadcast while these are
    few; beyond, the rows of one value are dealt over several tasks."""
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(few), on)
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).alias("salt")
    copies = F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt")
    return rows.select("*", salt).join(few.select("*", copies), [on, "salt"]).drop("salt")


def windows(items: DataFrame, window: int, item: str, text: str) -> DataFrame:
    """``item, phrase, length``: each window's words with one space between."""
    counted = items.select(F.col(item).alias("item"), words(F.col(text)).alias("words"))
    placed = counted.withColumn("n", F.size("words")).where("n > 0").select(
        "item",
        "words",
        F.least("n", F.lit(window)).alias("length"),
        F.explode(F.expr(f"sequence(0, greatest(n - {window}, 0))")).alias("start"),
    )
    phrase = F.array_join(F.expr("slice(words, start + 1, length)"), " ")
    return placed.select("item", phrase.alias("phrase"), "length")


def _shingles(phrases: DataFrame) -> DataFrame:
    """``phrase, length, size, offset, token`` for each shingle of a phrase."""
    split = phrases.select("phrase", "length", F.split("phrase", " ").alias("words"))
    placed = split.withColumn("size", F.least("length", F.lit(SHINGLE))).withColumn(
        "pos", F.explode(F.expr("sequence(0, length - size)"))
    )
    token = F.coalesce(*(F.when(F.col("size") == s, gram(s)) for s in range(SHINGLE, 0, -1)))
    return placed.select("phrase", "length", "size", F.col("pos").alias("offset"), token.alias("token"))


def _tokens(documents: DataFrame, sizes: list[int]) -> DataFrame:
    """All shingles of the given sizes with their places, beside the words."""
    left = F.size("words") - F.col("pos")
    placed = documents.withColumn("pos", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)))))
    every = F.array(*(F.when(left >= size, gram(size)) for size in sizes))
    return placed.withColumn("token", F.explode(every)).where("token IS NOT NULL")


def _counts(documents: DataFrame, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """``token, count``: how often the documents hold each token of the items."""
    wanted = shingles.select("token").distinct()
    seen = _tokens(documents.select("words"), sizes).select("token")
    if wanted.count() <= BROADCAST_TOKENS:
        return seen.join(F.broadcast(wanted), "token").groupBy("token").count()
    return seen.groupBy("token").count().join(wanted, "token", "left_semi")


def _rarest(shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """``token, offset, phrase, length``: the prefix of each window of which the
    documents hold all shingles."""
    least = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "token", "offset"))
    found = shingles.join(counts, "token", "left").groupBy("phrase", "length").agg(least.alias("t")).where("t.count > 0")
    return found.select(F.col("t.token").alias("token"), F.col("t.offset").alias("offset"), "phrase", "length")


def hits(documents: DataFrame, cut: DataFrame) -> DataFrame:
    """``key, mark, start, length, phrase``: every place where a window occurs.
    ``documents`` has the columns ``key, mark, words``; ``cut`` is what ``windows``
    gives, written."""
    shingles = _shingles(cut.select("phrase", "length").distinct())
    size = F.least("length", F.lit(SHINGLE))
    sizes = sorted(r[0] for r in cut.select(size).distinct().collect())  # at most SHINGLE
    columns = ["key", "mark", "start", "length", "phrase"]
    if not sizes:
        nothing = (F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("phrase"))
        return documents.select("key", "mark", *nothing).limit(0)
    rare = materialize(_rarest(shingles, _counts(documents, shingles, sizes)), "prefixes")
    n = rare.count()
    places = _tokens(documents, sizes)
    start = (F.col("pos") - F.col("offset")).alias("start")
    if n <= BROADCAST_ROWS:
        found = _join_few(places, rare, n, "token").select("*", start)
    else:
        narrow = _join_few(places.select("key", "mark", "pos", "token"), rare, n, "token")
        candidates = narrow.select("key", "mark", start, "length", "phrase").where("start >= 0").distinct()
        held = materialize(candidates, "candidates").withColumnsRenamed({"key": "held_key", "mark": "held_mark"})
        same_row = F.col("key").eqNullSafe(F.col("held_key")) & F.col("mark").eqNullSafe(F.col("held_mark"))
        found = documents.join(held, same_row)
    inside = found.where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.size("words")))
    same = F.array_join(F.expr("slice(words, start + 1, length)"), " ") == F.col("phrase")
    return inside.where(same).select(*columns)


def covered(spans: str) -> str:
    """SQL: how many words lie in a sorted array of (start, length)."""
    return (
        f"aggregate({spans}, named_struct('n', 0, 'upto', 0), (a, s) -> named_struct("
        "'n', a.n + greatest(0, s.start + s.length - greatest(a.upto, s.start)),"
        " 'upto', greatest(a.upto, s.start + s.length)), a -> a.n)"
    )


def contamination(
    documents: DataFrame,
    items: DataFrame,
    window: int,
    share: int,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``key, n_words, n_hit, n_items, items_sha256, contaminated`` per row.

    A document is contaminated if at least one word in ``share`` is hit."""
    mark = F.xxhash64(F.col(text)).alias("mark")  # tells rows that share a key apart
    rows = documents.select(F.col(key).alias("key"), mark, n_words(F.col(text)).alias("n_words"))
    texts = documents.select(F.col(key).alias("key"), mark, words(F.col(text)).alias("words"))
    cut = materialize(windows(items, window, item, item_text), "windows")
    places = materialize(hits(texts, cut), "hits")
    named = cut.select("phrase", F.col("item").cast("string")).distinct()
    by_document = places.groupBy("key", "mark")
    spans = by_document.agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"))
    phrases = places.select("key", "mark", "phrase").distinct()
    lists = (
        _join_few(phrases, named, named.count(), "phrase")
        .groupBy("key", "mark")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    marked = spans.select("key", "mark", F.expr(covered("spans")).cast("long").alias("n_hit"))
    joined = rows
    for side in (marked, lists):
        side = side.withColumnsRenamed({"key": "side_key", "mark": "side_mark"})
        same = F.col("key").eqNullSafe(F.col("side_key")) & (F.col("mark") == F.col("side_mark"))
        joined = joined.join(side, same, "left").drop("side_key", "side_mark")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        F.col("key").alias(key),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
