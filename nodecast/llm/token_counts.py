"""Token counts by the whole-token shortcut.

Before the job, the vocabulary strings that encode alone as exactly one token
are proven by encoding each of them (``proven``).  In the tasks a pre-token from
that set counts as one; only the rest goes through the merges.

Null and empty texts have no tokens.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from nodecast.llm.tasks import small_batches, text_groups
from nodecast.llm.wordbpe import Batch, WordBpe, byte_letters

CHARACTERS = 5_000_000


def proven(bpe: WordBpe) -> frozenset[str]:
    """Texts of vocabulary strings that are one pre-token and one token, and the
    special strings as pieces have them."""
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    candidates = []
    for token in bpe.vocab:
        if token.endswith(bpe.suffix) and token != bpe.suffix:
            raw = bytes(byte_of[c] for c in token[: -len(bpe.suffix)])
            try:
                word = raw.decode("utf-8")
            except UnicodeDecodeError:
                continue  # part of a letter: no pre-token equals it
            if bpe.pieces(word) == [word] and bpe.pre_tokens(word) == [word]:
                candidates.append(word)
    _, offsets = bpe.encode_words(candidates)
    single = np.diff(offsets) == 1
    return frozenset([*(w for w, one in zip(candidates, single) if one), *(" " + s for s in bpe.special)])


def count_texts(bpe: WordBpe, whole: frozenset[str], texts: list[str]) -> list[int]:
    batch = Batch(bpe, texts)
    rest = [i for i, word in enumerate(batch.words) if word not in whole]
    tokens = np.ones(len(batch.words), dtype=np.int64)
    _, offsets = bpe.encode_words([batch.words[i] for i in rest])
    tokens[rest] = np.diff(offsets)
    running = np.concatenate(([0], np.cumsum(tokens[batch.piece_words])))
    per_piece = np.diff(running[batch.piece_offsets])
    return [int(per_piece[pieces].sum()) for pieces in batch.texts]


def count_tokens(
    frame: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` per row; ``key`` is a long and
    ``over_limit`` says whether there are more than ``limit`` tokens."""
    spark = small_batches(frame.sparkSession)
    bpe = WordBpe(path)
    shared = spark.sparkContext.broadcast((bpe, proven(bpe)))  # bounded by the vocabulary file
    narrow = frame.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    long = T.LongType()
    schema = T.StructType(
        [narrow.schema[0], T.StructField("n_bytes", long), T.StructField("n_tokens", long)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, whole = shared.value
        for keys, texts in text_groups(batches, CHARACTERS):
            sizes = [len(t.encode("utf-8")) for t in texts]
            counts = count_texts(bpe, whole, texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (keys, sizes, counts)], schema.names
            )

    counted = narrow.mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
