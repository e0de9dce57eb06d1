"""BPE encoding and decoding by a pair occurrence index.

Texts are encoded exactly as the public tokenizers library does with the same
file, without added special tokens; decoding joins the token strings.  Each
task gathers texts up to ``CHARACTERS`` and encodes their distinct words in one
index (``wordbpe``), so nothing is shuffled and memory is bounded by that
number, or by the longest single text.

Null and empty texts give no tokens.  Repeated rows give repeated rows.  Other
columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from nodecast.llm.tasks import small_batches, text_groups
from nodecast.llm.wordbpe import Batch, WordBpe, gather

CHARACTERS = 5_000_000


def encode_texts(bpe: WordBpe, texts: list[str]) -> list[np.ndarray]:
    """The ids of each text."""
    batch = Batch(bpe, texts)
    ids, offsets = bpe.encode_words(batch.words)
    flat, ends = gather(ids, offsets[:-1], np.diff(offsets), batch.piece_words)
    borders = ends[batch.piece_offsets]
    starts, sizes = borders[:-1], np.diff(borders)
    return [gather(flat, starts, sizes, pieces)[0].astype(np.int32) for pieces in batch.texts]


def _map(frame: DataFrame, key: str, text: str, path: str, fields: list, row) -> DataFrame:
    """One output row ``row(bpe, ids)`` per text, after its key."""
    spark = small_batches(frame.sparkSession)
    shared = spark.sparkContext.broadcast(WordBpe(path))  # bounded by the vocabulary file
    narrow = frame.select(F.col(key), F.col(text))
    schema = T.StructType([narrow.schema[0], *(T.StructField(n, t) for n, t in fields)])
    arrow = pa.schema([pa.field(key, pa.int64()), *((n, ARROW[type(t)](t)) for n, t in fields)])
    names = arrow.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for keys, texts in text_groups(batches, CHARACTERS):
            encoded = encode_texts(bpe, texts)
            del texts
            for i in range(0, len(keys), 256):
                rows = [row(bpe, ids) for ids in encoded[i : i + 256]]
                columns = [keys[i : i + 256], *(list(c) for c in zip(*rows))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow)], names
                )

    return narrow.mapInArrow(run, schema)


ARROW = {
    T.LongType: lambda _: pa.int64(),
    T.StringType: lambda _: pa.string(),
    T.ArrayType: lambda _: pa.list_(pa.int32()),
}


def encode(frame: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids`` (array of token ids) of each row; ``key`` is a long."""
    return _map(frame, key, text, path, [("ids", T.ArrayType(T.IntegerType()))], lambda _, ids: (ids,))


def decode(frame: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text`` from arrays of token ids; null ids give an empty text."""
    spark = small_batches(frame.sparkSession)
    shared = spark.sparkContext.broadcast(WordBpe(path))
    narrow = frame.select(F.col(key), F.col(ids))
    schema = T.StructType([narrow.schema[0], T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            texts = [
                shared.value.decode(np.array(x or [], dtype=np.int64))
                for x in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], [key, "text"]
            )

    return narrow.mapInArrow(run, schema)


def digests(frame: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256``: encode and decode each
    text in one pass and keep digests of the ids (little-endian unsigned 32-bit)
    and of the decoded text (UTF-8)."""

    def row(bpe: WordBpe, ids: np.ndarray):
        decoded = bpe.decode(ids).encode("utf-8")
        packed = ids.astype("<u4").tobytes()
        return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()

    fields = [
        ("n_tokens", T.LongType()),
        ("ids_sha256", T.StringType()),
        ("decoded_sha256", T.StringType()),
    ]
    return _map(frame, key, text, path, fields, row)
