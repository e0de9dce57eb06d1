"""BPE against the library that owns the file format."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from nodecast.llm import bpe_codec, token_counts
from nodecast.llm.wordbpe import WordBpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = (
    "aaabbbcdeéèñßÉÀİıΣςſĸŉ'́ \t\n\x0b\x1c\x1f\x85\xa0 ​　﻿12²½Ⅷ٣"
    "<|>endoftext!%&$.,;ABC世界🎉İẞﬁK"
)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(7)
    found = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 70))) for _ in range(1500)]
    return found + [
        "",
        " \n ",
        "<|endoftext|>a<|startoftext|><|endoftext|",
        "don't we'll 's's ''s!'s",
        "a" * 3000,
        "word " * 20000,
    ]


def test_ids_and_text_equal_the_library(library, texts):
    bpe = WordBpe(PATH)
    for text, ids in zip(texts, bpe_codec.encode_texts(bpe, texts), strict=True):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == wanted, text
        assert bpe.decode(ids) == library.decode(wanted, skip_special_tokens=False)


def both(bpe, library, texts):
    """Ids and counts here, and the library's ids."""
    whole = token_counts.proven(bpe)
    for at in range(0, len(texts), 20_000):
        part = texts[at : at + 20_000]
        wanted = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        ids = [i.tolist() for i in bpe_codec.encode_texts(bpe, part)]
        assert [t for t, a, b in zip(part, ids, wanted) if a != b] == []
        assert token_counts.count_texts(bpe, whole, part) == [len(w) for w in wanted]


def test_every_code_point(library):
    # private and unassigned planes are alike throughout; the first of each are there
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x33500 or 0xE0000 <= c < 0xE1000 or c % 4099 == 0)]
    both(WordBpe(PATH), library, [f"a{chr(c)}b" for c in points])


def test_mixes_of_special_strings(library):
    rnd = random.Random(11)
    special = ["<|endoftext|>", "<|startoftext|>"]
    pieces = [*special, *(s.upper() for s in special), "<|EndOfText|>", "<|endoftext", "|>", "<|", " ", "a", "Été", "\n", "1", "!"]
    both(WordBpe(PATH), library, ["".join(rnd.choices(pieces, k=rnd.randint(1, 6))) for _ in range(30_000)])


def test_counts_equal_the_library(library, texts):
    bpe = WordBpe(PATH)
    counts = token_counts.count_texts(bpe, token_counts.proven(bpe), texts)
    assert counts == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_proven_strings_are_single_tokens(library):
    whole = token_counts.proven(WordBpe(PATH))
    assert len(whole) > 30_000
    for word in random.Random(1).sample(sorted(whole), 500):
        assert len(library.encode(word, add_special_tokens=False).ids) == 1


def test_frames_nulls_repeats_and_clashing_names(spark, library):
    rows = [(1, "Été <|endoftext|>", "x"), (1, "Été <|endoftext|>", "y"), (2, None, "z"), (3, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = sorted(map(tuple, bpe_codec.digests(frame, PATH).collect()))
    ids = library.encode("Été <|endoftext|>", add_special_tokens=False).ids
    packed = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    text = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    nothing = hashlib.sha256(b"").hexdigest()
    assert found == [
        (1, len(ids), packed, text),
        (1, len(ids), packed, text),
        (2, 0, nothing, nothing),
        (3, 0, nothing, nothing),
    ]
    back = bpe_codec.decode(bpe_codec.encode(frame, PATH), PATH)
    assert {r.text for r in back.where("doc_id = 1").collect()} == {
        library.decode(ids, skip_special_tokens=False)
    }
    counts = token_counts.count_tokens(frame.withColumn("n_tokens", frame.text), PATH, 3)
    assert sorted(map(tuple, counts.collect())) == [
        (1, 19, len(ids), len(ids) > 3),
        (1, 19, len(ids), len(ids) > 3),
        (2, 0, 0, False),
        (3, 0, 0, False),
    ]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_codec.digests(frame, PATH).collect() == []
    assert token_counts.count_tokens(frame, PATH, 3).collect() == []
