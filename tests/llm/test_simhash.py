"""SimHash near-dedup against a plain all-pairs version."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from nodecast.llm import simhash
from nodecast.llm.graph import components
from nodecast.llm.queries import QUERIES


def plain_print(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(edges, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_groups(rows, bits=2):
    prints = {i: plain_print(t) for i, t in rows}
    ids = list(prints)
    close = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[i + 1 :]
        if (prints[a] ^ prints[b]).bit_count() <= bits
    ]
    found = plain_components(close, ids)
    return {i: (f"{prints[i]:016x}", found[i]) for i in ids}


@pytest.mark.parametrize("block", [1 << 18, 7])
def test_fingerprints(monkeypatch, block):
    monkeypatch.setattr(simhash, "WORDS_AT_ONCE", block)
    rnd = random.Random(3)
    texts = ["", " \t ", "One", "a b", "a b c", "É é\x1cx\x0by z", "same " * 900]
    texts += [" ".join(rnd.choice("abcdefg") * rnd.randint(1, 3) for _ in range(n)) for n in range(1, 60)]
    for text in texts:
        assert simhash.fingerprint(text, 3) == plain_print(text), text[:50]


def test_links_join_all_close_fingerprints(spark):
    """Random values, a chain of steps, and a dense group that overflows the paired chains."""
    rnd = random.Random(5)
    values = {rnd.getrandbits(64) for _ in range(400)}
    for _ in range(6):
        at = rnd.getrandbits(64)
        for _ in range(20):
            values.add(at)
            at ^= 1 << rnd.randrange(64)
            at ^= 1 << rnd.randrange(64)
    middle = rnd.getrandbits(64)
    for _ in range(300):
        values.add(middle ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed] * 2, "print long")
    for bits in (0, 1, 2):
        found = [(r.a, r.b) for r in simhash.links(frame, bits).collect()]
        assert all(0 < ((a ^ b) & (1 << 64) - 1).bit_count() <= bits for a, b in found)
        close = [
            (a, b)
            for i, a in enumerate(signed)
            for b in signed[i + 1 :]
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits
        ]
        assert plain_components(found, signed) == plain_components(close, signed)
    with pytest.raises(ValueError):
        simhash.links(frame, 3)


def test_components(spark):
    rnd = random.Random(9)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    loose = [(rnd.randrange(2000, 2300), rnd.randrange(2000, 2300)) for _ in range(150)]
    edges = path + star + loose + loose[:9] + [(7, 7)]
    frame = spark.createDataFrame(edges + [(None, 3)], "x long, y long")
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    wanted = plain_components([e for e in edges if e[0] != e[1]], nodes)
    found = components(frame).collect()
    assert len(found) == len(wanted) and dict(map(tuple, found)) == wanted
    assert components(frame.limit(0)).collect() == []


def test_rows_nulls_repeats_and_clashing_names(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(5, base), (3, base + " end"), (9, base), (9, base), (1, None), (2, ""), (4, " \n"), (8, "other words here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("print", F.lit("x"))
    frame = frame.withColumn("component_id", F.lit(None).cast("string"))
    found = sorted(map(tuple, simhash.near_duplicates(frame, 3, 2).collect()))
    wanted = plain_groups(dict(rows).items())
    assert found == sorted((i, *wanted[i]) for i, _ in rows)
    assert simhash.near_duplicates(frame.limit(0), 3, 2).collect() == []


def test_query_on_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash_near_dedup"](spark, folder).collect()}
    assert found == plain_groups(rows)
