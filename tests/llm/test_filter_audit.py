"""The filter audit against filters applied one after the other."""

import random
from fractions import Fraction
from itertools import permutations
from math import factorial

from pyspark.sql import functions as F

from nodecast.llm import filter_audit as fa


def walk(documents, labels):
    """Each order applied to each part, document by document."""
    first, good, toxic = {}, set(), set()
    for i, text, _ in documents:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, q, t in labels:
        if i is not None:
            good |= {i} if q == 1 else set()
            toxic |= {i} if t == 1 else set()
    parts = {}
    for i, text, part in documents:
        raw = (text or "").encode()
        fails = {f for k, f in enumerate("ABCD") if fa.own_failures(raw, len(text or "")) >> k & 1}
        if i is not None and first[text or ""] < i:
            fails.add("E")
        parts.setdefault(part or "", []).append((i, fails))
    rows = []
    for part, held in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            left = held
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                redundant = sum(name in d[1] for d in held) - len(gone)
                unique = sum(d[1] == {name} for d in held)
                lost = [sum(d[0] in marks for d in gone) for marks in (good, toxic)]
                total[name] += len(gone)
                found.append((part, "".join(order), step, len(left), len(gone), redundant, unique, *lost, name))
        rows += [(*r[:-1], total[r[-1]]) for r in found]
    return sorted(rows)


def frames(spark, documents, labels):
    docs = spark.createDataFrame(documents, "doc_id long, text string, source string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs.withColumn("n", F.lit("x")).withColumn("part", F.lit(1)), marks.withColumn("text", F.lit(0))


def test_every_order_equals_filters_in_turn(spark):
    rnd = random.Random(3)
    words = ["one", "Two", "THREE", "fo#ur", "five six", "é", "ß%"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([0, 5, 49, 50, 60]))) for _ in range(30)]
    texts += [" ".join(f"w{i}" for i in range(n)) for n in (49, 50, 20_000)]
    texts += [" ".join([f"w{i}" for i in range(65)] + ["w0"] * 35), " ".join([f"w{i}" for i in range(64)] + ["w0"] * 36)]
    texts += [None, "", "A" * 5 + "a" * 95, "A" * 6 + "a" * 94, "É" * 50]
    documents = [(rnd.randrange(60), rnd.choice(texts), rnd.choice(["a", "a", "b", "", None])) for _ in range(200)]
    documents += [(None, texts[0], "a"), (None, texts[0], "b"), (7, texts[1], "a"), (7, texts[1], "a"), (-3, "", "c")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 60, 2)] + [(4, 1, 1), (None, 1, 1)]
    found = sorted(map(tuple, fa.audit(*frames(spark, documents, labels)).collect()))
    assert found == walk(documents, labels)


def test_a_hot_text_in_one_part(spark):
    documents = [(i, "same text", "hot") for i in range(3000)] + [(i, f"text {i}", "rest") for i in range(3000, 3100)]
    found = {(r.part, r.filter_order, r.step): r for r in fa.audit(*frames(spark, documents, [])).collect()}
    assert found["hot", "EABCD", 1].removed == 2999 and found["hot", "EABCD", 2].kept == 0
    assert found["rest", "EABCD", 1].removed == 0 and len(found) == 1200


def test_empty_tables(spark):
    assert fa.audit(*frames(spark, [], [])).collect() == []
    found = fa.audit(*frames(spark, [(1, "a", None)], [])).collect()
    assert len(found) == 600 and {r.part for r in found} == {""} and sum(r.good_lost + r.toxic_lost for r in found) == 0


def test_weights_are_sums_over_orders():
    for n in range(1, 6):
        rnd = random.Random(n)
        value = [0] + [rnd.randrange(1000) for _ in range((1 << n) - 1)]
        sums = [0] * n
        for order in permutations(range(n)):
            before = 0
            for i in order:
                sums[i] += value[before | 1 << i] - value[before]
                before |= 1 << i
        weights = fa.shapley_weights(n)
        assert [sum(w * v for w, v in zip(row, value)) for row in weights] == sums
        assert sum(sums) == factorial(n) * value[-1]


def test_rational_elimination():
    matrix = [[Fraction(0), Fraction(2)], [Fraction(3), Fraction(1)]]
    assert fa.solve(matrix, [[Fraction(4)], [Fraction(5)]]) == [[Fraction(1)], [Fraction(2)]]


def test_bounds_of_the_filters():
    text = lambda n, d: " ".join([f"w{i}" for i in range(d)] + ["w0"] * (n - d)).encode()
    fails = lambda raw: fa.own_failures(raw, len(raw.decode()))
    assert fails(text(50, 50)) == 0 and fails(text(49, 49)) == 1
    assert fails(text(100, 65)) == 0 and fails(text(100, 64)) == 2
    assert fails(b"") == 1 and fails(text(60, 60) + b"|") == 8
    assert fails(text(60, 60) + "É".encode() * 40) == 0
    assert fails(text(60, 60) + b"\x0bA" * 50) == 2 | 4  # a vertical tab ends a word
