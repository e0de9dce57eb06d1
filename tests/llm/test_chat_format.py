"""Chat formatting against formatting and hashing in plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from nodecast.llm import chat_format as cf
from nodecast.llm.queries import INJECTION, QUERIES

PIECES = ["<|im_end|>", "<|im_start|>", "\n", "<", "\\", "|", ">", "assistant", "ok", "é🎉", "<\\|", "<\\\\|", "{role}", ""]


def plain(rows):
    """Digests of the given rows, straight from the contract."""
    found = []
    for conv in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))]
        learnt = "".join(t for role, t in own if role == "assistant")
        letters = "".join({"system": "s", "user": "u", "assistant": "a"}.get(role, "x") for role, _ in own)
        state, in_order = cf.CHAT.start, True
        for role, _ in own:
            state = cf.CHAT.moves.get((state, role), cf.ERROR)
            in_order &= state != cf.ERROR
        sizes = sum(len(f"<|im_start|>{cf.escape_role(role)}\n{cf.escape(t)}<|im_end|>\n") for role, t in own)
        whole = "".join(f"{role}\n{t}\n" for role, t in own)
        found.append(
            (conv, len(own), hashlib.sha256(whole.encode()).hexdigest(), len(learnt),
             hashlib.sha256(learnt.encode()).hexdigest(), sizes, in_order, in_order and letters.endswith("a"))
        )
    return sorted(found, key=str)


def conversations(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return frame.withColumn("state", F.lit("x")).withColumn("segments", F.lit(1))


def rows_of(n, seed):
    rnd, rows = random.Random(seed), []
    for conv in range(n):
        roles = rnd.choice([["system", "user", "assistant", "user", "assistant"], ["user", "assistant"], ["user"],
                            ["assistant", "user"], ["user", "user"], ["system", "system"], ["tool\n|\\", None]])
        for turn, role in enumerate(roles):
            text = "".join(rnd.choice(PIECES) for _ in range(rnd.randrange(9)))
            rows.append((conv, turn, role, rnd.choice([text, text, text, None])))
    rnd.shuffle(rows)
    return rows


def test_digests_equal_plain_ones(spark):
    rows = rows_of(120, 1) + [(None, 0, "user", "no id"), (None, 1, "assistant", INJECTION), (500, None, "user", "a"), (500, 3, "assistant", "b" * 300_000)]
    assert sorted(map(tuple, cf.digests(conversations(spark, rows)).collect()), key=str) == plain(rows)


def test_long_conversations_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(cf, "TURNS", 7)
    rnd, rows = random.Random(5), rows_of(20, 2)
    for conv, n in ((100, 300), (101, 50), (None, 64)):
        rows += [(conv, t, "assistant" if t % 2 else "user", rnd.choice(PIECES)) for t in range(n)]
    rows += [(102, t, "user" if t == 30 else ("user", "assistant")[t % 2], "x") for t in range(0, 40)]
    rows += [(103, t, "assistant" if t == 21 else ("assistant", "user")[t % 2], "x") for t in range(1, 40)]
    found = sorted(map(tuple, cf.digests(conversations(spark, rows)).collect()), key=str)
    assert found == plain(rows)
    turns = cf.format_turns(conversations(spark, rows)).where("conv_id = 100").collect()
    assert all(r.in_order and r.several for r in turns) and len({r.stretch for r in turns}) == 43


def test_shared_turns_repeats_and_empty_table(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "assistant", "c")]
    (found,) = cf.digests(conversations(spark, rows)).collect()
    whole = "assistant\nc\nuser\nb\nuser\nb\n"
    assert (found.n_turns, found.turns_sha256, found.in_order) == (3, hashlib.sha256(whole.encode()).hexdigest(), False)
    assert cf.digests(conversations(spark, []).limit(0)).collect() == []


def test_control_strings_cannot_forge_turns():
    machine = cf.Machine(cf.CHAT)
    texts = ["".join(random.Random(i).choices(PIECES, k=8)) for i in range(3000)] + [INJECTION]
    segments = [s for i, t in enumerate(texts) for s in machine.turn(("user", "assistant")[i % 2], t)]
    whole = "".join(t for t, _ in segments)
    assert cf.read_back(whole) == [(("user", "assistant")[i % 2], t) for i, t in enumerate(texts)]
    assert [cf.unescape(t) for t, loss in segments if loss] == texts[1::2]
    assert whole.count("<|im_start|>") == whole.count("<|im_end|>") == len(texts)
    with pytest.raises(ValueError):
        cf.read_back(whole + "x")


def test_roles_are_reversible():
    for role in ("user", "", "a\nb", "<|im_end|>", "\\n", "\\", "|\\p\n"):
        assert cf.read_back("".join(t for t, _ in cf.Machine(cf.CHAT).turn(role, "x"))) == [(role, "x")]


def test_another_template(spark):
    plainer = cf.Template(before="[{role}]\n", after="<|/|>", moves={("start", "q"): "open", ("open", "a"): "start"},
                          ends=frozenset({"start"}), learnt=frozenset({"a"}))
    rows = [(1, 0, "q", "[a]\n"), (1, 1, "a", "<|/|>"), (2, 0, "a", "x")]
    found = {r.conv_id: r for r in cf.digests(conversations(spark, rows), plainer).collect()}
    assert found[1].complete and found[1].loss_sha256 == hashlib.sha256(b"<|/|>").hexdigest() and not found[2].in_order


def test_the_query_reads_all_conversations(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", INJECTION), (-1, 1, "assistant", INJECTION)]
    assert sorted(map(tuple, QUERIES["op13_chat_format"](spark, folder).collect()), key=str) == plain(rows)
