"""Chat formatting by a finite-state machine over roles.

A template (``Template``) declares which role may follow which, what stands
before and after a turn's text, and which roles' texts are learnt from.  A
machine (``Machine``) walks over the turns of a conversation: its state is what
the template allows next, each turn moves it on and emits the turn's segments
(marks and text) with a loss flag each.  A turn that the state does not allow
leads to the error state, which is final; its segments are emitted all the same,
so no turn is lost, and ``in_order`` is false from there on.

Control strings inside texts are escaped reversibly: a backslash goes into every
``<|``, and one more into every ``<`` with backslashes before ``|``.  In a role,
backslash, line end and bar are escaped.  So marks occur only where the template
puts them, and ``read_back`` recovers roles, texts and loss text from the
formatted text alone.

Rows are ordered by turn (null first); rows that share a turn by role, a hash of
the text and the text.  A null role or text is empty; an empty role is one the
template does not know.  Rows without a conversation id are one conversation
without an id.  Repeated rows are repeated turns.  An empty table gives no rows.
Other columns are not read.

A conversation is cut into stretches of ``TURNS`` turn numbers, so that a very
long one is worked on by many tasks.  Only conversations of several stretches
need a pass over their roles before: each stretch is a function from the state
before to the state after it, small as the template; these are applied in
order, which gives the state every stretch starts in (``entry_states``).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from nodecast.llm.tasks import small_batches
from nodecast.session import materialize

TURNS = 1000
"""Turn numbers a stretch of a conversation spans."""


@dataclass(frozen=True)
class Template:
    """Marks around a turn, states and moves, and the roles that are learnt."""

    before: str = "<|im_start|>{role}\n"
    after: str = "<|im_end|>\n"
    start: str = "start"
    moves: dict = field(
        default_factory=lambda: {
            ("start", "system"): "instructed",
            ("start", "user"): "asked",
            ("instructed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    ends: frozenset = frozenset({"answered"})
    learnt: frozenset = frozenset({"assistant"})


CHAT = Template()
ERROR = "error"
CONTROL = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<(\\*)\\\|")
ROLE_CODES = {"\\": "\\\\", "\n": "\\n", "|": "\\p"}
ROLE_BACK = {"\\": "\\", "n": "\n", "p": "|"}


def escape(text: str) -> str:
    return CONTROL.sub(r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text) if "\\" in text else text


def escape_role(role: str) -> str:
    return "".join(ROLE_CODES.get(c, c) for c in role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: ROLE_BACK[m[1]], role)


class Machine:
    """The state over the turns of one conversation."""

    def __init__(self, template: Template, state: str | None = None):
        self.template, self.state = template, state or template.start

    def turn(self, role: str, text: str) -> list[tuple[str, bool]]:
        """Moves on and emits the segments of a turn: (formatted text, loss)."""
        own = self.template
        self.state = own.moves.get((self.state, role), ERROR)
        return [
            (own.before.format(role=escape_role(role)), False),
            (escape(text), role in own.learnt),
            (own.after, False),
        ]


def read_back(formatted: str, template: Template = CHAT) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted text."""
    head, tail = template.before.split("{role}")
    one = re.compile("(.*?)".join(map(re.escape, (head, tail, template.after))), re.DOTALL)
    turns, at = [], 0
    while at < len(formatted):
        found = one.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn begins at character {at}")
        turns.append((unescape_role(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def _stretches(conversations: DataFrame) -> DataFrame:
    """``conv_id, stretch, turn, role, mark, text`` of all rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    turn = F.col("turn").cast("long")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.floor(turn / TURNS), F.lit(-(2**60))).cast("long").alias("stretch"),
        turn.alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.xxhash64(text).alias("mark"),
        text.alias("text"),
    )


def entry_states(rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """``conv_id, stretch, entry``: the state in which each stretch of the
    conversations with several stretches starts.

    Reads roles only.  A task holds one stretch's state per possible start, then
    one state per conversation.
    """
    states = sorted({template.start, ERROR, *template.moves.values()})
    narrow = rows.select("conv_id", "stretch", "turn", "role", "mark")
    spans = narrow.groupBy("conv_id").agg(F.min("stretch").alias("first"), F.max("stretch").alias("last"))
    several = materialize(spans.where("first < last").select(F.col("conv_id").alias("id")), "several")
    long = narrow.join(several, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")
    dealt = long.repartition("conv_id", "stretch").sortWithinPartitions("conv_id", "stretch", "turn", "role", "mark")

    def functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ends = None, []

        def done():
            return pa.RecordBatch.from_pylist([{"conv_id": at[0], "stretch": at[1], "ends": ends}], schema)

        for batch in batches:
            for conv, stretch, role in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "stretch", "role"))):
                if at != (conv, stretch):
                    if at is not None:
                        yield done()
                    at, ends = (conv, stretch), states
                ends = [template.moves.get((state, role), ERROR) for state in ends]
        if at is not None:
            yield done()

    schema = pa.schema([("conv_id", pa.int64()), ("stretch", pa.int64()), ("ends", pa.list_(pa.string()))])
    mapped = dealt.mapInArrow(functions, "conv_id long, stretch long, ends array<string>")
    entry = pa.schema([("conv_id", pa.int64()), ("stretch", pa.int64()), ("entry", pa.string())])

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = ..., template.start
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["conv_id"] != at:
                    at, state = row["conv_id"], template.start
                found.append({"conv_id": at, "stretch": row["stretch"], "entry": state})
                state = row["ends"][states.index(state)]
            yield pa.RecordBatch.from_pylist(found, entry)

    ordered = mapped.repartition("conv_id").sortWithinPartitions("conv_id", "stretch")
    return ordered.mapInArrow(composed, "conv_id long, stretch long, entry string")


FORMATTED = (
    "conv_id long, stretch long, place long, several boolean, state string, in_order boolean,"
    " segments array<struct<text: string, loss: boolean>>"
)
"""Columns of ``format_turns``: a turn's place in its stretch, whether its
conversation has several stretches, the state after it and its segments."""


def format_turns(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per turn, with its formatted segments (``FORMATTED``).

    Partitions hold whole stretches, sorted by conversation, stretch and place;
    the texts are shuffled once.
    """
    spark = small_batches(conversations.sparkSession)
    rows = _stretches(conversations)
    entries = materialize(entry_states(rows, template), "entries").select(
        F.col("conv_id").alias("id"), F.col("stretch").alias("at"), "entry"
    )
    dealt = rows.repartition("conv_id", "stretch")
    known = dealt.join(entries, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("stretch") == F.col("at")), "left")
    ordered = known.select("conv_id", "stretch", "turn", "role", "mark", "text", "entry").sortWithinPartitions(
        "conv_id", "stretch", "turn", "role", "mark", "text"
    )
    arrow = pa.schema(
        [("conv_id", pa.int64()), ("stretch", pa.int64()), ("place", pa.int64()), ("several", pa.bool_()),
         ("state", pa.string()), ("in_order", pa.bool_()),
         ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())])))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, machine, place = None, None, 0
        for batch in batches:
            found = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "stretch", "role", "text", "entry"))
            for conv, stretch, role, text, entry in zip(*columns):
                if at != (conv, stretch):
                    at, machine, place = (conv, stretch), Machine(template, entry), 0
                segments = [{"text": t, "loss": loss} for t, loss in machine.turn(role, text)]
                found.append(
                    {"conv_id": conv, "stretch": stretch, "place": place, "several": entry is not None,
                     "state": machine.state, "in_order": machine.state != ERROR, "segments": segments}
                )
                place += 1
            yield pa.RecordBatch.from_pylist(found, arrow)

    return ordered.mapInArrow(run, FORMATTED)


class Digest:
    """Running digests of one conversation, read back from its formatted turns."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.learnt, self.formatted = conv_id, 0, 0, 0
        self.all, self.loss, self.state, self.in_order = hashlib.sha256(), hashlib.sha256(), "", True

    def add(self, segments: list[dict], state: str, in_order: bool, template: Template) -> None:
        whole = "".join(s["text"] for s in segments)
        for role, text in read_back(whole, template):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        for segment in segments:
            if segment["loss"]:
                learnt = unescape(segment["text"])
                self.loss.update(learnt.encode())
                self.learnt += len(learnt)
        self.formatted += len(whole)
        self.state, self.in_order = state, self.in_order and in_order

    def row(self, template: Template) -> dict:
        return {
            "conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.learnt, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.formatted,
            "in_order": self.in_order, "complete": self.in_order and self.state in template.ends,
        }


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long, in_order boolean, complete boolean"
)


def digests(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per conversation (``DIGESTS``), read back from the formatted turns.

    A conversation of one stretch is digested where it was formatted.  A digest
    runs over a conversation in order, so the turns of one with several
    stretches (formatted by many tasks) pass one more shuffle and then a task
    that keeps no more than the digest's state.
    """
    formatted = format_turns(conversations, template)
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    final = pa.schema(
        [(n, pa.string() if "sha" in n else pa.bool_() if n in ("in_order", "complete") else pa.int64()) for n in names]
    )
    turn = [("stretch", pa.int64()), ("place", pa.int64()), ("state", pa.string()), ("turn_in_order", pa.bool_()),
            ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())])))]
    mixed = pa.schema([*final, *(pa.field(n, t) for n, t in turn)])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["several"]:
                    found.append(
                        {"conv_id": row["conv_id"], "stretch": row["stretch"], "place": row["place"],
                         "state": row["state"], "turn_in_order": row["in_order"], "segments": row["segments"]}
                    )
                    continue
                if digest is None or digest.conv_id != row["conv_id"]:
                    if digest is not None:
                        found.append(digest.row(template))
                    digest = Digest(row["conv_id"])
                digest.add(row["segments"], row["state"], row["in_order"], template)
            yield pa.RecordBatch.from_pylist(found, mixed)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([digest.row(template)], mixed)

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["segments"] is None:
                    found.append(row)
                    continue
                if digest is None or digest.conv_id != row["conv_id"]:
                    if digest is not None:
                        found.append(digest.row(template))
                    digest = Digest(row["conv_id"])
                digest.add(row["segments"], row["state"], row["turn_in_order"], template)
            yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in found], final)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([digest.row(template)], final)

    types = DIGESTS + (
        ", stretch long, place long, state string, turn_in_order boolean,"
        " segments array<struct<text: string, loss: boolean>>"
    )
    partly = formatted.mapInArrow(near, types)
    ordered = partly.repartition("conv_id").sortWithinPartitions("conv_id", "stretch", "place")
    return ordered.mapInArrow(far, DIGESTS)
