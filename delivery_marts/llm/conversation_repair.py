"""Repair of conversation structure: the cheapest edits that make roles alternate.

A conversation is to read ``(s?(ua)+)?`` by the first letters of its roles. Every turn is kept (cost
0), given the other role (2) or deleted (3), and empty turns may be inserted anywhere (2). Blank
turns, and turns whose role and text were there before, have to be deleted; a turn that ends without
``.``, ``!`` or ``?`` costs one more if it stays.

All choices are made by one comparison of integers. A weight is a cost in the high digits and, below
them, the letters of the edits that follow (D, I, K, R as the octal digits 1 to 4) at fixed places
from the left, with zeros after the last, so that a smaller integer is a cheaper repair or, at equal
cost, one whose letters come first in ASCII. The weights are the shortest paths of an acyclic graph
(turn, what has been said so far), taken from the last turn to the first: an edit shifts the letters
one place to the right and adds its own on top. Between two turns one insertion is enough, as two
in a row could both be left out, so two places a turn hold every candidate.

Long conversations are taken in blocks of ``BLOCK`` turns, so integers stay short. At the border of a
block the letters of the four states behind it are replaced by their order, as one digit: edits up
to a border use up the same turns and end with one of them, so none is the beginning of another and
comparing them first, then the order, compares the whole.

Turns are brought together by conv_id and streamed in order, with digests of their texts; a task
holds a byte a turn and the letters of the conversation it is at. ``repaired`` then streams the texts
past the letters. A conversation of a third of all rows is one task's work, in bounded memory but
for those letters, which are one value of the result anyway.

Defined results: NULL roles and texts are one space; turns go by number, NULL first, then by role and
by SHA-256 of the text; NULL conv_ids are one conversation; a role's kind is its first character, and
an empty role has none; turns equal in role and text differ in place only, the first one stays; gaps
beyond a long are the largest long; no rows give no conversations. Other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 512
ROWS = 1024  # rows of a batch given back
WHITE = " \t\n\x0b\x0c\r"

SYSTEM, USER, ASSISTANT, OTHER = range(4)  # what a role begins with
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)  # first fault
EMPTY, OPENED, ASKED, ANSWERED = range(4)  # what has been said: nothing, system, user, a whole pair
WANTED = (USER, USER, ASSISTANT, USER)
NEXT = (ASKED, ASKED, ANSWERED, ASKED)
NAMES = ("system", "user", "assistant")
LETTERS = " DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
ABSENT = object()

AUDITS = (
    "conv_id long, turns long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string"
)
TURNS = "conv_id long, place long, edit string, role string, text string"


class Weights:
    """Costs and letters of one block as integers of a fixed number of places."""

    def __init__(self, turns: int):
        self.places = 2 * turns + 2
        self.top = 3 * (self.places - 1)
        self.unit = 1 << 3 * self.places

    def of(self, cost: int, first: int) -> int:
        return cost * self.unit + (first << self.top)

    def cost(self, weight: int) -> int:
        return weight // self.unit

    def letters(self, weight: int) -> int:
        return weight % self.unit

    def edit(self, weight: int, letter: int, cost: int) -> int:
        """The weight with one more edit before the others."""
        high, low = divmod(weight, self.unit)
        return (high + cost) * self.unit + (letter << self.top) + (low >> 3)

    def digits(self, weight: int) -> str:
        return f"{self.letters(weight):0{self.places}o}".rstrip("0")


def _inserted(w: Weights, values: list[int | None]) -> list[int | None]:
    """The states' weights with an insertion before the next turn, where that is smaller."""
    found = []
    for state, plain in enumerate(values):
        after = values[NEXT[state]]
        options = [plain] if plain is not None else []
        if after is not None:
            options.append(w.edit(after, INSERT, 2))
        found.append(min(options, default=None))
    return found


def _before(w: Weights, code: int, values: list[int | None]) -> list[int | None]:
    """The states' weights before one turn, from those after it."""
    kind, fault = divmod(code, 4)
    found = []
    for state in range(4):
        options = []
        if values[state] is not None:
            options.append(w.edit(values[state], DELETE, 3))
        if fault in (FINE, TRUNCATED):
            extra = int(fault == TRUNCATED)
            after = values[NEXT[state]]
            if after is not None and kind == WANTED[state]:
                options.append(w.edit(after, KEEP, extra))
            elif after is not None:
                options.append(w.edit(after, REROLE, 2 + extra))
            if state == EMPTY and kind == SYSTEM and values[OPENED] is not None:
                options.append(w.edit(values[OPENED], KEEP, extra))
        found.append(min(options, default=None))
    return _inserted(w, found)


def cheapest(codes: bytes, block: int | None = None) -> tuple[int, str]:
    """Cost and letters of the repair of turns given as ``4 * kind + fault``."""
    block = block or BLOCK
    starts = range(0, len(codes), block)
    ends: list[tuple[int, int] | None] = [(0, 0), None, None, (0, 0)]  # cost, order; the end is a whole repair
    steps: list[tuple[list[str | None], list[int]]] = []
    cost = 0
    for start in reversed(starts):
        part = codes[start : start + block]
        w = Weights(len(part))
        values = [None if end is None else w.of(*end) for end in ends]
        if not steps:
            values = _inserted(w, values)
        for code in reversed(part):
            values = _before(w, code, values)
        followed = [0] * 5
        for state, end in enumerate(ends):
            if end is not None:
                followed[end[1]] = state
        steps.append(([None if v is None else w.digits(v) for v in values], followed))
        order = {low: i + 1 for i, low in enumerate(sorted({w.letters(v) for v in values if v is not None}))}
        ends = [None if v is None else (w.cost(v), order[w.letters(v)]) for v in values]
        cost = w.cost(values[EMPTY])
    state, audit = EMPTY, []
    for place, (digits, followed) in enumerate(reversed(steps)):
        found = digits[state]
        if place < len(steps) - 1:
            found, state = found[:-1], followed[int(found[-1])]
        audit.append(found)
    return cost, "".join(audit).translate(str.maketrans("1234", LETTERS[1:]))


class Conversation:
    """What a task keeps of the conversation it is at."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.codes = bytearray()
        self.first = self.last = None
        self.numbers = self.illegal = 0

    def add(self, turn: int | None, code: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.numbers += 1
        if self.codes and (self.codes[-1] // 4, code // 4) not in LEGAL:
            self.illegal += 1
        self.codes.append(code)

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.numbers
        faults = [code % 4 for code in self.codes]
        cost, audit = cheapest(bytes(self.codes))
        return (
            self.conv_id, len(self.codes), min(gaps, (1 << 63) - 1),
            faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED),
            self.illegal, cost, audit,
        )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    types = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, types[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, rows, at = _arrow(AUDITS), [], None
    for batch in batches:
        for conv_id, turn, code in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "code")), strict=True):
            if at is None or at.conv_id != conv_id:
                if at is not None:
                    rows.append(at.row())
                at = Conversation(conv_id)
            at.add(turn, code)
        if len(rows) >= ROWS:
            yield _batch(rows, schema)
            rows = []
    if at is not None:
        rows.append(at.row())
    yield _batch(rows, schema)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (NULL: one space) and digest of the rows that are to be repaired."""
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation of ``turns``: faults, and the cost and letters of the cheapest repair."""
    kind = F.lit(OTHER)
    for number, name in enumerate(NAMES):
        kind = F.when(F.substring("role", 1, 1) == name[0], number).otherwise(kind)
    said = F.rtrim(F.col("text"), F.lit(WHITE))
    ends = F.substring(said, -1, 1).isin(".", "!", "?")
    of_text = F.when(said == "", BLANK).when(ends, FINE).otherwise(TRUNCATED)
    # Texts stay behind: what is shuffled has one size a turn, but for the role.
    small = rows.select("conv_id", "turn", "role", "digest", kind.alias("kind"), of_text.alias("text_fault"))
    same = Window.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    repeated = (F.row_number().over(same) > 1) & (F.col("text_fault") != BLANK)
    fault = F.when(repeated, DUPLICATE).otherwise(F.col("text_fault"))
    coded = small.repartition("conv_id").withColumn("code", (F.col("kind") * 4 + fault).cast("bigint"))
    sorted_rows = coded.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest")
    return sorted_rows.select("conv_id", "turn", "code").mapInArrow(_audited, AUDITS)


class Rewriter:
    """Turns of one conversation after another, with their letters."""

    def __init__(self) -> None:
        self.conv_id, self.letters, self.at, self.state, self.place = None, "", 0, EMPTY, 0

    def _said(self, edit: str, role: str, text: str, state: int) -> tuple:
        self.state, self.place = state, self.place + 1
        return (self.conv_id, self.place - 1, edit, role, text)

    def inserted(self) -> Iterator[tuple]:
        while self.letters[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._said("I", NAMES[WANTED[self.state]], "", NEXT[self.state])

    def begin(self, conv_id: int | None, letters: str) -> None:
        self.conv_id, self.letters, self.at, self.state, self.place = conv_id, letters, 0, EMPTY, 0

    def turn(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.letters[self.at]
        self.at += 1
        if edit == "K":
            opens = self.state == EMPTY and role[:1] == "s"
            yield self._said("K", role, text, OPENED if opens else NEXT[self.state])
        elif edit == "R":
            yield self._said("R", NAMES[WANTED[self.state]], text, NEXT[self.state])


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, writer = _arrow(TURNS), Rewriter()
    for batch in batches:
        rows = []
        for conv_id, audit, role, text in zip(
            *(batch[c].to_pylist() for c in ("conv_id", "audit", "role", "text")), strict=True
        ):
            if audit is None:
                rows += writer.turn(role, text)
            else:
                rows += writer.inserted()
                writer.begin(conv_id, audit)
        yield _batch(rows, schema)
    yield _batch(list(writer.inserted()), schema)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The turns of every repaired conversation: conv_id, place (from 0), edit (K, R or I), role, text.

    ``found`` is what ``audits`` gives for ``rows``. A conversation's turns lie in one partition, in
    order.
    """
    texts = rows.withColumn("audit", F.lit(None).cast("string"))
    letters = found.select("conv_id", "audit")
    joined = texts.unionByName(letters, allowMissingColumns=True).repartition("conv_id")
    # The letters come before the turns they are of.
    ordered = joined.sortWithinPartitions(
        "conv_id", F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "digest"
    )
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(_rewritten, TURNS)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, at, sha = _arrow("conv_id long, repaired_sha256 string"), ABSENT, None
    for batch in batches:
        rows = []
        for conv_id, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if at is ABSENT or at != conv_id:
                if sha is not None:
                    rows.append((at, sha.hexdigest()))
                at, sha = conv_id, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        yield _batch(rows, schema)
    yield _batch([(at, sha.hexdigest())] if sha is not None else [], schema)


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text`` lines per conversation of ``repaired``; empty ones have no row."""
    return turns.select("conv_id", "role", "text").mapInArrow(_digested, "conv_id long, repaired_sha256 string")
