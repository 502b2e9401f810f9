"""Chat formatting: layouts found by the hash of their field paths, turns in one template.

A record is a struct column that is wide enough for every layout; a row fills the fields of
its own. The nested paths that a row fills are sorted and hashed, and that fingerprint selects
a declared layout, which says how canonical turns (role, text) are read from the record. The
turns become one string, ``<|im_start|>role\\ntext<|im_end|>\\n`` each, with a loss mask over
the texts of assistants.

Escapes: in texts ``~`` becomes ``~0`` and ``<|`` becomes ``~1``, in roles also the end of line
becomes ``~2``; every ``~`` in the output is thus followed by its meaning, no control string can
come from a text, and ``parsed`` gives back exactly what went in.

Defined results: a NULL text or role is empty; a record whose fingerprint no layout has keeps
its row, with layout, turns, formatted and loss_runs NULL; a record without turns is formatted
to the empty string; equal records give equal rows; an empty table gives an empty one. Columns
named like the results are replaced. Whole texts are formatted, whatever their length.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


@dataclass(frozen=True)
class Fields:
    """One turn per field: (role, path), in order; ``optional`` paths may be missing."""

    name: str
    turns: Sequence[tuple[str, str]]
    optional: frozenset[str] = frozenset()

    def path_sets(self) -> list[set[str]]:
        return _subsets({path for _, path in self.turns}, self.optional)

    def read(self, record: Column) -> Column:
        turns = [
            F.when(_at(record, path).isNotNull() | F.lit(path not in self.optional), _turn(F.lit(role), _at(record, path)))
            for role, path in self.turns
        ]
        return F.filter(F.array(*turns), lambda turn: turn.isNotNull())


@dataclass(frozen=True)
class Messages:
    """One turn per element of an array of structs; ``roles`` renames roles."""

    name: str
    array: str
    role: str
    text: str
    roles: dict[str, str] = field(default_factory=dict)

    def path_sets(self) -> list[set[str]]:
        role, text = f"{self.array}[].{self.role}", f"{self.array}[].{self.text}"
        return [{role, text}, {role}, {text}]

    def read(self, record: Column) -> Column:
        def turn(message: Column) -> Column:
            role = message[self.role]
            for old, new in self.roles.items():
                role = F.when(message[self.role] == old, F.lit(new)).otherwise(role)
            return _turn(role, message[self.text])

        return F.transform(_at(record, self.array), turn)


LAYOUTS = (
    Fields("prompt", [("user", "prompt"), ("assistant", "response")]),
    Fields(
        "instruction",
        [("system", "instruction"), ("user", "input"), ("assistant", "output")],
        frozenset({"input"}),
    ),
    Messages("messages", "messages", "role", "content"),
    Messages("conversations", "conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
)


def _subsets(paths: set[str], optional: frozenset[str]) -> list[set[str]]:
    some = chain.from_iterable(combinations(sorted(optional), n) for n in range(len(optional) + 1))
    return [paths - set(left_out) for left_out in some]


def _at(record: Column, path: str) -> Column:
    for name in path.split("."):
        record = record[name]
    return record


def _turn(role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.struct(F.coalesce(role, empty).alias("role"), F.coalesce(text, empty).alias("text"))


def _has(name: str) -> Callable[[Column], Column]:
    return lambda element: element[name].isNotNull()


def _filled(kind: T.DataType, value: Column, path: str) -> list[tuple[str, Column]]:
    """Each nested path below a value, and whether the row fills it."""
    if isinstance(kind, T.StructType):
        below = [_filled(f.dataType, value[f.name], f"{path}.{f.name}" if path else f.name) for f in kind]
        return list(chain.from_iterable(below))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return [(f"{path}[].{f.name}", F.exists(value, _has(f.name))) for f in kind.elementType]
    if isinstance(kind, T.ArrayType):
        return [(f"{path}[]", F.exists(value, lambda x: x.isNotNull()))]
    return [(path, value.isNotNull())]


def fingerprint(df: DataFrame, record: str) -> Column:
    """The hash of the sorted nested paths that a row's record fills."""
    paths = sorted(_filled(df.schema[record].dataType, F.col(record), ""), key=lambda entry: entry[0])
    return F.xxhash64(F.concat_ws("\n", *[F.when(there, F.lit(path)) for path, there in paths]))


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("~1"))


def _unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~1"), F.lit("<|")), F.lit("~0"), F.lit("~"))


def _escaped_role(role: Column) -> Column:
    return F.replace(_escaped(role), F.lit("\n"), F.lit("~2"))


def _unescaped_role(role: Column) -> Column:
    return _unescaped(F.replace(role, F.lit("~2"), F.lit("\n")))


def with_turns(df: DataFrame, record: str, layouts: Sequence[Fields | Messages] = LAYOUTS) -> DataFrame:
    """The rows with ``layout`` and canonical ``turns`` of their record."""
    known = set(df.schema[record].dataType.names)
    usable = [x for x in layouts if {p.split("[")[0].split(".")[0] for s in x.path_sets() for p in s} <= known]
    found = df.withColumn("_fingerprint", fingerprint(df, record))
    nothing = F.lit(None).cast("array<struct<role:string,text:string>>")
    layout, turns = F.lit(None).cast("string"), nothing
    for one in usable:
        hashes = [F.xxhash64(F.lit("\n".join(sorted(paths)))) for paths in one.path_sets()]
        fits = F.col("_fingerprint").isin(hashes)
        layout = F.when(fits, F.lit(one.name)).otherwise(layout)
        turns = F.when(fits, one.read(F.col(record))).otherwise(turns)
    return found.withColumns({"layout": layout, "turns": turns}).drop("_fingerprint")


def formatted(df: DataFrame) -> DataFrame:
    """The rows with ``formatted`` and ``loss_runs`` made from ``turns``.

    ``loss_runs`` has three lengths per turn, in code points: how many to skip, how many are
    trained on, how many to skip after those. The lengths add up to the whole string.
    """

    def head(turn: Column) -> Column:
        return F.concat(F.lit(START), _escaped_role(turn["role"]), F.lit("\n"))

    def run(turn: Column) -> Column:
        skip, text, end = F.length(head(turn)), F.length(_escaped(turn["text"])), F.lit(len(END))
        trained = turn["role"] == TRAINED_ROLE
        return F.struct(
            F.when(trained, skip).otherwise(skip + text + end).alias("skip"),
            F.when(trained, text).otherwise(0).alias("keep"),
            F.when(trained, end).otherwise(0).alias("rest"),
        )

    turns = F.col("turns")
    segments = F.transform(turns, lambda t: F.concat(head(t), _escaped(t["text"]), F.lit(END)))
    return df.withColumns({"formatted": F.array_join(segments, ""), "loss_runs": F.transform(turns, run)})


def parsed(df: DataFrame) -> DataFrame:
    """The rows with ``read_turns`` and ``loss_texts`` read back from the formatted string."""
    ended = F.split("formatted", END.replace("|", "\\|"), -1)
    segments = F.slice(ended, 1, F.greatest(F.size(ended) - 1, F.lit(0)))

    def turn(segment: Column) -> Column:
        body = F.substring(segment, len(START) + 1, 1 << 30)
        line = F.instr(body, "\n")
        return F.struct(
            _unescaped_role(F.substring(body, F.lit(1), line - 1)).alias("role"),
            _unescaped(F.substring(body, line + 1, F.length(body))).alias("text"),
        )

    masked = F.zip_with(
        segments,
        "loss_runs",
        lambda segment, run: F.when(
            run["rest"] > 0, _unescaped(F.substring(segment, run["skip"] + 1, run["keep"]))
        ),
    )
    return df.withColumns(
        {"read_turns": F.transform(segments, turn), "loss_texts": F.filter(masked, lambda t: t.isNotNull())}
    )
