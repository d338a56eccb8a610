"""Chat formatting: turns with typed content parts as training text with a loss mask.

Every turn becomes ``### <role>: <body></turn>`` and a line break. A visitor flattens the
parts of the turn into the body: text as it is, an image, audio clip or document as the
placeholder ``<|kind:n|>`` with its number in the turn; what it refers to and the tokens it
expands to are recorded beside it. Inside texts and roles a backslash goes before every
backslash and control string, so the marks that the template sets can be told apart and the
texts come back exactly. The loss mask covers the bodies of assistant turns, as code point
offsets into each formatted turn.

The formatted turns are one row each: a conversation is their concatenation in order of
turn, and however long it is, no task holds it whole. ``read_back`` reads formatted turns
in order as a stream.

Cases: null texts and roles are empty; a null conversation id is one conversation; null
turns come first and rows of one turn are ordered by their formatted text; repeated rows
stay; null parts and parts of unknown kind are empty text; an empty table gives an empty
result; the results hold the id and turn columns and their own, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlake.llm.common import ready_workers, text_of

START, BETWEEN, STOP = "### ", ": ", "</turn>"
LEARNT_ROLE = "assistant"
# A backslash, or a string that the template gives a meaning.
CONTROL = r"(\\|###|</turn>|<\|)"
CONTROL_IN_ROLE = r"(\\|###|</turn>|<\||: )"
ESCAPED = re.compile(r"\\(\\|###|</turn>|<\||: )")

PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
NOT_OF_TEXT = {"uri": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
# Tokens that attachments expand to: per patch of pixels, per second, per page.
PATCH_SIDE = 28
TOKENS_PER_SECOND = 25
TOKENS_PER_PAGE = 560


def escaped(text: Column, control: str = CONTROL) -> Column:
    return F.regexp_replace(text, control, r"\\$1")


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def _patches(part: Column) -> Column:
    side = lambda name: F.ceil(F.coalesce(part[name], F.lit(0)) / PATCH_SIDE)
    return side("width") * side("height")


# What each kind of attachment expands to, in tokens.
VISITORS: dict[str, Callable[[Column], Column]] = {
    "image": _patches,
    "audio": lambda part: F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * TOKENS_PER_SECOND),
    "document": lambda part: F.coalesce(part["pages"], F.lit(0)) * TOKENS_PER_PAGE,
}


def _expanded(part: Column) -> Column:
    tokens = F.lit(0)
    for kind, visit in VISITORS.items():
        tokens = F.when(part["kind"] == kind, visit(part)).otherwise(tokens)
    return tokens.cast("bigint")


def _flattened(parts: Column) -> tuple[Column, Column]:
    """Body and attachments of the parts, in their order."""
    attached = F.filter(parts, lambda p: p["kind"].isin(*VISITORS))

    def shown(part: Column, i: Column) -> Column:
        number = F.size(F.filter(F.slice(parts, 1, i + 1), lambda p: p["kind"].isin(*VISITORS))) - 1
        mark = F.concat(F.lit("<|"), part["kind"], F.lit(":"), number.cast("string"), F.lit("|>"))
        return F.when(part["kind"].isin(*VISITORS), mark).otherwise(escaped(text_of(part["text"])))

    body = F.array_join(F.transform(parts, shown), "", "")
    attachments = F.transform(
        attached,
        lambda p, i: F.struct(
            i.cast("int").alias("number"), p["kind"].alias("kind"), p["uri"].alias("uri"), _expanded(p).alias("tokens")
        ),
    )
    return body, attachments


def format_turns(
    turns: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    parts_column: str | None = None,
) -> DataFrame:
    """``<id>, <turn>, formatted, loss_start, loss_end, attachments`` for every row.

    ``parts_column`` holds an array of PART; without it the text is the only part.
    """
    if parts_column:
        parts = F.coalesce(F.col(parts_column), F.array().cast(f"array<{PART}>"))
    else:
        absent = [F.lit(None).cast(kind).alias(name) for name, kind in NOT_OF_TEXT.items()]
        parts = F.array(F.struct(F.lit("text").alias("kind"), F.col(text_column).alias("text"), *absent))
    body, attachments = _flattened(parts)
    head = F.concat(F.lit(START), escaped(text_of(role_column), CONTROL_IN_ROLE), F.lit(BETWEEN))
    learnt = F.coalesce(F.col(role_column) == LEARNT_ROLE, F.lit(False))
    staged = turns.select(
        F.col(id_column), F.col(turn_column), head.alias("__head"), body.alias("__body"),
        learnt.alias("__learnt"), attachments.alias("attachments"),
    )
    start = F.length("__head")
    return staged.select(
        id_column, turn_column,
        F.concat("__head", "__body", F.lit(STOP + "\n")).alias("formatted"),
        start.cast("int").alias("loss_start"),
        F.when(F.col("__learnt"), start + F.length("__body")).otherwise(start).cast("int").alias("loss_end"),
        "attachments",
    )


_ESCAPE = r"\\(?:\\|###|</turn>|<\||: )"
TURN = re.compile(
    rf"{START}((?:(?!###|</turn>|: )[^\\]|{_ESCAPE})*){BETWEEN}((?:(?!###|</turn>)[^\\]|{_ESCAPE})*){STOP}\n"
)


def parsed(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    match = TURN.fullmatch(formatted)
    if match is None:
        raise ValueError(f"Not a formatted turn: {formatted[:80]!r}")
    return unescaped(match[1]), unescaped(match[2])


class _Digest:
    """What is known of one conversation while its turns pass by."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, start: int, end: int) -> None:
        role, text = parsed(formatted)
        learnt = unescaped(formatted[start:end])
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(learnt.encode())
        self.n_turns += 1
        self.loss_chars += len(learnt)
        self.chars += len(formatted)


def read_back(formatted: DataFrame, id_column: str = "conv_id", turn_column: str = "turn") -> DataFrame:
    """Per conversation ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    One shuffle by conversation; the turns of a conversation pass through in order and
    only running digests are kept.
    """
    ready_workers(formatted.sparkSession)
    kind = formatted.schema[id_column].dataType.simpleString()
    names = [id_column, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[object, _Digest] | None = None

        def rows(done: list[tuple[object, _Digest]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _ in done], key_type),
                    pa.array([d.n_turns for _, d in done], pa.int64()),
                    pa.array([d.turns.hexdigest() for _, d in done], pa.string()),
                    pa.array([d.loss_chars for _, d in done], pa.int64()),
                    pa.array([d.loss.hexdigest() for _, d in done], pa.string()),
                    pa.array([d.chars for _, d in done], pa.int64()),
                ],
                names,
            )

        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            done = []
            for key, *turn in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if held is None or held[0] != key:
                    if held:
                        done.append(held)
                    held = (key, _Digest())
                held[1].add(*turn)
            yield rows(done)
        if held:
            yield rows([held])

    ordered = (
        formatted.select(id_column, "formatted", "loss_start", "loss_end", turn_column)
        .repartition(id_column)
        .sortWithinPartitions(id_column, turn_column, "formatted")
        .drop(turn_column)
    )
    return ordered.mapInArrow(
        run,
        f"`{id_column}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint,"
        " loss_sha256 string, formatted_chars bigint",
    )
