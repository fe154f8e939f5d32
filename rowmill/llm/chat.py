"""Chat formatting from heterogeneous records.

A record is a JSON text in one of several layouts.  The hash of its nested field paths, its schema
fingerprint, selects a declarative mapping, which says where turns, roles and contents are.  The
canonical turns are written with a template that marks turns and escapes its own control strings.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.session import ship_package


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps things.

    ``turns`` is None where the record is one turn or a fixed list of them, else the field of the
    list of turns; ``fields`` gives for each turn its role (a literal, or a field after ``@``) and the
    fields whose texts, joined by a blank line, are its content.  A turn of a fixed list without any
    of its fields, or with NULL in all of them, does not exist; elsewhere its text is empty.
    """

    name: str
    key: str
    needed: frozenset[str]
    may_have: frozenset[str] = frozenset()
    turns: str | None = None
    position: str | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)


LAYOUTS = (
    Mapping("turn-row", "conv_id", frozenset({"conv_id", "turn", "role", "text"}), position="turn", fields=(("@role", ("text",)),)),
    Mapping(
        "messages", "id", frozenset({"id", "messages", "messages[].role", "messages[].content"}),
        frozenset({"messages[].name"}), turns="messages", fields=(("@role", ("content",)),),
    ),
    Mapping(
        "from-value", "id", frozenset({"id", "conversations", "conversations[].from", "conversations[].value"}),
        turns="conversations", fields=(("@from", ("value",)),), roles={"human": "user", "gpt": "assistant"},
    ),
    Mapping(
        "prompt", "id", frozenset({"id", "prompt", "completion"}), frozenset({"system"}),
        fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))),
    ),
    Mapping(
        "instruction", "id", frozenset({"id", "instruction", "output"}), frozenset({"input", "system"}),
        fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
    ),
)


def field_paths(value, at: str = "") -> set[str]:
    """Nested field paths: ``a.b`` for a field in a field, ``a[].b`` for one in a list's elements."""
    if isinstance(value, dict):
        paths = set()
        for name, inner in value.items():
            here = f"{at}.{name}" if at else name
            paths |= {here} | field_paths(inner, here)
        return paths
    if isinstance(value, list):
        return set().union(*(field_paths(inner, f"{at}[]") for inner in value)) if value else set()
    return set()


def schema_fingerprint(paths: set[str] | frozenset[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@lru_cache(maxsize=4)
def mappings(layouts: tuple[Mapping, ...] = LAYOUTS) -> dict[str, Mapping]:
    """The mapping of each fingerprint, with every choice of the fields that may be missing."""
    chosen = {}
    for layout in layouts:
        optional = sorted(layout.may_have)
        for size in range(len(optional) + 1):
            for extra in combinations(optional, size):
                chosen[schema_fingerprint(layout.needed | set(extra))] = layout
        if layout.turns:
            # A conversation of no turns shows no fields inside its list.
            chosen[schema_fingerprint({p for p in layout.needed if "[]" not in p})] = layout
    return chosen


def _string(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, mapping: Mapping) -> list[tuple[int, str, str]]:
    """(position, role, content) of each turn of a record in this layout."""
    listed = mapping.turns is not None
    found = []
    for entry in record[mapping.turns] or [] if listed else [record]:
        for role, names in mapping.fields:
            if len(mapping.fields) > 1 and all(entry.get(name) is None for name in names):
                continue
            named = _string(entry.get(role[1:])) if role[0] == "@" else role
            parts = [_string(entry.get(name)) for name in names]
            content = "\n\n".join([parts[0], *(part for part in parts[1:] if part)])
            at = record[mapping.position] if mapping.position else len(found)
            found.append((at, mapping.roles.get(named, named), content))
    return found


def canonical_turns(records: DataFrame, record: str = "record") -> DataFrame:
    """(layout, fingerprint, conv_id, position, role, text): a row per turn of every record.

    A record that is no JSON object, or whose fingerprint has no mapping, or whose key or position is
    no whole number or NULL, gives one row with layout NULL, its fingerprint if it has one, and the
    record as text, so that nothing is lost.  A conversation without turns gives no rows.  NULL
    contents and roles are empty, a NULL key or position stays NULL.  Repeated records repeat their
    turns.  Other columns are not read, an empty table gives no rows.
    """
    ship_package(records.sparkSession)

    def whole(value) -> bool:
        return value is None or isinstance(value, int) and not isinstance(value, bool) and -(1 << 63) <= value < 1 << 63

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = mappings()
        for batch in batches:
            rows = []
            for source in batch.column(0).to_pylist():
                try:
                    parsed = json.loads(source) if source is not None else None
                except ValueError:
                    parsed = None
                if not isinstance(parsed, dict):
                    rows.append((None, None, None, None, None, source))
                    continue
                mark = schema_fingerprint(field_paths(parsed))
                mapping = known.get(mark)
                try:
                    turns = turns_of(parsed, mapping) if mapping else None
                except (AttributeError, TypeError):
                    turns = None
                if turns is None or not whole(parsed.get(mapping.key)) or not all(whole(t[0]) for t in turns):
                    rows.append((None, mark, None, None, None, source))
                    continue
                rows += [(mapping.name, mark, parsed[mapping.key], *turn) for turn in turns]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)],
                names=["layout", "fingerprint", "conv_id", "position", "role", "text"],
            )

    schema = "layout string, fingerprint string, conv_id long, position long, role string, text string"
    return records.select(F.col(record).cast("string")).mapInArrow(mapped, schema)


# The template: <s>[INST] role LF text [/INST] and <s>role LF text</s> for the assistant.
CONTROL = r"(\[|<)(\\*)(/?INST\]|/?s>)"
LEARNED = "assistant"
HEAD, OPEN, CLOSE, END = "<s>", "[INST] ", " [/INST]", "</s>"


def escaped(text: Column) -> Column:
    """A backslash goes after the first character of each control string, and one more into those
    that have some there already: no control string is left and every text can be got back."""
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescaped(text: str) -> str:
    return re.sub(r"(\[|<)\\(\\*)(/?INST\]|/?s>)", r"\1\2\3", text)


def formatted_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, position, piece, loss_from, loss_length): each turn as the template writes it, and
    which of its characters a model learns from: the assistant's text.  A line feed in a role is
    written as ``\\n`` and a backslash there doubled, so the role is what stands before the first
    line feed."""
    role = F.replace(F.replace(escaped(F.coalesce("role", F.lit(""))), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    text = escaped(F.coalesce("text", F.lit("")))
    learned = F.coalesce(F.col("role") == LEARNED, F.lit(False))
    opening = F.when(learned, F.concat(F.lit(HEAD), role, F.lit("\n"))).otherwise(F.concat(F.lit(HEAD + OPEN), role, F.lit("\n")))
    closing = F.when(learned, F.lit(END)).otherwise(F.lit(CLOSE))
    return turns.select(
        "conv_id", "position", F.concat(opening, text, closing).alias("piece"),
        F.when(learned, F.length(opening)).cast("long").alias("loss_from"),
        F.when(learned, F.length(text)).cast("long").alias("loss_length"),
        "role", "text",
    )


SEGMENT_CHARS = 1 << 20
SPAN = pa.struct({"start": pa.int64(), "length": pa.int64()})


def conversations(pieces: DataFrame, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """(conv_id, segment, formatted, loss array<struct<start, length>>, whole): conversations in order.

    Turns are sorted by conversation and position (equal ones by their text) and streamed, and a
    conversation is written in segments of whole turns of about ``segment_chars`` characters.  Tasks
    take ranges of turns, so one that owns a third of all turns is split among them.  Segments of a
    conversation ascend, with gaps: the upper 32 bits number the range.  Starts count characters from
    the beginning of the segment.  ``whole`` marks a segment that is seen to be all of its conversation,
    others of which a range begins or ends with them may be so too.

    Repeated turns are written each time, NULL conversations are one conversation, other columns are not
    read, and an empty table gives no rows.  A turn longer than a segment ends the one that it stands in.
    """
    ship_package(pieces.sparkSession)
    # What bounds the ranges is kept on the driver, so it holds the beginning of a turn only.
    ordered = pieces.select("conv_id", "position", "piece", "loss_from", "loss_length").repartitionByRange(
        "conv_id", "position", F.substring("piece", 1, 64)
    ).sortWithinPartitions("conv_id", "position", "piece")

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        loss: list[dict] = []
        size, now, segment, begun, rows = 0, None, 0, False, []
        part, leads = TaskContext.get().partitionId() << 32, True

        def close(ended: bool = False):
            if held:
                rows.append((now, part + segment, "".join(held), list(loss), ended and not leads and not segment))
            held.clear()
            loss.clear()

        def flush():
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(SPAN), pa.bool_())
            batch = pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)],
                names=["conv_id", "segment", "formatted", "loss", "whole"],
            )
            rows.clear()
            return batch

        for batch in batches:
            for conv, piece, start, length in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if begun and conv != now:
                    close(True)
                    size, segment, leads = 0, 0, False
                elif size > segment_chars:
                    close()
                    size, segment = 0, segment + 1
                now, begun = conv, True
                if start is not None:
                    loss.append({"start": size + start, "length": length})
                held.append(piece)
                size += len(piece)
            yield flush()
        close()
        yield flush()

    kind = "conv_id long, segment long, formatted string, loss array<struct<start: long, length: long>>, whole boolean"
    return ordered.mapInArrow(assembled, kind)


# What ends a turn, and what every turn begins with, neither of which an escaped text can hold.
_TURN = re.compile(
    r"<s>(?:\[INST\] (?P<role>[^\n]*)\n(?P<text>.*?) \[/INST\](?=<s>|\Z)|(?P<own>[^\n]*)\n(?P<reply>.*?)</s>)", re.S
)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted segment, unescaped."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError("not written by this template")
        role, text = (found["role"], found["text"]) if found["role"] is not None else (found["own"], found["reply"])
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)
        turns.append((unescaped(role), unescaped(text)))
        at = found.end()
    return turns


class Reading:
    """What is known of a conversation after some of its segments."""

    def __init__(self):
        self.turns = self.learned = self.chars = 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss: list[dict]) -> None:
        for role, text in read_turns(formatted):
            self.turns += 1
            self.turns_hash.update(f"{role}\n{text}\n".encode())
        for span in loss:
            text = unescaped(formatted[span["start"] : span["start"] + span["length"]])
            self.learned += len(text)
            self.loss_hash.update(text.encode())
        self.chars += len(formatted)

    def values(self) -> tuple:
        return self.turns, self.turns_hash.hexdigest(), self.learned, self.loss_hash.hexdigest(), self.chars


READ = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
READ_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation from the formatted segments alone: (conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars).

    ``turns_sha256`` hashes role, line feed, text, line feed of each turn in order, ``loss_sha256`` the
    texts under the loss mask.  Whole conversations are read where they are.  Only segments of others
    are shuffled, sorted and streamed, hashes carried from one to the next: a hash over a whole
    conversation has to pass through it in order.
    """
    ship_package(segments.sparkSession)
    names = [part.split()[0] for part in READ.split(", ")]

    def frame(rows: list[tuple], heads: dict[str, pa.DataType]) -> pa.RecordBatch:
        kinds = (*heads.values(), *READ_KINDS)
        return pa.RecordBatch.from_arrays(
            [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)], names=[*heads, *names]
        )

    def read_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = {"conv_id": pa.int64(), "segment": pa.int64(), "formatted": pa.string(), "loss": pa.list_(SPAN)}
        for batch in batches:
            rows = []
            for conv, segment, formatted, loss, whole in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if whole:
                    reading = Reading()
                    reading.add(formatted, loss)
                    rows.append((conv, segment, None, None, *reading.values()))
                else:
                    rows.append((conv, segment, formatted, loss, *[None] * len(names)))
            yield frame(rows, heads)

    def read_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reading = None, None
        heads = {"conv_id": pa.int64()}
        for batch in batches:
            rows = []
            for conv, _, formatted, loss, *known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if reading is not None and (formatted is None or conv != now):
                    rows.append((now, *reading.values()))
                    reading = None
                if formatted is None:
                    rows.append((conv, *known))
                    continue
                now, reading = conv, reading or Reading()
                reading.add(formatted, loss)
            yield frame(rows, heads)
        if reading is not None:
            yield frame([(now, *reading.values())], heads)

    kept = segments.select("conv_id", "segment", "formatted", "loss", "whole")
    part = kept.mapInArrow(
        read_whole, f"conv_id long, segment long, formatted string, loss array<struct<start: long, length: long>>, {READ}"
    )
    return part.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(read_on, f"conv_id long, {READ}")
