"""Fill-in-middle documents through a memo of content-defined chunks.

A rolling hash of the last WINDOW bytes ends a chunk wherever its leading bits are zero, so texts that
share a passage share the chunks inside it wherever the passage stands.  A chunk's boundary summary
says how many words begin in it, how many characters it holds and whether it begins and ends inside a
word.  Summaries are looked up by the chunk's bytes; those of a document, combined from left to right,
count its tokens and say in which chunk a cut falls, and only that chunk is read for the place.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.blocks import Memo, blocks, mix, unload, utf8
from rowmill.session import ship_package

# The markers of the three parts and the white space of tokens.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SPACE = b" \t\n\x0b\x0c\r"
WINDOW = 32
# A chunk ends behind a window with this many leading zero bits, between LEAST and MOST bytes on.
ZEROS, LEAST, MOST = 9, 64, 8192
SEGMENT = 1 << 20
MEMO_BYTES = 16 << 20

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_WORD = re.compile(rb"[^ \t-\r]+")
_SPACE = re.compile(rb"[ \t-\r]")
_CONTINUED = bytes(range(0x80, 0xC0))


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Positions behind which the rolling hash ends a chunk: the sum over a window of the byte's random
    number times two to the power of its distance.  Read in segments, each with the window before it."""
    found = []
    for first in range(0, len(data), SEGMENT):
        since = max(0, first - WINDOW + 1)
        total = _GEAR[data[since : first + SEGMENT]]
        reach = 1
        while reach < WINDOW:
            # Sums over 2, 4, 8 ... bytes from two neighbouring ones of half as many.
            longer = total.copy()
            longer[reach:] += total[:-reach] << np.uint32(reach)
            total, reach = longer, 2 * reach
        at = np.flatnonzero(total >> np.uint32(32 - ZEROS) == 0) + since + 1
        found.append(at[at > first])
    return np.concatenate(found) if found else np.empty(0, np.int64)


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """Words that begin in the chunk if white space precedes it, characters that begin in it, and whether
    its first and its last byte belong to a word."""
    return (
        len(chunk.split()), len(chunk.translate(None, _CONTINUED)),
        chunk[0] not in SPACE, chunk[-1] not in SPACE,
    )


class Document:
    """Tokens and characters up to the end of every chunk of one text."""

    def __init__(self, text: bytes, ends: list[int], memo: Memo):
        self.text = text
        self.begins, self.words, self.chars = [0], [0], [0]
        at = words = chars = 0
        inside = False
        while at < len(text):
            i = bisect_left(ends, at + LEAST)
            end = min(ends[i] if i < len(ends) else len(text), at + MOST, len(text))
            chunk = text[at:end]
            known = memo.get(chunk, len(chunk) + 200)
            if known is None:
                known = summary(chunk)
                memo.put(chunk, known, len(chunk) + 200)
            own, letters, opens, closes = known
            # A word that runs on from the chunk before does not begin here.
            words += own - (inside and opens)
            chars += letters
            inside, at = closes, end
            self.begins.append(at)
            self.words.append(words)
            self.chars.append(chars)
        # White space at the end is a token of its own.
        self.tokens = words + (bool(text) and not inside)

    def cut(self, tokens: int) -> tuple[int, int]:
        """Bytes and characters of the first ``tokens`` tokens."""
        if tokens == 0:
            return 0, 0
        if tokens > self.words[-1]:
            return len(self.text), self.chars[-1]
        # The chunk in which the last word of them begins; a word cut by a chunk's end began before it.
        i = bisect_left(self.words, tokens) - 1
        at = self.begins[i]
        carried = at > 0 and self.text[at - 1] not in SPACE and self.text[at] not in SPACE
        nth = tokens - self.words[i] - 1 + carried
        begin = next(islice(_WORD.finditer(self.text, at, self.begins[i + 1]), nth, None)).start()
        stop = _SPACE.search(self.text, begin)
        end = stop.start() if stop else len(self.text)
        j = bisect_left(self.begins, end) - 1
        return end, self.chars[j] + len(self.text[self.begins[j] : end].translate(None, _CONTINUED))


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the SHA-256 of seed and key; a NULL key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm: int = 80
) -> DataFrame:
    """One row (key, n, form, prefix_chars, middle_chars, output) for every row of ``docs``.

    A token is a word with the white space before it, or white space at the end.  Of 100 documents ``rate``
    are turned, of 100 of these ``spm`` with the suffix first; the others, empty ones and those that hold a
    marker stay plain, with NULL for both counts.  Which, and where the cuts fall, follows from ``seed`` and
    key alone.  NULL texts count as empty, with 0 tokens.  Repeated rows and NULL keys keep their row, other
    columns are not read, an empty table gives no rows.  A text of any length is cut as a whole; a task
    holds one block of texts, hashes of a segment of it and a memo of MEMO_BYTES twice.
    """
    ship_package(docs.sparkSession)
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    first, second, third, fourth = draws(F.col(key), seed)
    marked = content.contains(PREFIX) | content.contains(SUFFIX) | content.contains(MIDDLE)
    form = F.when((content == "") | marked | (F.pmod(third, F.lit(100)) >= rate), "plain").when(
        F.pmod(fourth, F.lit(100)) < spm, "spm"
    ).otherwise("psm")
    rows = docs.select(
        F.col(key).alias("__key"), content.alias("__text"), form.alias("form"), first.alias("__h1"), second.alias("__h2")
    )
    kind = rows.schema["__key"].dataType.simpleString()

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        memo = Memo(MEMO_BYTES)
        for block in blocks(batches, "__text"):
            column = block.column("__text")
            data, offsets = utf8(column)
            ends, bounds = chunk_ends(data), offsets.tolist()
            at = np.searchsorted(ends, offsets, side="right").tolist()
            forms, h1, h2 = (block.column(name).to_pylist() for name in ("form", "__h1", "__h2"))
            counts, before, between, outputs = [], [], [], []
            for i, content in enumerate(column.cast(pa.binary()).to_pylist()):
                held = Document(content, (ends[at[i] : at[i + 1]] - bounds[i]).tolist(), memo)
                n = held.tokens
                counts.append(n)
                if forms[i] == "plain":
                    before.append(None)
                    between.append(None)
                    outputs.append(content)
                    continue
                low, high = sorted((h1[i] % (n + 1), h2[i] % (n + 1)))
                (a, chars), (b, upto) = held.cut(low), held.cut(high)
                before.append(chars)
                between.append(upto - chars)
                parts = {PREFIX: content[:a], MIDDLE: content[a:b], SUFFIX: content[b:]}
                order = (SUFFIX, PREFIX, MIDDLE) if forms[i] == "spm" else (PREFIX, SUFFIX, MIDDLE)
                outputs.append(b"".join(mark.encode() + parts[mark] for mark in order))
            yield pa.RecordBatch.from_arrays(
                [block.column("__key"), pa.array(counts, pa.int64()), block.column("form"), pa.array(before, pa.int64()),
                 pa.array(between, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())],
                names=["__key", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    made = rows.mapInArrow(
        turned, f"__key {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )
    return made.withColumnRenamed("__key", key)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from.  Markers never overlap each other or text, since
    each has its only ``<`` at the front, so the three of a turned output are found again for certain."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    one, two, three = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(one, three, two)).when(form == "spm", F.concat(two, three, one)).otherwise(output)
