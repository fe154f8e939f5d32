"""Texts inside a task: bounded blocks of Arrow rows, and words as hashes over the block's bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20


_MODEL: dict = {}


def loaded(build: Callable, *arguments):
    """``build(*arguments)``, kept by the Python worker until it needs another model: a worker serves
    the stages of many jobs, and what earlier ones loaded must not add up."""
    key = (build, arguments)
    if key not in _MODEL:
        _MODEL.clear()
        _MODEL[key] = build(*arguments)
    return _MODEL[key]


def unload() -> None:
    """Drop the model that an earlier job has left, before work that needs room and no model."""
    _MODEL.clear()


class Memo:
    """What a task has worked out before, by key, in two generations.  Entries go to the younger one; when
    that holds ``most`` bytes, as its entries were declared, it becomes the older one and what was older
    goes, so the memo never holds more than twice that and what is asked for often stays."""

    def __init__(self, most: int):
        self.most, self.held = most, 0
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key, size: int = 64):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found, size)
        return found

    def put(self, key, value, size: int = 64) -> None:
        if size > self.most:
            return
        if self.held + size > self.most:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[key] = value
        self.held += size


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the offsets of its rows in them; NULL counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def blocks(
    batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts stay below ``max_bytes``; a longer text is a run of its own."""
    for batch in batches:
        _, ends = utf8(batch.column(batch.schema.get_field_index(text)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(ends, ends[first] + max_bytes, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def strings(column: pa.Array) -> list[str]:
    return pc.fill_null(column, "").to_pylist()


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, one line feed after each, and where each text begins (and the total)."""
    encoded = [text.encode() for text in texts]
    ends = np.zeros(len(encoded) + 1, np.int64)
    np.cumsum([len(text) + 1 for text in encoded], out=ends[1:])
    return np.frombuffer(b"\n".join(encoded) + b"\n" if encoded else b"", np.uint8), ends


def _word_bytes() -> np.ndarray:
    """Bytes that belong to words: ASCII letters and digits, and every byte of other characters."""
    table = np.zeros(256, bool)
    table[ord("0") : ord("9") + 1] = True
    table[ord("A") : ord("Z") + 1] = True
    table[ord("a") : ord("z") + 1] = True
    table[128:] = True
    return table


WORD_BYTES = _word_bytes()
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


SLICE = 1 << 20


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse, for the places in a slice."""
    up, down = np.full(SLICE, _ODD, np.uint64), np.full(SLICE, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a hash depends on every bit of its input."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def _power(base: np.uint64, exponent: int) -> np.uint64:
    return np.uint64(pow(int(base), exponent, 1 << 64))


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in joined texts.

    The hash of a word is a polynomial in its bytes, read off running sums over the bytes.  These are
    made slice by slice, and of each slice only the sums at the edges of words are kept, so a long text
    or a long word needs no more room than its words do.
    """
    found, before = [], False
    for first in range(0, len(data), SLICE):
        inside = WORD_BYTES[data[first : first + SLICE]]
        found.append(np.flatnonzero(np.diff(inside, prepend=before)) + first)
        before = bool(inside[-1])
    if before:
        found.append(np.array([len(data)]))
    edges = np.concatenate(found) if found else np.empty(0, np.int64)
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.empty(0, np.uint64)
    up, down = _powers()
    sums, back = np.zeros(len(edges), np.uint64), np.zeros(len(starts), np.uint64)
    total = np.zeros(1, np.uint64)
    for first in range(0, len(data), SLICE):
        part = data[first : first + SLICE]
        running = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=running[1:])
        scale = np.array([_power(_ODD, first)])
        last = first + len(part)
        # An edge at the very end belongs to the slice before it.
        low, high = np.searchsorted(edges, [first, last + (last == len(data))])
        sums[low:high] = total + scale * running[edges[low:high] - first]
        low, high = np.searchsorted(starts, [first, last])
        back[low:high] = down[starts[low:high] - first] * _power(_INVERSE, first)
        total = total + scale * running[-1:]
    return starts, ends, mix((sums[1::2] - sums[::2]) * back)
