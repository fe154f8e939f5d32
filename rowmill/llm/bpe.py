"""Byte-level BPE by depth-first traversal of a trie of distinct words.

Of every prefix of a word the encoding ends in one token, its last-token state; the tokens before
it are the encoding of the prefix that this token leaves.  The state of a trie node therefore
follows from the states on the path above it: it is the longest token ending there that BPE would
keep beside the last token of the rest.  Words that share a prefix share its states.

The trie is never built of nodes.  Sorted words are its depth-first order: what a word shares with
the one before it is the part of the path that stays, and the rest of the word are the nodes below,
so the states of one path, in flat lists, are all that is held.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.blocks import blocks, loaded, strings
from rowmill.session import ship_package

# Fixed value: the pattern by which byte-level tokenizers of this family split a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Words kept in each of two generations, the longest of them, and entries of the other memos.
MEMO_ENTRIES = 1 << 17
MEMO_BYTES = 64
STEP_ENTRIES = 1 << 18


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in the vocabulary: printable Latin-1 ones for themselves,
    the others, in order, for 256 and up."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    kept = set(printable)
    others = [byte for byte in range(256) if byte not in kept]
    return {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}


class Endings:
    """Which tokens end at a byte: a state for every prefix of a token, and the step from state to
    state that each byte makes, to the longest prefix that the bytes read so far end in."""

    def __init__(self, ids: dict[bytes, int]):
        self.after: list[dict[int, int]] = [{}]
        own: list[tuple[int, int] | None] = [None]
        for token, number in ids.items():
            state = 0
            for byte in token:
                onward = self.after[state].get(byte)
                if onward is None:
                    onward = self.after[state][byte] = len(self.after)
                    self.after.append({})
                    own.append(None)
                state = onward
            own[state] = (number, len(token))
        self.shorter = [0] * len(self.after)
        # Tokens that end in a state, the longest first.
        self.found: list[tuple[tuple[int, int], ...]] = [()] * len(self.after)
        self.steps: dict[int, int] = {}
        level = [0]
        while level:
            below = []
            for state in level:
                for byte, onward in self.after[state].items():
                    shorter = self.step(self.shorter[state], byte) if state else 0
                    self.shorter[onward] = shorter
                    self.found[onward] = (own[onward], *self.found[shorter]) if own[onward] else self.found[shorter]
                    below.append(onward)
            level = below

    def step(self, state: int, byte: int) -> int:
        known = self.steps.get(state << 8 | byte)
        if known is None:
            at = state
            while at and byte not in self.after[at]:
                at = self.shorter[at]
            known = self.steps[state << 8 | byte] = self.after[at].get(byte, 0)
        return known


class BytePairs:
    """Vocabulary and merges of a tokenizer file, and which two tokens may stand side by side."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        alphabet = byte_alphabet()
        to_bytes = lambda token: bytes(alphabet[c] for c in token)
        self.special = {token["content"]: token["id"] for token in held["added_tokens"]}
        vocabulary = {k: v for k, v in held["model"]["vocab"].items() if k not in self.special}
        self.ids = {to_bytes(token): number for token, number in vocabulary.items()}
        self.tokens = {number: token for token, number in self.ids.items()}
        self.tokens |= {number: token.encode() for token, number in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for rank, merge in enumerate(held["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = (vocabulary[left], vocabulary[right])
            whole = vocabulary[left + right]
            self.rank[pair] = rank
            if whole not in self.parts:
                self.parts[whole], self.made[whole] = pair, rank
        self.beside: dict[int, bool] = {}
        self.endings = Endings(self.ids)

    def _stays_apart(self, left: int, right: int) -> bool:
        """Whether BPE, building both tokens, never merges across the border between them.

        Both are taken apart again, latest merge first.  At each moment the two pieces that meet at
        the border must have no merge that ranks before the one just undone; on equal ranks BPE
        merges from the left.
        """
        made, parts, rank = self.made, self.parts, self.rank
        border = rank.get((left, right))
        if border is not None:
            return False
        while True:
            left_rank, right_rank = made.get(left, -1), made.get(right, -1)
            if left_rank < 0 and right_rank < 0:
                return True
            if left_rank > right_rank:
                left, undone, on_left = parts[left][1], left_rank, True
            else:
                right, undone, on_left = parts[right][0], right_rank, False
            border = rank.get((left, right))
            if border is not None and (border < undone or border == undone and not on_left):
                return False

    def encode_words(self, distinct: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Each distinct word with its ids, in the order of a depth-first walk of their trie."""
        for memo in (self.beside, self.endings.steps):
            if len(memo) > STEP_ENTRIES:
                # The half that was found out first goes.
                for key in list(islice(memo, len(memo) // 2)):
                    del memo[key]
        beside, steps, step, found = self.beside, self.endings.steps, self.endings.step, self.endings.found
        # Of each prefix on the path: the state of the endings, the last token, and where it begins.
        states, last, begins = [0], [0], [0]
        before = b""
        for word in sorted(distinct):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del states[shared + 1 :], last[shared + 1 :], begins[shared + 1 :]
            state, depth = states[shared], shared
            for byte in word[shared:] if shared else word:
                depth += 1
                onward = steps.get(state << 8 | byte)
                state = step(state, byte) if onward is None else onward
                for token, length in found[state]:
                    if length == depth:
                        break
                    pair = last[depth - length] << 32 | token
                    apart = beside.get(pair)
                    if apart is None:
                        apart = beside[pair] = self._stays_apart(last[depth - length], token)
                    if apart:
                        break
                states.append(state)
                last.append(token)
                begins.append(depth - length)
            ids = []
            while depth:
                ids.append(last[depth])
                depth = begins[depth]
            ids.reverse()
            yield word, ids
            before = word


class TextEncoder:
    """Whole texts to ids and back; words met before in the task are looked up."""

    def __init__(self, path: str):
        self.pairs = BytePairs(path)
        self.split = regex.compile(SPLIT).findall
        by_length = sorted(self.pairs.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if by_length else None
        # Packed ids of words: those met lately, and those of the generation before.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _pieces(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.split(text)
        pieces: list[str] = []
        for part in self.special.split(text):
            pieces += [part] if part in self.pairs.special else self.split(part)
        return pieces

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, packed as 32-bit little-endian numbers."""
        split = [self._pieces(text) for text in texts]
        if len(self.young) > MEMO_ENTRIES:
            self.old, self.young = self.young, {}
        young = self.young
        fresh = {word for words in split for word in words}.difference(young)
        for word in fresh & self.old.keys():
            young[word] = self.old[word]
            fresh.discard(word)
        for word in fresh & self.pairs.special.keys():
            young[word] = array("i", [self.pairs.special[word]]).tobytes()
            fresh.discard(word)
        for word, ids in self.pairs.encode_words([word.encode() for word in fresh]):
            young[word.decode()] = array("i", ids).tobytes()
        packed = [b"".join(map(young.__getitem__, words)) for words in split]
        for word in fresh:
            if len(word) > MEMO_BYTES:
                del young[word]
        return packed

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pairs.tokens.__getitem__, ids)).decode(errors="replace")


def _id_lists(packed: list[bytes]) -> pa.ListArray:
    ends = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(ids) // 4 for ids in packed], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def encode_texts(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (key, ids, decoded) for every row of ``docs``: the ids of the whole text, and the
    text that these ids stand for.

    Nothing is added or cut; strings of special tokens inside a text become those tokens.  A NULL
    text counts as empty and has no ids.  Repeated rows and NULL keys keep their row, other columns
    are not read, an empty table gives no rows.  Tries are built per block of texts, so a task
    holds the distinct words of one block and a bounded memo, whatever the corpus's vocabulary.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    kind = rows.schema["__key"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(TextEncoder, tokenizer)
        for block in blocks(batches, "__text"):
            packed = encoder.encode(strings(block.column("__text")))
            decoded = [encoder.decode(np.frombuffer(ids, "<i4").tolist()) for ids in packed]
            yield pa.RecordBatch.from_arrays(
                [block.column("__key"), _id_lists(packed), pa.array(decoded, pa.string())],
                names=["__key", "ids", "decoded"],
            )

    coded = rows.mapInArrow(encoded, f"__key {kind}, ids array<int>, decoded string")
    return coded.withColumnRenamed("__key", key)


def decode_ids(coded: DataFrame, tokenizer: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``coded`` with the text of its ids under ``name``; NULL ids give the empty text."""
    ship_package(coded.sparkSession)

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        encoder = loaded(TextEncoder, tokenizer)
        return pa.array([encoder.decode(row or []) for row in column.to_pylist()], pa.string())

    return coded.withColumn(name, decoded(F.col(ids)))
