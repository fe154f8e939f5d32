"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are runs of character classes (shapes) and repeats of words, hashed into a fixed
number of dimensions and weighted by inverse document frequencies over all documents.  The singular
vectors of a bounded labelled sample span the latent space; its labelled vectors are broadcast, every
document's cosine with each of them comes from blocked matrix products, and the nearest vote with
their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.blocks import SLICE, blocks, joined, mix, strings, unload, words
from rowmill.llm.toxicity import sample_labelled
from rowmill.session import ship_package

DIMENSIONS = 1024
LATENT = 32
NEIGHBOURS = 25
THRESHOLD = 0.3
SHAPE = 4
LAGS = (1, 2, 3)


@dataclass(frozen=True)
class Model:
    """Bounded by its parameters: DIMENSIONS x LATENT numbers and one vector per labelled text."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray


def _classes() -> np.ndarray:
    """Letters become one class for each case, digits one, every other ASCII character its own;
    bytes inside a character of several bytes are class 0 and left out."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("a") : ord("z") + 1] = ord("a")
    table[ord("A") : ord("Z") + 1] = ord("A")
    table[ord("0") : ord("9") + 1] = ord("0")
    table[[9, 11, 12, 13]] = ord(" ")
    table[0x80:0xC0] = 0
    table[0xC0:] = ord("a")
    return table


_CLASS = _classes()


def term_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed terms, a row of DIMENSIONS for each text.  The bytes are read in slices, each with
    the classes that the one before has left unfinished, so a long text needs little room."""
    data, begins = joined(texts)
    if not len(texts):
        return np.zeros((0, DIMENSIONS), np.float32)
    total = np.zeros(len(texts) * DIMENSIONS, np.int64)

    def add(owners: np.ndarray, hashes: np.ndarray) -> None:
        spot = (mix(hashes) % np.uint64(DIMENSIONS)).astype(np.int64)
        total[:] += np.bincount(owners * DIMENSIONS + spot, minlength=len(total))

    left, whose = np.empty(0, np.uint64), np.empty(0, np.int64)
    for first in range(0, len(data), SLICE):
        part = data[first : first + SLICE]
        row = np.repeat(np.arange(len(texts)), np.diff(np.clip(begins, first, first + len(part))))
        shape = _CLASS[part]
        # Latin letters of two bytes, 0xC3 before the second: the upper-case ones end below 0xA0.
        following = data[first + 1 : first + SLICE + 1]
        upper = np.flatnonzero((part[: len(following)] == 0xC3) & (following < 0x9F))
        shape[upper] = ord("A")
        kept = np.flatnonzero(shape)
        shape, owner = np.concatenate([left, shape[kept].astype(np.uint64)]), np.concatenate([whose, row[kept]])
        if len(shape) >= SHAPE:
            code = np.zeros(len(shape) - SHAPE + 1, np.uint64)
            for i in range(SHAPE):
                code = code * np.uint64(256) + shape[i : i + len(code)]
            same = owner[: len(code)] == owner[SHAPE - 1 :]
            add(owner[: len(code)][same], code[same])
        left, whose = shape[-(SHAPE - 1) :], owner[-(SHAPE - 1) :]
    starts, _, hashes = words(data)
    owner = np.searchsorted(begins, starts, side="right") - 1
    for lag in LAGS:
        if len(hashes) > lag:
            again = (hashes[lag:] == hashes[:-lag]) & (owner[lag:] == owner[:-lag])
            add(owner[lag:][again], np.full(int(again.sum()), (1 << 40) + lag, np.uint64))
    return total.reshape(len(texts), DIMENSIONS).astype(np.float32)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Logarithmic term frequency times inverse document frequency, each row of length 1."""
    values = np.log1p(counts) * idf
    length = np.linalg.norm(values, axis=1, keepdims=True)
    return np.divide(values, length, out=np.zeros_like(values), where=length > 0)


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def vote(vectors: np.ndarray, model: Model) -> np.ndarray:
    """Weighted share of label 1 among each vector's nearest labelled vectors.

    A vector that resembles nothing (the empty text's) gets the mean label.  Ties at the last
    neighbour's similarity all vote, so the order of the sample does not matter.
    """
    mean = float(model.votes.mean())
    near = min(NEIGHBOURS, len(model.votes))
    cosine = vectors @ model.vectors.T
    least = np.partition(cosine, cosine.shape[1] - near, axis=1)[:, cosine.shape[1] - near, None]
    weight = np.where(cosine >= least, np.clip(cosine, 0, None), 0) ** 8
    total = weight.sum(axis=1)
    share = np.divide(weight @ model.votes, total, out=np.full(len(vectors), mean, np.float32), where=total > 1e-12)
    return np.clip(share, 0, 1)


def document_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many documents each hashed term occurs, over all of them: DIMENSIONS numbers."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        held, rows = np.zeros(DIMENSIONS, np.int64), 0
        for block in blocks(batches, "__text"):
            held += (term_counts(strings(block.column(0))) > 0).sum(axis=0)
            rows += block.num_rows
        terms = pa.array(np.append(np.arange(DIMENSIONS), -1), pa.int64())
        yield pa.RecordBatch.from_arrays([terms, pa.array(np.append(held, rows), pa.int64())], names=["term", "n"])

    counts = docs.select(F.col(text).cast("string").alias("__text")).mapInArrow(counted, "term long, n long")
    held = {r["term"]: r["n"] for r in counts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return np.array([held.get(term, 0) for term in range(DIMENSIONS)]), held.get(-1, 0)


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    per_class: int = 1500,
) -> Model | None:
    """A model from at most ``per_class`` labelled texts of each label; None without any, as for an empty
    table.  Repeated rows and copies count once, see ``sample_labelled``; other columns are not read.
    """
    ship_package(docs.sparkSession)
    found, total = document_frequencies(docs, text)
    idf = (np.log((1 + total) / (1 + found)) + 0.1).astype(np.float32)
    sample = sample_labelled(docs, labels, label, key, text, per_class).repartition(8, "__key")

    def termed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "__text"):
            counts = term_counts(strings(block.column("__text")))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row.tobytes() for row in counts], pa.binary()), block.column("__label"), block.column("__key")],
                names=["terms", "vote", "at"],
            )

    kind = sample.schema["__key"].dataType.simpleString()
    rows = sample.select("__text", "__label", "__key").mapInArrow(termed, f"terms binary, vote int, at {kind}")
    rows = rows.orderBy("at").collect()
    if not rows:
        return None
    terms = weighted(np.array([np.frombuffer(r["terms"], np.float32) for r in rows]), idf)
    _, vectors = np.linalg.eigh(terms.T @ terms)
    axes = np.ascontiguousarray(vectors[:, ::-1][:, :LATENT]).astype(np.float32)
    return Model(idf, axes, _unit(terms @ axes), np.array([r["vote"] for r in rows], np.float32))


def quality(text: Column, model: Model | None, spark) -> Column:
    """Score from 0 to 1 of the whole text, higher where label 1 is likelier.

    NULL counts as empty; an empty text gets the labelled sample's mean.  Without a model every
    score is 1.  Repeated rows get equal scores.  A text of any length is read whole, in slices.
    """
    if model is None:
        return F.lit(1.0)
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        held, found = sent.value, []
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        for block in blocks(iter([batch]), "text"):
            for first in range(0, block.num_rows, 256):
                counts = term_counts(strings(block.column(0).slice(first, 256)))
                found.append(vote(_unit(weighted(counts, held.idf) @ held.axes), held))
        return pa.array(np.concatenate(found) if found else [], pa.float64())

    return scored(text.cast("string"))
