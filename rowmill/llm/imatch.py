"""I-Match fingerprints from randomised lexicons.

A term belongs to the lexicon when its inverse document frequency lies in a chosen band.  The
lexicon is thinned at random into several subsets, in tiers of which the first keeps half of the
terms and each other a quarter of the one before; a text's fingerprint is, for each subset, a hash of its sorted distinct terms there.
The same is done with all terms, for texts of which the lexicon knows little.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.blocks import BLOCK_BYTES, blocks, joined, mix, strings, words
from rowmill.session import settle, ship_package

FAMILIES = 2
TIERS = 8
SUBSETS = 16
SLICE_TERMS = 1 << 14
# The band: terms in one document of 20 to one of 8,000.
IDF_LOW, IDF_HIGH = 3.0, 9.0


def _seeds() -> np.ndarray:
    return mix(np.arange(1, SUBSETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def distinct_terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct term hashes of the texts, one text after the other, and where each text's
    begin (and the total).  Terms are words in lower case."""
    data, begins = joined([text.lower() for text in texts])
    starts, _, hashes = words(data)
    owner = np.searchsorted(begins, starts, side="right") - 1
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def lexicon(docs: DataFrame, text: str = "text", low: float = IDF_LOW, high: float = IDF_HIGH) -> np.ndarray:
    """Sorted hashes of the terms whose idf, ln(documents / documents with the term), is in the band.

    Counted over all documents, summed per task before the shuffle.  A document with T distinct
    terms adds T to the counts and a term of the band has at least documents / e**high of them, so
    the lexicon is at most e**high times the mean T, whatever the size of the corpus: that many
    8-byte hashes are broadcast.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0

        def emit():
            terms, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64), [])
            return pa.RecordBatch.from_arrays(
                [pa.array(terms.view(np.int64)), pa.array(n, pa.int32())], names=["term", "n"]
            )

        for block in blocks(batches, "__text"):
            found, _ = distinct_terms(strings(block.column(0)))
            held.append(found)
            size += len(found)
            if size > 4_000_000:
                yield emit()
                held, size = [], 0
        yield emit()

    ship_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    total = rows.count()
    counts = rows.mapInArrow(counted, "term long, n int").groupBy("term").agg(F.sum("n").alias("n"))
    idf = F.log(F.lit(float(max(total, 1))) / F.col("n"))
    chosen = counts.where((idf >= low) & (idf <= high)).select("term").toArrow()
    return np.sort(chosen.column(0).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def _known(terms: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Which of the terms are in the lexicon."""
    if not len(band):
        return np.zeros(len(terms), bool)
    return band[np.minimum(np.searchsorted(band, terms), len(band) - 1)] == terms


def _gather(draws: np.ndarray, hashes: np.ndarray, owner: np.ndarray, sums: np.ndarray, held: np.ndarray) -> None:
    """Add the terms to the sums of one family, tier by tier; a tier's terms are among those of the one before."""
    for tier in range(TIERS):
        inside = draws < np.uint64(1 << 63 - 2 * tier)
        some = inside.any(axis=1)
        draws, hashes, owner, inside = draws[some], hashes[some], owner[some], inside[some]
        if not len(owner):
            return
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        sums[owner[first], tier] += np.add.reduceat(np.where(inside, hashes, np.uint64(0)), first, axis=0)
        held[owner[first], tier] |= np.logical_or.reduceat(inside, first, axis=0)


def prints_of(texts: list[str], band: np.ndarray) -> np.ndarray:
    """For each text FAMILIES x TIERS x SUBSETS hashes, 0 where it has no term in the subset.

    The first family is over its terms in the lexicon, the second over all its terms; without any term
    every hash is 0.  Terms are drawn for SLICE_TERMS at a time, so the draws of a long text take no
    more room than those of a short one.
    """
    terms, begins = distinct_terms(texts)
    shape = (FAMILIES, len(texts), TIERS, SUBSETS)
    sums, held = np.zeros(shape, np.uint64), np.zeros(shape, bool)
    for low in range(0, len(terms), SLICE_TERMS):
        own = terms[low : low + SLICE_TERMS]
        owner = np.searchsorted(begins, np.arange(low, low + len(own)), side="right") - 1
        draws = mix(own[:, None] ^ _seeds()[None, :])
        hashes = mix(own)[:, None] * (draws | np.uint64(1))
        known = _known(own, band)
        _gather(draws[known], hashes[known], owner[known], sums[0], held[0])
        _gather(draws, hashes, owner, sums[1], held[1])
    # The sum of the hashes of sorted distinct terms names the set of them.
    prints = np.zeros(shape, np.uint16)
    prints[held] = (mix(sums[held]) % np.uint64((1 << 16) - 1)).astype(np.uint16) + np.uint16(1)
    return np.ascontiguousarray(prints.swapaxes(0, 1))


def _thinnest(busy: np.ndarray) -> np.ndarray:
    """The last tier in which at least half of the subsets hold terms, -1 without one."""
    return (busy >= SUBSETS // 2).sum(axis=-1) - 1


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """For each pair of texts the share of equal hashes among the subsets in which one has terms.

    Taken at the thinnest tier in which at least half of the subsets hold terms of one of the two:
    there a subset holds about one term and a small change leaves many subsets as they were.  All
    terms are compared instead of those in the lexicon where these are few in one of the two, less
    than about six or a sixteenth of its terms: they do not stand for the text.  Two texts without
    terms are alike.
    """
    few = np.zeros(len(one), bool)
    for prints in (one, other):
        tiers = _thinnest((prints > 0).sum(axis=3))
        few |= (tiers[:, 0] < 1) | (tiers[:, 1] - tiers[:, 0] >= 2)
    at = np.arange(len(one))
    one, other = one[at, few.astype(np.int64)], other[at, few.astype(np.int64)]
    held = (one > 0) | (other > 0)
    busy = held.sum(axis=2)
    tier = np.maximum(_thinnest(busy), 0)
    same = ((one == other) & held)[at, tier].sum(axis=1)
    total = busy[at, tier]
    return np.where(total > 0, same / np.maximum(total, 1), 1.0)


def packed(prints: np.ndarray) -> list[bytes]:
    """Two bytes for each hash, family by family and tier by tier."""
    return [own.astype(">u2").tobytes() for own in prints]


def edited(text: str, following: str) -> str:
    """The last third replaced by the beginning of the following text, of the same length if it is
    long enough."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


KINDS = (
    "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, "
    "near_next double"
)


def _compare(texts: list[str], following: list[str], band: np.ndarray) -> list[pa.Array]:
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    if following[:-1] == texts[1:]:
        every = prints_of([*texts, following[-1]], band)
        own, after = every[:-1], every[1:]
    else:
        own, after = prints_of(texts, band), prints_of(following, band)
    other = prints_of(changed, band)
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).digest() for t in changed], pa.binary()),
        pa.array(packed(own), pa.binary()),
        pa.array(packed(other), pa.binary()),
        pa.array(likeness(own, other), pa.float64()),
        pa.array(likeness(own, after), pa.float64()),
    ]


def fingerprints(docs: DataFrame, band: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) for every row of ``docs``; NULL counts as the empty text."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(band)

    @F.arrow_udf("string")
    def printed(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        return pa.array([
            name.hex() for block in blocks(iter([batch]), "text")
            for name in packed(prints_of(strings(block.column(0)), sent.value))
        ], pa.string())

    return docs.select(F.col(key), printed(F.col(text).cast("string")).alias("fingerprint"))


def compressed(text: Column) -> Column:
    """Each text as a zstandard frame of its own, for a shuffle of less bytes."""

    @F.arrow_udf("binary")
    def made(column: pa.Array) -> pa.Array:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        return pa.array([squeeze(content.encode()) for content in strings(column)], pa.binary())

    return made(text)


def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """(keys, texts) of rows of a key and a compressed text, in blocks of about BLOCK_BYTES of text;
    the sizes are read off the frames before any is expanded."""
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        frames = batch.column(1).to_pylist()
        first = size = 0
        for at, frame in enumerate(frames):
            own = zstandard.frame_content_size(frame)
            if at > first and size + own > BLOCK_BYTES:
                yield batch.column(0).slice(first, at - first), [expand(f).decode() for f in frames[first:at]]
                first, size = at, 0
            size += own
        if first < len(frames):
            yield batch.column(0).slice(first), [expand(f).decode() for f in frames[first:]]


def compare_edited(docs: DataFrame, band: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``, with its fingerprint, that of its edited text, and the likeness of
    its own to this one and to the following document's.

    Documents follow each other by descending key (NULL last, equal keys by a hash of the text);
    after the last comes the first, and a single document follows itself.  The texts are shuffled
    once, compressed, into ranges that tasks go through in order; only the last row of each range
    meets the first of the next by a join.  A key that owns much of the table is split among ranges by
    hash, and so are its copies of one text by the partition that they were read in.

    NULL counts as the empty text, which has no terms; two texts without terms are alike.  Rows that repeat
    follow each other and keep a row each, NULL keys likewise.  Other columns are not read, an empty table
    gives no rows.  Texts are read whole: a task holds the words of a block, or of one longer text.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(band)
    rows = docs.select(F.col(key).alias("__key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    kind = rows.schema["__key"].dataType.simpleString()
    order: list[Column] = [F.col("__key").desc_nulls_last(), F.col("__hash").asc(), F.col("__from").asc()]
    packed_rows = rows.select(
        "__key", compressed(F.col("__text")).alias("__frame"), F.xxhash64("__text").alias("__hash"),
        F.spark_partition_id().alias("__from"),
    )
    ranged = packed_rows.repartitionByRange(*order).sortWithinPartitions(*order, "__frame").select("__key", "__frame")
    names = ["__key", *[part.split()[0] for part in KINDS.split(", ")], "__part", "__edge", "__text"]
    schema = f"__key {kind}, {KINDS}, __part long, __edge int, __text string"

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None

        def rows_of(keys, columns, edge, texts):
            n = len(keys)
            blank = [pa.nulls(n, t) for t in (pa.int64(), *[pa.binary()] * 3, *[pa.float64()] * 2)]
            return pa.RecordBatch.from_arrays(
                [keys, *(columns or blank), pa.array([part] * n, pa.int64()), pa.array([edge] * n, pa.int32()),
                 pa.array(texts, pa.string()) if texts else pa.nulls(n, pa.string())],
                names=names,
            )

        for keys, texts in expanded(batches):
            if held is None:
                yield rows_of(keys.slice(0, 1), None, 1, texts[:1])
            else:
                keys, texts = pa.concat_arrays([held[0], keys]), [held[1], *texts]
            if len(texts) > 1:
                yield rows_of(keys.slice(0, len(texts) - 1), _compare(texts[:-1], texts[1:], sent.value), 0, None)
            held = (keys.slice(len(texts) - 1, 1), texts[-1])
        if held is not None:
            yield rows_of(held[0], None, 2, [held[1]])

    stored = settle(ranged.mapInArrow(compared, schema), "compared", compression="zstd")
    # One row per range: which range with rows comes next.
    heads = stored.where("__edge = 1").select("__part")
    first = F.min("__part").over(Window.partitionBy())
    onward = heads.select("__part", F.coalesce(F.lead("__part").over(Window.orderBy("__part")), first).alias("__next"))
    tails = stored.where("__edge = 2").select("__key", "__text", "__part").join(onward, "__part")
    begins = stored.where("__edge = 1").select(F.col("__part").alias("__next"), F.col("__text").alias("__following"))
    last = tails.join(begins, "__next").select("__key", "__text", "__following")

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = _compare(strings(batch.column(1)), strings(batch.column(2)), sent.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names[:-3])

    edges = last.mapInArrow(finished, f"__key {kind}, {KINDS}")
    found = stored.where("__edge = 0").select(*names[:-3]).unionByName(edges)
    written = {kind.split()[0] for kind in KINDS.split(", ") if kind.endswith("binary")}
    return found.select(
        F.col("__key").alias(key), *[F.lower(F.hex(n)).alias(n) if n in written else n for n in names[1:-3]]
    )
