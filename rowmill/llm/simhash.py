"""SimHash fingerprints, and near-duplicates by covering locality-sensitive hashing.

For a radius r every bit position gets a vector of r + 1 bits, and every non-zero vector v of r + 1
bits a table whose mask keeps the positions with an odd product with v.  Two fingerprints that
differ in at most r positions meet in some table for certain: r vectors of r + 1 bits leave a v that
is orthogonal to all of them, and its mask drops every differing position.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.blocks import blocks, mix, strings, unload
from rowmill.llm.components import connected
from rowmill.operators.joins import join_small
from rowmill.session import settle, ship_package

BITS = 64
# Shingles of a text that are hashed and counted at a time.
SLICE = 1 << 16
# How far around a shingle's hash must be the least for a segment to begin there, the coarsest cut first.
REACHES = (4, 2, 1)
# Texts that tell which shingles are common, and how many of these are listed.
SAMPLE, COMMON = 20_000, 200_000
# Products of sizes and similarities are taken as whole numbers within this.
_ROUNDING = 1e-9
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def covering_masks(radius: int) -> list[int]:
    """The masks of the 2**(radius + 1) - 1 tables; every mask keeps half of the positions."""
    vectors = [position % (1 << (radius + 1)) for position in range(BITS)]
    return [
        sum(1 << position for position, own in enumerate(vectors) if (own & table).bit_count() % 2)
        for table in range(1, 1 << (radius + 1))
    ]


def shingle_hashes(text: str, words: int, seed: int) -> Iterator[list[int]]:
    """XXH64 of every run of ``words`` words, repeats included, SLICE at a time; of all words where there
    are fewer, and nothing without any.

    Words are what lies between ASCII white space, with A to Z in lower case.
    """
    parts = text.encode().translate(LOWER).split()
    if not parts:
        return
    joined = b" ".join(parts)
    if len(parts) <= words:
        yield [xxhash.xxh64_intdigest(joined, seed)]
        return
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    del parts
    starts = np.concatenate(([0], ends[: len(ends) - words] + 1))
    ends, digest = ends[words - 1 :], xxhash.xxh64_intdigest
    for at in range(0, len(starts), SLICE):
        places = zip(starts[at : at + SLICE].tolist(), ends[at : at + SLICE].tolist(), strict=True)
        yield [digest(joined[i:j], seed) for i, j in places]


def majority(hashes: Iterable[list[int]]) -> int:
    """The number whose bits are set in over half of the hashes; 0 of none."""
    counts, total = np.zeros(BITS, np.int64), 0
    for some in hashes:
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(some)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, seed: int = 42
) -> DataFrame:
    """One row (key, fingerprint long) for every row of ``docs``.

    NULL texts and texts without words have fingerprint 0.  Repeated rows and NULL keys keep their
    row, other columns are not read, an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    kind = rows.schema["__key"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        for block in blocks(batches, "__text"):
            found = [majority(shingle_hashes(content, words, seed)) for content in strings(block.column("__text"))]
            yield pa.RecordBatch.from_arrays(
                [block.column("__key"), pa.array(found, pa.int64())], names=["__key", "fingerprint"]
            )

    return rows.mapInArrow(hashed, f"__key {kind}, fingerprint long").withColumnRenamed("__key", key)


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _spanning(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that hold together what lies within the radius, a forest of the members."""
    # Of a signed number bitwise_count takes the absolute value.
    bits = members.view(np.uint64)
    left = np.ones(len(members), bool)
    links: list[tuple[int, int]] = []
    for first in range(len(members)):
        if not left[first]:
            continue
        left[first] = False
        reached = [first]
        while reached:
            at = reached.pop()
            near = np.flatnonzero(left)
            near = near[np.bitwise_count(bits[near] ^ bits[at]) <= radius]
            left[near] = False
            links += [(int(members[at]), int(members[other])) for other in near]
            reached += near.tolist()
    return links


def near_links(distinct: DataFrame, radius: int = 4, block: int = 512) -> DataFrame:
    """Links (a, b) among distinct fingerprints which connect exactly what pairs within ``radius`` do.

    Fingerprints meet under each mask.  A bucket of two is checked at once.  A larger one is dealt
    into blocks by a hash, and each pair of blocks is one small unit which returns a forest, so no
    task holds more than two blocks of a bucket and no bucket is cut or written out as pairs.
    """
    ship_package(distinct.sparkSession)
    masks = F.array(*[F.lit(mask - (1 << BITS) if mask >> 63 else mask).cast("long") for mask in covering_masks(radius)])
    met = distinct.select("fingerprint", F.posexplode(masks).alias("table", "mask")).select(
        "fingerprint", "table", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("bucket")
    )
    sizes = met.groupBy("table", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b")
    )
    sizes = settle(sizes.where("n > 1"), "buckets")
    twos = sizes.where((F.col("n") == 2) & (_apart("a", "b") <= radius)).select("a", "b")

    blocks_of = F.ceil(F.col("n") / block).cast("int")
    crowded = met.join(sizes.where("n > 2").select("table", "bucket", blocks_of.alias("dealt")), ["table", "bucket"])
    own = F.pmod(F.xxhash64("fingerprint"), F.col("dealt")).cast("int")
    units = crowded.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("dealt") - 1)))
    units = units.groupBy("table", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    units = units.agg(F.collect_list("fingerprint").alias("members")).select("members")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: list[tuple[int, int]] = []
            for members in batch.column(0):
                links += _spanning(members.values.to_numpy(zero_copy_only=False), radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())],
                names=["a", "b"],
            )

    return twos.unionByName(units.mapInArrow(linked, "a long, b long")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4
) -> DataFrame:
    """One row (key, fingerprint, component) for every row of ``docs``; the component is the smallest
    key among all rows that links of at most ``radius`` differing bits reach, directly or not.

    Texts without words share fingerprint 0, which links like any other.  NULL keys belong to a
    component but never name one unless it has no other key.  Repeated rows keep their row.
    """
    marked = settle(fingerprints(docs, key, text, words).withColumnRenamed(key, "__key"), "fingerprints")
    distinct = settle(marked.groupBy("fingerprint").agg(F.min("__key").alias("least")), "distinct-fingerprints")
    roots = settle(connected(near_links(distinct, radius), "a", "b"), "roots")
    rooted = distinct.join(roots, F.col("node") == F.col("fingerprint"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = settle(rooted, "rooted")
    names = settle(rooted.groupBy("root").agg(F.min("least").alias("component")), "components")
    by_print = settle(rooted.select("fingerprint", "root").join(names, "root").drop("root"), "by-fingerprint")
    return marked.join(by_print, "fingerprint").select(F.col("__key").alias(key), "fingerprint", "component")


def _cuts(hashes: np.ndarray, reach: int) -> np.ndarray:
    """Where segments begin: at the start, and wherever a shingle's hash is the least of ``reach`` on
    either side.  What two texts share is cut alike, wherever it stands."""
    beyond = np.full(reach, np.iinfo(np.uint64).max, np.uint64)
    around = np.lib.stride_tricks.sliding_window_view(np.concatenate([beyond, hashes, beyond]), 2 * reach + 1)
    at = np.flatnonzero(around.min(axis=1) == hashes)
    return at if len(at) and at[0] == 0 else np.concatenate([[0], at])


def segment_fingerprints(hashes: np.ndarray, most: int) -> np.ndarray:
    """SimHashes of a text's segments, at most ``most``: those smallest by a hash, which is the same choice
    in every text that holds them.  A text with fewer segments is cut more finely as well."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    found = np.empty(0, np.uint64)
    for reach in REACHES:
        starts = _cuts(hashes, reach)
        counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        lengths = np.diff(np.append(starts, len(hashes)))
        own = np.packbits(counts * 2 > lengths[:, None], axis=1, bitorder="little").view("<u8").ravel()
        fresh = np.setdiff1d(own, found)
        found = np.concatenate([found, fresh[np.argsort(mix(fresh), kind="stable")][: most - len(found)]])
        if len(found) >= most:
            break
    return found


def jaccard(one: bytes, other: bytes) -> float:
    """Of two sorted sets of hashes; two empty sets are equal."""
    a, b = np.frombuffer(one, "<u8"), np.frombuffer(other, "<u8")
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) or len(b) else 1.0


def shingle_set(text: str, words: int) -> np.ndarray:
    """A text's distinct shingle hashes in ascending order."""
    every = [np.array(some, "<u8") for some in shingle_hashes(text, words, 0)]
    return np.unique(np.concatenate(every)) if every else np.empty(0, "<u8")


def alike(texts: DataFrame, pairs: DataFrame, words: int, least: float) -> DataFrame:
    """Those of the stored, distinct ``pairs`` (a, b) of rows (node, text) whose sets of shingles have a Jaccard
    similarity of ``least`` or more; only texts of some pair send their sets."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            sets = [shingle_set(content, words).tobytes() for content in strings(block.column("text"))]
            yield pa.RecordBatch.from_arrays([block.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = [jaccard(x, y) >= least for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(like, pa.bool_()))

    wanted = settle(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "wanted")
    sets = settle(join_small(texts, wanted, "node", "left_semi").mapInArrow(shingled, "node long, shingles binary"), "shingle-sets")
    one, other = (sets.select(F.col("node").alias(end), F.col("shingles").alias(f"{end}_set")) for end in ("a", "b"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "a_set", "b_set")
    return both.mapInArrow(compared, "a long, b long")


def segment_links(texts: DataFrame, words: int, least: float, segments: int, radius: int) -> DataFrame:
    """Links (a, b) between rows (node long, text) whose sets of shingles have a Jaccard similarity of
    ``least`` or more: most of them, found cheaply; ``similar_links`` adds what is missing.

    Segments' fingerprints meet under covering masks.  In a bucket each text is compared with the bucket's
    first text of its own size and of the sizes just below: sizes of similar texts are at most a factor
    ``least`` apart, and a bucket of any size makes no more than two pairs for each of its texts.  Every
    pair is checked on whole shingle sets, which only texts of some pair send.
    """
    step = -math.log(least)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        for block in blocks(batches, "text"):
            nodes, bands, prints = [], [], []
            for node, content in zip(block.column("node").to_pylist(), strings(block.column("text")), strict=True):
                kept, total = np.empty(0, np.uint64), 0
                for some in shingle_hashes(content, words, 0):
                    some = np.array(some, np.uint64)
                    kept = np.unique(np.concatenate([kept, segment_fingerprints(some, segments)]))
                    kept = kept[np.argsort(mix(kept), kind="stable")][:segments]
                    total += len(some)
                nodes.append(node)
                bands.append(int(math.log(total) / step) if total else -2)
                prints.append((kept if total else np.zeros(1, np.uint64)).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(bands, pa.int32()), pa.array(prints, pa.list_(pa.int64()))],
                names=["node", "band", "prints"],
            )

    marked = texts.mapInArrow(hashed, "node long, band int, prints array<long>")
    masks = F.array(*[F.lit(mask - (1 << BITS) if mask >> 63 else mask).cast("long") for mask in covering_masks(radius)])
    each = marked.select("node", "band", F.explode("prints").alias("print"))
    each = each.select("node", "band", "print", F.posexplode(masks).alias("table", "mask"))
    met = settle(each.select("node", "band", F.xxhash64("table", F.col("print").bitwiseAND(F.col("mask"))).alias("bucket")), "met")
    firsts = settle(met.groupBy("bucket", "band").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")), "firsts")
    # A first text stands for its own band and the one above.
    busy = firsts.groupBy("bucket").agg(F.sum("n").alias("n")).where("n > 1").select("bucket")
    stands = firsts.join(busy, "bucket", "left_semi").select(
        "bucket", "first", F.explode(F.array("band", F.col("band") + 1)).alias("band")
    )
    pairs = met.join(stands, ["bucket", "band"]).where("node != first")
    pairs = settle(pairs.select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b")).distinct(), "pairs")
    return alike(texts, pairs, words, least)


def first_number(size: int, least: float) -> int:
    """How many first shingles of a set of this size hold the first one shared with any set of a Jaccard similarity of
    ``least`` or more, since what they share is ``least`` of the larger one or more."""
    return size - math.ceil(least * size - _ROUNDING) + 1


def further_number(size: int, least: float) -> int:
    """How many first shingles more are taken: with them two such sets have in common, among the first ones of both, one
    and as many as the smaller one takes."""
    return max(0, min(math.floor((1 - least) / 2 * size), math.ceil(least * size - _ROUNDING) - 1))


def first_shingles(shingles: np.ndarray, common: np.ndarray, ranks: np.ndarray, least: float) -> np.ndarray:
    """The first of a text's shingles, with the further ones, in an order that all texts share: ``common`` ones, which
    ascend, last and by their ``ranks``, the others by a hash."""
    if not len(shingles):
        return shingles
    rank = np.zeros(len(shingles), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        rank = np.where(common[at] == shingles, ranks[at], 0)
    many = first_number(len(shingles), least) + further_number(len(shingles), least)
    return shingles[np.lexsort((mix(shingles), rank))[:many]]


def common_shingles(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that three of about SAMPLE texts or more hold, at most COMMON, in ascending order, and their
    ranks from 1, the most frequent one's the highest.  They decide in which order shingles are compared, not
    what is found, so a sample will do."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        for block in blocks(batches, "text"):
            for content in strings(block.column("text")):
                held = shingle_set(content, words).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64())], names=["shingle"])

    total = texts.count()
    drawn = texts.where(F.pmod(F.xxhash64("node"), F.lit(max(total, 1))) < SAMPLE)
    counts = drawn.mapInArrow(shingled, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    found = counts.orderBy(F.desc("n"), "shingle").limit(COMMON).select("shingle").toArrow()
    listed = found.column("shingle").to_numpy()[::-1].astype(np.int64).view(np.uint64)
    order = np.argsort(listed)
    return listed[order], order + 1


def parity_sketch(shingles: np.ndarray) -> bytes:
    """One bit for each residue of the hashes, of how many of them have it, odd or even: where two sets' sketches
    differ, some shingle is in one of them only, so they differ in no more bits than the sets have such shingles.
    The longer of two is folded to the shorter one's width."""
    width = 1 << min(16, max(6, (4 * len(shingles)).bit_length()))
    odd = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(sketches: list[bytes]) -> np.ndarray:
    width = min(map(len, sketches))
    parts = [np.frombuffer(sketch, "<u8").reshape(-1, width // 8) for sketch in sketches]
    return np.stack([np.bitwise_xor.reduce(part, axis=0) for part in parts])


def _most_apart(size, other, least: float):
    """Shingles that only one of two sets with these numbers of them may have, in all, for a similarity of ``least``."""
    return size + other - 2 * np.ceil(least / (1 + least) * (size + other) - _ROUNDING)


def likely(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Those of the ``pairs`` (a, b, ...) that the ``sketches`` (node, size, sketch) don't rule out: all of a
    similarity of ``least`` or more, and few others."""
    columns = pairs.columns

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, other = (batch.column(name).to_numpy() for name in ("a_size", "b_size"))
            ends = zip(batch.column("a_sketch").to_pylist(), batch.column("b_sketch").to_pylist(), strict=True)
            apart = np.array([int(np.bitwise_count(np.bitwise_xor(*_folded(both))).sum()) for both in ends], np.int64)
            yield batch.select(columns).filter(pa.array(apart <= _most_apart(size, other, least)))

    one, other = (sketches.select(*[F.col(name).alias(to) for name, to in (("node", end), ("size", f"{end}_size"), ("sketch", f"{end}_sketch"))]) for end in ("a", "b"))
    return pairs.join(one, "a").join(other, "b").mapInArrow(kept, pairs.schema)


def open_holders(held: DataFrame, moved: DataFrame | None = None, turn: int | None = None) -> DataFrame:
    """Holders (shingle, band, below, node, root, size, at) of buckets, a shingle and a band of sizes, with more than
    one root, and the number n of a bucket's holders, after ``moved`` (node, root) roots were joined to others.

    With a ``turn`` each has its bucket's most central holder as well: at first the one with the fewest shingles
    before the bucket's, which are rare ones that others lack, in later turns one by a hash."""
    columns = ["shingle", "band", "below", "node", "root", "size", "at"]
    held = held.select(*columns)
    if moved is not None:
        to = moved.select(F.col("node").alias("root"), F.col("root").alias("__to"))
        held = settle(join_small(held, to, "root", "left").withColumn("root", F.coalesce("__to", "root")).select(*columns), "rerooted")
    kept = [F.count(F.lit(1)).alias("n")]
    if turn is not None:
        order = F.struct("at", "node") if turn == 0 else F.struct(F.xxhash64("node", F.lit(turn)), "node")
        kept.append(F.min_by(F.struct("node", "root", "size", "at"), order).alias("centre"))
    ends = held.groupBy("shingle", "band").agg(
        *kept, F.min("root").alias("low"), F.max("root").alias("high"), F.min("below").alias("all_below")
    )
    busy = settle(ends.where("low != high and not all_below").drop("low", "high", "all_below"), "busy")
    return settle(join_small(held, busy, ["shingle", "band"]), "holders")


def central_pairs(held: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b), with their roots (low, high), of each holder and its bucket's most central one.  Each holder
    makes one pair at most."""
    room = F.least(F.col("size") - F.col("at"), F.col("centre.size") - F.col("centre.at"))
    possible = room >= F.ceil(F.lit(least / (1 + least)) * (F.col("size") + F.col("centre.size")) - _ROUNDING)
    return held.where(possible & (F.col("root") != F.col("centre.root"))).select(
        F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b"),
        F.least("root", "centre.root").alias("low"), F.greatest("root", "centre.root").alias("high"),
    ).distinct()


def missed_links(
    texts: DataFrame, roots: DataFrame, words: int, least: float, block: int = 256, turns: int = 0, few: int = 8
) -> DataFrame:
    """Every link (a, b) of similarity ``least`` or more between rows (node, text) that ``roots`` (node, root)
    does not connect yet; with ``turns`` only links that connect what all of these do.

    Two such texts share one of their ``first_shingles``, and their sizes are in one band or in two that follow
    each other.  Where a shingle is held under one root only, as almost all are, nothing is compared.  A text of
    whose first and further shingles fewer are held under several roots than it would share with any like it is left
    out: what texts share by chance would soon be most of what is compared.  Other holders
    meet their bucket's most central one in up to ``turns`` turns, which leaves groups of near copies few roots.
    What is then still apart is dealt into blocks; a pair of blocks is one small unit, which gives the pairs of
    different roots whose sizes, places of the shingle and, in buckets of more than ``few``, sketches leave ``least``
    possible.  Only pairs whose sketches are alike send their sets of shingles.
    """
    common, ranks = common_shingles(texts, words)

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        for block in blocks(batches, "text"):
            sets = [shingle_set(content, words) for content in strings(block.column("text"))]
            firsts = [first_shingles(held, common, ranks, least).view(np.int64) for held in sets]
            many = [first_number(len(held), least) for held in sets]
            # What a text shares with the smallest one like it, which takes the fewest further ones.
            enough = [1 + further_number(math.ceil(least * len(held) - _ROUNDING), least) for held in sets]
            numbers = [pa.array(held, pa.int32()) for held in (map(len, sets), many, enough)]
            yield pa.RecordBatch.from_arrays(
                [block.column("node"), *numbers, pa.array(firsts, pa.list_(pa.int64()))],
                names=["node", "size", "many", "enough", "firsts"],
            )

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        for block in blocks(batches, "text"):
            sets = [shingle_set(content, words) for content in strings(block.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [block.column("node"), pa.array(map(len, sets), pa.int32()), pa.array(map(parity_sketch, sets), pa.binary())],
                names=["node", "size", "sketch"],
            )

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit in batch.column(0):
                *numbers, held = unit.values.flatten()
                node, root, size, at, own, below = (field.to_numpy(zero_copy_only=False) for field in numbers)
                most, room = _most_apart(size[:, None], size, least), size - at
                chosen = (root[:, None] != root) & (size[:, None] + size - 2 * np.minimum(room[:, None], room) <= most)
                chosen &= ~(below[:, None] & below)
                if own.min() != own.max():
                    chosen &= own[:, None] != own
                chosen = np.triu(chosen)
                if not held.null_count:
                    sketches = _folded(held.to_pylist())
                    for i in np.flatnonzero(chosen.any(axis=1)):
                        to = np.flatnonzero(chosen[i])
                        apart = np.bitwise_count(sketches[to] ^ sketches[i]).sum(axis=1, dtype=np.int64)
                        chosen[i, to] = apart <= most[i, to]
                one, other = np.nonzero(chosen)
                if len(one):
                    ends = np.minimum(node[one], node[other]), np.maximum(node[one], node[other])
                    yield pa.RecordBatch.from_arrays([pa.array(end, pa.int64()) for end in ends], names=["a", "b"])

    begins = texts.mapInArrow(begun, "node long, size int, many int, enough int, firsts array<long>")
    stored = settle(
        join_small(begins, roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "first-shingles"
    )
    met = stored.select("node", "root", "size", "many", "enough", F.posexplode("firsts").alias("at", "shingle"))
    shared = met.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    held = join_small(met, settle(shared.select("shingle"), "shared"), "shingle")
    counts = held.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.first("enough").alias("enough"))
    able = settle(counts.where("n >= enough").select("node"), "able")
    held = settle(join_small(held.where("at < many").drop("many", "enough"), able, "node"), "held")
    # A bucket holds the sizes of its band and, marked, of the one below: a band is a little wider than similar sizes are apart.
    band = F.floor(F.log("size") / (-math.log(least) * (1 + _ROUNDING))).cast("int")
    held = held.withColumn("below", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("band", band + F.col("below").cast("int"))
    held = open_holders(held, turn=0 if turns else None)
    nodes = settle(held.select("node").distinct(), "holding")
    sketches = settle(join_small(texts, nodes, "node", "left_semi").mapInArrow(sketched, "node long, size int, sketch binary"), "sketches")
    links: list[DataFrame] = []
    for turn in range(turns):
        near = settle(likely(central_pairs(held, least), sketches, least), "central-pairs")
        found = settle(alike(texts, near.select("a", "b"), words, least).join(near, ["a", "b"]), "central-links")
        # The central one has met its whole bucket: it leaves, and a bucket of two, as most are, is done.
        left = held.where("n > 2 and node != centre.node")
        if found.isEmpty():
            held = open_holders(left)
            break
        links.append(found.select("a", "b"))
        held = open_holders(left, settle(connected(found, "low", "high"), "moved"), turn + 1 if turn + 1 < turns else None)
    small = held.where(F.col("n") <= few).withColumn("sketch", F.lit(None).cast("binary"))
    held = small.unionByName(held.where(F.col("n") > few).join(sketches.drop("size"), "node").select(*small.columns))
    dealt = held.withColumn("dealt", F.ceil(F.col("n") / block).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("dealt")).cast("int"))
    units = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("dealt") - 1)))
    units = units.groupBy("shingle", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    member = F.struct("node", "root", "size", "at", "own", "below", "sketch")
    units = units.agg(F.collect_list(member).alias("members")).select("members")
    pairs = settle(likely(units.mapInArrow(crossed, "a long, b long").distinct(), sketches, least), "missed-pairs")
    return reduce(DataFrame.unionByName, links, alike(texts, pairs, words, least))


def similar_links(texts: DataFrame, words: int, least: float, segments: int, radius: int) -> DataFrame:
    """Links (a, b) that connect exactly the rows (node long, text) which pairs of a Jaccard similarity of
    ``least`` or more do, directly or not.

    Most come from segments' fingerprints; what these leave apart is then compared by first shingles, which
    lose no pair.
    """
    roots = settle(connected(segment_links(texts, words, least, segments, radius), "a", "b"), "segment-roots")
    rest = settle(missed_links(texts, roots, words, least, turns=2), "missed-links")
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(rest)


def similar_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, least: float = 0.8,
    segments: int = 8, radius: int = 1,
) -> DataFrame:
    """One row (key, component) for every row of ``docs``: the smallest key that links reach, where texts
    link whose sets of ``words``-word shingles have a Jaccard similarity of ``least`` or more.

    A whole text's fingerprint is too coarse for that: at a similarity of 0.8 some eight of 64 bits differ,
    more than a workable number of masks covers.  So texts are cut at places that their content names, and
    fingerprints are taken of up to ``segments`` of the segments.  Copies are one text.  Texts that share no
    chosen segment, or of which neither is the first in a bucket of theirs, are compared by first shingles
    where no chain of links joins them, so the components are those of all pairs.

    NULL texts count as empty; texts without words are alike.  A NULL key names a component only where it
    has no other.  Repeated rows keep their row, other columns are not read, an empty table gives no rows.
    A text of any length is hashed whole, SLICE shingles at a time.
    """
    ship_package(docs.sparkSession)
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("__key"), F.unhex(F.sha2(content, 256)).alias("digest"), content.alias("text"))
    kinds = settle(rows.groupBy("digest").agg(F.min("__key").alias("least")).withColumn("node", F.monotonically_increasing_id()), "texts")
    keyed = settle(rows.select("__key", "digest"), "text-keys")
    # Of the rows with one text, which are many where it was copied, each task sends one.
    once = settle(rows.select("digest", "text").dropDuplicates(["digest"]).join(kinds, "digest").select("node", "text"), "distinct-texts", "zstd")
    roots = settle(connected(similar_links(once, words, least, segments, radius), "a", "b"), "roots")
    rooted = settle(
        kinds.join(roots, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root")), "rooted"
    )
    names = settle(rooted.groupBy("root").agg(F.min("least").alias("component")), "components")
    by_text = settle(rooted.join(names, "root").select("digest", "component"), "by-text")
    return keyed.join(by_text, "digest").select(F.col("__key").alias(key), "component")


def hexadecimal(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fingerprint)), 16, "0"))
