"""Benchmark decontamination by spaced seeds.

A mask picks some positions of a run of words.  Hashes of the picked words are computed at every
position of tests and documents, so a seed still matches where words at ignored positions were
substituted.  Seeds that tests and documents share are joined, and around each the two word
sequences are compared position by position.

Passages that several items share, such as an instruction before each question, are compared once for
all of them: their seeds lead to the passage, and the passage to its items.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.blocks import Memo, blocks, joined, mix, strings, unload, words
from rowmill.operators.joins import join_small
from rowmill.session import settle, ship_package

# A stretch of 24 words or more with LIKE of them equal can be halved so that one half is such a stretch
# of at least 12; so each holds a run of 12 words with at most 2 substitutions, of 15 with 3 or of 20
# with 4.  Wherever these are, one of the masks, which keep 6 words, meets equal words only.
MASKS = ("110010111", "1111011", "11000100111")
SPAN = 12
LEAST_WORDS = 5
FILTER_BITS = 24
LIKE = 0.8
# Equal words that make up for a substitution.
COST = round(LIKE / (1 - LIKE))
# Word hashes of texts that a task keeps while their pairs pass.
MEMO_BYTES = 16 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def short_masks(n: int) -> list[np.ndarray]:
    """Positions kept by the masks of a test of n < SPAN words: they lie in five classes, and a mask for
    every choice of as many classes as words may be substituted leaves these out."""
    classes, may = np.arange(n) % 5, n // (COST + 1)
    return [np.flatnonzero(~np.isin(classes, out)) for out in combinations(range(5), may)]


def seed_masks(lengths: set[int]) -> list[tuple[int, np.ndarray]]:
    """Span and kept positions of each mask; after MASKS come those of tests shorter than SPAN."""
    masks = [(len(mask), np.flatnonzero([c == "1" for c in mask])) for mask in MASKS]
    return masks + [(n, kept) for n in sorted(lengths) if LEAST_WORDS <= n < SPAN for kept in short_masks(n)]


def seeds(
    hashes: np.ndarray, owner: np.ndarray, span: int, kept: np.ndarray, number: int
) -> tuple[np.ndarray, np.ndarray]:
    """Position and hash of one mask's seeds, at every position whose span stays inside its text."""
    n = len(hashes) - span + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    total = np.full(n, mix(np.array([number + 1], np.uint64))[0], np.uint64)
    for offset in kept:
        total = total * _FACTOR + hashes[offset : offset + n]
    at = np.flatnonzero(owner[:n] == owner[span - 1 :])
    return at, mix(total[at])


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, the text of each word, and where each text's words begin."""
    data, begins = joined([text.lower() for text in texts])
    starts, _, hashes = words(data)
    owner = np.searchsorted(begins, starts, side="right") - 1
    return hashes, owner, np.searchsorted(owner, np.arange(len(texts) + 1))


def overlap(document: np.ndarray, test: np.ndarray, shift: int, need: int) -> tuple[int, int, int] | None:
    """Best stretch of at least ``need`` words of the two word sequences laid over each other with the
    test at ``shift``: begin and end in the test and the words equal there.  A substitution costs COST
    equal words, so no stretch of that length has LIKE of its words equal unless the best one has; None
    then."""
    first, last = max(0, -shift), min(len(test), len(document) - shift)
    if last - first < need:
        return None
    same = test[first:last] == document[first + shift : last + shift]
    gain = np.concatenate(([0], np.cumsum(np.where(same, 1, -COST))))
    lowest = np.minimum.accumulate(gain[: len(gain) - need])
    end = need + int(np.argmax(gain[need:] - lowest))
    begin = int(np.argmin(gain[: end - need + 1]))
    if gain[end] < gain[begin]:
        return None
    return first + begin, first + end, int(same[begin:end].sum())


def shared_passages(items: DataFrame, least_words: int = SPAN) -> DataFrame:
    """(passage, __digest, item_from, item_to, total, n): where items hold a passage that others hold too,
    ``total`` being the words of the item and ``n`` the places that hold the passage.

    ``items`` are distinct texts (__digest, __test).  A passage is a run of windows of ``least_words``
    words, all of which the same items hold; so each shared window lies in a passage of each of its
    items, and items with one opening share one passage however long that is.  Texts shorter than a
    window have none.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.arange(least_words)
        for block in blocks(batches, "__test"):
            hashes, owner, begins = _words(strings(block.column("__test")))
            at, found = seeds(hashes, owner, least_words, kept, 0)
            own = owner[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), block.column("__digest").take(pa.array(own)),
                 pa.array(at - begins[own], pa.int64()), pa.array(np.diff(begins)[own], pa.int64())],
                names=["window", "__digest", "at", "total"],
            )

    every = settle(items.mapInArrow(windows, "window long, __digest string, at long, total long"), "item-windows")
    owner = F.xxhash64("__digest")
    shared = every.groupBy("window").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(owner).alias("own"), F.min(owner).alias("low"), F.max(owner).alias("high")
    ).where("low <> high").select("window", "n", F.xxhash64("n", "own", "low", "high").alias("mark"))
    place = F.row_number().over(Window.partitionBy("__digest", "mark").orderBy("at"))
    runs = every.join(shared, "window").withColumn("run", F.col("at") - place)
    listed = F.transform(F.sort_array(F.collect_list(F.struct("at", "window"))), lambda w: w["window"].cast("string"))
    return runs.groupBy("__digest", "mark", "run").agg(
        F.md5(F.concat_ws(",", listed)).alias("passage"), F.min("at").alias("item_from"),
        (F.max("at") + least_words).alias("item_to"), F.max("total").alias("total"), F.max("n").alias("n"),
    ).select("passage", "__digest", "item_from", "item_to", "total", "n")


def _verified(pairs: DataFrame, texts: DataFrame, least_words: int) -> DataFrame:
    """Of pairs (__doc, target, shifts, __test, item_from, item_to) those that overlap, with their longest
    overlap in words of the target: (__doc, target, words, equal, begin, doc_from)."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(MEMO_BYTES)

        def hashes(text: str) -> np.ndarray:
            found = memo.get(text, 16 * len(text) + 64)
            if found is None:
                found = _words([text])[0]
                memo.put(text, found, 16 * len(text) + 64)
            return found

        for block in blocks(batches, "__text"):
            found, kept = [], []
            columns = [block.column(n).to_pylist() for n in ("__text", "__test", "item_from", "item_to", "shifts")]
            for row, (document, test, low, high, shifts) in enumerate(zip(*columns, strict=True)):
                one, other = hashes(document), hashes(test)[low:high]
                best = None
                for shift in shifts:
                    stretch = overlap(one, other, shift, min(least_words, len(other)))
                    if stretch:
                        begin, end, equal = stretch
                        candidate = (end - begin, equal, begin, begin + shift)
                        best = candidate if best is None or candidate > best else best
                if best:
                    kept.append(row)
                    found.append(best)
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [block.column("__doc").take(rows), block.column("target").take(rows),
                 *[pa.array([f[i] for f in found], pa.int64()) for i in range(4)]],
                names=["__doc", "target", "words", "equal", "begin", "doc_from"],
            )

    checked = pairs.join(texts, "__doc").select("__doc", "target", "shifts", "__text", "__test", "item_from", "item_to")
    return checked.mapInArrow(
        compared, "__doc string, target string, words long, equal long, begin long, doc_from long"
    )


def contaminated(
    docs: DataFrame, tests: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", least_words: int = SPAN,
) -> DataFrame:
    """Documents and the test items that they overlap: (key, item, words, equal, item_from, item_words,
    doc_from, passage), in words: the longest of their overlaps, one for each way to lay the item over the
    document, without ends that do not pay for their substitutions where at least ``least_words`` are left.

    They overlap when a stretch of at least ``least_words`` words, or of all words of a shorter
    item, has at least LIKE of its words equal position by position.  Words are runs of letters and
    digits in lower case.  Items of fewer than LEAST_WORDS words match nothing: they are no evidence.

    ``passage`` is NULL in a row that stands for its document and item.  Where the overlap lies in a
    passage that several items share, ``passage`` names it, and a document has one row for the passage, with
    the smallest of its items; the smallest document that holds the passage has a row for each of the
    items.  Likewise of several items with one text.  So D documents and I items with one opening make D + I
    rows, not D x I, and all pairs follow by joining documents with items on ``passage``.  A document that
    meets seeds of a shared passage without overlapping it is compared with each of its items.

    NULL texts are empty.  A document key that repeats counts as one document, one row for each of
    its distinct texts' overlaps at most; items with equal keys likewise; NULL keys are kept.  Empty
    tables on either side give no rows.  Other columns are not read, whatever their names.  A task compares
    one pair of texts at a time, whatever their length.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(key).alias("__key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    items = tests.select(F.col(item).alias("__item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("__test"))
    items = settle(items.distinct().withColumn("__digest", F.md5("__test")), "items")
    kind = rows.schema["__key"].dataType.simpleString()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, begins = _words(strings(batch.column("__test")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__digest"), batch.column("__test"), pa.array(np.diff(begins), pa.int64())],
                names=["__digest", "__test", "total"],
            )

    distinct = items.select("__digest", "__test").distinct()
    distinct = settle(distinct.mapInArrow(lengths, "__digest string, __test string, total long"), "item-texts")
    short = distinct.select("total").where(F.col("total") < SPAN).distinct()
    masks = seed_masks({r["total"] for r in short.collect()})
    passages = settle(shared_passages(distinct.select("__digest", "__test"), least_words), "passages")
    spans = passages.groupBy("__digest").agg(
        F.sort_array(F.collect_list(F.struct("n", "passage", "item_from", "item_to"))).alias("spans")
    )

    def test_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "__test"):
            hashes, owner, begins = _words(strings(block.column("__test")))
            digests, held = block.column("__digest").to_pylist(), block.column("spans").to_pylist()
            for number, (span, kept) in enumerate(masks):
                at, found = seeds(hashes, owner, span, kept, number)
                if number >= len(MASKS):
                    whole = np.diff(begins)[owner[at]] == span
                    at, found = at[whole], found[whole]
                target = np.array(digests, object)[owner[at]]
                base = begins[owner[at]]
                shared = np.zeros(len(at), bool)
                # A seed leads to the passage around it that most items hold: these come last.
                for own in np.unique(owner[at]):
                    for s in held[own] or ():
                        low, high = np.searchsorted(at, begins[own] + np.array([s["item_from"], s["item_to"] - span + 1]))
                        target[low:high], shared[low:high] = s["passage"], True
                        base[low:high] = begins[own] + s["item_from"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(target, pa.string()), pa.array(shared),
                     pa.array(at - base, pa.int64())],
                    names=["seed", "target", "shared", "item_at"],
                )

    index = distinct.join(spans, "__digest", "left").select("__digest", "__test", "spans")
    index = index.mapInArrow(test_seeds, "seed long, target string, shared boolean, item_at long").distinct()
    index = settle(index, "test-seeds")
    # A filter of fixed size, 2 MB, says which seeds of documents may be among the tests'.
    spots = index.select(F.col("seed").bitwiseAND((1 << FILTER_BITS) - 1).alias("spot")).distinct()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[spots.toArrow().column(0).to_numpy()] = True
    sent = spark.sparkContext.broadcast(np.packbits(bits))

    def document_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        may = np.unpackbits(sent.value).astype(bool)
        low = np.uint64((1 << FILTER_BITS) - 1)
        for block in blocks(batches, "__text"):
            texts = strings(block.column("__text"))
            hashes, owner, begins = _words(texts)
            held = []
            for number, (span, kept) in enumerate(masks):
                at, found = seeds(hashes, owner, span, kept, number)
                hit = may[(found & low).astype(np.int64)]
                held.append((at[hit], found[hit]))
            at, found = (np.concatenate([part[i] for part in held]) for i in (0, 1))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [block.column("__key").take(pa.array(owner[at])),
                     block.column("__digest").take(pa.array(owner[at])),
                     pa.array(found.view(np.int64)), pa.array(at - begins[owner[at]], pa.int64())],
                    names=["__key", "__doc", "seed", "doc_at"],
                )

    digested = rows.withColumn("__digest", F.md5("__text"))
    hits = digested.mapInArrow(document_seeds, f"__key {kind}, __doc string, seed long, doc_at long")
    hits = settle(hits, "document-seeds")
    # One row per text, target and shift, however many seeds and copies agree on it.
    shifts = hits.select("__doc", "seed", "doc_at").distinct().join(index, "seed")
    shifts = shifts.select("__doc", "target", "shared", (F.col("doc_at") - F.col("item_at")).alias("shift"))
    shifts = settle(shifts.distinct(), "shifts")
    wanted = settle(shifts.select("__doc").distinct(), "hit-docs")
    texts = join_small(digested, wanted, F.col("__digest") == F.col("__doc"), "left_semi").dropDuplicates(["__digest"])
    texts = settle(texts.select(F.col("__digest").alias("__doc"), "__text"), "hit-texts", compression="zstd")

    def gathered(some: DataFrame) -> DataFrame:
        return some.groupBy("__doc", "target").agg(F.sort_array(F.collect_set("shift")).alias("shifts"))

    stands = passages.groupBy("passage").agg(F.min(F.struct("__digest", "item_from", "item_to")).alias("first"))
    stands = stands.select(F.col("passage").alias("target"), "first.*").join(distinct, "__digest")
    passed = gathered(shifts.where("shared")).join(stands, "target")
    passed = settle(_verified(passed, texts, least_words), "passage-overlaps")
    # Passages that a document does not hold: what it holds of their items must lie around them.
    left = shifts.where("shared").join(passed.select("__doc", "target"), ["__doc", "target"], "left_anti")
    left = left.join(passages, F.col("target") == F.col("passage"))
    around = left.select("__doc", F.col("__digest").alias("target"), (F.col("shift") - F.col("item_from")).alias("shift"))
    single = gathered(shifts.where("not shared").select("__doc", "target", "shift").unionByName(around))
    whole = distinct.select(F.col("__digest").alias("target"), "__test", F.lit(0).alias("item_from"), F.col("total").alias("item_to"))
    single = settle(_verified(single.join(whole, "target"), texts, least_words), "item-overlaps")

    named = items.select("__digest", "__item").distinct()
    members = passages.join(named, "__digest").select(
        F.col("passage").alias("target"), "__item", "item_from", "total", F.col("passage")
    ).unionByName(named.join(distinct, "__digest").select(
        F.col("__digest").alias("target"), "__item", F.lit(0).cast("long").alias("item_from"), "total",
        F.lit(None).cast("string").alias("passage"),
    ))
    found = passed.unionByName(single)
    members = members.join(found.select("target").distinct(), "target", "left_semi")
    members = settle(members.groupBy("target", "__item").agg(F.min(F.struct("item_from", "total", "passage")).alias("at")), "members")
    sizes = members.groupBy("target").agg(F.min(F.struct("__item", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
    # A text of several items is a passage of its own, named by its digest.
    passage = F.coalesce("first.at.passage", F.when(F.col("n") > 1, F.col("target")))
    first = sizes.select("target", F.col("first.__item").alias("__item"), F.col("first.at").alias("at"), passage.alias("passage"))
    keyed = settle(found.join(hits.select("__key", "__doc").distinct(), "__doc"), "keyed-overlaps")
    shared = sizes.where("n > 1").select("target", passage.alias("passage"))
    anchors = keyed.join(shared, "target", "left_semi").groupBy("target").agg(F.min("__key").alias("__anchor"))
    bearers = keyed.join(anchors, "target").where(F.col("__key").eqNullSafe(F.col("__anchor"))).drop("__anchor")
    every = keyed.join(first, "target").unionByName(bearers.join(members, "target").join(shared, "target"))
    longest = F.max(F.struct(
        "words", "equal", (F.col("begin") + F.col("at.item_from")).alias("item_from"),
        F.col("at.total").alias("item_words"), "doc_from",
    )).alias("best")
    return every.groupBy("__key", "__item", "passage").agg(longest).select(
        F.col("__key").alias(key), F.col("__item").alias(item), "best.*", "passage"
    )
