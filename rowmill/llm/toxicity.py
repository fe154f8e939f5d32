"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled texts: the ordinary one holds the words that most
ordinary texts share, the toxic one holds besides them the passages that mark toxic texts.  A window
of a text that gets shorter with the toxic dictionary than with the ordinary one speaks for toxic.
Thresholds on how much shorter, and how often, are calibrated on labelled texts kept apart.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.blocks import blocks, loaded, strings, unload
from rowmill.session import settle, ship_package

# Grams of any SHORT characters, and of LONG ones from the space before a word on.
SHORT, LONG = 5, 8
COUNTED_BYTES = 1 << 18
# Places of a gram that one text counts for.
REPEATS = 4
# A gram marks toxic texts if LEAST_TEXTS of them hold it, if so many of its places are in toxic texts that less
# than CHANCE of all grams would be there so often by chance, and if it is RATIO times as frequent there: the
# same at every size of the sample.
LEAST_TEXTS, CHANCE, RATIO = 5, 1e-4, 4.0
WINDOW_WORDS = 12
LEVEL = 13
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def _even(text: str) -> str:
    """Lower case, one space between words and at both ends."""
    return " " + " ".join(text.lower().split()) + " "


class Meter:
    """Bytes that windows of a text save with the toxic dictionary."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, min_match=4, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        self.ordinary, self.toxic = (
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(held, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                compression_params=settings,
            ).compress
            for held in (ordinary, toxic)
        )

    def saved(self, text: str) -> np.ndarray:
        """One number per run of WINDOW_WORDS words, over the whole text."""
        words = text.lower().split()
        windows = [
            (" " + " ".join(words[i : i + WINDOW_WORDS]) + " ").encode() for i in range(0, len(words), WINDOW_WORDS)
        ]
        if not windows:
            return np.zeros(1)
        plain, marked = self.ordinary, self.toxic
        return np.array([len(plain(window)) - len(marked(window)) for window in windows], float)

    def features(self, text: str) -> np.ndarray:
        """What the score is a function of: mean saving, shares of windows that save at least 1, 2, 3
        and 5 bytes, the largest saving, and how short the text is."""
        saved = self.saved(text)
        return np.array([
            1.0, saved.mean(), *(np.mean(saved >= least) for least in (1, 2, 3, 5)),
            min(saved.max(), 8.0) / 8, 1 / len(saved),
        ])


def probability(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))


def _fit(features: np.ndarray, labels: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Logistic weights by Newton's method; the ridge keeps separable labels finite."""
    weights = np.zeros(features.shape[1])
    for _ in range(50):
        chance = probability(features, weights)
        slope = features.T @ (chance - labels) + ridge * weights
        curve = (features * (chance * (1 - chance))[:, None]).T @ features + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def sample_labelled(
    docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, per_class: int
) -> DataFrame:
    """(key, text, label) of at most ``per_class`` labelled rows of each label, the smallest by a hash
    of the key; equal texts once.  The list of keys is bounded by that, so it is broadcast.

    Of a key with several labels the largest counts, and so it does of equal texts, which go under the
    smallest of their keys: the sample depends on the rows alone, not on their order or their files.
    """
    chosen = None
    held = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
    held = held.where("__key is not null and __label is not null").groupBy("__key").agg(F.max("__label").alias("__label"))
    for value in (0, 1):
        some = held.where(F.col("__label") == value).orderBy(F.xxhash64("__key"), "__key").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    chosen = settle(chosen, "labelled-keys")
    rows = docs.select(F.col(key).alias("__key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    found = rows.join(F.broadcast(chosen), "__key").groupBy(F.sha2("__text", 256).alias("__digest"))
    once = found.agg(F.min("__key").alias("__key"), F.max("__label").alias("__label"), F.any_value("__text").alias("__text"))
    return settle(once.select("__key", "__text", "__label"), "labelled")


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    per_class: int = 4000, ordinary_words: int = 24_000, fragments: int = 2000, word_chars: int = 64,
) -> Model | None:
    """Dictionaries and calibrated weights from a bounded sample of the labelled rows.

    ``per_class`` bounds the sample, ``ordinary_words`` and ``fragments`` what the dictionaries hold, in
    which words longer than ``word_chars`` have no place; the marking grams are as many as the test finds
    in the sample.  None where the labels lack one of the two classes, as for an empty table: nothing can
    be compared then.  Repeated rows, copies and labels that differ are settled by ``sample_labelled``.
    Other columns are not read.
    """
    ship_package(docs.sparkSession)
    rows = sample_labelled(docs, labels, label, key, text, per_class)
    # Three quarters of the sample make the dictionaries, one quarter the thresholds.
    rows = rows.withColumn("__fit", F.pmod(F.xxhash64(F.lit("fit"), "__key"), F.lit(4)) == 0).repartition(16, "__key")
    rows = settle(rows, "training")
    made = {r["__label"]: r["n"] for r in rows.where("not __fit").groupBy("__label").agg(F.count(F.lit(1)).alias("n")).collect()}
    kept = {r["__label"] for r in rows.where("__fit").groupBy("__label").agg(F.count(F.lit(1))).collect()}
    if not (made.get(0) and made.get(1) and kept == {0, 1}):
        return None
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each gram the toxic texts that hold it and its places in toxic and in ordinary texts, of which
        a text counts for REPEATS at most; without a gram the places there are."""
        unload()
        for batch in blocks(batches, "__text", COUNTED_BYTES):
            texts, places = Counter(), {0: Counter(), 1: Counter()}
            for content, value in zip(strings(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                content = _even(content)
                begins = [i for i, c in enumerate(content) if c == " "]
                for size, starts in ((SHORT, range(len(content) - SHORT + 1)), (LONG, begins)):
                    own = Counter(content[i : i + size] for i in starts if i + size <= len(content))
                    places[value].update({gram: min(n, REPEATS) for gram, n in own.items()})
                    if value:
                        texts.update(own.keys())
                places[value][""] += len(content)
            grams = list(places[0].keys() | places[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.string()), *(pa.array([n[g] for g in grams], pa.int64()) for n in (texts, places[1], places[0]))],
                names=["gram", "d", "t", "o"],
            )

    making = rows.where("not __fit").select("__text", "__label")
    grams = settle(making.mapInArrow(counted, "gram string, d long, t long, o long").groupBy("gram").agg(
        F.sum("d").alias("d"), F.sum("t").alias("t"), F.sum("o").alias("o")
    ), "grams")
    total, every = grams.where("gram = ''").first(), grams.count()
    share = total["t"] / (total["t"] + total["o"])
    # By chance a gram's places are in toxic texts as often as all places are; the logarithm of how unlikely so
    # many there are is at least the divergence times their number, and every gram had that chance.
    held = F.col("t") + F.col("o")
    seen = F.col("t") / held
    divergence = seen * F.ln(seen / share) + F.coalesce((1 - seen) * F.ln((1 - seen) / (1 - share)), F.lit(0.0))
    ratio = (F.col("t") / total["t"]) / ((F.col("o") + 1) / total["o"])
    marking = grams.where("gram != '' and t > 0").where(
        (F.col("d") >= LEAST_TEXTS) & (seen > share) & (held * divergence > math.log(every / CHANCE)) & (ratio > RATIO)
    ).select("gram")
    marks = frozenset(r["gram"] for r in marking.collect())

    def covered(content: str) -> list[bool]:
        """Which characters of a text lie in marking grams."""
        inside = [False] * len(content)
        for size in (SHORT, LONG):
            for i in range(len(content) - size + 1):
                if content[i : i + size] in marks:
                    inside[i : i + size] = [True] * size
        return inside

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of marking grams in toxic texts."""
        for batch in batches:
            found: Counter[str] = Counter()
            for content in strings(batch.column(0)):
                content = _even(content)
                inside = [False, *covered(content), False]
                edges = [i for i in range(len(inside) - 1) if inside[i] != inside[i + 1]]
                found.update({content[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)})
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["part", "n"]
            )

    parts = making.where("__label = 1").mapInArrow(passages, "part string, n long").groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.orderBy(F.desc("n"), "part").limit(fragments).collect()
    words = making.where("__label = 0").select(F.explode(F.array_distinct(F.split(F.lower("__text"), r"\s+"))).alias("word"))
    words = words.where((F.col("word") != "") & (F.length("word") <= word_chars)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = words.orderBy(F.desc("n"), "word").limit(ordinary_words).collect()
    words = [r for r in words if not any(covered(f" {r['word']} "))]
    # What is frequent stands last, where it is nearest to a window.
    ordinary = (" " + " ".join(r["word"] for r in reversed(words)) + " ").encode()
    marked = ""
    for part in parts:
        if part["part"] not in marked:
            marked = part["part"] + marked
    toxic = marked.encode() + ordinary

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = loaded(Meter, ordinary, toxic)
        for batch in batches:
            values = [meter.features(content).tolist() for content in strings(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.list_(pa.float64())), batch.column(1)], names=["x", "y"]
            )

    fitted = rows.where("__fit").select("__text", "__label").mapInArrow(measured, "x array<double>, y int").collect()
    weights = _fit(np.array([r["x"] for r in fitted]), np.array([r["y"] for r in fitted], float))
    # The sample holds as many of each class as it may, so its share of toxic texts is not the labels': the odds of
    # a score are those of all labels, whether the sample's bound was reached or not.
    each = labels.where(F.col(key).isNotNull()).groupBy(F.col(label).cast("int").alias("y")).agg(F.count_distinct(key).alias("n"))
    every = {r["y"]: r["n"] for r in each.collect()}
    taken = {value: min(1.0, per_class / every[value]) for value in (0, 1)}
    weights[0] += math.log(taken[0] / taken[1])
    return Model(ordinary, toxic, tuple(weights.tolist()))


def toxicity(text: Column, model: Model | None) -> Column:
    """Score from 0 to 1 of the whole text, higher where toxic is likelier.

    NULL counts as empty; an empty text has one window that saves nothing.  Without a model every
    score is 0.  Repeated rows get equal scores.  A text of any length is read whole, window by window.
    """
    if model is None:
        return F.lit(0.0)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        meter, weights = loaded(Meter, model.ordinary, model.toxic), np.array(model.weights)
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        found = [meter.features(text) for block in blocks(iter([batch]), "text") for text in strings(block.column(0))]
        return pa.array(probability(np.array(found), weights) if found else [], pa.float64())

    return scored(text.cast("string"))
