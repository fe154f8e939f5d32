"""Token counts through a cache of content digests.

Each text is looked up by the digest of its normalised content together with the digest of the
tokenizer's file.  Only texts that the cache does not know are encoded, each once however many
copies there are, and their counts are appended to the cache.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm.blocks import blocks, loaded, strings
from rowmill.session import settle, ship_package

CACHE_SCHEMA = "content binary, n_tokens long, tokenizer string"
# Words kept in each of two generations, and the longest of them in characters.
MEMO_ENTRIES = 1 << 18
MEMO_CHARS = 64


class PieceCounter:
    """Counts the pieces of whole texts as the sentencepiece library does.

    Its pieces hold spaces at their beginning only, so merges never reach over the beginning of a
    run of spaces and the pieces of a text are those of its words.  Words met before are looked up.
    A vocabulary with a space inside a piece has every text encoded whole instead.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.by_word = (
            self.library.encode("a  b", out_type=str) == ["▁a", "▁", "▁b"]
            or self.library.encode("a  b", out_type=str) == ["▁a", "▁▁", "b"]
            or "▁" in pieces
        ) and not any("▁" in piece.lstrip("▁") for piece in pieces)
        self.by_word = self.by_word and self.library.normalize("  a  é ") == "▁▁▁a▁▁é▁"
        # Pieces of words: of those met lately, and of the generation before.
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.space = 1

    def _words(self, text: str) -> list[str]:
        """Words without the one space that the library itself puts before a text."""
        text = text.replace("▁", " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [word[1:] for word in re.findall(" +[^ ]*", " " + text)]
        return text.split(" ")

    def count(self, texts: list[str]) -> list[int]:
        if not self.by_word:
            return [len(ids) for ids in self.library.encode(texts, num_threads=1)]
        split = [self._words(text) if text else [] for text in texts]
        if len(self.young) > MEMO_ENTRIES:
            self.old, self.young = self.young, {}
        young = self.young
        fresh = {word for words in split for word in words}.difference(young)
        for word in fresh & self.old.keys():
            young[word] = self.old[word]
            fresh.discard(word)
        listed = list(fresh)
        for word, ids in zip(listed, self.library.encode(listed, num_threads=1), strict=True):
            young[word] = len(ids) if word else self.space
        counts = [sum(map(young.__getitem__, words)) for words in split]
        for word in listed:
            if len(word) > MEMO_CHARS:
                del young[word]
        return counts


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts of one tokenizer version; an absent cache is an empty one."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    return stored.where(F.col("tokenizer") == version).select("content", "n_tokens")


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (key, n_bytes, n_tokens) for every row of ``docs``, in no order.

    NULL texts count as empty: 0 bytes, 0 tokens.  Rows that repeat, and NULL keys, each keep their
    row.  Other columns are not read.  An empty table gives no rows.  Content is normalised by
    turning NULL into the empty text and nothing else: the library counts every other difference.
    Texts are counted whole; a task holds one block of texts and at most 2 * MEMO_ENTRIES counts of
    words of up to MEMO_CHARS characters, longer words being counted anew each time.

    ``cache`` is a Parquet folder in a store that all executors reach, partitioned by the digest of
    the tokenizer's file.  Two runs that append the same content at a time only repeat a row.
    """
    spark = docs.sparkSession
    ship_package(spark)
    version = tokenizer_digest(tokenizer)
    content = docs.select(F.col(key).alias("__key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    content = content.withColumn("content", F.unhex(F.sha2("__text", 256)))
    digests = settle(
        content.select("__key", "content", F.octet_length("__text").cast("long").alias("n_bytes")), "digests"
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(PieceCounter, tokenizer)
        for block in blocks(batches, "__text"):
            counts = counter.count(strings(block.column("__text")))
            yield pa.RecordBatch.from_arrays(
                [block.column("content"), pa.array(counts, pa.int64())], names=["content", "n_tokens"]
            )

    # Copies meet by digest after each task has kept one of its own, then known content goes.
    once = content.select("content", "__text").dropDuplicates(["content"])
    misses = once.join(read_cache(spark, cache, version), "content", "left_anti")
    misses.mapInArrow(counted, "content binary, n_tokens long").withColumn("tokenizer", F.lit(version)).write.mode(
        "append"
    ).partitionBy("tokenizer").parquet(cache)

    # Stored once more so that the join's sides are plain shuffles, whose hot digests AQE can split.
    known = settle(
        read_cache(spark, cache, version)
        .join(digests.select("content").distinct(), "content", "left_semi")
        .groupBy("content").agg(F.max("n_tokens").alias("n_tokens")),
        "counts",
    )
    return digests.join(known, "content").select(F.col("__key").alias(key), "n_bytes", "n_tokens")
