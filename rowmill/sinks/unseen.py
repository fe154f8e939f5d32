"""Idempotent append (SNK13) with an index of stored keys and staged commits.

Beside the rows of a target lie, hidden from readers of the folder, the commits that made it: each with
the keys it added, in buckets, and their bits of a Bloom filter.  A run asks the filter which of its rows
may be stored already and reads only the buckets of those.  It stages what is new and becomes the next
commit by creating a file that must not exist; who finds that another writer was first drops what this one
has stored meanwhile and tries the next number.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.operators.groups import latest_rows
from rowmill.operators.joins import join_small, unseen
from rowmill.session import settle
from rowmill.sources.files import path_exists, remove_folder

# Blocks of the filter, of 256 bits each: one key in thirty is taken for stored at about 2 million keys.
# More keys only make more rows be looked up.
BLOCKS = 1 << 16
BUCKETS = 64
# Commits after which one writes the keys and bits of all before it again.
MERGE_EVERY = 16


def without_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that lack a part of their key: nothing can tell whether they were seen before."""
    return df.where(reduce(lambda some, key: some | key, (F.col(key).isNull() for key in keys)))


def _probes(keys: list[str]) -> list[Column]:
    """Four places among the 256 bits of a key's block."""
    second = F.xxhash64(F.lit("bits"), *keys)
    return [F.shiftrightunsigned(second, 8 * i).bitwiseAND(255).cast("int") for i in range(4)]


def _block(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BLOCKS)).cast("int")


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), *keys), F.lit(BUCKETS)).cast("int")


def key_bits(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(block, w0, w1, w2, w3): the bits that the keys set in their blocks."""
    probe = F.explode(F.array(*_probes(keys)))
    each = rows.select(_block(keys).alias("block"), probe.alias("probe"))
    bit = F.expr("shiftleft(1L, probe & 63)")
    words = [F.coalesce(F.bit_or(F.when(F.shiftright("probe", 6) == i, bit)), F.lit(0)).alias(f"w{i}") for i in range(4)]
    return each.groupBy("block").agg(*words)


def may_be_stored(rows: DataFrame, bits: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``__may``: false only where the filter knows that the key is not stored."""
    merged = settle(bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)]), "key-filter")
    words = F.array(*[F.col(f"w{i}") for i in range(4)])
    hits = [
        F.get(words, F.shiftright(probe, 6)).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), probe.bitwiseAND(63))) != 0
        for probe in _probes(keys)
    ]
    marked = join_small(rows.withColumn("block", _block(keys)), merged, "block", "left")
    return marked.withColumn("__may", F.coalesce(reduce(lambda a, b: a & b, hits), F.lit(False))).select(*rows.columns, "__may")


class Commits:
    """The commits of one target, as files ``_registry/commits/N``, and where each keeps its index."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.root = f"{self.path}/_registry"
        self.jvm = spark._jvm
        self.fs = self._at(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, path: str) -> list[str]:
        at = self._at(path)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def numbers(self) -> list[int]:
        return sorted(int(name) for name in self._names(f"{self.root}/commits") if name.isdigit())

    def read(self, number: int) -> dict:
        """A commit's record; its writer may be about to write it."""
        for _ in range(100):
            stream = self.fs.open(self._at(f"{self.root}/commits/{number:08d}"))
            try:
                text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("\n"):
                return json.loads(text)
            time.sleep(0.1)
        raise ValueError(f"{self.root}/commits/{number:08d} was never finished; remove it if its writer is gone")

    def create(self, number: int, record: dict) -> bool:
        """Become commit ``number``; false where another writer already has."""
        at = self._at(f"{self.root}/commits/{number:08d}")
        if self.fs.exists(at):
            return False
        try:
            stream = self.fs.create(at, False)
        except Exception as error:  # noqa: BLE001 - the file system's own exception, through the gateway
            if self.fs.exists(at):
                return False
            raise error
        stream.write(bytearray((json.dumps(record) + "\n").encode()))
        stream.close()
        return True

    def since_merge(self, upto: int) -> list[dict]:
        """The records whose indexes together name all keys up to a commit."""
        held: list[dict] = []
        for number in reversed([n for n in self.numbers() if n <= upto]):
            held.append(self.read(number))
            if held[-1]["merged"]:
                break
        return held

    def publish(self, record: dict) -> None:
        """Move a commit's rows to where readers of the folder find them; done again, it does nothing."""
        rows = f"{self.root}/{record['id']}/rows"
        for name in self._names(rows):
            if name.startswith("part-"):
                self.fs.rename(self._at(f"{rows}/{name}"), self._at(f"{self.path}/{record['id']}-{name}"))
        remove_folder(self.spark, rows)

    def recover(self) -> None:
        """Publish what a writer committed and did not get to publish."""
        for number in self.numbers():
            record = self.read(number)
            if path_exists(self.spark, f"{self.root}/{record['id']}/rows"):
                self.publish(record)

    def index(self, records: list[dict], part: str, ddl: str) -> DataFrame | None:
        # Folders with partitions of their own, so each is read by itself.
        parts = [self.spark.read.schema(ddl).parquet(f"{self.root}/{record['id']}/{part}") for record in records]
        return reduce(DataFrame.unionByName, parts) if parts else None


@dataclass(frozen=True)
class Staged:
    """Rows of one run that no commit up to ``seen`` has stored."""

    commits: Commits
    rows: DataFrame
    ddl: str
    keys: list[str]
    seen: int


def _key_ddl(rows: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{key}` {rows.schema[key].dataType.simpleString()}" for key in keys)


def _write_index(rows: DataFrame, keys: list[str], commits: Commits, record: dict, earlier: list[dict]) -> None:
    """The keys and bits of a commit, with ``earlier`` ones merged into them."""
    stored = rows.select(*keys)
    bits = key_bits(rows, keys)
    if earlier:
        stored = stored.unionByName(commits.index(earlier, "keys", _key_ddl(rows, keys)).select(*keys))
        bits = bits.unionByName(commits.index(earlier, "bits", "block int, w0 long, w1 long, w2 long, w3 long"))
        bits = bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])
    at = f"{commits.root}/{record['id']}"
    stored.withColumn("bucket", _bucket(keys)).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{at}/keys")
    bits.hint("rebalance").write.parquet(f"{at}/bits")


def _adopt(commits: Commits, ddl: str, keys: list[str]) -> None:
    """Index the rows of a target that was written without commits, as commit 0."""
    old = [name for name in commits._names(commits.path) if not name.startswith(("_", "."))]
    if commits.numbers() or not old:
        return
    record = {"id": uuid.uuid4().hex, "merged": True}
    _write_index(commits.spark.read.schema(ddl).parquet(commits.path), keys, commits, record, [])
    commits.create(0, record)


def stage_unseen(new: DataFrame, path: str, ddl: str, keys: list[str], order: list[str]) -> Staged:
    """The rows of ``new`` whose keys the target lacks, one per key, stored but not yet appended.

    Rows ``without_key`` are left out, since a NULL equals no stored key.  Copies of a key are merged in each
    task first, so a key that fills a third of the input is looked up as one row.
    """
    commits = Commits(new.sparkSession, path)
    _adopt(commits, ddl, keys)
    commits.recover()
    seen = max(commits.numbers(), default=-1)
    rows = latest_rows(new.na.drop("any", subset=keys), keys, order)
    records = commits.since_merge(seen)
    if records:
        bits = commits.index(records, "bits", "block int, w0 long, w1 long, w2 long, w3 long")
        marked = settle(may_be_stored(rows, bits, keys), "marked")
        asked = marked.where("__may")
        buckets = [r["bucket"] for r in asked.select(_bucket(keys).alias("bucket")).distinct().collect()]
        rows = marked.where("not __may").drop("__may")
        if buckets:
            known = commits.index(records, "keys", f"{_key_ddl(new, keys)}, bucket int").where(F.col("bucket").isin(buckets))
            rows = rows.unionByName(unseen(asked.drop("__may"), known, keys).select(*rows.columns))
    return Staged(commits, settle(rows, "fresh"), ddl, keys, seen)


def commit_unseen(staged: Staged) -> bool:
    """Append staged rows; say whether there were any.

    Rows whose keys another writer has committed since they were staged are dropped, so of writers at the same
    time one stores a key.  The commit's file decides: its file system creates a file for one of two writers
    only, as HDFS does.  Rows become visible file by file; a writer that ends between commit and publication
    leaves that to the next run.
    """
    commits, keys = staged.commits, staged.keys
    while True:
        if staged.rows.isEmpty():
            return False
        number = staged.seen + 1
        record = {"id": uuid.uuid4().hex, "merged": number % MERGE_EVERY == MERGE_EVERY - 1}
        earlier = commits.since_merge(staged.seen) if record["merged"] else []
        staged.rows.write.parquet(f"{commits.root}/{record['id']}/rows")
        _write_index(staged.rows, keys, commits, record, earlier)
        if commits.create(number, record):
            commits.publish(record)
            return True
        remove_folder(commits.spark, f"{commits.root}/{record['id']}")
        newer = [n for n in commits.numbers() if n > staged.seen]
        known = commits.index([commits.read(n) for n in newer], "keys", _key_ddl(staged.rows, keys))
        left = settle(unseen(staged.rows, known, keys).select(*staged.rows.columns), "fresh")
        staged = replace(staged, rows=left, seen=newer[-1])


def append_unseen(new: DataFrame, path: str, ddl: str, keys: list[str], order: list[str]) -> bool:
    """Append the rows whose keys the target lacks, one per key; say whether there were any.

    Running it again with the same rows changes nothing, and neither do two runs at the same time.
    """
    return commit_unseen(stage_unseen(new, path, ddl, keys, order))
