"""Secrets in texts, told from copied examples by who owns them across the corpus.

Texts are scanned for spans of known forms and for long mixed strings that may be credentials.  The
hash of each candidate string is counted over distinct owners and distinct repositories of the whole
corpus: what many owners hold is an example that was copied, what one or few hold looks live.  A mixed
string becomes a span only where its ownership says so; spans of known forms stay either way and
carry the verdict.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.blocks import blocks, strings, unload
from rowmill.session import settle, ship_package

# The known forms, in the order of their kinds, and the least length of the whole or the value.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "owned")

# Candidates of no known form: runs of the characters credentials are made of, with letters, digits and
# this many different characters.
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
LEAST_DISTINCT = 10
# A candidate that more owners than this hold is a copied example.
MOST_OWNERS = 2


def _random_like(value: str) -> bool:
    return len(set(value)) >= LEAST_DISTINCT and any(c.isdigit() for c in value) and any(c.isalpha() for c in value)


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, secret) of all spans, by start and then kind.

    Of an assignment the secret is its value, else the span itself.  The last kind, of no known form, is
    only a candidate: runs that overlap no span of the others.
    """
    found = [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    runs = [(3, m.start(), m.end(), m[0]) for m in RUN.finditer(text) if _random_like(m[0])]
    if runs:
        taken = sorted((start, end) for _, start, end, _ in found)
        at, reach = 0, -1
        for run in runs:
            # The furthest end of the known spans that begin before this run ends.
            while at < len(taken) and taken[at][0] < run[2]:
                reach = max(reach, taken[at][1])
                at += 1
            if reach <= run[1]:
                found.append(run)
    return sorted(found, key=lambda span: (span[1], span[0]))


def ownership(held: DataFrame) -> DataFrame:
    """One row (secret, repositories, owners) per candidate hash of ``held`` (secret, owner, repository).

    Distinct pairs are taken before the shuffle, in each task, so a string that one owner repeats or that
    stands in a third of all rows sends one row per task and owner.  NULL owners and NULL repositories
    count as one each.
    """
    pairs = held.select("secret", "owner", "repository").distinct()
    by_owner = pairs.groupBy("secret", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("secret").agg(F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def find_secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str | Column = "source",
    repository: str | Column = "doc_id", most_owners: int = MOST_OWNERS,
) -> DataFrame:
    """One row (key, spans) for every row of ``docs``: an array of (kind, start, end, secret, repositories,
    owners, live) by start and then the order of KINDS; ends are exclusive, both in code points.

    ``secret`` is the SHA-256 of the string, never the string itself.  ``live`` says that at most
    ``most_owners`` distinct owners hold it.  Spans of kind ``owned`` are listed only if live.

    NULL texts count as empty and have no spans.  Repeated rows and NULL keys keep their row.  A NULL
    owner or repository is one of its own.  Other columns are not read, an empty table gives no rows.
    Texts are scanned whole; candidates of a text are held by one task, their counts are not: hashes are
    counted by shuffles over (hash, owner), and a hash that a third of all spans share is split.
    """
    ship_package(docs.sparkSession)
    chosen = lambda c: F.col(c) if isinstance(c, str) else c
    rows = docs.select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text"),
        chosen(owner).cast("string").alias("owner"), chosen(repository).cast("string").alias("repository"),
    )
    kind = rows.schema["key"].dataType.simpleString()
    span = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("secret", pa.binary())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        for block in blocks(batches, "text"):
            spans = [
                [(k, i, j, hashlib.sha256(secret.encode()).digest()) for k, i, j, secret in candidates(content)]
                for content in strings(block.column("text"))
            ]
            named = [[dict(zip(("kind", "start", "end", "secret"), one, strict=True)) for one in own] for own in spans]
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), block.column("owner"), block.column("repository"), pa.array(named, pa.list_(span))],
                names=["key", "owner", "repository", "spans"],
            )

    listed = "array<struct<kind:int,start:bigint,end:bigint,secret:binary>>"
    found = rows.mapInArrow(scanned, f"key {kind}, owner string, repository string, spans {listed}")
    # Stored with a number per row, which equal rows and NULL keys are told apart by.
    found = settle(found.withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    each = found.select("row", "owner", "repository", F.inline("spans"))
    counts = settle(ownership(each), "secret-owners")
    judged = each.select("row", "kind", "start", "end", "secret").join(counts, "secret")
    live = F.col("owners") <= most_owners
    judged = judged.where((F.col("kind") < len(KINDS) - 1) | live)
    names = F.array(*[F.lit(name) for name in KINDS])
    verdict = F.struct(
        "start", "kind", "end", F.lower(F.hex("secret")).alias("secret"), "repositories", "owners", live.alias("live")
    )
    by_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(verdict)).alias("held"))
    by_row = by_row.withColumn("held", F.transform("held", lambda s: F.struct(
        names[s["kind"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["secret"].alias("secret"),
        s["repositories"].alias("repositories"), s["owners"].alias("owners"), s["live"].alias("live"),
    )))
    with_spans = found.where(F.size("spans") > 0).select("row", "key").join(by_row, "row", "left")
    without = found.where(F.size("spans") == 0).select("row", "key", F.lit(None).cast(by_row.schema["held"].dataType).alias("held"))
    empty = F.array().cast(by_row.schema["held"].dataType)
    return with_spans.unionByName(without).select(F.col("key").alias(key), F.coalesce("held", empty).alias("spans"))
