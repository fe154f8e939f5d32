"""Rows out of XML, envelope JSON and HTML (SRC17-SRC21)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_xml_records(spark: SparkSession, path: str, row_tag: str, ddl: str) -> DataFrame:
    """SRC17: one row per element; a missing child is NULL in its own row only."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(ddl).load(path)


def envelope_rows(replies: DataFrame, *carried: str, items: str = "data") -> DataFrame:
    """SRC18: the reply's list as rows, with envelope fields copied to each."""
    return replies.select(*carried, F.explode(items).alias("__item")).select(*carried, "__item.*")


def named_value(pairs: Column, name: str, type_name: str = "int") -> Column:
    """SRC20: the content of the pair called ``name``, typed; NULL if absent or not of the type."""
    match = F.filter(pairs, lambda pair: pair["name"] == name)
    return F.get(match, F.lit(0))["content"].try_cast(type_name)


def source_rows(replies: DataFrame, source_name: str, items: str = "data") -> DataFrame:
    """SRC21: the rows of the lists published under ``source_name``."""
    chosen = F.filter(items, lambda entry: entry["sourceName"] == source_name)
    lists = replies.select(F.explode(chosen).alias("__list"))
    return lists.select(F.explode("__list.data").alias("__row")).select("__row.*")


COMMENT = r"(?s)<!--.*?-->"
ANCHOR_TAG = r"""(?i)<a(\s(?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>"""
ATTRIBUTE = r"""[^\s=>"'/]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
# fixed values: character references with a name that turn up in addresses
ENTITIES = {"&quot;": '"', "&apos;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}
_NUMBERED = r"(?i)^&#(?:x([0-9a-f]{1,6})|([0-9]{1,7}));"


def _numbered(part: Column) -> Column:
    """A leading ``&#N;`` or ``&#xN;`` as its character; one that names no character stays."""
    digits = F.regexp_extract(part, _NUMBERED, 1)
    code = F.coalesce(
        F.conv(F.when(digits != "", digits), 16, 10).try_cast("bigint"), F.regexp_extract(part, _NUMBERED, 2).try_cast("bigint")
    )
    sound = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(F.when(sound, code).otherwise(32)), 8, "0")), "UTF-32")
    return F.when(sound, F.concat(character, F.regexp_replace(part, _NUMBERED, ""))).otherwise(part)


def decoded(value: Column) -> Column:
    """Text with its numbered and its commonest named character references resolved, each once."""
    plain = F.array_join(F.transform(F.split(value, "(?=&)"), _reference), "")
    return F.when(F.contains(value, F.lit("&")), plain).otherwise(value)


def _reference(part: Column) -> Column:
    found = _numbered(part)
    for name, character in ENTITIES.items():
        rest = F.concat(F.lit(character), F.substr(part, F.lit(len(name) + 1)))
        found = F.when(F.startswith(part, F.lit(name)), rest).otherwise(found)
    return found


def _attribute(tag: Column, name: str) -> Column:
    """The value of the tag's first attribute called ``name``; NULL without one."""
    pairs = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0))
    pair = F.get(F.filter(pairs, lambda pair: pair.rlike(f"(?i)^{name}\\s*=")), F.lit(0))
    value = F.regexp_replace(pair, r"^[^=]*=\s*", "")
    return decoded(F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2"))


def html_links(pages: DataFrame, key: str, html: str = "html", css_class: str | None = None) -> DataFrame:
    """SRC19: the ``href`` of every anchor, in any attribute order.

    Anchors in comments are left out, a quoted value may hold ``>``, and character references are
    resolved.  With ``css_class``, only anchors whose class list has that word, or those words side by side.
    """
    text = F.regexp_replace(html, COMMENT, "")
    tags = pages.select(key, F.explode(F.regexp_extract_all(text, F.lit(ANCHOR_TAG), F.lit(1))).alias("tag"))
    links = tags.select(key, _attribute(F.col("tag"), "href").alias("href"), _attribute(F.col("tag"), "class").alias("css"))
    links = links.where(F.col("href").isNotNull())
    if css_class is not None:
        listed = F.concat(F.lit(" "), F.regexp_replace("css", r"\s+", " "), F.lit(" "))
        links = links.where(F.contains(listed, F.lit(f" {' '.join(css_class.split())} ")))
    return links.select(key, "href")
