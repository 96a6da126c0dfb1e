"""Items of a reference library: parents with attachments as children, from a JSON dump or pages of one."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = """data struct<key:string,parentItem:string,itemType:string,contentType:string,filename:string,title:string,linkMode:string,md5:string,
  DOI:string,url:string,date:string,note:string,creators:array<struct<firstName:string,lastName:string,name:string>>>"""


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of one or more files with a JSON array each, as pages were saved."""
    return spark.read.schema(SCHEMA).option("multiLine", True).json(path).select("data.*").filter("key IS NOT NULL")


def is_pdf_attachment() -> Column:
    """An attachment of type PDF, or whose file name or title ends in .pdf."""
    named = F.lower(F.coalesce("filename", F.lit(""))).endswith(".pdf") | F.lower(F.coalesce("title", F.lit(""))).endswith(".pdf")
    return (F.col("itemType") == "attachment") & (F.coalesce(F.col("contentType") == "application/pdf", F.lit(False)) | named)


def authors() -> Column:
    """'Last, First' or the single name of each creator, joined by '; '."""
    one = lambda c: F.coalesce(F.nullif(c["name"], F.lit("")), F.concat_ws(", ", F.nullif(c["lastName"], F.lit("")), F.nullif(c["firstName"], F.lit(""))))
    return F.array_join(F.filter(F.transform(F.coalesce("creators", F.array()), one), lambda x: x != ""), "; ")


def inventory(items: DataFrame) -> DataFrame:
    """Parents with their fields, and the best PDF child: stored files first, then those with a checksum, then by key."""
    child = items.filter(is_pdf_attachment() & F.col("parentItem").isNotNull())
    order = F.struct((F.col("linkMode") != "imported_file").alias("a"), F.col("md5").isNull().alias("b"), "key")
    best = child.groupBy(F.col("parentItem").alias("key")).agg(F.min_by(F.struct("key", "filename"), order).alias("f"))
    parents = items.filter("parentItem IS NULL AND itemType NOT IN ('attachment', 'note')")
    return parents.join(best, "key", "left").select(
        F.col("key").alias("zotero_key"), F.col("itemType").alias("item_type"), "title", authors().alias("authors"), F.regexp_extract(F.coalesce("date", F.lit("")), r"(\d{4})", 1).alias("year"),
        F.coalesce("DOI", F.lit("")).alias("doi"), F.coalesce("url", F.lit("")).alias("url"), F.col("f").isNotNull().alias("has_pdf"), F.col("f.key").alias("pdf_attachment_key"), F.col("f.filename").alias("pdf_file"),
    )


def prompt_section(text: str, number: int, strict: bool = True) -> str:
    """The first fenced block after the heading 'System message' within section ``number`` of a prompt document.

    A missing section is an error, or the whole document if not ``strict``; a missing heading or block is an error.
    """
    start = re.search(rf"(?m)^#{{1,2}} {number}\.", text)
    if not start and strict:
        raise ValueError(f"no section {number}")
    body = text[start.start() :] if start else text
    after = re.search(r"(?m)^#{1,2} \d+\.", body[1:]) if start else None
    body = body[: after.start() + 1] if after else body
    head = re.search(r"(?im)^#+.*system message.*$", body)
    block = head and re.search(r"(?s)```[^\n]*\n(.*?)\n```", body[head.end() :])
    if not block:
        raise ValueError("no system message")
    return block[1]
