"""RIS files: tagged lines, one record after the other."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.functions.keys import first_year

TAG = re.compile(r"^([A-Z][A-Z0-9])  - ?(.*)$")
CLOSING = "\nER  -"
SCHEMA = "source_file string, block bigint, pos bigint, tags map<string,array<string>>"


def parse(text: str) -> list[dict[str, list[str]]]:
    """Records of a file's text. A tag may repeat, lines without a tag go on with the value before, ER or the end of the
    file closes a record; a record without a tag is none."""
    records, tags, last = [], {}, None
    for line in text.lstrip("﻿").splitlines():
        found = TAG.match(line.rstrip())
        if found and found[1] == "ER":
            if tags:
                records.append(tags)
            tags, last = {}, None
        elif found:
            last = found[1]
            tags.setdefault(last, []).append(found[2].strip())
        elif line.strip() and last:
            tags[last][-1] = f"{tags[last][-1]} {line.strip()}".strip()
    return [*records, tags] if tags else records


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, block, pos, tags) of all files under a path, in the order of block and pos within a file.

    Files are split at the lines that close records, so one of any size is read by many tasks and none holds more than a record at a time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(name, block, pos, tags) for name, block, pos, text in zip(batch["name"], batch["block"], batch["pos"], batch["value"], strict=True) for tags in parse(text)]
            yield pd.DataFrame(rows, columns=["source_file", "block", "pos", "tags"])

    parts = spark.read.option("lineSep", CLOSING).text(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1).alias("name")
    return parts.select(name, F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), "value").mapInPandas(run, SCHEMA)


def first_of(*names: str) -> F.Column:
    """First value of the named tags that isn't blank, else ''."""
    every = F.flatten(F.array(*[F.coalesce(F.col("tags")[n], F.array().cast("array<string>")) for n in names]))
    return F.coalesce(F.get(F.filter(F.transform(every, lambda v: F.trim(v)), lambda v: v != ""), F.lit(0)), F.lit(""))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records with the usual fields; missing ones are ''. ``row_no`` follows file name and place in the file."""
    rows = read_tags(spark, path).select(
        "source_file", "block", "pos", first_of("U1").alias("record_id"), first_of("T1", "TI").alias("title"), first_of("AB", "N2").alias("abstract"),
        first_year(first_of("PY", "Y1", "DA")).alias("year"), first_of("TY").alias("type"), F.lower(first_of("DO")).alias("doi"),
    )
    place = [F.lpad(F.col(c).cast("string"), 20, "0") for c in ("block", "pos")]
    return rows.withColumn("row_no", F.concat_ws("|", "source_file", *place))
