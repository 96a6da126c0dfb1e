"""Sheets, JSON lines and label files; everything is read as text, nothing is inferred."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from screenloom.functions.keys import clean

# Texts that a sheet means as missing, names of the column with a reviewer's decision, and decisions.
MISSING = ("", "NA", "N/A", "n/a", "nan", "NaN", "NULL", "null", "None", "<NA>", "#N/A")
DECISION_COLUMNS = ("human_decision", "human_review", "review_decision", "decision", "final_decision")
INCLUDES, EXCLUDES = ("INCLUDE", "INCLUDE_TA", "Y", "YES", "1"), ("EXCLUDE", "N", "NO", "0")


def read_sheet(spark: SparkSession, path: str, header_row: int = 1) -> DataFrame:
    """A CSV or XLSX file whose header stands in line ``header_row`` (0 is the first), with the row's place as ``ord``.

    Texts that mean missing become null. Another suffix is an error; quoted line breaks are kept.
    """
    if path.lower().endswith(".xlsx"):
        raw = _xlsx(spark, path)
    elif path.lower().endswith(".csv"):
        top = [r["value"] for r in spark.read.text(path).limit(header_row + 1).collect()]
        width = len(next(csv.reader(top[-1:]), [])) if len(top) > header_row else 1
        schema = ", ".join(f"c{k} string" for k in range(max(1, width)))
        lines = spark.read.schema(schema).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
        raw = lines.select(F.monotonically_increasing_id().alias("ord"), F.array(*lines.columns).alias("cells"))  # one file is one task here
    else:
        raise ValueError(f"neither .csv nor .xlsx: {path}")
    head = raw.filter(F.col("ord") == header_row).first()
    names = [re.sub("^﻿", "", c or f"_c{k}").strip() for k, c in enumerate(head["cells"])] if head else []
    cells = [F.get("cells", F.lit(k)).alias(n) for k, n in enumerate(names)]
    rows = raw.filter(F.col("ord") > header_row).select("ord", *cells)
    return rows.select("ord", *[F.when(~F.trim(f"`{n}`").isin(*MISSING), F.col(f"`{n}`")).alias(n) for n in names])


def _xlsx(spark: SparkSession, path: str) -> DataFrame:
    """(ord, cells) of a workbook's first sheet, by the standard library; a workbook is one task."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}

    def place(ref: str) -> int:
        n = 0
        for c in re.match("[A-Z]+", ref)[0]:
            n = n * 26 + ord(c) - 64
        return n - 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                book = zipfile.ZipFile(io.BytesIO(content))
                shared = [] if "xl/sharedStrings.xml" not in book.namelist() else ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall("m:si", ns)]
                out = []
                for k, row in enumerate(ElementTree.fromstring(book.read("xl/worksheets/sheet1.xml")).iterfind(".//m:row", ns)):
                    cells: dict[int, str | None] = {}
                    for cell in row.findall("m:c", ns):
                        value = cell.find("m:v", ns)
                        text = "".join(t.text or "" for t in cell.iter(f"{{{ns['m']}}}t")) if cell.get("t") == "inlineStr" else value.text if value is not None else None
                        cells[place(cell.get("r"))] = shared[int(text)] if cell.get("t") == "s" and text else text
                    out.append((int(row.get("r", k + 1)) - 1, [cells.get(i) for i in range(max(cells, default=-1) + 1)]))
                yield pd.DataFrame(out, columns=["ord", "cells"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "ord bigint, cells array<string>")


def flat_records(sheet: DataFrame, columns: dict[str, str]) -> tuple[DataFrame, DataFrame | None]:
    """Records and labels of a sheet with a record per row. ``columns`` names record_id, year, title, abstract and,
    where there is one, decision. Missing values are 'NA', a missing title ''; of repeated ids the last label counts."""
    lacking = [c for k, c in columns.items() if c not in sheet.columns and k != "decision"]
    if lacking:
        raise ValueError(f"missing columns: {lacking}")
    rows = sheet.filter(F.col(f"`{columns['record_id']}`").isNotNull())
    records = rows.select("ord", *[clean(F.col(f"`{columns[k]}`"), "" if k == "title" else "NA").alias(k) for k in ("record_id", "year", "title", "abstract")])
    if columns.get("decision") not in sheet.columns:
        return records, None
    labels = rows.select(F.trim(f"`{columns['record_id']}`").alias("record_id"), F.trim(f"`{columns['decision']}`").alias("label"), "ord")
    return records, labels.groupBy("record_id").agg(F.max_by("label", "ord").alias("label"))


def paired_records(sheet: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Records of a sheet whose decision stands in the row after the record; 'NA' if that row has an id of its own.

    The next row is found by a window over blocks of rows and the first row of the next block, so no task sorts
    the whole sheet.
    """
    own = sheet.select("ord", *[F.col(f"`{c}`").alias(k) for k, c in columns.items()]).withColumn("block", F.floor(F.col("ord") / 100_000))
    first = own.groupBy("block").agg(F.min_by(F.struct("record_id", "decision"), "ord").alias("n")).select((F.col("block") - 1).alias("block"), "n")
    w = Window.partitionBy("block").orderBy("ord")
    after = F.coalesce(F.lead(F.struct("record_id", "decision")).over(w), F.col("n"))
    rows = own.join(F.broadcast(first), "block", "left").withColumn("next", after)  # a row per 100,000 lines of one sheet
    label = F.when(F.col("next.record_id").isNull(), clean(F.col("next.decision"), "NA")).otherwise("NA")
    return rows.filter("record_id IS NOT NULL").select("ord", clean(F.col("record_id"), "NA").alias("record_id"), *[clean(F.col(k), "" if k == "title" else "NA").alias(k) for k in ("year", "title", "abstract")], label.alias("label"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under a schema; blank lines and lines that can't be read are left out."""
    parsed = F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    rows = spark.read.text(path).filter("trim(value) <> ''").select(parsed.alias("r"))
    return rows.filter("r IS NOT NULL AND r._bad IS NULL").select("r.*").drop("_bad")


def last_by(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by ``order``: a line that was written again replaces the one before. A null key has no row."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), order).alias("r")).select(key, "r.*")


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, label) of a file with one JSON object."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("record_id", "label"))


def reviewed(sheet: DataFrame) -> DataFrame:
    """(record_id, label) of a reviewed sheet: the first of the known decision columns; blank decisions are skipped and
    others that mean nothing are labelled 'unknown'."""
    column = next((c for c in DECISION_COLUMNS if c in sheet.columns), None)
    if column is None:
        raise ValueError("no decision column")
    said = F.upper(F.trim(column))
    label = F.when(said.isin(*INCLUDES), "INCLUDE").when(said.isin(*EXCLUDES), "EXCLUDE").otherwise("unknown")
    return sheet.filter(F.coalesce(said, F.lit("")) != "").select("record_id", label.alias("label"))
