"""Results as files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenloom.functions.keys import escape_html
from screenloom.operators.references import ris_lines


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_review_csv(df: DataFrame, path: str) -> None:
    """With a header in each part and quotes doubled, so that sheets with line breaks survive; blanks at the ends of cells stay."""
    own = {"header": True, "escape": '"', "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**own).csv(path)


def write_ris(records: DataFrame, path: str) -> None:
    ris_lines(records).select(F.concat("ris", F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def write_audit(df: DataFrame, path: str) -> None:
    """Side records, a folder per reason; reasons without a row make none."""
    df.write.mode("overwrite").partitionBy("reason").json(path)


def worklist_html(rows: DataFrame) -> DataFrame:
    """A table row of HTML per item (number, title, doi)."""
    cell = lambda c: F.concat(F.lit("<td>"), escape_html(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>"))
    return rows.select("number", F.concat(F.lit("<tr>"), cell("number"), cell("title"), cell("doi"), F.lit("</tr>")).alias("value"))
