"""The panel: records times models times runs, answered by a pluggable screener."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Screener = Callable[[pd.DataFrame], pd.Series]
#: What the built-in stand-in answers, by hash modulo 5.
HASH_CODES = ("INCLUDE_TA", "INCLUDE_TA", "EXCLUDE_OUTCOME", "EXCLUDE_TIME_LANGUAGE", "EXCLUDE_POPULATION")


def expand(records: DataFrame, models: list[str], k: int) -> DataFrame:
    """One request per record, model and run, by explosion; nothing is shuffled."""
    return records.withColumn("model", F.explode(F.array(*map(F.lit, models)))).withColumn("run_idx", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))


def hash_panel(requests: DataFrame) -> DataFrame:
    """Deterministic answers inside generated code: a hash of record, model and run chooses the code."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", "record_id", "model", F.col("run_idx").cast("string"))), 1, 4), 16, 10).cast("bigint")
    return requests.select("record_id", "model", "run_idx", F.get(F.array(*map(F.lit, HASH_CODES)), F.pmod(h, F.lit(5)).cast("int")).alias("code"))


def screen(requests: DataFrame, screener: Screener, text: str) -> DataFrame:
    """(record_id, model, run_idx, raw, error): raw responses of a screener, any function from a batch with record_id, model,
    run_idx and the text to strings. A screener that raises is asked once more for each row alone, so that one
    bad row spoils no others; a row that fails again has the error instead of a response.

    An external call must not be repeated: write the result to the runs table before anything reads it, filter
    before and not after it, and keep (record_id, model, run_idx) unique so that a retried task replaces its own rows.
    """

    def asked(batch: pd.DataFrame) -> pd.DataFrame:
        try:
            return pd.DataFrame({"raw": list(screener(batch)), "error": None})
        except Exception as error:  # any failure of the far side
            if len(batch) == 1:
                return pd.DataFrame({"raw": [None], "error": [str(error)]})
            return pd.concat([asked(batch.iloc[k : k + 1]) for k in range(len(batch))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch[["record_id", "model", "run_idx"]].reset_index(drop=True)
            yield own.join(asked(batch).reset_index(drop=True)) if len(batch) else own.assign(raw=None, error=None)

    return requests.select("record_id", "model", "run_idx", F.col(text).alias("text")).mapInPandas(run, "record_id string, model string, run_idx int, raw string, error string")
