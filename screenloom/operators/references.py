"""References: deduplication in stages, cascading look-up, export lines, candidate matching."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenloom.functions import keys
from screenloom.session import stage


def _kept(df: DataFrame, key: str, order: str) -> DataFrame:
    """First row of each key; rows with a blank key stay. One aggregation with a combined minimum instead of a window,
    so a key with a third of all rows costs no task more than the others."""
    own = F.when(F.col(key) != "", F.concat(F.lit("k"), F.col(key))).otherwise(F.concat(F.lit("r"), F.col(order).cast("string")))
    return df.groupBy(own.alias("_k")).agg(F.min_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def _key_stages(records: DataFrame, order: str) -> list[DataFrame]:
    """The rows after each stage as (order, keys) only: titles and abstracts are never shuffled. Keys are written once."""
    keyed = {"_id": F.coalesce(F.trim("record_id"), F.lit("")), "_doi": keys.doi_key(F.col("doi")), "_title": keys.title_key_ascii(F.col("title"))}
    stages = [stage(records.select(order, *[c.alias(n) for n, c in keyed.items()]))]
    for name in keyed:
        stages.append(_kept(stages[-1], name, order))
    return stages


def dedup_stages(records: DataFrame, order: str = "row_no") -> list[DataFrame]:
    """The records after each stage: as they are, by id, by DOI, by title. Earlier rows win (``order`` is unique); a null key is blank."""
    return [records] + [records.join(kept.select(order), order, "left_semi") for kept in _key_stages(records, order)[1:]]


def dedup_funnel(records: DataFrame, order: str = "row_no") -> DataFrame:
    """Rows left after each stage."""
    names = ("raw", "after_id", "after_doi", "after_title")
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("step"), F.lit(name).alias("stage"), "n") for k, (name, df) in enumerate(zip(names, _key_stages(records, order), strict=True))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def data_quality(records: DataFrame) -> DataFrame:
    """Counts per source: missing abstracts, titles, DOIs and years, and years before 2000."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")).isin("", "NA")
    year = keys.first_year(F.col("year")).try_cast("int")
    return records.groupBy("source_file").agg(F.count("*").alias("n"), F.count_if(blank("abstract")).alias("no_abstract"), F.count_if(blank("title")).alias("no_title"), F.count_if(blank("doi")).alias("no_doi"), F.count_if(year.isNull()).alias("no_year"), F.count_if(year < 2000).alias("before_2000"))


def cascade_lookup(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """The id of each row (key, doi, url, title) by DOI, else by URL, else by title. ``mapping``: (map_id, doi, url, title, ord).

    Presence of a key decides: a DOI that is known with a blank id ends the cascade, and the row is unmatched. Of
    mapping rows with the same key the last (largest ord) counts. Blank keys match nothing; each gets a value of its own for
    the join, so that however many there are, they are no hot key.
    """
    made = {"doi": keys.doi_key, "url": keys.url_key, "title": keys.title_key_words}
    alone = F.concat(F.lit("\0"), F.xxhash64(*rows.columns).cast("string"))
    out = rows.withColumns({f"k_{n}": F.when(f(F.col(n)) != "", f(F.col(n))).otherwise(alone) for n, f in made.items()})
    for name, make in made.items():
        side = mapping.withColumn("_k", make(F.col(name))).filter("_k <> ''").groupBy("_k").agg(F.max_by("map_id", "ord").alias(f"id_{name}"), F.lit(True).alias(f"hit_{name}"))
        out = out.join(side, out[f"k_{name}"] == side["_k"], "left").drop("_k")
    found = F.when(F.col("hit_doi"), F.col("id_doi")).when(F.col("hit_url"), F.col("id_url")).when(F.col("hit_title"), F.col("id_title"))
    how = F.when(F.col("hit_doi"), "doi").when(F.col("hit_url"), "url").when(F.col("hit_title"), "title")
    ok = F.coalesce(found, F.lit("")) != ""
    return out.select("key", F.when(ok, found).alias("map_id"), F.when(ok, how).otherwise("unmatched").alias("method"))


def ris_lines(records: DataFrame, default_type: str = "JOUR") -> DataFrame:
    """One text per record in RIS form; blank fields are left out, a DOI loses its resolver."""
    line = lambda tag, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{tag}  - "), c))
    kind = keys.lookup(keys.RIS_TYPES, F.upper("type"), default_type)
    abstract = F.when(F.col("abstract") != "NA", F.col("abstract"))
    doi = F.regexp_replace(F.lower("doi"), r"https?://doi\.org/", "")
    return records.select("row_no", F.concat_ws("\n", line("TY", kind), line("T1", F.col("title")), line("PY", F.col("year")), line("AB", abstract), line("DO", doi), line("U1", F.col("record_id")), F.lit("ER  - ")).alias("ris"))


@F.pandas_udf(T.DoubleType())
def title_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Longest-matching-blocks ratio of two keys; 0 if one is blank. Arrow batches."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a.fillna(""), b.fillna(""), strict=True)])


def best_candidates(rows: DataFrame, candidates: DataFrame, accept: int = 82) -> DataFrame:
    """Best candidate per row by title ratio and year. ``rows``: (key, year); ``candidates``: (key, ord, doi,
    cand_title, cand_year, ratio). Equal years add 5, more than two apart take 15; the first of equals wins; candidates
    without a DOI and confidence 0 don't count."""
    both = rows.join(candidates, "key").filter("doi IS NOT NULL AND doi <> ''")
    base = F.round(F.col("ratio") * 100).cast("int")
    apart = F.abs(F.col("year").try_cast("int") - F.col("cand_year"))
    conf = F.when(apart == 0, F.least(F.lit(100), F.col("base") + 5)).when(apart > 2, F.greatest(F.lit(0), F.col("base") - 15)).otherwise(F.col("base"))
    rated = both.withColumn("base", base).withColumn("conf", conf).filter("conf > 0")
    best = rated.groupBy("key").agg(F.max_by(F.struct("doi", "conf", "cand_title"), F.struct("conf", -F.col("ord"))).alias("b"))
    return best.select("key", F.when(F.col("b.conf") >= accept, F.col("b.doi")).alias("doi"), F.col("b.conf").alias("confidence"), F.col("b.cand_title").alias("match_title"))


def overlap(seed: DataFrame, corpus: DataFrame, key: str = "record_id") -> DataFrame:
    """Ids of the seed that stand in the corpus."""
    return seed.select(key).distinct().join(corpus.select(key), key, "left_semi")
