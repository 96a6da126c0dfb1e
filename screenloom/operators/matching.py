"""Files found by hand against the inventory: what they say of themselves, candidates by title, one item per file."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenloom.functions import keys
from screenloom.functions.likeness import Titles, common, exact_ratio, shared_bound
from screenloom.session import cut, stage

#: Words of a title, rarest first, on which candidates are joined; the least likeness of two titles of one publication.
RARE_WORDS, LEAST_RATIO = 6, 0.80
#: Titles of either side that meet in one block; a word with more of them has several blocks.
BLOCK_TITLES = 500
#: Titles of either side that meet in one block where all pairs do.
ALL_LEFT, ALL_RIGHT = 2000, 4000
#: A pair of titles more than two years apart is rated no higher.
MOST_APART = 85.0
#: Best ratings kept beside the blocks of a task; they only spare work.
KEPT_BEST = 200_000
#: A first line of so many characters is no title.
SHORT_LINE = 25


def untracked(files: DataFrame, inventory: DataFrame) -> DataFrame:
    """Files (file, ...) whose name isn't the last part of a path in the inventory (pdf_path)."""
    known = inventory.filter(F.coalesce(F.trim("pdf_path"), F.lit("")) != "").select(F.regexp_extract("pdf_path", r"([^/\\]+)$", 1).alias("file"))
    return files.join(known, "file", "left_anti")


def sniffed(files: DataFrame, text: str = "text", title: str = "meta_title") -> DataFrame:
    """Adds dois (of title and first three pages, each once, in order) and rough_title: the file's own title, or its first line that is long enough."""
    pages = F.slice(F.split(F.coalesce(F.col(text), F.lit("")), "\f"), 1, 3)
    own = F.coalesce(F.trim(F.col(title)), F.lit(""))
    lines = F.filter(F.transform(F.split(F.get(pages, F.lit(0)), r"\r?\n"), lambda x: F.trim(x)), lambda x: F.length(x) > SHORT_LINE)
    return files.withColumns({"dois": keys.dois_in(F.concat_ws(" ", own, F.array_join(pages, " "))), "rough_title": F.when(own != "", own).otherwise(F.coalesce(F.get(lines, F.lit(0)), F.lit("")))})


def _rare(titles: DataFrame) -> DataFrame:
    """(t, words): hashes of the RARE_WORDS rarest words of each title key (t, n), as counted over all n rows of each."""
    words = titles.groupBy("t").agg(F.sum("n").alias("n")).select("t", "n", F.explode(F.array_distinct(F.split("t", " "))).alias("word")).filter("word <> ''")
    counts = words.groupBy("word").agg(F.sum("n").alias("n"))
    ranked = words.select("t", "word").join(counts, "word").groupBy("t").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "word"))), 1, RARE_WORDS).alias("w"))  # a title has few words
    return ranked.select("t", F.array_sort(F.transform("w", lambda x: F.xxhash64(x["word"]))).alias("words"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each value of the first three columns, by which batches are sorted."""
    held: list[pa.Table] = []
    for batch in batches:
        part = pa.Table.from_batches([batch])
        key = [part.column(k).to_numpy() for k in range(3)]
        ends = [0, *(np.nonzero(np.any([k[1:] != k[:-1] for k in key], axis=0))[0] + 1).tolist(), part.num_rows]
        for x, y in zip(ends, ends[1:], strict=False):
            if y == x:
                continue
            if held and any(held[-1].column(k)[0] != part.column(k)[x] for k in range(3)):
                yield pa.concat_tables(held)
                held = []
            held.append(part.slice(x, y - x))
    if held:
        yield pa.concat_tables(held)


def _met(a: DataFrame, b: DataFrame, rate: Callable, schema: str) -> DataFrame:
    """What ``rate`` gives for the titles of a and b (id, t, year, least, n) that share one of the rarest words of both, each pair of titles once.

    Titles of a word meet in blocks of about BLOCK_TITLES of either side, so a word that is common after all takes many small blocks and no large task.
    """
    rare = stage(_rare(a.select("t", "n").unionByName(b.select("t", "n"))))
    sides = [x.join(rare, "t").select("id", "t", "year", "least", "words", F.explode("words").alias("word")) for x in (a, b)]
    many = [x.groupBy("word").agg(F.ceil(F.count("*") / BLOCK_TITLES).cast("int").alias(n)) for x, n in zip(sides, ("ca", "cb"), strict=True)]
    cells = stage(many[0].join(many[1], "word"))
    own = [F.pmod(F.xxhash64("id"), F.col(n)).cast("int") for n in ("ca", "cb")]
    other = [F.explode(F.sequence(F.lit(0), F.col(n) - 1)) for n in ("cb", "ca")]
    left = sides[0].join(cells, "word").select("word", own[0].alias("i"), other[0].alias("j"), F.lit(False).alias("right"), "id", "t", "year", "least", "words")
    right = sides[1].join(cells, "word").select("word", other[1].alias("i"), own[1].alias("j"), F.lit(True).alias("right"), "id", "t", "year", "least", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, float] = {}
        for block in _blocks(batches):
            right = block.column("right").to_numpy()
            if right.all() or not right.any():
                continue
            word, parts = block.column("word")[0].as_py(), []
            for rows in (block.filter(pa.array(~right)), block.filter(pa.array(right))):
                lists = rows.column("words").combine_chunks()
                words = np.zeros((rows.num_rows, RARE_WORDS), dtype=np.int64)
                sizes = np.diff(lists.offsets.to_numpy())
                words[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes])] = lists.flatten().to_numpy()
                lower = (np.arange(RARE_WORDS)[None, :] < sizes[:, None]) & (words < word)
                years = rows.column("year").to_numpy().astype(float)  # null is nan
                parts.append((rows.column("id").to_numpy(), Titles(rows.column("t").to_pylist()), years, rows.column("least").to_numpy(), words, lower))
            a, b = parts
            once = np.ones((len(a[0]), len(b[0])), dtype=bool)  # a pair counts in the block of the first word that it shares
            for x in range(RARE_WORDS):
                for y in range(RARE_WORDS):
                    who, whom = np.nonzero(a[5][:, x])[0], np.nonzero(b[5][:, y])[0]
                    if len(who) and len(whom):
                        once[np.ix_(who, whom)] &= a[4][who, x][:, None] != b[4][whom, y][None, :]
            if len(best) > KEPT_BEST:
                best.clear()
            yield from rate(a[:4], b[:4], once, best)

    return left.unionByName(right).repartition(_tasks(a), "word", "i", "j").sortWithinPartitions("word", "i", "j").mapInArrow(run, schema)


def _tasks(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)  # work lies in pairs, not in bytes


def _met_all(a: DataFrame, b: DataFrame, rate: Callable, schema: str) -> DataFrame:
    """What ``rate`` gives for all titles of a (id, t, year, least) and b (id, t, year), each pair once, less those whose years rule out a rating of least.

    Titles of b meet in blocks of one year. More than two years apart no pair is rated over MOST_APART, so a title with a higher least meets the years around
    its own and titles without a year.
    """
    b = b.withColumn("of", F.coalesce("year", F.lit(-1)))
    cells = stage(b.groupBy("of").agg(F.ceil(F.count("*") / ALL_RIGHT).cast("int").alias("many")))
    chunks = F.broadcast(a.agg(F.greatest(F.ceil(F.count("*") / ALL_LEFT), F.lit(1)).cast("int").alias("ca")))  # one row
    near = (F.col("of") == -1) | F.col("year").isNull() | (F.col("least") <= MOST_APART) | (F.abs(F.col("year") - F.col("of")) <= 2)
    # a row per year
    left = a.crossJoin(chunks).join(F.broadcast(cells), near).select("of", F.pmod(F.xxhash64("id"), F.col("ca")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("many") - 1)).alias("j"), F.lit(False).alias("right"), "id", "t", "year", "least")
    right = b.join(F.broadcast(cells), "of").crossJoin(chunks).select("of", F.explode(F.sequence(F.lit(0), F.col("ca") - 1)).alias("i"), F.pmod(F.xxhash64("id"), F.col("many")).cast("int").alias("j"), F.lit(True).alias("right"), "id", "t", "year", F.lit(0.0).alias("least"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, float] = {}
        for block in _blocks(batches):
            right = block.column("right").to_numpy()
            if right.all() or not right.any():
                continue
            if len(best) > KEPT_BEST:
                best.clear()
            sides = [block.filter(pa.array(x)) for x in (~right, right)]
            x, y = ((s.column("id").to_numpy(), Titles(s.column("t").to_pylist()), s.column("year").to_numpy().astype(float), s.column("least").to_numpy()) for s in sides)
            yield from rate(x, y, None, best)

    return left.unionByName(right).repartition(_tasks(a), "of", "i", "j").sortWithinPartitions("of", "i", "j").mapInArrow(run, schema)


def _title_rows(rows: DataFrame, own: str) -> DataFrame:
    """The rows with t, their title key, and without blank ones."""
    return rows.withColumn("t", keys.title_key_untagged(F.col("title"))).filter("t <> ''").withColumn("id", F.xxhash64("t")).withColumnRenamed(own, "_own")


def title_pairs(left: DataFrame, right: DataFrame, least: float = LEAST_RATIO) -> DataFrame:
    """(l, r, ratio) of titles (l, title) and (r, title) with a ratio of at least ``least``.

    Candidates share one of the RARE_WORDS rarest words of both titles, as counted over both tables. Equal keys are one title. Lengths, then the longest
    common subsequence, rule out pairs that can't reach the ratio before it is computed, so the result is that of computing it for all candidates. Blank titles
    pair with nothing. Two titles that share no rare word are missed however alike they are: tests measure that share.
    """
    a, b = _title_rows(left.select("l", "title"), "l"), _title_rows(right.select("r", "title"), "r")
    one = [x.groupBy("id", "t").agg(F.count("*").alias("n")).select("id", "t", "n", F.lit(None).cast("int").alias("year"), F.lit(0.0).alias("least")) for x in (a, b)]

    def rate(x: tuple, y: tuple, once: np.ndarray, best: dict[int, float]) -> Iterator[pa.RecordBatch]:
        m, n = x[1].length[:, None], y[1].length[None, :]
        i, j = np.nonzero(once & (2 * np.minimum(m, n) >= least * (m + n)))
        total = x[1].length[i] + y[1].length[j]
        near = np.nonzero(2 * common(x[1], y[1], i, j) >= least * total - 1e-9)[0]
        found = [(k, r) for k in near if (r := exact_ratio(x[1].texts[i[k]], y[1].texts[j[k]])) >= least]
        if found:
            at = np.array([k for k, _ in found])
            yield pa.RecordBatch.from_arrays([pa.array(x[0][i[at]]), pa.array(y[0][j[at]]), pa.array([r for _, r in found], pa.float64())], names=["x", "y", "ratio"])

    near = _met(*one, rate, "x bigint, y bigint, ratio double")
    ids = [df.select(F.col("_own").alias(own), F.col("id").alias(key)) for df, own, key in ((a, "l", "x"), (b, "r", "y"))]
    return near.join(ids[0], "x").join(ids[1], "y").select("l", "r", "ratio")


def best_title_pairs(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(l, r, ratio) of titles with years (l, title, year) and (r, title, year) with a ratio of at least ``least``, less pairs that can't be the best rated one of l.

    Ratings are those of ``references.best_candidates``, ties go to the smallest r. Titles of one key and year are one; an equal key gives a title its first rating,
    titles that share one of the rarest words of both the next. Then all titles of both sides meet, whatever their words, and a pair whose bound (of lengths, of
    shared letter pairs and triples, of the longest common subsequence) is rated lower than what its title has already isn't computed. What is left has the best
    pair of every l among all pairs.
    """
    own = lambda df, name: _title_rows(df.select(name, "title", F.col("year").cast("int").alias("year")), name).withColumn("id", F.xxhash64("t", "year"))
    a, b = own(left, "l"), own(right, "r")
    one = [x.groupBy("id", "t", "year").agg(F.count("*").alias("n"), F.min("_own").alias("first")) for x in (a, b)]
    apart = F.abs(F.col("year") - F.col("y"))
    equal = one[0].select("id", "t", "year").join(one[1].select("t", F.col("year").alias("y")), "t").groupBy("id").agg(F.max(F.when(apart > 2, MOST_APART).otherwise(100.0)).alias("least"))
    sides = [stage(one[0].join(equal, "id", "left").select("id", "t", "n", "year", F.coalesce("least", F.lit(0.0)).alias("least"))), stage(one[1].select("id", "t", "n", "year", F.lit(0.0).alias("least"), "first"))]

    def rated(ratio: np.ndarray, years: np.ndarray, slack: float) -> np.ndarray:
        base = np.floor(ratio * 100 + 0.5 + slack)
        return np.where(years == 0, np.minimum(100, base + 5), np.where(years > 2, np.maximum(0, base - 15), base))

    def rate(x: tuple, y: tuple, once: np.ndarray | None, best: dict[int, float]) -> Iterator[pa.RecordBatch]:
        have = np.array([max(best.get(k, 0.0), s) for k, s in zip(x[0].tolist(), x[3].tolist(), strict=True)])
        m, n = x[1].length[:, None], y[1].length[None, :]
        bound = 2 * np.minimum(m, n) / (m + n)
        years = np.abs(x[2][:, None] - y[2][None, :])
        may = (bound >= least - 1e-9) & (rated(bound, years, 1e-9) >= have[:, None])
        if once is not None:
            may &= once
        elif may.any():
            bound = np.minimum(bound, shared_bound(x[1], y[1]))
            may &= (bound >= least - 1e-9) & (rated(bound, years, 1e-9) >= have[:, None])
        i, j = np.nonzero(may)
        bound, years = 2 * common(x[1], y[1], i, j) / (x[1].length[i] + y[1].length[j]), years[i, j]
        most = rated(bound, years, 1e-9)
        near = np.nonzero((bound >= least - 1e-9) & (most >= have[i]))[0]
        found = []
        for k in near[np.argsort(-most[near], kind="stable")]:
            if most[k] >= have[i[k]] and (r := exact_ratio(x[1].texts[i[k]], y[1].texts[j[k]])) >= least:
                reached = float(rated(np.float64(r), years[k], -1e-9))
                if float(rated(np.float64(r), years[k], 1e-9)) >= have[i[k]]:
                    found.append((k, r, reached))
                have[i[k]] = max(have[i[k]], reached)
        best.update(zip(x[0].tolist(), have.tolist(), strict=True))
        if found:
            at = np.array([k for k, *_ in found])
            yield pa.RecordBatch.from_arrays([pa.array(x[0][i[at]]), pa.array(y[0][j[at]]), *(pa.array([f[c] for f in found], pa.float64()) for c in (1, 2))], names=["x", "y", "ratio", "reached"])

    schema = "x bigint, y bigint, ratio double, reached double"
    first = _met(*sides, rate, schema).groupBy(F.col("x").alias("id")).agg(F.max("reached").alias("reached"))
    begun = stage(sides[0].join(first, "id", "left").select("id", "t", "year", F.greatest("least", F.coalesce("reached", F.lit(0.0))).alias("least")))
    near = _met_all(begun, sides[1], rate, schema)
    ids = a.select(F.col("_own").alias("l"), F.col("id").alias("x"))
    return near.join(ids, "x").join(sides[1].select(F.col("id").alias("y"), F.col("first").alias("r")), "y").select("l", "r", "ratio")


def one_to_one(options: DataFrame) -> DataFrame:
    """(file, item): each file in order of its name takes the best item that is left. ``options``: (file, item, rank), smaller is better, any order type.

    Files propose to their best item, an item keeps the first file by name, refused files go on to their next item; as all
    items rank files alike, the outcome is that of one file after the other. Rounds end when no file is refused; each refusal
    uses up an option, so they end.
    """
    left = cut(options.select("file", "item", "rank"))
    while True:
        best = left.groupBy("file").agg(F.min(F.struct("rank", "item")).alias("b")).select("file", F.col("b.item").alias("item"))
        held = best.groupBy("item").agg(F.min("file").alias("file"))
        refused = best.join(held, ["item", "file"], "left_anti")
        if refused.isEmpty():
            return best
        left = cut(left.join(refused, ["item", "file"], "left_anti"))


def match_files(files: DataFrame, inventory: DataFrame) -> DataFrame:
    """(file, zotero_key, how) of files (file, dois, rough_title) and items that lack a PDF (zotero_key, doi, title, ord).

    A DOI in a file is its first choice (of items with one DOI the last, by ord), then titles by likeness, the earlier item first;
    every item is used once. Files without a match have no row.
    """
    items = inventory.filter("zotero_key IS NOT NULL")
    by_doi = items.select(keys.doi_key(F.col("doi")).alias("doi"), "zotero_key", "ord").filter("doi <> ''").groupBy("doi").agg(F.max_by("zotero_key", "ord").alias("item"))
    said = files.select("file", F.posexplode("dois").alias("pos", "doi"))
    first: Column = F.struct(F.lit(0).alias("kind"), F.col("pos").cast("double").alias("order"), F.lit(0).cast("bigint").alias("ord"))
    hits = said.join(by_doi, "doi").groupBy("file", "item").agg(F.min("pos").alias("pos")).select("file", "item", first.alias("rank"))
    alike = title_pairs(files.select(F.col("file").alias("l"), F.col("rough_title").alias("title")), items.select(F.col("zotero_key").alias("r"), "title"))
    place = items.select(F.col("zotero_key").alias("item"), F.col("ord").cast("bigint").alias("ord"))
    second = F.struct(F.lit(1).alias("kind"), (-F.col("ratio")).alias("order"), F.col("ord"))
    near = alike.select(F.col("l").alias("file"), F.col("r").alias("item"), "ratio").join(place, "item").select("file", "item", second.alias("rank"))
    options = hits.unionByName(near).groupBy("file", "item").agg(F.min("rank").alias("rank"))
    options = cut(options)
    how = F.when(F.col("rank.kind") == 0, "doi").otherwise("title")
    return one_to_one(options).join(options, ["file", "item"]).select("file", F.col("item").alias("zotero_key"), how.alias("how"))
