import difflib
import io
import random
import time
import zipfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenloom.functions import likeness
from screenloom.operators import incremental, inventory, matching, panel, references, retrieval
from screenloom.sources import library, ris, sinks, tabular
from screenloom.streaming import resume


def test_dedup_chain_and_blanks(spark):
    rows = [(1, "a", "10.1/x", "T one"), (2, "a", "10.1/y", "T two"), (3, "b", "https://doi.org/10.1/X", "T three"), (4, "c", None, "t ONE!"), (5, "", "", ""), (6, "", None, None), (7, "d", "", "")]
    df = spark.createDataFrame(rows, "row_no int, record_id string, doi string, title string")
    stages = references.dedup_stages(df)
    assert [s.count() for s in stages] == [7, 6, 5, 4]
    assert references.dedup_stages(stages[-1])[-1].count() == 4
    assert references.dedup_stages(df.limit(0))[-1].count() == 0


def test_cascade_stops_at_a_blank_id(spark):
    rows = spark.createDataFrame([("k1", "10.1/a", "", "Title"), ("k2", "", "", "Title"), ("k3", "", "u/", ""), ("k4", None, None, None)], "key string, doi string, url string, title string")
    mapping = spark.createDataFrame([("", "10.1/A", "", "", 1), ("m2", "", "", "title", 2), ("m3", "", "U", "", 3), ("m4", "", "u", "", 4)], "map_id string, doi string, url string, title string, ord int")
    got = {r["key"]: (r["map_id"], r["method"]) for r in references.cascade_lookup(rows, mapping).collect()}
    assert got == {"k1": (None, "unmatched"), "k2": ("m2", "title"), "k3": ("m4", "url"), "k4": (None, "unmatched")}


def test_best_candidate(spark):
    rows = spark.createDataFrame([("k", "2010"), ("far", "2001")], "key string, year string")
    same = [("k", k, d, "A study of things", y, r) for k, d, y, r in ((1, "d1", 2010, 1.0), (2, "d2", 2010, 1.0), (3, "", 2010, 1.0), (4, "d4", 1990, 0.2))]
    cand = spark.createDataFrame([*same, ("far", 5, "d5", "x", 2003, 0.9), ("far", 6, "d6", "y", 2004, 1.0)], "key string, ord int, doi string, cand_title string, cand_year int, ratio double")
    got = {r["key"]: (r["doi"], r["confidence"]) for r in references.best_candidates(rows, cand).collect()}
    assert got == {"k": ("d1", 100), "far": ("d5", 90)}  # two years apart are neutral, three cost fifteen


def test_ris_round_trip(spark, tmp_path):
    text = "TY  - JOUR\r\nT1  - First\r\n  goes on\r\nAB  - a\r\nAB  - b\r\nPY  - 2001/05\r\nDO  - 10.1/X\r\nU1  - id1\r\nER  - \r\n\r\nTY  - BOOK\nTI  - Second\nU1  - id2\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.ris").write_text(text, newline="")
    got = {r["record_id"]: r for r in ris.read_records(spark, str(tmp_path / "in")).collect()}
    assert got["id1"]["title"] == "First goes on" and got["id1"]["year"] == "2001" and got["id1"]["doi"] == "10.1/x" and got["id2"]["title"] == "Second"
    sinks.write_ris(ris.read_records(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    again = {r["record_id"]: r["title"] for r in ris.read_records(spark, str(tmp_path / "out") + "/part-*").collect()}
    assert again == {"id1": "First goes on", "id2": "Second"}
    assert ris.parse("") == [] and ris.parse("ER  - \n") == []


def test_sheets(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('title row,,,\nID,Year,Title,Abstract,Decision\na,2001.0,"x ""q""\nline",NA,INCLUDE\nb,,,abs,\na,2002,y,z,EXCLUDE\n')
    names = {"record_id": "ID", "year": "Year", "title": "Title", "abstract": "Abstract", "decision": "Decision"}
    records, labels = tabular.flat_records(tabular.read_sheet(spark, str(path)), names)
    assert records.count() == 3 and {(r["record_id"], r["title"], r["abstract"]) for r in records.collect()} >= {("a", 'x "q"\nline', "NA"), ("b", "", "abs")}
    assert {r["record_id"]: r["label"] for r in labels.collect()} == {"a": "EXCLUDE", "b": None}
    with pytest.raises(ValueError):
        tabular.read_sheet(spark, "x.txt")


def test_paired_rows(spark):
    rows = [(0, "a", "2001", "t", "x", None), (1, None, None, None, None, "INCLUDE"), (2, "b", None, None, None, None), (3, "c", None, None, None, None)]
    df = spark.createDataFrame(rows, "ord bigint, ID string, Y string, T string, A string, D string")
    got = tabular.paired_records(df, {"record_id": "ID", "year": "Y", "title": "T", "abstract": "A", "decision": "D"})
    assert {r["record_id"]: r["label"] for r in got.collect()} == {"a": "INCLUDE", "b": "NA", "c": "NA"}


def test_xlsx(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>ID</t></si><si><t>Title</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row r="2"><c r="B2" t="inlineStr"><is><t>only b</t></is></c></row></sheetData></worksheet>')
    (tmp_path / "b.xlsx").write_bytes(book.getvalue())
    assert [tuple(r) for r in tabular.read_sheet(spark, str(tmp_path / "b.xlsx"), 0).collect()] == [(1, None, "only b")]


def test_jsonl_and_reviews(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"record_id": "a", "n": 1}\n\nbroken\n{"record_id": "b"}\n')
    assert tabular.read_jsonl(spark, str(tmp_path / "r.jsonl"), "record_id string, n int").count() == 2
    sheet = spark.createDataFrame([("a", "y"), ("b", "EXCLUDE_X"), ("c", ""), ("d", "0")], "record_id string, decision string")
    assert {tuple(r) for r in tabular.reviewed(sheet).collect()} == {("a", "INCLUDE"), ("b", "unknown"), ("d", "EXCLUDE")}
    (tmp_path / "gt.json").write_text('{"a": "x", "b": null}')
    assert tabular.read_label_map(spark, str(tmp_path / "gt.json")).count() == 2


def test_library(spark, tmp_path):
    (tmp_path / "items.json").write_text('[{"data": {"key": "P", "itemType": "book", "title": "T", "date": "May 2001", "creators": [{"firstName": "A", "lastName": "B"}, {"name": "Org"}]}}, {"data": {"key": "C1", "parentItem": "P", "itemType": "attachment", "filename": "x.PDF", "linkMode": "linked"}}, {"data": {"key": "C2", "parentItem": "P", "itemType": "attachment", "contentType": "application/pdf", "linkMode": "imported_file", "md5": "1"}}]')
    row = library.inventory(library.read_items(spark, str(tmp_path / "items.json"))).collect()[0]
    assert (row["authors"], row["year"], row["pdf_attachment_key"]) == ("B, A; Org", "2001", "C2")
    doc = "# 1. A\n## System message\n```\none\n```\n# 2. B\n## System message\n```text\ntwo\nlines\n```\n"
    assert library.prompt_section(doc, 1) == "one" and library.prompt_section(doc, 2) == "two\nlines"
    with pytest.raises(ValueError):
        library.prompt_section(doc, 3)
    assert library.prompt_section(doc, 3, strict=False) == "one"


def test_bm25_against_a_loop(spark):
    import math

    docs = {1: "alpha beta beta gamma", 2: "alpha delta", 3: "beta delta epsilon zeta", 4: "alpha", 5: "", 6: None}
    pool = spark.createDataFrame(list(docs.items()), "doc_id int, text string")
    got = {(r["q"], r["id"]): r["score"] for r in retrieval.bm25(pool, pool, "doc_id", "text").collect()}
    toks = {k: (v or "").split() for k, v in docs.items()}
    n, avg = len(docs), sum(map(len, toks.values())) / len(docs)
    terms = {t for v in toks.values() for t in v}
    df = {t: sum(t in v for v in toks.values()) for t in terms}
    idf = {t: math.log(n - df[t] + 0.5) - math.log(df[t] + 0.5) for t in terms}
    mean = sum(idf.values()) / len(idf)
    idf = {t: x if x >= 0 else 0.25 * mean for t, x in idf.items()}
    for (q, d), score in got.items():
        want = sum(idf[t] * toks[d].count(t) * 2.5 / (toks[d].count(t) + 1.5 * (0.25 + 0.75 * len(toks[d]) / avg)) for t in toks[q] if t in toks[d])
        assert abs(want - score) < 1e-9


def test_numbering_and_children(spark):
    rows = spark.createDataFrame([("b", None, 3), ("a", "1", 1), ("a", "1", 2), ("b", "0", 4)], "p string, y string, k int")
    assert [(r["number"], r["k"]) for r in inventory.numbered(rows, ["p", "y"], ["k"]).orderBy("number").collect()] == [(1, 1), (2, 2), (3, 3), (4, 4)]
    kids = spark.createDataFrame([("a", True), ("a", None), ("b", True)], "k string, ok boolean")
    assert [r["k"] for r in inventory.all_children(kids, "k", F.col("ok")).collect()] == ["b"]


def test_incremental(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "record_id string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "record_id string, v int")
    assert sorted(map(tuple, incremental.replaced(old, new).collect())) == [("a", 1), ("b", 9), ("c", 3)]
    done = spark.createDataFrame([(None,), ("a",)], "record_id string")
    assert [r["record_id"] for r in incremental.pending(old, done).collect()] == ["b"]


def test_stream_resumes_without_repeats(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    work = lambda df: df.select("id", (F.col("id") * 2).alias("v"))
    spark.range(10).write.parquet(src)
    resume.run_available(spark, src, "id bigint", work, out, chk)
    spark.range(10, 15).write.mode("append").parquet(src)
    for _ in range(2):
        resume.run_available(spark, src, "id bigint", work, out, chk)
    got = spark.read.parquet(out)
    assert got.count() == 15 == got.select("id").distinct().count()


def test_retry():
    answers = iter([None, None, "ok"])
    assert resume.with_retry(lambda: next(answers), pause=lambda s: None) == "ok"
    with pytest.raises(ValueError):
        resume.with_retry(lambda: None, attempts=2, pause=lambda s: None)


def test_panel(spark):
    rows = spark.createDataFrame([("a", "t")], "record_id string, text string")
    requests = panel.expand(rows, ["m", "n"], 3)
    assert panel.hash_panel(requests).count() == 6
    assert panel.screen(requests, lambda b: b["text"] + b["model"], "text").filter("raw = 'tm'").count() == 3


def test_best_titles_are_those_of_all_candidates(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(25)]
    title = lambda: " ".join(rng.choice(words) for _ in range(7))
    right = [(k, title(), rng.choice([None, 2001, 2002, 2009])) for k in range(700)]  # every word is common: several blocks each
    left = [(f"k{k}", right[k * 3][1] if k % 4 == 0 else right[k * 3][1][:-5] + "x" if k % 4 == 1 else title(), rng.choice([None, 2001, 2005])) for k in range(150)]
    a, b = spark.createDataFrame(left, "l string, title string, year int"), spark.createDataFrame(right, "r bigint, title string, year int")
    blocks = matching.BLOCK_TITLES
    matching.BLOCK_TITLES = 60
    try:
        pairs = {(r["l"], r["r"]): r["ratio"] for r in matching.title_pairs(a.drop("year"), b.drop("year"), 0.6).collect()}
        best = {(r["l"], r["r"]): r["ratio"] for r in matching.best_title_pairs(a, b, 0.6).collect()}
    finally:
        matching.BLOCK_TITLES = blocks
    counts = Counter(w for t in [t for _, t, _ in left + right] for w in set(t.split()))
    rare = lambda t: set(sorted(set(t.split()), key=lambda w: (counts[w], w))[:6])
    ratio = lambda x, y: difflib.SequenceMatcher(None, x, y).ratio()
    wanted = {(l, r): q for l, t, _ in left for r, u, _ in right if rare(t) & rare(u) and (q := ratio(t, u)) >= 0.6}
    assert pairs == wanted and len(best) < len(pairs)
    year, other = dict((l, y) for l, _, y in left), {r: (u, y) for r, u, y in right}
    rows = spark.createDataFrame([(l, str(y) if y else None) for l, _, y in left], "key string, year string")
    made = lambda found: references.best_candidates(rows, spark.createDataFrame([(l, r, f"d{r}", *other[r], q) for (l, r), q in found.items()], "key string, ord bigint, doi string, cand_title string, cand_year int, ratio double")).collect()
    assert sorted(made(best)) == sorted(made(wanted)) and len(year) == 150
    assert matching.best_title_pairs(a.limit(0), b, 0.6).count() == 0


def test_best_titles_need_no_shared_word(spark):
    """Titles with a slip in each of their words used to be no candidates, as did those that share only words which are common."""
    rng = random.Random(9)
    made = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    right = [(k, " ".join(["trial of", *(made(8) for _ in range(7))]), rng.choice([None, 2001, 2003, 2009])) for k in range(120)]
    slipped = lambda t: " ".join(w[:3] + "x" + w[4:] if len(w) > 5 else w for w in t.split())
    left = [(f"k{k}", [right[k][1], slipped(right[k][1]), slipped(right[k][1]).replace(" ", ""), made(70), "", None][k % 6], rng.choice([None, 2001, 2004])) for k in range(60)]
    left += [("n", right[7][1][:-2], right[7][2]), ("m", right[7][1], right[7][2])]
    rows = spark.createDataFrame([(l, str(y) if y else None) for l, _, y in left], "key string, year string")
    other = {r: (u, y) for r, u, y in right}
    made_best = lambda found: sorted(map(tuple, references.best_candidates(rows, spark.createDataFrame([(l, r, f"d{r}", *other[r], q) for (l, r), q in found.items()], "key string, ord bigint, doi string, cand_title string, cand_year int, ratio double")).collect()), key=str)
    wanted = {(l, r): q for l, t, _ in left if t for r, u, _ in right if (q := difflib.SequenceMatcher(None, t, u).ratio()) >= 0.6}
    sizes = matching.ALL_LEFT, matching.ALL_RIGHT
    matching.ALL_LEFT, matching.ALL_RIGHT = 13, 11  # several blocks
    try:
        best = {(r["l"], r["r"]): r["ratio"] for r in matching.best_title_pairs(spark.createDataFrame(left, "l string, title string, year int"), spark.createDataFrame(right, "r bigint, title string, year int"), 0.6).collect()}
    finally:
        matching.ALL_LEFT, matching.ALL_RIGHT = sizes
    assert made_best(best) == made_best(wanted) and {"k1", "k2", "k7"} <= {l for l, _ in best} and best.items() <= wanted.items()


def test_bounds_of_shared_letters():
    rng = random.Random(10)
    texts = ["a", "ab", *("".join(rng.choices("ab c", k=rng.randrange(1, 150))) for _ in range(20))]
    texts += [t[:40] + "z" + t[41:] for t in texts if len(t) > 41]
    bound = likeness.shared_bound(likeness.Titles(texts), likeness.Titles(texts))
    assert all(bound[i, j] >= likeness.exact_ratio(x, y) - 1e-9 for i, x in enumerate(texts) for j, y in enumerate(texts))
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    assert likeness.shared_bound(likeness.Titles([letters]), likeness.Titles([letters[::-1]]))[0, 0] < 0.7


def test_common_words_cost_bounds_and_no_ratios(spark):
    """A word of every title used to have the ratio computed for each pair: some minutes for 2,000 titles of either side."""
    rng = random.Random(6)
    made = [" ".join(["trial", *("".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(3))]) for _ in range(2000)]
    a, b = spark.createDataFrame(list(enumerate(made)), "l int, title string"), spark.createDataFrame(list(enumerate(made)), "r int, title string")
    began = time.time()
    assert {(r["l"], r["r"]) for r in matching.title_pairs(a, b).collect()} == {(k, k) for k in range(2000)}
    assert time.time() - began < 60


def test_common_subsequence():
    rng = random.Random(7)
    texts = ["", "a", "b" * 64, "b" * 65, "ab" * 70, *("".join(rng.choices("abc 1", k=rng.randrange(1, 200))) for _ in range(25))]

    def plain(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            new = [0]
            for k, d in enumerate(y):
                new.append(row[k] + 1 if c == d else max(row[k + 1], new[k]))
            row = new
        return row[-1]

    one = likeness.Titles(texts)
    i, j = (x.ravel() for x in np.mgrid[: len(texts), : len(texts)])
    assert likeness.common(one, one, i, j).tolist() == [plain(texts[p], texts[q]) for p, q in zip(i, j, strict=True)]
