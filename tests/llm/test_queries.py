"""The registered queries on whole tables of the smallest scales, against plain versions or SQL twins."""

import os
import re
import sys

import pyarrow.parquet as pq
import pytest
from compare import connect, difference

from screenloom.llm import leakage, oracles, queries, titles

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def _rows(name):
    return pq.read_table(f"{FOLDER}/{name}.parquet").to_pylist()


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_twin(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), oracles.ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracles.ORACLES) - {"p1_found", "p8_found"}))
def test_runs(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    rows = [tuple(map(str, r)) for r in df.collect()]
    assert df.columns and len(rows) == len(set(rows))


def test_p1_against_all_pairs(spark):
    rows = sorted(_rows("records"), key=lambda r: r["batch_no"])
    words, want = {}, set()
    for number in sorted({r["batch_no"] for r in rows}):
        earlier = [r for r in rows if r["batch_no"] < number]
        known = {f[0] for r in earlier if (f := titles.title_forms(r["title"]))}
        new = {f[0] for r in rows if r["batch_no"] == number and (f := titles.title_forms(r["title"]))} - known
        for f in new:
            for w in set(f.split()):
                words[w] = words.get(w, 0) + 1
        for r in (r for r in rows if r["batch_no"] == number):
            forms = titles.title_forms(r["title"])
            hit = r["record_id"] is not None and any(r["record_id"] == e["record_id"] for e in earlier)
            hit |= bool(forms) and forms[0] in known
            for k in known if forms and not hit else ():
                slips = next((s for f in forms if (s := titles.word_slips(f, k)) is not None), None)
                low_high = [sorted((words.get(a, 0), words.get(b, 0))) for a, b in slips or ()]
                own = any(low >= titles.OWN_WORD_TITLES and low >= titles.OWN_WORD_RATIO * high for low, high in low_high)
                hit |= slips is not None and not own
            if hit:
                want.add(r["row_no"])
    assert {r["row_no"] for r in queries.p1_found(spark, FOLDER).collect()} == want and want


def test_p8_against_alignment_of_all_pairs(spark):
    from test_operators import _brute_leaks

    accounts = [(r["item_id"], r["account"]) for r in leakage.accounts(spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()]
    docs = [(r["doc_id"], r["text"]) for r in _rows("documents") if r["text"]]
    shared = [(k, a) for k, a in accounts if any(len(set(leakage.words(a)) & set(leakage.words(t))) * 3 >= len(leakage.words(a)) for _, t in docs)]
    want = _brute_leaks(shared[:40], docs)
    asked = {k for k, _ in shared[:40]}
    assert {(r["item_id"], r["doc_id"]) for r in queries.p8_found(spark, FOLDER).collect() if r["item_id"] in asked} == want


def test_p7_covers_every_document(spark):
    want = {r["doc_id"]: r["text"] for r in _rows("documents")}
    got = {r["doc_id"]: r["ids"] for r in queries.p7_ids(spark, FOLDER).collect()}
    assert set(got) == set(want) and all(bool(ids) == bool(want[k]) for k, ids in got.items())
    assert not [k for k in queries.QUERIES if not re.match(r"p[1-9]_", k)]
