import json

from pyspark.sql import functions as F

from screenloom.functions import keys, quotes
from screenloom.operators import responses


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r[0] for r in df.orderBy("k").select(make(F.col("v"))).collect()]


def test_fragments(spark):
    got = column(spark, ['"a"; "b \\"c\\""', "NA", "na", "", None, "plain", '"open end', '""'], quotes.fragments)
    assert got == [["a", 'b "c"'], [], [], [], [], ["plain"], ["open end"], []]


def test_tolerant_match():
    assert quotes.tolerant("abcdefghij", "xx ajihgfedcb yy")
    assert not quotes.tolerant("abcdefghij", "klmnopqrst")
    assert not quotes.tolerant("a" * 201, "a" * 150 + "b" + "a" * 150)
    assert quotes.normal("“intel-\nligence” ﬁnds  Café — x") == '“intelligence” finds cafe x'
    window = "a" + "b" * 9
    assert not quotes.tolerant(window, "ac" * 500 + window[:5] + "c" + window[6:])


def test_truncation(spark):
    text = "x" * 85 + "\n\n" + "y" * 50
    page = "x" * 82 + "\n\f\n" + "y" * 50
    early = "x" * 20 + "\n\n" + "y" * 200
    got = column(spark, [text, page, early, "short", "", None], lambda c: keys.truncate_text(c, 100))
    assert got == ["x" * 85, "x" * 82, early[:100], "short", "", None]


def test_keys(spark):
    assert column(spark, ["https://doi.org/10.1/AB", "doi: 10.1/ab", " DOI:10.1/ab ", None, ""], keys.doi_key) == ["10.1/ab"] * 3 + ["", ""]
    assert column(spark, ["c2001", "1999.0", "NA", "", None], keys.first_year) == ["2001", "1999", "", "", ""]
    assert column(spark, ["Çelik, A; B, C", "", None, "Ann Lee"], keys.first_author) == ["Çelik", "", "", "Lee"]
    assert column(spark, ["a b/c?", "___", None, "x" * 100], keys.safe_component) == ["a_b_c", "untitled", "untitled", "x" * 80]
    assert column(spark, ["see 10.1234/AbC. and 10.1234/abc)", "none", None], keys.dois_in) == [["10.1234/abc"], [], None]
    assert column(spark, ["https://www.a.org:80/x", "no", None], keys.url_host) == ["a.org", "", ""]
    assert column(spark, [b"%PDF-1.4", b"<html", b"", None], keys.is_pdf, "binary") == [True, False, False, False]


def test_links(spark):
    page = '<META content="/m.pdf" name="citation_pdf_url"><a href="/a.pdf?x=1&amp;y=2"><a href=/b.pdf>'
    assert column(spark, [page, "", None], keys.pdf_links)[:2] == [["/m.pdf", "/a.pdf?x=1&y=2", "/b.pdf"], []]


def test_responses(spark):
    trace = {"1": {"verdict": "PASS", "supporting_quote": "p"}, "2": {"verdict": "FAIL"}, "3": {"verdict": "FAIL", "code_if_fail": "X", "supporting_quote": "q"}}
    raw = [
        '```json\n{"code": "X"}\n```', 'Sure: {"screening_decision": "EXCLUDE_Y"} done', "{}", "[1]", '{"screening_code": "X', json.dumps({"trace": trace}), json.dumps({"trace": ["no"], "screening_decision": "EXCLUDE"}),
        '{"screening_code": "retain"}', '{"screening_code": null, "code": "X", "screening_decision": "EXCLUDE"}', None,
    ]
    df = spark.createDataFrame(list(enumerate(raw)), "k int, raw string")
    got = [(r["parsed"], r["screening_code"], r["screening_decision"], r["supporting_quote"]) for r in responses.repaired(df).orderBy("k").collect()]
    out = (False, "INCLUDE_TA", "INCLUDE", "NA")
    assert got[0][:3] == (True, "X", "EXCLUDE") and got[1][:3] == (True, "EXCLUDE_Y", "EXCLUDE")
    assert got[2] == got[3] == got[4] == got[9] == out
    assert got[5] == (True, "X", "EXCLUDE", "q") and got[6][2] == "EXCLUDE" and got[7][:3] == (True, "INCLUDE_TA", "INCLUDE")
    assert got[8][:3] == (True, None, "EXCLUDE")


def test_trace_checks(spark):
    done = {str(k): {"verdict": "PASS", "supporting_quote": "p", "rationale": "r", "code_if_fail": "NA"} for k in range(1, 5)}
    good = {"hierarchical_trace": done | {"5": {"verdict": "FAIL", "code_if_fail": "X", "rationale": "r"}, "6": {"verdict": "NOT_EVALUATED"}}, "screening_code": "X", "screening_decision": "EXCLUDE"}
    bad = {"trace": {"1": {"verdict": "NOT_EVALUATED"}, "2": {"verdict": "FAIL"}, "3": {"verdict": "PASS", "code_if_fail": "Z"}, "4": {"verdict": "maybe"}, "5": {"verdict": "UNCLEAR"}}, "screening_code": "Y", "screening_decision": "INCLUDE"}
    rows = responses.trace_checks(spark.createDataFrame([(0, json.dumps(good)), (1, json.dumps(bad)), (2, "{}"), (3, None)], "k int, raw string")).orderBy("k").collect()
    assert len(rows) == 2 and len(rows[0]) == 12 and all(rows[0][c] for c in rows[0].asDict() if c != "k")
    assert not any(rows[1][c] for c in rows[1].asDict() if c != "k")


def test_first_failure(spark):
    order = ["p", "s", "i"]
    rows = [("a", "m", "p", True, True), ("a", "m", "s", False, False), ("a", "m", "i", True, False), ("b", "m", "p", False, False), ("b", "m", "s", True, True), ("b", "m", "i", True, False), ("c", "m", "p", True, False), ("c", "m", "i", False, True)]
    got = {r["record_id"]: (r["failed"], r["decision"], r["needs_second_opinion"]) for r in responses.first_failure(spark.createDataFrame(rows, "record_id string, model string, criterion string, pass boolean, uncertain boolean"), order).collect()}
    assert got == {"a": ("s", "EXCLUDE", True), "b": ("p", "EXCLUDE", False), "c": (None, "INCLUDE", True)}


def test_routes_and_year_gate(spark):
    routes = [[], ["not_applicable"], ["determinants", "not_applicable"], ["determinants", "intervention"], ["measurement"], None]
    assert column(spark, routes, responses.screener_for, "array<string>") == ["intervention", "intervention", "no_intervention", "intervention", "no_intervention", "intervention"]
    df = spark.createDataFrame([(k, str(k), y) for k, y in enumerate(["", "NA", "1999", "1999.5", "2000", "c2001", "2001/05", None])], "row_no int, record_id string, year string")
    assert {r["row_no"] for r in responses.year_gate(df).collect()} == {2, 3}
