"""Screening as a whole, matching of hand-found files, and streaming, against brute force and the odd inputs."""

import difflib
import json
import random
import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from screenloom.functions import keys, quotes
from screenloom.operators import calibration, matching, panel, responses, screening
from screenloom.sources import ris
from screenloom.streaming import resume

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this file
LONG = "word " * 30_000


def _answers(batch: pd.DataFrame) -> pd.Series:
    if (batch["record_id"] == "down").any() and len(batch) > 0:
        raise ConnectionError("closed")
    out = []
    for rid, text in zip(batch["record_id"], batch["text"], strict=True):
        again = text.endswith(screening.REPROMPT)
        quote = {"ok": "first title", "late": "second title" if again else "nowhere to be found", "bad": "nowhere to be found", "none": "NA"}.get(rid)
        out.append("no JSON" if quote is None else json.dumps({"code": "EXCLUDE_OUTCOME", "quote": quote}))
    return pd.Series(out)


def test_screening_asks_again_only_where_needed(spark):
    rows = [("ok", "First title", "abs", "2001", "x"), ("late", "Second title", None, None, "x"), ("bad", "Third", "abs", "2001", "x"), ("none", None, None, None, "x"), ("mute", "t", "", "", "x"), ("down", "t", LONG, "", "x"), (None, "t", "a", "1", "x")]
    df = spark.createDataFrame(rows, "record_id string, title string, abstract string, year string, flags string")
    got = {(r["record_id"], r["model"]): r for r in screening.screen_records(df, ["m"], 1, _answers).collect()}
    tell = {k[0]: (r["screening_code"], r["flags"], r["needs_second_opinion"], r["attempts"]) for k, r in got.items()}
    assert tell == {
        "ok": ("EXCLUDE_OUTCOME", [], False, 1), "late": ("EXCLUDE_OUTCOME", [], False, 2), "bad": ("EXCLUDE_OUTCOME", ["quote_validation_failed"], True, 2),
        "none": ("EXCLUDE_OUTCOME", [], False, 1), "mute": ("INCLUDE_TA", ["parse_error"], True, 2), "down": ("INCLUDE_TA", ["api_error"], True, 1),
    }
    assert screening.screen_records(df.limit(0), ["m"], 1, _answers).count() == 0


def test_request_text(spark):
    df = spark.createDataFrame([("r", None, "{braces}", None)], "record_id string, title string, abstract string, screening_level string")
    own = screening.PROJECTS["strongminds"]
    text = df.select(screening.request(df, own.labels, own.ask, own.level).alias("t")).first()["t"]
    assert text.startswith("RECORD_ID: r\n\nSCREENING_LEVEL: review\n\nPUBLICATION_YEAR: NA\n\n") and "TITLE: \n\nABSTRACT: {braces}" in text and text.endswith(own.ask)
    asked = df.withColumns({"primary_code": F.lit("X"), "primary_decision": F.lit("EXCLUDE")})
    text = asked.select(screening.request(asked, screening.RECORD, screening.RESCREEN, critic=True).alias("t")).first()["t"]
    assert "PRIMARY_SCREENER_VERDICT:\n  screening_code: X\n  screening_decision: EXCLUDE\n  explanation: NA\n  supporting_quote: NA\n\n" in text


def test_critic_and_router(spark):
    verdicts = spark.createDataFrame([("ok", "INCLUDE_TA", "INCLUDE", True), ("mute", "EXCLUDE_TOPIC", "EXCLUDE", True), ("calm", "INCLUDE_TA", "INCLUDE", False)], "record_id string, screening_code string, screening_decision string, needs_second_opinion boolean")
    records = spark.createDataFrame([(k, "First title", "a", "2001") for k in ("ok", "mute", "calm")], "record_id string, title string, abstract string, year string")
    runs = spark.createDataFrame([("ok", "m", 0, "why", "q")], "record_id string, model string, run_idx int, explanation string, supporting_quote string")
    got = {r["record_id"]: r for r in screening.critic_review(verdicts, records, runs, "c", _answers).collect()}
    assert (got["ok"]["screening_code"], got["ok"]["adjudication"], got["ok"]["overridden_code"], got["ok"]["needs_second_opinion"]) == ("EXCLUDE_OUTCOME", "override", "INCLUDE_TA", False)
    assert (got["mute"]["screening_code"], got["mute"]["adjudication"], got["mute"]["needs_second_opinion"]) == ("EXCLUDE_TOPIC", "confirm", True)
    assert not got["calm"]["critic_applied"] and got["calm"]["adjudication"] is None
    route = lambda b: pd.Series(['{"routes": ["determinants", "not_applicable"], "primary_route": "determinants", "confidence": "High"}' if r == "ok" else "?" for r in b["record_id"]])
    got = {r["record_id"]: r for r in screening.routed(records, "m", route).collect()}
    assert got["ok"]["screener"] == "no_intervention" and not got["ok"]["router_error"] and got["calm"]["routes"] == ["intervention"] and got["calm"]["router_error"]


def test_criteria_in_two_stages(spark):
    records = spark.createDataFrame([("a", "T", "A", "2001")], "record_id string, title string, abstract string, year string")
    seen = lambda b: pd.Series([json.dumps({"pass": "CONTEXT FROM PRIOR" in t or "CRITERION: outcome" in t, "uncertain": False, "reasoning": "r" * 600}) for t in b["text"]])
    got = {r["criterion"]: r for r in screening.judge_criteria(records, ["m"], ["population", "outcome", "design"], seen).collect()}
    assert set(got) == {"population", "outcome", "design"} and all(r["pass"] and len(r["reasoning"]) == 500 for r in got.values())
    few = screening.few_shot(records.withColumn("block", F.lit("EXEMPLARS:")), ["m"], 2, lambda b: pd.Series(['{"decision": "include"}' if k else "x" for k in b["run_idx"]]))
    assert sorted((r["run_idx"], r["decision"]) for r in few.collect()) == [(0, None), (1, "INCLUDE")]


def test_failing_row_spoils_no_other(spark):
    rows = panel.expand(spark.createDataFrame([("down",), ("fine",)], "record_id string").withColumn("t", F.lit("x")), ["m"], 1).coalesce(1)
    got = {r["record_id"]: (r["raw"], r["error"]) for r in panel.screen(rows, lambda b: _answers(b), "t").collect()}
    assert got == {"down": (None, "closed"), "fine": ("no JSON", None)}


def test_mojibake_and_aliases():
    clean = quotes.clean_extracted.func(pd.Series(["waitâ€¦ itâ€“s cafÃ© Ã¶ber Ã±", None, ""]))
    assert list(clean) == ["wait... it-s café öber ñ", "", ""] and len(quotes.MOJIBAKE) == 15
    assert responses.FIELD_ALIASES["screening_code"][0] == "final_code"


def _greedy(files, items):
    """One file after the other, as the operator's meaning has it."""
    by_doi, used, found = {}, set(), {}
    for key, doi, _, _ in sorted(items, key=lambda i: i[3]):
        if doi:
            by_doi[doi] = key
    plain = lambda t: re.sub(" +", " ", re.sub("[^a-z0-9 ]", "", (t or "").lower())).strip()
    for name, dois, title in sorted(files):
        hit = next((by_doi[d] for d in dois if d in by_doi and by_doi[d] not in used), None)
        if hit is None and plain(title):
            best = max(((difflib.SequenceMatcher(None, plain(title), plain(t)).ratio(), -o, k) for k, _, t, o in items if k not in used and plain(t)), default=(0, 0, None))
            hit = best[2] if best[0] >= 0.8 else None
        if hit:
            used.add(hit)
            found[name] = hit
    return found


def test_files_take_items_one_after_the_other(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(60)]
    title = lambda: " ".join(rng.sample(words, 8))
    items = [(f"k{i:02d}", f"10.1234/d{i % 30}" if i % 3 else "", title(), i) for i in range(45)]
    items += [(f"k{i + 45:02d}", "", items[i][2] + " more", i + 45) for i in range(8)] + [("k98", None, None, 98), ("k99", "", "", 99)]
    files = []
    for i in range(60):
        own = items[rng.randrange(53)]
        slip = list(own[2])
        slip[rng.randrange(len(slip))] = "x"
        files.append((f"f{i:02d}", [own[1]] if own[1] and rng.random() < 0.5 else ["10.9999/none"], "".join(slip) if rng.random() < 0.8 else ""))
    files.append(("f99", [], None))
    a = spark.createDataFrame(files, "file string, dois array<string>, rough_title string")
    b = spark.createDataFrame(items, "zotero_key string, doi string, title string, ord int")
    got = {r["file"]: r["zotero_key"] for r in matching.match_files(a, b).collect()}
    assert got == _greedy(files, items) and len(got) > 30
    assert matching.match_files(a.limit(0), b).count() == 0
    # recall of the candidates against all pairs
    x, y = [(f, t) for f, _, t in files if t], [(k, t) for k, _, t, _ in items if t]
    close = {(f, k) for f, t in x for k, u in y if difflib.SequenceMatcher(None, t, u).ratio() >= 0.8}
    found = {(r["l"], r["r"]) for r in matching.title_pairs(spark.createDataFrame(x, "l string, title string"), spark.createDataFrame(y, "r string, title string")).collect()}
    assert len(close & found) >= 0.97 * len(close) and found <= close


def test_sniffing_and_untracked(spark):
    df = spark.createDataFrame([("a.pdf", "short\nA first line that is long enough\nx\fdoi 10.1234/ABC.5).\f\f10.1234/late", None), ("b.pdf", None, " Own title 10.5555/x, "), ("c.pdf", "", "")], "file string, text string, meta_title string")
    got = {r["file"]: r for r in matching.sniffed(df).collect()}
    assert got["a.pdf"]["rough_title"] == "A first line that is long enough" and got["a.pdf"]["dois"] == ["10.1234/abc.5"]
    assert got["b.pdf"]["rough_title"] == "Own title 10.5555/x," and got["b.pdf"]["dois"] == ["10.5555/x"] and got["c.pdf"]["rough_title"] == ""
    inventory = spark.createDataFrame([("pdfs/a.pdf",), (None,), ("",)], "pdf_path string")
    assert {r["file"] for r in matching.untracked(df, inventory).collect()} == {"b.pdf", "c.pdf"}


def test_ris_file_in_many_tasks(spark, tmp_path):
    (tmp_path / "big.ris").write_text("".join(f"TY  - JOUR\nT1  - Title {k}\n  goes on\nU1  - {k}\nER  - \n\n" for k in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        rows = ris.read_records(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 3
        got = sorted((r["row_no"], r["record_id"], r["title"]) for r in rows.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [g[1] for g in got] == [str(k) for k in range(3000)] and got[7][2] == "Title 7 goes on"


def test_metrics_without_cases_are_null(spark):
    none = spark.createDataFrame([], "record_id string, decision string")
    y = spark.createDataFrame([("a", 1)], "record_id string, y int")
    assert all(r["kappa"] is None and r["n_undecided"] == 1 for r in screening.compared(none, none, y).collect())
    one = calibration.flag_projection(spark.createDataFrame([], "share double"), 100).first()
    assert one["n"] == 0 and one["flag_rate"] is None


def test_streams_of_arrivals(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "2024-01-01 00:00:01"), (1, "a", "2024-01-01 00:00:02"), (2, "b", "2024-01-01 01:00:00"), (3, "a", "2024-01-01 00:00:03")], "id int, s string, t string").withColumn("t", F.to_timestamp("t"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for name, df, mode in (("seen", resume.new_only(stream, "id", "t", "1 hour"), "append"), ("windows", resume.arrivals(stream, "t", "1 hour", "1 hour", "s"), "complete")):
        query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        query.awaitTermination()
    assert sorted(r["id"] for r in spark.table("seen").collect()) == [1, 2, 3]
    assert sorted((r["s"], r["n"]) for r in spark.table("windows").collect()) == [("a", 3), ("b", 1)]
    years = spark.createDataFrame([("2001-05",), ("x",), (None,)], "y string").select(keys.leading_year(F.col("y")).alias("y"))
    assert [r["y"] for r in years.collect()] == [2001, None, None]
