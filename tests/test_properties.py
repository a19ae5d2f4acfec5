"""Property tests on random inputs: exact global ranks and valid negative samples,
including a hot group holding most rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from noteflow.operators import order, sampling

rows_strategy = st.lists(st.tuples(st.integers(0, 10_000), st.sampled_from(["hot", "hot", "hot", "a", "b", "c"])),
                         min_size=2, max_size=60, unique_by=lambda t: t[0])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, parts=st.sampled_from([1, 3, 16]))
def test_global_rank_matches_sorted_order(spark, rows, parts):
    df = spark.createDataFrame(rows, "k long, g string")
    got = [(r["g"], r["k"], r["rk"]) for r in order.global_rank(df, ["g", "k"], "rk", num_partitions=parts).collect()]
    want = sorted((g, k) for k, g in rows)
    assert sorted(got, key=lambda t: t[2]) == [(g, k, i + 1) for i, (g, k) in enumerate(want)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, seed=st.integers(0, 1000))
def test_negative_samples_take_other_scheme_rows(spark, rows, seed):
    if len({g for _, g in rows}) < 2:
        return
    df = spark.createDataFrame([(k, g, f"{g}-{k}") for k, g in rows],
                               "obs_id long, ObservationScheme string, ObservationAnswer string")
    out = sampling.negative_samples(df, ["ObservationAnswer"], "ObservationScheme", "obs_id", seed).collect()
    assert sorted(r["obs_id"] for r in out) == sorted(k for k, _ in rows)
    donors = {f"{g}-{k}": g for k, g in rows}
    for r in out:
        assert donors[r["ObservationAnswer"]] != r["ObservationScheme"]
        assert r["labels"] == 0


def _py_is_number_or_date(s):
    import datetime
    import re

    from noteflow.functions.constants import DATE_DMY_PATTERN, DATE_YMD_PATTERN, NUMBER_PATTERN
    if s is None:
        return False
    if re.search(NUMBER_PATTERN, s):
        return True

    def valid(y, m, d):
        try:
            datetime.date(y, m, d)
            return True
        except ValueError:
            return False
    g = re.search(DATE_YMD_PATTERN, s)
    if g and valid(int(g.group(1)), int(g.group(2)), int(g.group(3))):
        return True
    g = re.search(DATE_DMY_PATTERN, s)
    if g:
        a, b, y = int(g.group(1)), int(g.group(2)), int(g.group(3))
        return valid(y, a, b) or valid(y, b, a)
    return False


texts = st.text(alphabet=st.sampled_from(list("0123456789/-.: eEaInfity+T")), min_size=0, max_size=16)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(texts, min_size=20, max_size=60))
def test_number_date_grammar_matches_python(spark, values):
    from noteflow.operators import clean
    extra = ["2020/02/29", "2021/02/29", "31-12-2020", "12-31-2020", "1e5", " 7 ", "-inf", "Infinity", "10:30",
             "2020-1-2 10:30", "2020-01-02T10:30:00.5", "13/13/2020"]
    rows = [(i, v) for i, v in enumerate(values + extra)]
    df = spark.createDataFrame(rows, "i int, s string")
    kept = {r["i"] for r in clean.drop_date_numeric(df, ["s"]).collect()}
    for i, v in rows:
        assert (i not in kept) == _py_is_number_or_date(v), repr(v)
