"""Ordering, splitting and sampling properties (repartition invariance, exact sizes)."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from noteflow.operators import order, sampling, split


def _docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "source")


@pytest.mark.parametrize("parts", [1, 4, 200])
def test_global_rank_is_exact_and_partition_independent(spark, parts):
    from conftest import SF_SMALL
    df = _docs(spark, SF_SMALL)
    r = order.global_rank(df, ["source", "doc_id"], "rk", num_partitions=parts)
    got = [x["doc_id"] for x in r.orderBy("rk").collect()]
    want = [x["doc_id"] for x in df.orderBy("source", "doc_id").collect()]
    assert got == want
    assert sorted(x["rk"] for x in r.collect()) == list(range(1, len(want) + 1))


def test_rank_within_hot_group(spark):
    rows = [(i, "hot" if i % 3 else f"g{i % 7}") for i in range(600)]
    df = spark.createDataFrame(rows, "k long, g string")
    r = order.rank_within(df, ["g"], ["k"], "rk").collect()
    by = {}
    for x in r:
        by.setdefault(x["g"], []).append((x["k"], x["rk"]))
    for g, pairs in by.items():
        pairs.sort()
        assert [rk for _, rk in pairs] == list(range(1, len(pairs) + 1))


@pytest.mark.parametrize("n", [0, 1, 50, 200, 10_000])
def test_last_n_flag(spark, n):
    from conftest import SF_SMALL
    df = _docs(spark, SF_SMALL)
    total = df.count()
    want = set(x["doc_id"] for x in df.orderBy(F.desc("doc_id")).limit(n).collect()) if n else set()
    got = set(x["doc_id"] for x in order.last_n_flag(df, n, ["doc_id"], "t").filter("t").collect())
    assert got == want
    assert len(got) == min(n, total)


def test_time_split3_disjoint_and_cover(spark):
    from conftest import SF_SMALL
    df = _docs(spark, SF_SMALL)
    s = split.time_split3(df, ["doc_id"], rate_pct=10).collect()
    assert len(s) == df.count()
    counts = {}
    for x in s:
        counts[x["split"]] = counts.get(x["split"], 0) + 1
    m = int(len(s) * 10 / 100)
    assert counts["test"] == m and counts["val"] == m
    assert max(x["doc_id"] for x in s if x["split"] == "train") < min(x["doc_id"] for x in s if x["split"] == "val")


def test_tail_split_zero_is_all_train(spark):
    from conftest import SF_SMALL
    df = _docs(spark, SF_SMALL)
    assert split.tail_split_n(df, 0, ["doc_id"]).filter("split = 'test'").count() == 0
    assert split.tail_split_n(df, 10 ** 6, ["doc_id"]).filter("split = 'test'").count() == df.count()


def test_random_split_exact_size_and_stable(spark):
    from conftest import SF_SMALL
    df = _docs(spark, SF_SMALL)
    a = split.random_split(df, "doc_id", 0.2, 42)
    n = df.count()
    val = sorted(x["doc_id"] for x in a.filter("split = 'val'").collect())
    assert len(val) == -(-n * 2 // 10)
    b = split.random_split(df.repartition(7), "doc_id", 0.2, 42)
    assert sorted(x["doc_id"] for x in b.filter("split = 'val'").collect()) == val


def test_subsamples_nest(spark):
    from conftest import SF_SMALL
    df = _docs(spark, SF_SMALL)
    s = split.subsample_sizes(df, [50, 100, 0], "doc_id", 42).collect()
    sets = {}
    for x in s:
        sets.setdefault(x["sample_size"], set()).add(x["doc_id"])
    assert len(sets[50]) == 50 and len(sets[100]) == 100 and len(sets[0]) == df.count()
    assert sets[50] <= sets[100] <= sets[0]


def test_kfold_is_stratified(spark):
    from conftest import SF_SMALL
    df = _docs(spark, SF_SMALL)
    f = split.kfold(df, 3, "lang", "doc_id", 42).groupBy("lang", "fold").count().collect()
    per = {}
    for x in f:
        per.setdefault(x["lang"], []).append(x["count"])
    for counts in per.values():
        assert max(counts) - min(counts) <= 1


def test_negative_samples_never_own_scheme(spark):
    from conftest import SF_SMALL
    o = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("event_id").alias("obs_id"), F.col("event_type").alias("ObservationScheme"),
        F.col("value").cast("string").alias("ObservationAnswer"))
    neg = sampling.negative_samples(o, ["ObservationAnswer"], "ObservationScheme", "obs_id", 100)
    src = {x["ObservationAnswer"]: x["ObservationScheme"] for x in o.collect()}
    rows = neg.collect()
    assert len(rows) == o.count()
    assert all(x["labels"] == 0 for x in rows)
    # a donor answer always comes from a row of another scheme
    by_scheme = {}
    for x in o.collect():
        by_scheme.setdefault(x["ObservationScheme"], set()).add(x["ObservationAnswer"])
    for x in rows:
        assert x["ObservationAnswer"] not in by_scheme[x["ObservationScheme"]] or \
            any(x["ObservationAnswer"] in v for k, v in by_scheme.items() if k != x["ObservationScheme"])
    assert src


def test_negative_samples_one_scheme_raises(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], "obs_id long, ObservationScheme string, ObservationAnswer string")
    with pytest.raises(ValueError):
        sampling.negative_samples(df, ["ObservationAnswer"], "ObservationScheme", "obs_id")


def test_examples_per_outcome_empty_stratum(spark):
    df = spark.createDataFrame([(1, "TP"), (2, "TP"), (3, "FN")], "k long, outcome string")
    out = sampling.examples_per_outcome(df, 4, "k", "outcome", 0).collect()
    assert sorted(set(x["outcome"] for x in out)) == ["FN", "TP"] and len(out) == 8


@pytest.mark.parametrize("key", ["preprocess_pipeline", "negative_samples", "sentence_scoring_pipeline",
                                 "new_class_dataset_pipeline"])
def test_results_do_not_depend_on_shuffle_partitions(spark, key):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    q = E.queries()[key]
    results = []
    for parts in ("1", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            df = q(spark, SF_SMALL)
            results.append(sorted(tuple(str(v) for v in r) for r in df.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_negative_samples_within_part(spark):
    rows = [(i, ["a", "b", "c"][i % 3], "x" if i < 40 else "y") for i in range(90)]
    df = spark.createDataFrame([(k, g, p, f"{p}{g}{k}") for k, g, p in rows],
                               "obs_id long, ObservationScheme string, src string, ObservationAnswer string")
    fast = sampling.negative_samples(df, ["ObservationAnswer"], "ObservationScheme", "obs_id", 5, within="src")
    got = {r["obs_id"]: r for r in fast.collect()}
    for k, g, p in rows:
        ans = got[k]["ObservationAnswer"]
        assert ans[0] == p and ans[1] != g             # same part, other scheme
    assert len(got) == len(rows)


def test_negative_samples_null_part(spark):
    rows = [(i, ["a", "b"][i % 2], None if i % 2 == i % 4 else "x", f"t{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "obs_id long, ObservationScheme string, src string, ObservationAnswer string")
    out = sampling.negative_samples(df, ["ObservationAnswer"], "ObservationScheme", "obs_id", 5, within="src").collect()
    part = {r[3]: (r[1], r[2]) for r in rows}
    assert len(out) == 60
    for r in out:
        assert part[r["ObservationAnswer"]][1] == r["src"] and part[r["ObservationAnswer"]][0] != r["ObservationScheme"]


@pytest.mark.parametrize("kind,values", [("date", [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]),
                                         ("decimal(10,2)", [decimal.Decimal("1.50"), decimal.Decimal("2.25")])])
def test_negative_samples_date_and_decimal_schemes(spark, kind, values):
    rows = [(i, values[i % 2], f"t{i}") for i in range(20)]
    df = spark.createDataFrame(rows, f"obs_id long, ObservationScheme {kind}, ObservationAnswer string")
    out = sampling.negative_samples(df, ["ObservationAnswer"], "ObservationScheme", "obs_id", 5).collect()
    own = {r[2]: r[1] for r in rows}
    assert len(out) == 20 and all(own[r["ObservationAnswer"]] != r["ObservationScheme"] for r in out)


def test_append_tail_warns_when_short(spark):
    base = spark.createDataFrame([(i, "a") for i in range(5)], "k long, c string")
    extra = spark.createDataFrame([(100 + i, "b") for i in range(3)], "k long, c string")
    with pytest.warns(UserWarning):
        out = sampling.append_tail(base, extra, 10, ["k"], "k", 0)
    assert out.count() == 8
    assert sampling.append_tail(base, extra, 2, ["k"], "k", 0).filter("c = 'b'").count() == 2


@pytest.mark.parametrize("n,m", [(10, 0), (10, 3), (10, 6), (10, 10), (10, 12), (7, 4)])
def test_time_split3_matches_positional_slices(spark, n, m):
    df = spark.createDataFrame([(i,) for i in range(n)], "k long")
    got = {r["k"]: r["split"] for r in split.time_split3(df, ["k"], n=m).collect()} if m else \
        {r["k"]: r["split"] for r in split.time_split3(df, ["k"], rate_pct=0).collect()}
    data = list(range(n))
    x, test = data[0:n - m], data[n - m:]
    train, val = x[0:len(x) - m], x[len(x) - m:]
    if m == 0:
        train, val, test = data, [], []
    want = {**{k: "train" for k in train}, **{k: "val" for k in val}, **{k: "test" for k in test}}
    assert got == want


# ---------------------------------------------------------------- repeated keys

def _repeated(spark):
    """Keys 1 (many times, also whole rows), 2, null; 40 rows."""
    rows = [(1, "hot", f"t{i % 12}", "2024/01/01") for i in range(36)] + [(2, "a", "x", "2024/01/02"), (2, "b", "y", None),
                                                                         (None, "a", None, "2023/01/01"), (None, "b", "z", "2025/01/01")]
    return spark.createDataFrame(rows, "obs_id long, ObservationScheme string, ObservationAnswer string, LastUpdateDate string").repartition(3)


def _sorted(rows):
    return sorted(map(str, rows))


def test_ranks_with_repeated_keys_keep_every_row(spark):
    from noteflow.operators import sorting
    df = _repeated(spark)
    want = _sorted(tuple(r) for r in df.collect())
    for out, pos in ((order.global_rank(df, ["obs_id"], "p"), "p"), (sorting.sort_by_date(df, order_by=["obs_id"]), "pos"),
                     (sampling.shuffle_rows(df, "obs_id"), "pos"), (order.global_rank(df, ["obs_id"], "p", descending=True), "p")):
        rows = out.collect()
        assert _sorted(tuple(r[c] for c in df.columns) for r in rows) == want
        assert sorted(r[pos] for r in rows) == list(range(1, 41))
    within = order.rank_within(df, ["ObservationScheme"], ["obs_id"], "p").collect()
    assert sorted(r["p"] for r in within if r["ObservationScheme"] == "hot") == list(range(1, 37)) and len(within) == 40
    both = sampling.concat_sorted(df, df, order_by=["obs_id"]).collect()
    assert sorted(r["pos"] for r in both) == list(range(1, 81))


@pytest.mark.parametrize("n", [1, 2, 3, 20, 38, 39])
def test_cuts_through_repeated_keys_are_exact(spark, n):
    from noteflow.operators import sorting
    df = _repeated(spark)
    first, last = order.first_n_flag(df, n, ["obs_id"], "f"), order.last_n_flag(df, n, ["obs_id"], "f")
    for flagged in (first, last):
        rows = flagged.collect()
        assert len(rows) == 40 and sum(r["f"] for r in rows) == n
    assert sorting.row_range(df, 40 - n, None, ["obs_id"]).count() == n
    assert split.tail_split_n(df, n, ["obs_id"]).where("split = 'test'").count() == n
    assert split.random_split(df, "obs_id", n / 40).where("split = 'val'").count() == n
    assert sampling.append_tail(df, df, n, ["obs_id"], "obs_id").count() == 40 + n


def test_sampling_with_repeated_keys_keeps_every_row(spark):
    df = _repeated(spark)
    neg = sampling.negative_samples(df, ["ObservationAnswer"], key="obs_id").collect()
    assert _sorted((r["obs_id"], r["ObservationScheme"], r["LastUpdateDate"]) for r in neg) == \
        _sorted((r["obs_id"], r["ObservationScheme"], r["LastUpdateDate"]) for r in df.collect())
    assert all(not (r["ObservationAnswer"] or "").startswith("t") for r in neg if r["ObservationScheme"] == "hot")
    folds = split.kfold(df, 3, "ObservationScheme", "obs_id").groupBy("ObservationScheme", "fold").count().collect()
    assert sum(r["count"] for r in folds) == 40 and sorted(r["count"] for r in folds if r["ObservationScheme"] == "hot") == [12, 12, 12]
    sizes = split.subsample_sizes(df, [10, 0], "obs_id").groupBy("sample_size").count().collect()
    assert {r["sample_size"]: r["count"] for r in sizes} == {10: 10, 0: 40}
    picked = sampling.examples_per_outcome(df.withColumn("outcome", F.col("ObservationScheme")), 5, "obs_id").groupBy("outcome").count().collect()
    assert {r["outcome"]: r["count"] for r in picked} == {"hot": 5, "a": 5, "b": 5}


@pytest.mark.parametrize("case", ["own keys", "repeated keys", "equal rows"])
def test_pos_neg_reread_equals_staged(spark, case):
    ids = {"own keys": range(60), "repeated keys": [i // 2 for i in range(60)], "equal rows": [i // 2 for i in range(60)]}[case]
    rows = [(k, "ab"[k % 2], f"text {k if case == 'equal rows' else i}", "2024/01/%02d" % (1 + k % 9)) for i, k in enumerate(ids)]
    df = spark.createDataFrame(rows, "obs_id long, ObservationScheme string, ObservationAnswer string, LastUpdateDate string")
    cols = ["obs_id", "labels", "ObservationScheme", "LastUpdateDate", "year", "month", "day", "pos"]
    out = [sampling.pos_neg(df, ["ObservationAnswer"], reread=r).select(*cols, "ObservationAnswer").collect() for r in (False, True)]
    for got in out:
        assert sorted(r["pos"] for r in got) == list(range(1, 121)) and sum(r["labels"] for r in got) == 60
        assert [(r["LastUpdateDate"], r["obs_id"], r["labels"]) for r in sorted(got, key=lambda r: r["pos"])] == \
            sorted((r["LastUpdateDate"], r["obs_id"], r["labels"]) for r in got)
        text = {}
        for r in rows:
            text.setdefault(r[2], r[1])
        assert all((text[r["ObservationAnswer"]] == r["ObservationScheme"]) == bool(r["labels"]) for r in got)
    if case != "repeated keys":   # rows of one key that differ interchange
        assert sorted(out[0]) == sorted(out[1])


def test_reread_rows_stay_where_they_are(spark):
    """Wide columns that are not selected are neither staged nor shuffled."""
    df = spark.range(200).selectExpr("id AS obs_id", "concat('s', id % 3) AS ObservationScheme", "concat('text ', id) AS ObservationAnswer",
                                     "'2024/01/01' AS LastUpdateDate")
    narrow = sampling.pos_neg(df, ["ObservationAnswer"], reread=True).select("obs_id", "labels", "ObservationScheme", "pos")
    assert "text" not in narrow._jdf.queryExecution().optimizedPlan().toString()
    unplaced = sampling.pos_neg(df, ["ObservationAnswer"], reread=True).select("obs_id", "labels", "ObservationAnswer")
    plan = unplaced._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and unplaced.count() == 400


def test_undrawn_donors_are_left_out_before_wide_columns_are_joined(spark):
    """The rows nobody drew are filtered on their keys: below the join that brings the texts, not above it."""
    from noteflow.operators import sampling
    from noteflow.session import staged
    keys = staged(spark.range(60).selectExpr("id AS obs_id", "concat('s', id % 3) AS ObservationScheme", "id % 20 AS t"))
    texts = staged(spark.range(20).selectExpr("id AS k", "concat('answer ', id) AS ObservationAnswer"))
    df = keys.join(texts, keys.t == texts.k).select("obs_id", "ObservationScheme", "ObservationAnswer",
                                                   F.length("ObservationAnswer").alias("ObservationAnswer_len"))
    out = sampling.negative_samples(df, ["ObservationAnswer"], key="obs_id", reread=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(plan) if "LeftSemi" in line)
    depth = plan[at].index("Join LeftSemi")
    below = [x for x in plan[at + 1:at + 1 + next((j for j, x in enumerate(plan[at + 1:]) if len(x) - len(x.lstrip(" :+-")) <= depth), len(plan))]]
    assert below and not any("Join Inner" in x for x in below)
    own = {r["obs_id"]: r["ObservationScheme"] for r in keys.collect()}
    rows = out.collect()
    assert sorted(r["obs_id"] for r in rows) == list(range(60)) and all(r["ObservationScheme"] == own[r["obs_id"]] for r in rows)
    plain = sampling.negative_samples(df, ["ObservationAnswer"], key="obs_id").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, plain))
