"""Physical-plan assertions: no single-partition exchange on fact tables, no row-at-a-time
Python, no cartesian products; small dimensions are broadcast; scans prune columns."""

import __spark_entry__ as E
from conftest import SF_SMALL

Q = E.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def fact_rows_to_one_task(p: str) -> bool:
    """True if some single-partition exchange is fed by anything but a partial aggregate
    (a global aggregate's map side sends one small buffer per partition, which is fine)."""
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            nxt = lines[i + 1] if i + 1 < len(lines) else ""
            if "partial_" not in nxt:
                return True
    return False


def test_preprocess_plan(spark):
    p = plan(Q["preprocess_pipeline"](spark, SF_SMALL))
    assert not fact_rows_to_one_task(p)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BroadcastHashJoin" in p


def test_negative_sampling_plan_is_equi_join(spark):
    p = plan(Q["negative_samples"](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert not fact_rows_to_one_task(p)


def test_pair_expansion_has_no_cartesian(spark):
    for k in ("cross_with_classes", "precision_at_k", "subsample_sizes", "confidence_sweep", "topk_accuracy"):
        p = plan(Q[k](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, k


def test_dedup_uses_partial_aggregation(spark):
    p = plan(Q["dedup_last"](spark, SF_SMALL))
    assert "partial_max_by" in p and not fact_rows_to_one_task(p)


def test_scan_prunes_columns(spark):
    p = plan(Q["len_words"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p
