"""Pipeline options beyond the registered defaults."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from noteflow.plans import fixtures as fx
from noteflow.plans import pipelines


def test_preprocess_options(spark):
    obs = fx.observations_null(spark, SF_SMALL)
    full = pipelines.preprocess_pipeline(obs, fx.goals(spark), fx.converter(spark), superusers=None, min_tokens=None)
    filtered = pipelines.preprocess_pipeline(obs, fx.goals(spark), fx.converter(spark),
                                             superusers=fx.superusers(spark, SF_SMALL), min_tokens=5)
    a, b = full.count(), filtered.count()
    assert a >= b > 0
    assert full.filter(F.col("ObservationAnswer").isNull()).count() == 0
    assert set(r["type"] for r in full.select("type").distinct().collect()) <= {"signup", "purchase", "click"}


def test_combined_text_without_shuffle_keeps_answer_order(spark):
    a, c = fx.form_answers(spark, SF_SMALL), fx.form_comments(spark, SF_SMALL)
    out = pipelines.combined_text_pipeline(a, c, shuffle_seed=None)
    row = out.orderBy("myUnqualifiedId").first()
    first_answer = (a.filter((F.col("myUnqualifiedId") == row["myUnqualifiedId"]))
                     .orderBy("turn").first()["ObservationAnswer"])
    assert row["all_text"].startswith(first_answer)
