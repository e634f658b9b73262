"""Properties from SURVEY 5: partitions of the long calls, and covered <= total."""

from pyspark.sql import functions as F

from pulseboard.operators import renewal as RN
from pulseboard.operators import sla as SL
from pulseboard.operators import touches as T
from pulseboard.queries import HISTORY, job_for

from .conftest import SF01


def test_unlogged_plus_matched_is_long_calls(spark):
    j = job_for(spark, SF01, HISTORY)
    long_calls = j.base.where((F.col("channel") != "action") & F.col("qualifies"))
    acts = j.base.where(F.col("channel") == "action").select("rep", "org", "day")
    matched = long_calls.join(acts, ["rep", "org", "day"], "left_semi")
    unlogged = T.unlogged_calls(j.base)
    assert unlogged.count() + matched.count() == long_calls.count()
    assert unlogged.join(matched, ["source_id", "channel"], "left_semi").count() == 0


def test_covered_never_exceeds_total(spark):
    j = job_for(spark, SF01, HISTORY)
    cov = j.coverage()
    bad = cov.where((F.col("cohort_called") > F.col("cohort_total")) | (F.col("m2m_called") > F.col("m2m_orgs"))
                    | (F.col("m2m_orgs") + F.col("annual_orgs") < F.col("cohort_total"))
                    | (F.col("coverage_pct") > 1) | (F.col("coverage_pct") < 0))
    assert cov.count() > 0 and bad.count() == 0
    sla = SL.retention_sla(j.src.cases, j.allow, j.outreach_keys, j.anchors)
    assert sla.where(F.col("sla_met_count") > F.col("total_ret_cases")).count() == 0
    ch = SL.churn_task_compliance(j.src.tasks, j.allow, j.outreach_keys, j.anchors, j.rules)
    assert ch.where((F.col("churn_tasks_reached") > F.col("total_churn_tasks"))
                    | ((F.col("has_unattempted_churn") == 1) != (F.col("churn_tasks_reached") < F.col("total_churn_tasks")))
                    ).count() == 0
