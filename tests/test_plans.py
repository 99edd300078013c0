"""Plans keep their shape: few shuffles, no Python, pruned scans."""

import pytest
from conftest import SMALL

import __spark_entry__ as entry
from inboxlens.operators import models
from inboxlens.sources import mailbox

LLM = set(entry.llm_registry.queries()) if entry.llm_registry else set()
LAZY = [n for n in entry.queries() if n not in LLM and not n.startswith(("sync_", "stream_"))]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The mail relation as a stored message table."""
    folder = str(tmp_path_factory.mktemp("raw") / "messages")
    mailbox.mail(spark, SMALL).write.parquet(folder)
    return spark.read.parquet(folder)


def classified(raw):
    return models.classify(models.find_job_mail(models.staging(raw)))


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_products(spark, plan_of, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    for node in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_application_mart_is_one_shuffle(raw, plan_of):
    plan = plan_of(models.applications(classified(raw), as_of=mailbox.AS_OF))
    assert plan.count("Exchange") == 1
    assert "partial_min_by" in plan and "Join" not in plan
    shuffled = plan[plan.index("Exchange") :].split("Project [")[1].split("]")[0]
    assert "plain_body" not in shuffled


def test_each_pattern_runs_once(raw, plan_of):
    plan = plan_of(models.applications(classified(raw), as_of=mailbox.AS_OF))
    assert plan.count("regexp_extract(") == 9
    assert plan.count("RLIKE(") == 6


def test_scans_are_pruned_and_filtered(raw, plan_of):
    plan = plan_of(models.thread_rollup(classified(raw)))
    assert "IsNotNull(thread_id)" in plan and "IsNotNull(message_id)" in plan
    schema = plan[plan.index("ReadSchema") :]
    assert "ingested_at" not in schema
    meta = plan_of(models.staging(raw).select("received_at"))
    assert "ReadSchema: struct<message_id:string,received_at:timestamp>" in meta


def test_json_is_parsed_once(spark, plan_of):
    for name in ("landing_roundtrip", "landing_documents"):
        # the other from_json takes a line of several objects apart
        assert plan_of(entry.queries()[name](spark, SMALL)).count("from_json(StructField(") == 1


def test_latest_status_needs_no_sort_of_threads(raw, plan_of):
    plan = plan_of(models.latest_status(classified(raw)))
    assert "Window" not in plan and "partial_max" in plan


def test_generated_methods_can_be_compiled(spark, raw):
    """The JVM interprets methods beyond 8,000 bytes of bytecode for good."""
    import re

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = models.applications(classified(raw), as_of=mailbox.AS_OF)
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000
