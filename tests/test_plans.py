"""Physical plans: what must not appear, and what must."""

import pytest
from pyspark.sql import functions as F

from casework import plans
from casework.operators import context, corpus, retrieval
from casework.plans.registry import Tables
from tests.conftest import SF

#: Queries that only read back what a job wrote, or a table of model figures.
BATCH = [n for n in plans.oracle_sql() if n[0] not in "st"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_row_python(spark, name):
    text = plan(plans.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text, bad


def test_chunking_needs_no_shuffle(spark):
    docs = Tables(spark, SF).documents
    for out in (corpus.chunk_fixed(docs.select("doc_id", "text"), "doc_id", "text"), corpus.chunk_ratio(docs.select("doc_id", "text"), "doc_id", "text")):
        assert "Exchange" not in plan(out)
    assert "Exchange" not in plan(retrieval.keyword_index(docs, "doc_id", "text"))


def test_rank_cuts_start_before_the_shuffle(spark):
    orders = Tables(spark, SF).orders
    text = plan(context.top_k(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert "WindowGroupLimit" in plan(corpus.dedupe_docs(Tables(spark, SF).documents, "text", [F.col("doc_id").desc()]))


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(plans.queries()["f1_audience_filter"](spark, SF))
    assert "EqualTo(source,src2)" in text and "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in text


def test_keyword_scores_add_up_without_a_second_shuffle(spark):
    t = Tables(spark, SF)
    index = retrieval.keyword_index(t.documents, "doc_id", "text")
    text = plan(retrieval.bm25(t.benchmark.select(F.col("item_id").alias("q_id"), "text"), index))
    main = text[: text.index("REPARTITION_BY_COL")]
    # One exchange for the rank by question; the one by id is the repartition itself.
    assert main.count("Exchange hashpartitioning(q_id") == 1 and "Exchange hashpartitioning(q_id#" in main
    assert "id#" not in main.split("Exchange hashpartitioning(q_id")[1].split(")")[0].split(",", 1)[1]


def test_conflict_times_are_written_once_per_booking(spark):
    text = plans.queries()["r8_interval_conflicts"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" not in text[: text.index("Join")] and text.count("date_format") >= 3
