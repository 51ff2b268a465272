"""Plan shape checks for every job."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tillroll.plans.loads import SPECS

QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.LLM_QUERIES}


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


# loads whose fixture time column is a stored column (the others derive it
# from a key, which no scan can filter on)
STORED_TIME = {
    "order_creation", "order_items", "order_payment", "order_refund", "product_reviews", "user_registration",
    "user_profile", "user_login", "user_preferences", "user_devices", "inventory_receipt", "receipt_items",
    "inventory_adjustments", "inventory_transfers", "transfer_items", "promotion_usage",
}


@pytest.mark.parametrize("spec", [s for s in SPECS if s.name in STORED_TIME], ids=lambda s: s.name)
def test_load_window_reaches_the_scan(spark, spec):
    text = _plan(QUERIES[spec.name](spark, SF_SMALL))
    assert "PushedFilters: [" in text and "GreaterThanOrEqual" in text and "LessThan" in text, text


def test_column_pruning_on_wide_scan(spark):
    df = QUERIES["category_performance"](spark, SF_SMALL)
    text = _plan(df)
    # lineitem has 11 columns; the job reads four of them
    line = [l for l in text.split("\n") if "lineitem" in l and "ReadSchema" in l] or [text]
    assert "l_comment" not in text
    assert "l_tax" not in " ".join(line)


# jobs whose big side (all-history items / payments / logins / reviews) must
# not be shuffled by the join key when the windowed side is proven small
BIG_SIDE_KEY = {
    "category_performance": "order_id",
    "product_sales": "order_id",
    "update_inventory_after_order": "order_id",
    "inventory_expense": "receipt_id",
    "revenue_recognition": "order_id",
}


@pytest.mark.parametrize("name", sorted(BIG_SIDE_KEY))
def test_big_side_is_not_shuffled_by_the_join_key(spark, name):
    import re

    key = BIG_SIDE_KEY[name]
    # an exchange on the join key alone (aggregation exchanges after partial
    # aggregation carry more keys and are fine)
    by_key = re.compile(rf"hashpartitioning\({key}#\d+L?, \d+\)")
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert not by_key.search(plan), plan
    spark.conf.set("tillroll.broadcast.maxRows", "0")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        fallback = _plan(QUERIES[name](spark, SF_SMALL))
    finally:
        spark.conf.unset("tillroll.broadcast.maxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert by_key.search(fallback) or "SortMergeJoin" in fallback


def test_ledger_is_one_pass_over_the_items(spark):
    """Shuffles of the ledger with broadcasts off, and scans of each item
    source (all are views of one file, so they are counted by columns)."""
    confs = {"tillroll.broadcast.maxRows": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        for name in ("inventory_levels", "inventory_levels_carried"):
            plan = _plan(QUERIES[name](spark, SF_SMALL))
            exchanges = [x for x in plan.split("\n") if " Exchange " in x or "- Exchange" in x]
            assert len(exchanges) <= 9, plan
            # receipt, order and transfer items, and adjustments
            assert plan.count("/lineitem.parquet") == 4
    finally:
        for k in confs:
            spark.conf.unset(k)


def test_conversion_reads_each_side_once(spark):
    for name in ("order_conversion", "order_conversion_exact"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert plan.count("FileScan") == 2, plan
