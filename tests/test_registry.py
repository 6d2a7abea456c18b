"""The driver contract: every query runs, and agrees with its SQL on the given tables."""

import pytest

import __spark_entry__ as entry
import check
from placepulse.registry import load

# Agreement on all tables is what check.py is for; these cover each kind of operator.
SAMPLE = (
    "flagship_clean_corpus", "s1_csv_scan", "p8_row_id", "t12_clean_text", "t13_clean_again", "f5_reclean",
    "j1_new_reviews", "j5_normalize_titles", "u4_dedupe_reviews", "u5_extend_dimension", "a2_class_distribution",
    "a4_describe_numeric", "a9_quality_indicators", "r1_balance_classes", "r3_stratified_split", "l1_detect_language",
    "l4_encode_tokens", "m1_score_stars", "m7_classification_report", "k3_profile_reviews", "k9_publish_stats",
)


@pytest.fixture(scope="module")
def database(sf):
    return check.database(sf)


@pytest.mark.parametrize("name", SAMPLE)
def test_agrees_with_sql(spark, sf, database, name):
    assert check.compare(spark, database, name, sf) == ""


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 90
    assert entry.entry(spark).count() > 0


def test_every_operator_has_a_query():
    families = {"s": 10, "p": 8, "f": 8, "j": 5, "u": 6, "a": 16, "r": 4, "t": 21, "l": 4, "m": 10, "k": 9}
    names = {name.split("_")[0] for name in load()}
    missing = {f"{letter}{i}" for letter, n in families.items() for i in range(1, n + 1)} - names
    assert not missing


def test_plans_have_no_cartesian_product_or_single_partition_window(spark, sf):
    for name in ("a2_class_distribution", "j1_new_reviews", "u4_dedupe_reviews", "r1_balance_classes", "flagship_clean_corpus", "k2_clean_reviews"):
        plan = load()[name].run(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "Window" not in plan
