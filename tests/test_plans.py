"""What the physical plans of registered queries must and must not contain."""

import re

import pytest

from tabularium.checks.all import CHECKS

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    return CHECKS[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "f9_source_predicate")
    assert "GreaterThanOrEqual(l_shipdate" in text and "EqualTo(l_returnflag,R)" in text
    assert "l_comment" not in text and "l_tax" not in text.split("ReadSchema")[1]
    assert "ReadSchema: struct<>" in plan(spark, "s13_lazy_count")
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>", plan(spark, "s12_parquet_scan"))


@pytest.mark.parametrize("name", ["n9_explode_keep_parent", "n10_explode_drop_parent", "n16_file_tree_leaves", "table_articles", "table_transcripts",
                                  "s17_acquisition_xml", "x7_match_rows"])
def test_flattening_does_not_shuffle_by_key(spark, name):
    assert "Exchange hashpartitioning" not in plan(spark, name)


@pytest.mark.parametrize("name", ["a4_null_counts", "a12_correlation", "f1_threshold_report", "a11_column_means"])
def test_profiles_read_the_table_once(spark, name):
    scans = plan(spark, name).count("FileScan parquet")
    assert scans == (2 if name == "a4_null_counts" else 1)  # that one joins two tables


@pytest.mark.parametrize("name", ["a2_group_total", "a17_entity_rollup", "s3_page_audit", "g5_adjacency", "j1_lookup_join", "j4_primary_else_fallback",
                                  "k8_land_report", "q5_differing_rows", "j2_semi_both_ends", "f4_both_ends_member", "x15_contrast_stretch", "a14_percentiles"])
def test_no_products(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
