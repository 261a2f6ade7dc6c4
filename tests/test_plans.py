"""What the physical plans of the main queries must look like to hold at scale."""

import re

import pytest

from placelake.plans import catalog

SF = "/root/testdata/sf0.01"


def plan_of(capsys, df):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def scans(plan, table):
    return re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*/" + table + r"\.parquet", plan)


def columns(scan):
    return {re.sub(r"#\d+L?", "", c) for c in scan.split(",")}


def test_listing_counts_read_two_columns_and_hash_before_the_shuffle(spark, capsys):
    plan = plan_of(capsys, catalog.listings_per_neighborhood(spark, SF))
    assert [columns(s) for s in scans(plan, "orders")] == [{"o_orderkey", "o_custkey"}]
    lowest = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
    assert " HashAggregate(" in lowest and "partial_count" in lowest


def test_listing_prices_are_not_shuffled(spark, capsys):
    plan = plan_of(capsys, catalog.price_vs_index(spark, SF))
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert not scans(plan, "supplier") and "o_orderpriority" not in "".join(scans(plan, "orders"))


def test_formatting_moves_no_rows(spark, capsys):
    for query in (catalog.format_listings_places, catalog.format_income, catalog.format_commercial):
        plan = plan_of(capsys, query(spark, SF))
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("query", [catalog.commerce_categories, catalog.orders_by_segment, catalog.avg_price_index])
def test_fan_outs_join_groups_only(spark, capsys, query):
    lines = plan_of(capsys, query(spark, SF)).splitlines()
    top_join = next(i for i, line in enumerate(lines) if "Join " in line)
    depth = [re.match(r"[ :|+\-*()\d]*", line).end() for line in lines]
    sides = [i for i in range(top_join + 1, len(lines)) if "HashAggregate(" in lines[i] and "partial" not in lines[i]]
    assert len(sides) == 2 and all(depth[i] > depth[top_join] for i in sides)
    assert not any("Aggregate(" in line for line in lines[:top_join])


def test_null_keys_are_filtered_in_the_scan(spark, capsys):
    plan = plan_of(capsys, catalog.orders_by_segment(spark, SF))
    assert "PushedFilters: [IsNotNull(o_custkey)]" in plan
    assert "IsNotNull(c_nationkey)" in plan


@pytest.mark.parametrize("name", ["format_listings", "nested_to_json", "split_message", "bad_rows", "commerce_categories",
                                  "price_vs_index", "train_test_split", "predict", "regression_metrics"])
def test_no_python_runs_on_executors(spark, capsys, name):
    plan = plan_of(capsys, catalog.QUERIES[name](spark, SF))
    assert "Python" not in plan and "MapInPandas" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
