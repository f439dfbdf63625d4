"""Plans that must not regress: what is parsed how often, pushed down, shuffled."""

import re

import pytest

from fisclake.operators.parse import documents, items
from fisclake.registry import DOCUMENTS, ITEMS
from fisclake.session import shared_folder
from workload import auditing, loading
from workload.documents import bronze


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    path = shared_folder(spark, "bronze")
    bronze(spark, sf_dir, "nfe").write.parquet(path)
    return spark.read.parquet(path)


def test_xml_is_parsed_once_even_under_filters(stored):
    header = documents(stored, DOCUMENTS["NFe"]).filter("chave IS NOT NULL AND ICMSTot_vNF > 10")
    assert plan_of(header).count("from_xml(") == 1
    lines = items(stored, ITEMS["NFe"]).filter("chave IS NOT NULL AND vProd > 10")
    assert plan_of(lines).count("from_xml(") == 1


def test_only_needed_columns_are_read(stored):
    plan = plan_of(documents(stored, DOCUMENTS["NFe"], ["ICMSTot_vNF"]).select("chave", "ICMSTot_vNF"))
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert [part.split(":")[0] for part in read.split(",")] == ["XML_DOCUMENTO_CLOB"]


def test_windows_reach_the_scan(spark, sf_dir):
    plan = plan_of(loading.QUERIES["window_extract_hour"](spark, sf_dir))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "props" not in plan


@pytest.mark.parametrize("name", sorted(auditing.QUERIES))
def test_audits_use_no_window_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(auditing.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert not re.search(r"^[ :+*()\d-]*Window ", plan, re.M)


def test_deduplication_merges_before_the_shuffle(spark, sf_dir):
    plan = plan_of(auditing.QUERIES["dedup_composite"](spark, sf_dir))
    assert "partial_min" in plan and "partial_count" in plan
    assert "LeftAnti" in plan and "LeftSemi" in plan


def test_one_shuffle_for_two_key_lists(spark, sf_dir):
    plan = plan_of(auditing.QUERIES["key_list_missing"](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
