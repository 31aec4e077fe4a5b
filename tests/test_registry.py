"""Registered queries: SQL agreement for a cross-section, plan shape for the rest.

``python check.py`` compares every query at sf0.01.
"""

import re

import pytest

import __spark_entry__ as entry
import check
from accesslens.plans import catalog

SF = "/root/testdata/sf0.001"
CROSS_SECTION = [
    "domain_traffic_5m", "user_status_traffic_5m", "platform_traffic_5m", "node_speed_join", "node_speed_median_rank",
    "hit_traffic_1m", "late_hit_traffic_1h", "machine_flow_1m", "late_machine_speed_hour", "client_speed_flag",
    "speed_histogram", "dir_traffic_1m", "parse_dispatch", "parse_machine", "parse_rejects", "parse_json", "slow_rate_5m",
    "hit_traffic_rollup", "dim_machine_load", "join_client_host_isp", "fn_ua_list", "merge_schedule_hourly", "merge_payload",
    "sink_parquet_rows", "stream_domain_traffic_5m", "adhoc_sql",
]
WRITES = re.compile("^(sink_|stream_|scan_rollup|output_|batch_counts|.*_rollup$|pno_)")


@pytest.fixture(scope="module")
def con():
    return check.database(SF)


def test_every_query_is_named_once_and_sql_names_exist():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", CROSS_SECTION)
def test_query_equals_its_sql(spark, con, name):
    ok, note = check.compare(spark, con, name, SF)
    assert ok, note


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in catalog.queries() if not WRITES.match(n)])
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert bad not in plan


def test_flagship_reads_three_event_columns_and_sums_before_the_lookup(spark):
    plan = plan_of(entry.entry(spark))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan
    sums = [i for i, line in enumerate(plan.splitlines()) if "partial_sum(cs" in line]
    lookups = [i for i, line in enumerate(plan.splitlines()) if "_exact" in line and "Join" in line]
    assert sums and lookups and max(lookups) < min(sums)


def test_node_speed_reads_the_log_once(spark):
    df = entry.queries()["node_speed_join"](spark, "/root/testdata/sf0.01")
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    big = [line for line in final.splitlines() if "Exchange hashpartitioning(isp" in line and "speed" in line]
    assert len([line for line in big if "Reused" not in line]) == 1
    assert len([line for line in big if "Reused" in line]) == 3


#: Joins of a whole plan: pages, the two owner lookups, and what each query names besides.
JOINS = {
    "status_traffic_1s": 5, "hit_traffic_1m": 6, "late_hit_traffic_1h": 6, "late_hit_traffic_5m": 6, "speed_histogram": 3,
    "machine_speed_1m": 8, "late_machine_speed_hour": 8, "machine_status_1m": 7, "late_machine_status_hour": 7,
    "machine_hit_1m": 10, "machine_flow_1m": 10, "platform_traffic_5m": 5, "ua_traffic": 3, "node_speed_5m": 4,
}


@pytest.mark.parametrize("name", JOINS)
def test_a_query_looks_up_only_what_it_uses(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert len(re.findall(r"(?:HashJoin|MergeJoin) ", plan)) <= JOINS[name], plan


def test_no_exchange_of_the_log_for_a_lookup(spark):
    plan = plan_of(entry.queries()["hit_traffic_1m"](spark, "/root/testdata/sf0.1"))
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_stored_minutes_are_pruned_by_hour(spark):
    plan = plan_of(entry.queries()["pno_traffic_5m"](spark, SF))
    assert re.search(r"PartitionFilters: \[[^]]*hour", plan)


def test_word_lists_are_as_they_were():
    """The SQL takes these lists from the package; they are pinned here."""
    from accesslens import constants

    # fixed values, in the order in which results depend on them
    base = """
        jpg gif png bmp ico swf css js htm html doc docx pdf ppt txt zip rar
        gz tgz exe xls cvs xlsx pptx mp3 mp4 rm mpeg wav m3u wma avi mov av
        flv f4v hlv f4fmp4 f4fmp3 ts dv fhv xml apk vxes ipa deb
    """.split()
    pinned = {
        "SUFFIXES_BASE": base, "SUFFIXES_EDGE": ["m3u8", *base, "jpeg"],
        "UA_KEYWORDS": "android iphone ipad letv miui firefox chrome linux windows".split(), "UA_TV": "inphic miui letv diyomate".split(),
        "UA_MOBILE": "android iphone ipad".split(), "UA_PC": ["windows nt", "linux", "msie", "firefox", "chrome"],
    }
    assert {n: list(getattr(constants, n)) for n in pinned} == pinned


def test_raw_lines_are_cut_once(spark):
    plan = plan_of(entry.queries()["parse_dispatch"](spark, SF))
    assert plan.count("gettimestamp(") == 1
