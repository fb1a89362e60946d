"""Physical plans and the shared folder."""

from types import SimpleNamespace

import pytest

from pricebeam.plans import registered_files
from pricebeam.plans.registered import QUERIES
from pricebeam.session import discard, scratch_path, shared_dir

SF_DIR = "/root/testdata/sf0.001"
BATCH = sorted(n for n, q in QUERIES.items() if q.__module__ != registered_files.__name__)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "InArrow"):
        assert operator not in text


@pytest.mark.parametrize("name", ["last_30_days", "last_4_weeks", "date_range"])
def test_date_filters_reach_the_scan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "o_orderdate" in scan.split("DataFilters: ")[1] and "GreaterThanOrEqual" in scan
    assert "o_custkey" not in scan and "o_orderstatus" not in scan


def test_copies_of_a_key_are_reduced_before_the_shuffle(spark):
    text = plan(QUERIES["dedupe_latest"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_max" in text.split("Exchange hashpartitioning")[1]


def test_weekly_performance_shuffles_once_after_dedupe(spark):
    text = plan(QUERIES["weekly_price_arrays"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") <= 3
    text = plan(QUERIES["weekly_performance"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning(week_start") == 1


def test_an_unset_shared_folder_is_an_error_on_a_cluster():
    class Session:
        conf = SimpleNamespace(get=lambda key, default: default)
        sparkContext = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_an_unset_shared_folder_is_made_once_in_local_mode():
    made = {}

    class Session:
        conf = SimpleNamespace(get=lambda key, default: default)
        sparkContext = SimpleNamespace(
            master="local[2]", getCheckpointDir=lambda: made.get("dir"),
            setCheckpointDir=lambda folder: made.update(dir=folder))

    assert shared_dir(Session()) == shared_dir(Session()) == made["dir"]


def test_discard_only_removes_scratch(spark, tmp_path):
    with pytest.raises(ValueError):
        discard(spark, str(tmp_path))
    path = scratch_path(spark, "gone")
    spark.range(1).write.parquet(path)
    discard(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_upserts_compute_their_source_once(spark):
    text = plan(QUERIES["upsert_daily_performance"](spark, SF_DIR))
    assert text.count("FileScan") <= 2
    assert text.count("Exchange hashpartitioning") <= 5 and "Join" not in text
