import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from pricebeam import schemas
from pricebeam.operators.upsert import DuplicateKeyError
from pricebeam.sources import export, tables
from pricebeam.sources.files import (
    bad_rows,
    classify,
    good_rows,
    pull_series,
    read_csv_strict,
    read_csv_text,
    read_json,
)
from pricebeam.sources.tables import append_load, overwrite_table, read_table, upsert_table

D = dt.date
LINES = """value,date,index,daily_return,monthly_return
10.5,2024-01-02,DOW,,
bad,2024-01-03,DOW,0.1,NULL
11.5,2024-01-04,DOW,0.1
12.0,2024-01-05,DOW,0.2,0.3,extra
12.5,2024-01-08,DOW,NULL,0.3
13.5,,DOW,0.1,0.3
14.5,2024-01-09,DOW,NaN,0.3
"""


@pytest.fixture
def landed(tmp_path):
    def write(text, name="a.csv"):
        (tmp_path / name).write_text(text)
        return str(tmp_path)

    return write


def test_tolerant_load(spark, landed):
    rows = classify(read_csv_text(spark, landed(LINES)))
    good = sorted(tuple(r) for r in good_rows(rows).collect())
    assert good == [(10.5, D(2024, 1, 2), "DOW", None, None), (12.5, D(2024, 1, 8), "DOW", None, 0.3),
                    (14.5, D(2024, 1, 9), "DOW", None, 0.3)]
    bad = {r.reason: r for r in bad_rows(rows).collect()}
    assert sorted(bad) == ["date", "field count", "index_value"]
    assert bad["index_value"].index_value == "bad"
    lines = sorted(r.line for r in bad_rows(rows).filter("line IS NOT NULL").collect())
    assert lines == ["11.5,2024-01-04,DOW,0.1", "12.0,2024-01-05,DOW,0.2,0.3,extra"]


def test_binding_is_positional(spark, landed):
    folder = landed("a,b,c,d,e\n1.0,2024-01-02,DOW,0.5,0.6\n")
    assert tuple(read_csv_strict(spark, folder).first()) == (1.0, D(2024, 1, 2), "DOW", 0.5, 0.6)


@pytest.mark.parametrize("line", LINES.splitlines()[2:5])
def test_strict_load_raises(spark, landed, line):
    folder = landed(LINES.splitlines()[0] + "\n1.0,2024-01-02,DOW,,\n" + line + "\n")
    with pytest.raises(Exception, match="bad row"):
        read_csv_strict(spark, folder).select("index_name").collect()
    with pytest.raises(Exception, match="bad row"):
        read_csv_strict(spark, folder).count()


def test_every_file_has_its_header_skipped(spark, landed):
    head = LINES.splitlines()[0] + "\n"
    landed(head + "1.0,2024-01-02,DOW,,\n", "a.csv")
    folder = landed(head + "2.0,2024-01-03,DOW,,\n", "b.csv")
    assert read_csv_strict(spark, folder).count() == 2


def test_json(spark, landed):
    folder = landed('{"date":"2024-01-02","index_name":"DOW","index_value":1.5}\n'
                    '{"date":"2024-01-03","index_name":"DOW"}\n', "a.json")
    assert sorted(tuple(r) for r in read_json(spark, folder).collect()) == [
        (D(2024, 1, 2), "DOW", 1.5), (D(2024, 1, 3), "DOW", None)]


def test_pull_series(spark, tmp_path):
    files = {"SP500": "2024-01-02,5\n2024-01-03,.\n", "DJIA": "2023-12-29,1\n2024-01-02,7\n"}
    for series, rows in files.items():
        (tmp_path / f"series_id={series}").mkdir()
        (tmp_path / f"series_id={series}" / "x.csv").write_text("DATE,VALUE\n" + rows)
    out = pull_series(spark, str(tmp_path), F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 31)))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == [
        ("DJIA", D(2024, 1, 2), 7.0), ("SP500", D(2024, 1, 2), 5.0), ("SP500", D(2024, 1, 3), None)]
    (tmp_path / "series_id=SP500" / "y.csv").write_text("DATE,VALUE\n2024-01-02,five\n")
    with pytest.raises(Exception, match="bad series row: 2024-01-02 five SP500"):
        pull_series(spark, str(tmp_path), F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 31))).collect()
    plan = out.filter("series_id = 'SP500'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(series_id" in plan


LANDED = "value double, date date, index string, daily_return double, monthly_return double"


def test_export_roundtrip_and_name(spark, scratch):
    df = spark.createDataFrame([(1 / 3, D(2024, 1, 2), "S&P500", None, 1e-17)] * 10, LANDED)
    out = export.export_csv(df.repartition(4), scratch("out"), D(2024, 1, 31))
    assert out.path.endswith("_20240131.csv") and out.rows == 10
    assert {tuple(r) for r in read_csv_strict(spark, out.path).collect()} == {
        (1 / 3, D(2024, 1, 2), "S&P500", None, 1e-17)}


def test_export_of_nothing(spark, scratch):
    out = export.export_csv(spark.createDataFrame([], LANDED), scratch("out"), D(2024, 1, 31))
    assert out.rows == 0


def test_export_detects_missing_rows(spark, scratch, monkeypatch):
    df = spark.createDataFrame([(1.0, D(2024, 1, 2), "DOW", None, None)], LANDED)
    send = export.write_csv
    monkeypatch.setattr(export, "write_csv", lambda *a: send(*a) + 1)
    with pytest.raises(export.SinkVerificationError):
        export.export_csv(df, scratch("out"), D(2024, 1, 31))


# --- tables ---

def monthly(spark, rows):
    return spark.createDataFrame(rows, schemas.MONTHLY_METRICS.columns)


def contents(spark, layers, spec=schemas.MONTHLY_METRICS):
    return sorted((tuple(r) for r in read_table(spark, layers, spec).collect()), key=repr)


BASE = [(D(2024, 1, 1), "a", 1.0), (D(2024, 2, 1), "a", 2.0), (D(2024, 2, 1), "b", 3.0)]


def test_tables_match_their_contract(spark, layers):
    for spec in schemas.TABLES:
        assert [(f.name, f.dataType) for f in read_table(spark, layers, spec).schema.fields] == [
            (f.name, f.dataType) for f in spec.columns.fields]


def test_overwrite_replaces_everything(spark, layers):
    overwrite_table(monthly(spark, BASE), layers, schemas.MONTHLY_METRICS)
    overwrite_table(monthly(spark, BASE[:1]), layers, schemas.MONTHLY_METRICS)
    assert contents(spark, layers) == BASE[:1]


def test_upsert_table_touches_only_its_months(spark, layers):
    overwrite_table(monthly(spark, BASE), layers, schemas.MONTHLY_METRICS)
    files = lambda: {r[0] for r in spark.table(layers.name(schemas.MONTHLY_METRICS)).filter(
        "part_month = '2024-01-01'").select(F.input_file_name()).collect()}
    january = files()
    upsert_table(monthly(spark, [(D(2024, 2, 1), "b", 9.0), (D(2024, 3, 1), "b", 4.0)]), layers,
                 schemas.MONTHLY_METRICS)
    assert contents(spark, layers) == sorted(
        [BASE[0], BASE[1], (D(2024, 2, 1), "b", 9.0), (D(2024, 3, 1), "b", 4.0)], key=repr)
    assert files() == january


def test_upsert_table_is_repeatable_and_guarded(spark, layers):
    rows = monthly(spark, BASE)
    for _ in range(2):
        upsert_table(rows, layers, schemas.MONTHLY_METRICS, "t1")
    assert contents(spark, layers) == BASE
    upsert_table(monthly(spark, []), layers, schemas.MONTHLY_METRICS)
    with pytest.raises(DuplicateKeyError):
        upsert_table(rows.unionByName(rows), layers, schemas.MONTHLY_METRICS)
    assert contents(spark, layers) == BASE


def test_null_keys_are_inserted(spark, layers):
    row = [(D(2024, 1, 1), None, 5.0)]
    upsert_table(monthly(spark, BASE), layers, schemas.MONTHLY_METRICS)
    upsert_table(monthly(spark, row * 2), layers, schemas.MONTHLY_METRICS)
    undated = [(None, "a", 6.0)]
    upsert_table(monthly(spark, undated), layers, schemas.MONTHLY_METRICS)
    upsert_table(monthly(spark, undated), layers, schemas.MONTHLY_METRICS)
    assert contents(spark, layers) == sorted(BASE + row * 2 + undated * 2, key=repr)


def test_upsert_table_survives_a_crash_while_replacing(spark, layers, monkeypatch):
    overwrite_table(monthly(spark, BASE), layers, schemas.MONTHLY_METRICS)
    source = monthly(spark, [(D(2024, 2, 1), "b", 9.0)])
    replace = tables._replace

    def crash(df, table, scope):
        # The worst moment: the old month is gone, the new one is not there yet.
        spark.sql(f"ALTER TABLE {table} DROP PARTITION (part_month = '2024-02-01')")
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "_replace", crash)
    with pytest.raises(RuntimeError):
        upsert_table(source, layers, schemas.MONTHLY_METRICS, "t2")
    monkeypatch.setattr(tables, "_replace", replace)
    upsert_table(source, layers, schemas.MONTHLY_METRICS, "t2")
    assert contents(spark, layers) == [BASE[0], BASE[1], (D(2024, 2, 1), "b", 9.0)]


def test_append_load_counts_a_repeated_load_once(spark, layers):
    spec = schemas.RAW_STAGING
    schema = StructType(schemas.RAW_VALUES.fields + [StructField("load_timestamp", TimestampType())])
    rows = spark.createDataFrame([(1.0, D(2024, 1, 2), "a", None, None, dt.datetime(2024, 1, 3))], schema)
    append_load(rows, layers, spec, "l1")
    append_load(rows, layers, spec, "l1")
    append_load(rows, layers, spec, "l2")
    assert read_table(spark, layers, spec).count() == 2
