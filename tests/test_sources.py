import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from larkspur import schemas
from larkspur.functions.projections import cast_columns, sample_rows, with_path_partitions
from larkspur.sources import readers, writers


def test_path_partitions(spark):
    paths = ["file:/x/2024/07/data.json", "file:/x/year=2024/month=08/p.json", "file:/2019/a/2024/09/p.json", "file:/x/2024/p.json", None]
    out = with_path_partitions(spark.createDataFrame([(p,) for p in paths], "source_file string")).collect()
    assert [(r.year, r.month) for r in out] == [("2024", "07"), ("2024", "08"), ("2024", "09"), (None, None), (None, None)]


def test_malformed_json_line_is_a_row_of_nulls(spark, tmp_path):
    (tmp_path / "2024" / "01").mkdir(parents=True)
    (tmp_path / "2024" / "01" / "data.json").write_text('{"claim_id": "a", "is_fraud": 1}\nnot json\n')
    rows = readers.read_json(spark, str(tmp_path), schemas.LABELS).collect()
    assert sorted((r.claim_id or "") for r in rows) == ["", "a"]


def test_uncastable_values_become_null(spark):
    raw = spark.createDataFrame([("18000.0", "xx", "40"), (None, "2020-01-01T00:00:00Z", "4x")], "a string, t string, n string")
    out = cast_columns(raw, {"a": "double", "t": "timestamp", "n": "int", "missing": "int"}).collect()
    assert [tuple(r) for r in out] == [(18000.0, None, 40), (None, dt.datetime(2020, 1, 1), None)]


def test_csv_with_schema_and_as_text(spark, tmp_path):
    df = spark.createDataFrame([("p1", 30, 1)], "policy_id string, age int, _secret int")
    writers.export_csv(df, str(tmp_path / "csv"))
    assert readers.read_csv(spark, str(tmp_path / "csv")).dtypes == [("policy_id", "string"), ("age", "string")]
    assert readers.read_csv(spark, str(tmp_path / "csv"), df.drop("_secret").schema).first().age == 30


def test_schema_is_inferred_once(spark, tmp_path):
    landing, store = tmp_path / "in", tmp_path / "schema"
    landing.mkdir()
    (landing / "a.json").write_text('{"x": 1}\n')
    first = readers.infer_schema(spark, str(landing), str(store), 1.0)
    (landing / "b.json").write_text('{"x": 1, "y": 2}\n')
    assert readers.infer_schema(spark, str(landing), str(store), 1.0) == first


def test_overwrite_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.range(3), path)
    writers.write_table(spark.range(2), path)
    assert readers.read_table(spark, path).count() == 2
    writers.write_table(spark.createDataFrame([], schemas.QUARANTINE), path)
    assert readers.read_table(spark, path).schema == schemas.QUARANTINE


def test_inferred_schema_sees_every_record(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.json").write_text('{"x": 1}\n' * 500 + '{"x": 1, "rare": "y"}\n')
    assert set(readers.infer_schema(spark, str(landing), str(tmp_path / "s")).fieldNames()) == {"x", "rare"}


def test_export_is_sorted_inside_a_month(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1 + i % 2, 1 + i % 27)) for i in range(400)]
    writers.export_json(spark.createDataFrame(rows, "i int, t timestamp"), str(tmp_path / "e"), "t", rows_a_file=30)
    files = sorted((tmp_path / "e").glob("year=2024/month=*/*.json"))
    assert len(files) >= 14 and sum(len(f.read_text().splitlines()) for f in files) == 400  # a month is no single task and no single file
    for f in files:
        times = [line.split('"t":"')[1] for line in f.read_text().splitlines()]
        assert times == sorted(times) and len(times) <= 30


def test_shared_folder_is_asked_for_on_a_cluster():
    from larkspur.sources import workdir

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "app-1"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workdir.shared_dir(Session())


def test_scratch_is_cleared(spark):
    from larkspur.sources import workdir

    path = workdir.new_dir(spark, "x")
    spark.range(3).write.parquet(path)
    workdir.remove(spark, path)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_samples(spark):
    df = spark.range(2000).selectExpr("id AS k")
    a, b = sample_rows(df, 10, "k"), sample_rows(df.where("k % 2 = 0"), 10, "k")
    assert 120 < a.count() < 280
    assert b.join(a, "k", "left_anti").count() == 0
    assert sample_rows(df, 10).count() == sample_rows(df, 10).count()


def test_schema_widths():
    assert (len(schemas.CLAIMS), len(schemas.LABELS), len(schemas.POLICIES), len(schemas.QUARANTINE)) == (17, 3, 20, 6)
