import pytest

from orefold.session import scratch_path, shared_dir
from orefold.sources import (
    count_malformed,
    drop_bronze_audit,
    read_csv_declared,
    read_csv_flagged,
    read_csv_strings,
    with_bronze_audit,
    with_gold_audit,
    with_silver_audit,
)

from .conftest import rows


def put(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_header_names_and_strings_only(spark, tmp_path):
    path = put(tmp_path / "a.csv", "b,a,x", "1, pad ,?", "2.50,,z")
    df = read_csv_strings(spark, path)
    assert df.dtypes == [("b", "string"), ("a", "string"), ("x", "string")]
    assert rows(df) == [("1", " pad ", "?"), ("2.50", None, "z")]


def test_declared_columns(spark, tmp_path):
    path = put(tmp_path / "a.csv", "a,b", "1,2")
    assert rows(read_csv_declared(spark, path, ["a", "b"])) == [("1", "2")]


def test_reordered_header_is_an_error(spark, tmp_path):
    path = put(tmp_path / "a.csv", "b,a", "1,2")
    with pytest.raises(Exception, match="header|Header"):
        read_csv_declared(spark, path, ["a", "b"]).collect()


def test_second_file_with_another_header_is_an_error(spark, tmp_path):
    put(tmp_path / "1.csv", "a,b", "1,2")
    put(tmp_path / "2.csv", "b,a", "3,4")
    with pytest.raises(Exception, match="header|Header"):
        read_csv_strings(spark, str(tmp_path)).collect()


def test_column_pruning_keeps_the_header_check(spark, tmp_path):
    good = put(tmp_path / "1.csv", "a,b,c", "1,2,3")
    assert rows(read_csv_declared(spark, good, ["a", "b", "c"]).select("c")) == [("3",)]


def test_bronze_audit_from_parameter_or_file(spark, tmp_path):
    put(tmp_path / "1.csv", "a", "1")
    put(tmp_path / "2.csv", "a", "2")
    df = read_csv_strings(spark, str(tmp_path))
    named = with_bronze_audit(df, "cars.csv", "landing").drop("_ingestion_timestamp")
    assert rows(named) == [("1", "cars.csv", "landing"), ("2", "cars.csv", "landing")]
    per_file = with_bronze_audit(df)
    assert rows(per_file.select("a", "_source_file", "_source_layer")) == [
        ("1", f"file:{tmp_path}/1.csv", "raw"),
        ("2", f"file:{tmp_path}/2.csv", "raw"),
    ]
    # A stored table keeps what it was stored with.
    assert rows(with_bronze_audit(per_file).select("a", "_source_file")) == rows(per_file.select("a", "_source_file"))
    assert per_file.filter("_ingestion_timestamp is null").isEmpty()
    assert drop_bronze_audit(per_file).columns == ["a"]


def test_silver_and_gold_audit(spark):
    df = with_gold_audit(with_silver_audit(spark.range(1), "2.0"))
    row = df.first()
    assert df.columns == ["id", "_silver_timestamp", "_silver_version", "_gold_timestamp"]
    assert row._silver_version == "2.0" and row._silver_timestamp and row._gold_timestamp


class FakeSession:
    def __init__(self, settings):
        self.conf = settings


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(FakeSession({"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession({"spark.master": "yarn"}))
    assert shared_dir(FakeSession({"spark.master": "local[2]"}))


# --- rows with a wrong number of fields -------------------------------------


@pytest.mark.parametrize("line", ["4,5", "6,7,8,9"])
@pytest.mark.parametrize("declared", [True, False])
def test_ragged_rows_stop_the_load(spark, tmp_path, line, declared):
    put(tmp_path / "r.csv", "a,b,c", "1,2,3", line)
    path = str(tmp_path / "r.csv")
    df = read_csv_declared(spark, path, ["a", "b", "c"]) if declared else read_csv_strings(spark, path)
    for shown in (df, df.select("a"), df.select("c")):
        with pytest.raises(Exception, match="MALFORMED"):
            shown.collect()


def test_ragged_rows_are_counted(spark, tmp_path):
    put(tmp_path / "r.csv", "a,b,c", "1,2,3", "4,5", "6,7,8,9", "x,,z")
    df = read_csv_flagged(spark, str(tmp_path / "r.csv"), ["a", "b", "c"])
    assert rows(count_malformed(df)) == [(4, 2)]
    assert rows(df.filter("_malformed is null").select("a", "b", "c")) == [("1", "2", "3"), ("x", None, "z")]
