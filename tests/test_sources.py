from types import SimpleNamespace

import pytest
from pyspark.ml.linalg import Vectors

from parityscope.roles import AuditRoles, MissingColumnsError, column_report, require_columns
from parityscope.plans import scratch
from parityscope.plans.scratch import scratch_path
from parityscope.sources import first_rows, read_csv, write_parquet, write_predictions_csv


@pytest.fixture
def csv_file(tmp_path):
    def write(*lines):
        path = tmp_path / "table.csv"
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


def test_first_copy_of_a_repeated_header_is_kept(spark, csv_file):
    df = read_csv(spark, csv_file("id,a,b,a", "1,10,20,30"))
    assert df.columns == ["id", "a", "b"]
    assert tuple(df.first()) == (1, 10, 20)


def test_any_column_may_repeat_and_case_does_not_matter(spark, csv_file):
    df = read_csv(spark, csv_file('id,"x, y",B,b,id,', '1,"p, q",2,3,4,5'))
    assert df.columns == ["id", "x, y", "B", "_c5"]
    assert tuple(df.first()) == (1, "p, q", 2, 5)


def test_schema_chooses_columns_by_name(spark, csv_file):
    path = csv_file("id,a,b,a", "1,10,,30", "2,x,y,z")
    df = read_csv(spark, path, schema="b string, a string, id bigint")
    assert df.dtypes == [("b", "string"), ("a", "string"), ("id", "bigint")]
    assert sorted(map(tuple, df.collect()), key=lambda r: r[2]) == [(None, "10", 1), ("y", "x", 2)]
    with pytest.raises(ValueError):
        read_csv(spark, path, schema="missing int")


def test_empty_fields_are_null(spark, csv_file):
    rows = read_csv(spark, csv_file("id,n,s", "1,,", "2,5,t")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, None, None), (2, 5, "t")]


def test_header_is_dropped_from_every_file(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(f"id,a,a\n{i},{i},9\n")
    rows = read_csv(spark, str(tmp_path), schema="id int, a int").collect()
    assert sorted(map(tuple, rows)) == [(0, 0), (1, 1), (2, 2)]


def test_empty_file_raises(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "empty.csv"))


def test_write_parquet_replaces_and_keeps_vectors(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 2):
        rows = [(i, Vectors.dense(i, 1.0)) for i in range(n)]
        written = write_parquet(spark.createDataFrame(rows, ["id", "v"]), path)
    assert written.count() == 2
    assert written.orderBy("id").collect()[1].v == Vectors.dense(1.0, 1.0)


def test_predictions_csv_needs_its_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, [0.5, 0.5])], "id int, probability array<double>")
    with pytest.raises(MissingColumnsError):
        write_predictions_csv(df, str(tmp_path / "p"), ["id", "label"])
    write_predictions_csv(df, str(tmp_path / "p"), ["id"])
    row = spark.read.csv(str(tmp_path / "p"), header=True).first()
    assert row.probability_str == "[0.5, 0.5]"


def test_first_rows_are_ordered_and_bounded(spark):
    df = spark.range(1000).repartition(7)
    assert [r.id for r in first_rows(df, 5, "id").collect()] == [0, 1, 2, 3, 4]


def _session(master, **settings):
    """Stands in for a session: the folder can only be set when a real one starts."""
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key.replace(".", "_"), default))
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: settings.get("by_call"))
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_scratch_path_uses_the_shared_folder(spark, monkeypatch):
    deleted = []
    monkeypatch.setattr(scratch, "_delete_at_exit", lambda _, path: deleted.append(path))
    assert scratch_path(_session("yarn", by_call="hdfs:///called"), "t").startswith("hdfs:///called/t-")
    cluster = _session("yarn", spark_checkpoint_dir="hdfs:///shared/")
    first, second = scratch_path(cluster, "t"), scratch_path(cluster, "t")
    assert first.startswith("hdfs:///shared/t-") and first != second
    assert deleted[1:] == [first, second]
    with pytest.raises(RuntimeError):
        scratch_path(_session("yarn"), "t")
    assert scratch_path(spark, "t") != scratch_path(spark, "t")


def test_roles_and_reports(spark):
    roles = AuditRoles("y", "p", "g", score="s")
    assert roles.attributes == ("g",)
    assert roles.columns() == ["y", "p", "s", "g"]
    df = spark.createDataFrame([(1, None), (2, "x")], "y int, g string")
    report = column_report(df, ["y"], ["g", "s"], count_values=True).collect()
    assert [tuple(r) for r in report] == [
        ("y", True, True, "int", 2), ("g", False, True, "string", 1), ("s", False, False, None, 0),
    ]
    assert column_report(df, ["y"], ["s"]).columns == ["column", "required", "present", "type"]
    with pytest.raises(MissingColumnsError):
        column_report(df, ["z"])
    with pytest.raises(MissingColumnsError):
        require_columns(df, ["y", "z"])


def _folder(tmp_path, *files):
    for number, text in enumerate(files):
        (tmp_path / f"{number}.csv").write_text(text)
    return str(tmp_path)


@pytest.mark.parametrize("header", ["id,{},{}", "id,{} ,{},id"])
def test_files_of_another_column_order_raise(spark, tmp_path, header):
    rows = "1,2,3,4\n" if header.count(",") == 3 else "1,2,3\n"
    path = _folder(tmp_path, header.format("x", "y") + "\n" + rows, header.format("y", "x") + "\n" + rows)
    for schema in ("id int, x int, y int", None):
        with pytest.raises(Exception, match="header|Header"):
            read_csv(spark, path, schema).collect()


def test_files_of_one_header_are_read_together(spark, tmp_path):
    path = _folder(tmp_path, "id,x\n1,2\n", "id,x\n3,bad\n")
    assert sorted((r.id, r.x) for r in read_csv(spark, path, "x int, id int").collect()) == [(1, 2), (3, None)]


def test_optional_columns_and_near_names(spark, tmp_path):
    path = _folder(tmp_path, "id,n_priors_9\n1,2\n")
    read = read_csv(spark, path, "id int, age int, priors int", optional=["age"], aliases={"priors": "PRIORS"})
    assert [tuple(r) for r in read.collect()] == [(1, 2)] and read.columns == ["id", "priors"]
    with pytest.raises(ValueError):
        read_csv(spark, path, "id int, age int")
