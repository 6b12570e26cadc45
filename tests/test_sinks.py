import os
from unittest.mock import MagicMock

import pytest
from helpers import rows

from sluice import schemas as S
from sluice.session import scratch_dir
from sluice.sinks import (
    JdbcTarget,
    ParquetTarget,
    PublishFailed,
    TableSpec,
    publish,
    publish_set,
    raise_on_failure,
    read_set,
    SetChanged,
    write_json_lines,
    write_parquet,
)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").write.parquet(path)
    return path


def test_parquet_overwrite_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    write_parquet(df, path)
    assert write_parquet(df, path).count() == 3
    assert write_parquet(df, path, "append").count() == 6


@pytest.mark.parametrize("form", ["{}", "{}/", "file:{}", "file://{}"])
def test_overwriting_the_source_is_refused(spark, table, form):
    df = spark.read.parquet(table)
    with pytest.raises(ValueError, match="refusing"):
        write_parquet(df.join(spark.range(2)), form.format(table))
    with pytest.raises(ValueError, match="refusing"):
        write_json_lines(df, form.format(os.path.dirname(table)))
    assert spark.read.parquet(table).count() == 2
    write_parquet(df, form.format(table + "2"))


def test_overwriting_a_part_of_the_source_is_refused(spark, tmp_path):
    path = str(tmp_path / "by_day")
    spark.createDataFrame([("a", 1)], "k string, day int").write.partitionBy("day").parquet(path)
    with pytest.raises(ValueError, match="refusing"):
        write_parquet(spark.read.parquet(path), f"{path}/day=1")
    joined = spark.range(1).crossJoin(spark.read.parquet(path).groupBy("k").count())
    with pytest.raises(ValueError, match="refusing"):
        write_parquet(joined, path)


def test_many_source_files_are_not_listed(spark, table, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "inputFiles", MagicMock(side_effect=AssertionError))
    df = spark.read.parquet(table)
    with pytest.raises(ValueError, match="refusing"):
        write_parquet(df, table)
    write_parquet(df, table + "3")
    assert write_parquet(df, table + "3").count() == 2


@pytest.mark.parametrize("mode", ["ignore", "error", "Append", ""])
def test_other_modes_are_refused(table, mode):
    with pytest.raises(ValueError, match="mode"):
        TableSpec(table, "t", mode)


def test_a_lossy_type_fails_its_table(spark, tmp_path):
    path, target = str(tmp_path / "d"), ParquetTarget(str(tmp_path / "db"))
    spark.createDataFrame([(1.9,)], "v double").write.parquet(path)
    schema = S.table(v=S.INT)
    status = publish(spark, [TableSpec(path, "t", "overwrite", schema=schema)], target)
    assert "narrower type" in status.first().error
    status = publish(spark, [TableSpec(path, "t", "overwrite", schema=schema, narrow=True)], target)
    assert rows(status, "status", "n_rows") == {("ok", 1): 1}
    assert rows(spark.read.parquet(target.path("t"))) == {(1,): 1}


@pytest.mark.parametrize("at_once", [1, 3])
def test_publish_keeps_the_order_of_the_specs_and_the_job_group(spark, table, tmp_path, at_once):
    specs = [TableSpec(table, f"t{i}", "append", keys=("k",), lengths={"k": 5}) for i in range(5)]
    spark.sparkContext.setLocalProperty("spark.job.description", "publishing")
    seen = []

    class Target(ParquetTarget):
        def write(self, df, *args):
            seen.append(spark.sparkContext.getLocalProperty("spark.job.description"))
            super().write(df, *args)

    status = publish(spark, specs, Target(str(tmp_path / "db")), at_once=at_once)
    spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert [r.table_name for r in status.collect()] == [f"t{i}" for i in range(5)]
    assert seen == ["publishing"] * 5
    with pytest.raises(ValueError, match="at least one"):
        publish(spark, specs, Target(str(tmp_path / "db")), at_once=0)


def test_publishing_onto_the_source_fails_safely(spark, table):
    target = ParquetTarget(os.path.dirname(table))
    status = publish(spark, [TableSpec(table, "source", "overwrite")], target)
    assert rows(status, "status") == {("failed",): 1}
    assert spark.read.parquet(table).count() == 2


def test_json_lines_keep_null_fields(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], S.RECOMMENDATIONS)
    write_json_lines(df, str(tmp_path / "t"), S.RECOMMENDATIONS_STORED_AS)
    lines = spark.read.text(str(tmp_path / "t"))
    assert rows(lines) == {('{"id":"a","related ids":null}',): 1}


def test_publish_isolates_failures(spark, table, tmp_path):
    specs = [
        TableSpec(str(tmp_path / "absent"), "absent", "overwrite"),
        TableSpec(table, "undeclared", "overwrite", schema=S.table(k=S.STRING)),
        TableSpec(table, "long", "overwrite", lengths={"k": 0}),
        TableSpec(table, "good", "append", schema=S.table(v=S.INT, k=S.STRING), keys=("k",)),
    ]
    target = ParquetTarget(str(tmp_path / "db"))
    status = publish(spark, specs, target)
    assert rows(status, "table_name", "mode", "n_rows", "status") == {
        ("absent", "overwrite", None, "failed"): 1,
        ("undeclared", "overwrite", None, "failed"): 1,
        ("long", "overwrite", None, "failed"): 1,
        ("good", "append", 2, "ok"): 1,
    }
    assert status.filter("status = 'failed' and error is null").isEmpty()
    with pytest.raises(PublishFailed, match="absent.*undeclared"):
        raise_on_failure(status)


def test_publish_counts_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty")
    spark.createDataFrame([], "k string").write.parquet(path)
    status = publish(spark, [TableSpec(path, "t", "overwrite")], ParquetTarget(str(tmp_path / "db")))
    assert rows(status, "n_rows", "status") == {(0, "ok"): 1}


def test_jdbc_options():
    """What Spark's JDBC writer is told; no database is involved."""
    df = MagicMock()
    target = JdbcTarget("jdbc:x:y", {"user": "u", "password": "secret"}, prefix="music_")
    target.write(df, "master_table", "overwrite", {"id": 50})
    writer = df.write.format
    writer.assert_called_once_with("jdbc")
    options = writer.return_value.options
    assert options.call_args.kwargs == {
        "url": "jdbc:x:y",
        "dbtable": "music_master_table",
        "user": "u",
        "password": "secret",
        "numPartitions": 16,
        "batchsize": 10_000,
        "truncate": True,
        "createTableColumnTypes": "id VARCHAR(50)",
    }
    options.return_value.mode.assert_called_once_with("overwrite")
    assert "secret" not in repr(target)


def test_jdbc_failure_is_reported_per_table(spark, table):
    specs = [TableSpec(table, name, "append") for name in ("one", "two")]
    status = publish(spark, specs, JdbcTarget("jdbc:nosuchdatabase:x"))
    assert rows(status, "table_name", "status") == {("one", "failed"): 1, ("two", "failed"): 1}
    assert "driver" in status.first().error.lower()


def test_scratch_dir_is_shared_and_fresh(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(shared)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_scratch_is_removed_when_asked(spark, monkeypatch):
    from sluice import session

    monkeypatch.setattr(session, "_MADE", [])
    path = scratch_dir(spark, "x")
    write_parquet(spark.range(3), path)
    assert os.path.isdir(path)
    scratch_dir(spark, "never written")
    session.remove_scratch(spark)
    assert not os.path.exists(path) and not session._MADE


def test_scratch_dir_refuses_a_cluster_without_shared_folder():
    spark = MagicMock()
    spark.conf.get.side_effect = lambda key, default=None: {"spark.master": "yarn"}.get(key, default)
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        scratch_dir(spark, "x")


class TestSets:
    def spec(self, path, name="t", mode="overwrite", **more):
        return TableSpec(path, name, mode, **more)

    def seen(self, spark, folder):
        return {name: df.count() for name, df in read_set(spark, folder).items()}

    def test_a_failing_table_leaves_readers_on_the_old_set(self, spark, tmp_path, table):
        folder = str(tmp_path / "set")
        assert read_set(spark, folder) == {}
        raise_on_failure(publish_set(spark, [self.spec(table), self.spec(table, "u")], folder))
        assert self.seen(spark, folder) == {"t": 2, "u": 2}
        status = publish_set(spark, [self.spec(table, mode="append"), self.spec(str(tmp_path / "none"), "u")], folder)
        assert rows(status, "table_name", "status") == {("t", "held"): 1, ("u", "failed"): 1}
        assert self.seen(spark, folder) == {"t": 2, "u": 2}
        publish_set(spark, [self.spec(table, mode="append")], folder)
        assert self.seen(spark, folder) == {"t": 4, "u": 2}
        publish_set(spark, [self.spec(table)], folder)
        assert self.seen(spark, folder) == {"t": 2, "u": 2}

    def test_torn_manifests_and_two_publishes_at_once(self, spark, tmp_path, table, monkeypatch):
        from sluice.sinks import versions

        folder = str(tmp_path / "set")
        publish_set(spark, [self.spec(table)], folder)
        (tmp_path / "set/manifests/000000000002.json").write_text('{"tables": {"t": ["now')
        assert self.seen(spark, folder) == {"t": 2}
        publish_set(spark, [self.spec(table, mode="append")], folder)
        assert self.seen(spark, folder) == {"t": 4}
        monkeypatch.setattr(versions, "_current", lambda *_: (1, {}))
        with pytest.raises(SetChanged):
            publish_set(spark, [self.spec(table)], folder)
        monkeypatch.undo()
        assert self.seen(spark, folder) == {"t": 4}

    def test_a_table_named_twice_is_refused(self, spark, tmp_path, table):
        with pytest.raises(ValueError, match="named twice"):
            publish_set(spark, [self.spec(table), self.spec(table)], str(tmp_path / "set"))
