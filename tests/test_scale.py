"""Work of one task that must not grow with the table."""

import random

import pytest

from catalog import queries
from helpers import plan_text, rows
from sluice import operators as ops
from sluice import paths, sources
from sluice import schemas as S
from sluice.sources import records


def test_files_to_cut_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    documents = spark.range(600).selectExpr("id as doc_id", "concat('a\\n\"', id, '\"') as text")
    documents.repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    small = sum(f.stat().st_size for f in (tmp_path / "documents.parquet").glob("*.parquet")) // 3
    monkeypatch.setattr(queries, "SPLIT_FILE_BYTES", small, raising=False)
    old = spark.conf.get("spark.sql.files.openCostInBytes"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    spark.conf.set("spark.sql.files.maxPartitionBytes", f"{small // 2}b")
    try:
        scanned = queries.scan_csv_split_records(spark, str(tmp_path))
        assert len(scanned.inputFiles()) >= 3
        assert rows(scanned) == rows(documents)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old[0])
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[1])


def test_shuffles_of_split_records_grow_with_the_files(spark, tmp_path, monkeypatch):
    (tmp_path / "f.csv").write_text("a,b\n" + '1,"x\ny"\n2,z\n' * 200)
    schema = S.table(a=S.INT, b=S.STRING)
    monkeypatch.setattr(records, "tasks_for", lambda *a: paths.tasks_for(*a, each=100), raising=False)
    scanned = sources.scan_csv(spark, str(tmp_path / "f.csv"), schema, multiline=True, splittable=True)
    assert "hashpartitioning(file#" in (plan := plan_text(scanned)) and f", {2404 // 100 + 1})" in plan
    assert rows(scanned) == {(1, "x\ny"): 200, (2, "z"): 200}


def test_dictionary_entries_are_sorted_without_paths_in_common(spark, tmp_path):
    """The rows of a key hold what orders them; where a file begins and ends is with its own rows."""
    folder = tmp_path / ("long" * 40)
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.json").write_text(f'{{"a": ["{i}"], "k{i}": ["x"]}}')
    scanned = sources.scan_json_dict(spark, str(folder))
    assert rows(scanned) == {("a", ("2",)): 1, ("k0", ("x",)): 1, ("k1", ("x",)): 1, ("k2", ("x",)): 1}
    start = paths.shared_start(spark, str(folder))
    assert start.endswith("longlong/")
    plan = plan_text(scanned)
    assert f", {len(start) + 1}, 2147483647)" in plan


def test_dictionaries_are_written_by_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "DICTIONARY_ROWS", 30_000, raising=False)
    spark.range(20_000).selectExpr(
        "id as o_orderkey", "id % 7 as o_custkey", "'x' as o_orderpriority", "'O' as o_orderstatus"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    seen, repartition = [], type(spark.range(0)).repartition
    monkeypatch.setattr(type(spark.range(0)), "repartition", lambda df, n, *c: seen.append(n) or repartition(df, n, *c))
    assert queries.json_dict_pivot(spark, str(tmp_path)).count() == 40_000
    assert seen == [3]


@pytest.mark.parametrize("keep", [["k", "b"], ["k"], ["c", "k"], ["d"], ["k", "x"], ["b", "x", "k"]])
def test_kept_columns_are_those_of_the_same_survivor(spark, keep):
    """With doubles of either zero too, which tie and yet differ."""
    draw = random.Random(3)
    data = [
        (draw.choice([None, "k1", "k2", "k3"]), *(draw.choice([None, 1, 2]) for _ in range(3)),
         draw.choice([None, 0.0, -0.0]), draw.randrange(9))
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, "k string, a int, b int, c int, x double, d int")
    whole = ops.dedupe_by_key(df, ["k"], ["c"]).select(*keep)
    kept = ops.dedupe_by_key(df, ["k"], ["c"], keep=keep)
    assert kept.columns == keep
    assert {str(r) for r in rows(kept)} == {str(r) for r in rows(whole)}


def test_master_table_reads_no_column_behind_the_last_it_needs(spark, monkeypatch):
    seen = []
    bridge = ops.track_bridge
    monkeypatch.setattr(queries.ops, "track_bridge", lambda df, **o: seen.append(df) or bridge(df, **o))
    queries.master_table(spark, "/root/testdata/sf0.001")
    plan = plan_text(seen[0])
    assert "l_linestatus" in plan
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan


def test_music_files_and_stages_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(queries, "CSV_ROWS", 1000, raising=False)
    queries.music_run_dictionary(spark, "/root/testdata/sf0.001")
    tracks = [f.name for f in (tmp_path / "music-in" / "tracks.csv").glob("part-*")]
    assert len(tracks) >= 6 and all(name.endswith(".csv.gz") for name in tracks)
    written = [f.name for folder in ("music-out", "music-db") for f in (tmp_path / folder).rglob("part-*")]
    assert written and all(name.endswith(".zstd.parquet") for name in written)
