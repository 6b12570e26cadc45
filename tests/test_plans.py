from pathlib import Path

import pytest
from helpers import plan_text, rows

import fixtures as fx
from sluice import plans
from sluice import schemas as S
from sluice.operators import dedupe_by_key
from sluice.sinks import ParquetTarget, raise_on_failure
from sluice.sources import scan_csv, scan_json_dict

MASTER_COLUMNS = ("track_id", "track_name", "artist_id", "artist_name", "followers", "related_ids")


@pytest.fixture(scope="module")
def music_in(tmp_path_factory):
    folder = tmp_path_factory.mktemp("music")
    (folder / "artists.csv").write_text(fx.ARTISTS_CSV)
    (folder / "tracks.csv").write_text(fx.TRACKS_CSV)
    (folder / "dict_artists.json").write_text(fx.DICTIONARY_JSON)
    return str(folder)


@pytest.fixture(scope="module")
def music_out(spark, music_in, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("music-out"))
    return folder, plans.run_music(spark, music_in, folder)


def test_cleaned_artists(spark, music_in):
    artists = scan_csv(spark, f"{music_in}/artists.csv", S.ARTISTS)
    cleaned = plans.clean_music(artists, artists, artists)["artists"]
    assert rows(cleaned, "id", "followers", "name", "popularity") == {
        ("a1", 100.0, "Ann", 50): 1,
        ("a2", None, 'Bob "B" Ray', None): 1,
        ("a3", 16777217.0, "Cy", None): 1,
    }


def test_music_master(music_out):
    written = music_out[1]
    assert rows(written["master_table"], *MASTER_COLUMNS) == fx.MASTER
    declared = [c for c in S.MUSIC_MASTER.names if c not in ("danceability", "energy", "tempo")]
    assert written["master_table"].columns == declared


def test_music_serving_tables(music_out):
    written = music_out[1]
    assert rows(written["recommendations_exploded"]) == {("a1", "a3"): 1, ("a9", "a1"): 1}
    assert rows(written["artist_track"]) == {
        ("t1", "a1"): 1, ("t1", "a2"): 1, ("t2", "a9"): 1, ("t5", "a1"): 2,
    }
    assert rows(written["unlisted_tracks"], "id") == {("t3",): 1, ("t4",): 1}
    assert written["track_metadata"].schema == S.TRACK_METADATA
    assert written["artist_metadata"].schema == S.ARTIST_METADATA
    assert written["track_metadata"].count() == 5
    assert written["master_table"].count() == written["artist_track"].count()


def test_sources_are_scanned_no_more_than_stated(spark, music_in):
    artists = scan_csv(spark, f"{music_in}/artists.csv", S.ARTISTS)
    related = scan_json_dict(spark, f"{music_in}/dict_artists.json")
    tracks = scan_csv(spark, f"{music_in}/tracks.csv", S.TRACKS)
    scans = {
        name: plan_text(df).count("Location:")
        for name, df in plans.clean_music(artists, related, tracks).items()
    }
    assert scans == {"artists": 1, "recommendations": 1, "tracks": 1}


def test_a_dictionary_that_breaks_off_stops_the_run(spark, music_in, tmp_path):
    for name in ("artists.csv", "tracks.csv"):
        (tmp_path / name).write_text(Path(music_in, name).read_text())
    (tmp_path / "dict_artists.json").write_text('{"a1": ["a2"], "a2": ["a1"')
    with pytest.raises(Exception, match="breaks off"):
        plans.run_music(spark, str(tmp_path), str(tmp_path / "out"))


def test_line_breaks_and_broken_lines(spark, music_in, tmp_path):
    (tmp_path / "artists.csv").write_text(Path(music_in, "artists.csv").read_text())
    tracks = Path(music_in, "tracks.csv").read_text()
    (tmp_path / "tracks.csv").write_text(tracks.replace("One, two", "One,\ntwo").replace("t2,Ghost,20", "t2,Ghost,many"))
    (tmp_path / "fixed_da.json").write_text('{"id": "a1", "related ids": ["a3"]}\n{"id": "a2", "rel\n')
    written = plans.run_music(
        spark, str(tmp_path), str(tmp_path / "out"), recommendations="lines", multiline=True, rejects=True
    )
    assert rows(written["master_table"], "track_id", "track_name", "track_popularity", "artist_id") == {
        ("t1", "One,\ntwo", 10, "a1"): 1, ("t1", "One,\ntwo", 10, "a2"): 1,
        ("t2", "Ghost", None, None): 1, ("t5", "Twice", 50, "a1"): 2,
    }
    rejected = {(r.file, r.id): r.line for r in written["rejected_lines"].collect()}
    assert set(rejected) == {("artists.csv", "a3"), ("tracks.csv", "t2"), ("fixed_da.json", None)}
    assert rejected["fixed_da.json", None] == '{"id": "a2", "rel'
    assert rejected["tracks.csv", "t2"].startswith("t2,Ghost,many")


def test_measures_reach_the_published_master(spark, music_in, tmp_path):
    out, target = str(tmp_path / "out"), ParquetTarget(str(tmp_path / "db"))
    plans.run_music(spark, music_in, out, measures=True)
    raise_on_failure(plans.publish_music(spark, out, target))
    published = spark.read.parquet(target.path("master_table"))
    assert published.schema == S.MUSIC_MASTER
    assert rows(published.filter("track_id = 't1'"), "danceability", "energy", "tempo") == {(0.5, 0.6, 120.0): 2}


def test_later_stages_read_the_written_ones(music_out):
    folder, written = music_out
    for name in ("master_table", "artist_track", "track_metadata"):
        assert "Scan parquet" in plan_text(written[name])
        assert "Scan csv" not in plan_text(written[name])


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_music_keep_key_and_salting(spark, music_in, tmp_path, hot_rows):
    out = str(tmp_path / "out")
    kept = plans.run_music(spark, music_in, out, keep_left_key=True, hot_rows=hot_rows)
    assert rows(kept["master_table"], *MASTER_COLUMNS) == fx.MASTER_KEEP_KEY
    plain = plans.run_music(spark, music_in, out, hot_rows=hot_rows)
    assert rows(plain["master_table"], *MASTER_COLUMNS) == fx.MASTER


def test_music_outer_keeps_unlisted_tracks(spark, music_in, tmp_path):
    written = plans.run_music(spark, music_in, str(tmp_path / "out"), outer=True)
    assert rows(written["master_table"], "track_id", "artist_id").keys() >= {
        ("t3", None), ("t4", None),
    }


def test_reshaped_lines_give_the_same_result(spark, music_in, tmp_path):
    plans.reshape_recommendations(spark, music_in)
    written = plans.run_music(spark, music_in, str(tmp_path / "out"), recommendations="lines")
    assert rows(written["master_table"], *MASTER_COLUMNS) == fx.MASTER
    with pytest.raises(ValueError, match="dictionary"):
        plans.run_music(spark, music_in, str(tmp_path / "out"), recommendations="xml")


def test_publish_music(spark, music_out, tmp_path):
    target = ParquetTarget(str(tmp_path / "db"))
    status = plans.publish_music(spark, music_out[0], target)
    raise_on_failure(status)
    assert rows(status, "table_name", "n_rows") == {
        ("master_table", 5): 1, ("recommendations_exploded", 2): 1, ("artist_track", 5): 1,
        ("track_metadata", 5): 1, ("artist_metadata", 3): 1,
    }
    for _ in range(2):
        plans.publish_music(spark, music_out[0], target, master_mode="append")
    published = spark.read.parquet(target.path("master_table"))
    assert published.count() == 15
    assert published.schema == S.MUSIC_MASTER
    assert published.filter("tempo is not null").isEmpty()
    assert spark.read.parquet(target.path("artist_track")).count() == 5


@pytest.fixture(scope="module")
def products(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("products")
    (folder / "p.csv").write_text(fx.PRODUCTS_CSV)
    out = str(folder / "out")
    return out, plans.run_products(spark, str(folder / "p.csv"), out)


def test_products(products):
    written = products[1]
    assert set(rows(written["cleaned_data"])) == fx.PRODUCTS_CLEAN
    texts = ("product_id", "product_name", "category", "subcategory")
    assert set(rows(written["master_table"], *texts)) == fx.PRODUCTS_MASTER_TEXTS
    assert ("p1", "silk DRESS long", "women", "Evening wear") in rows(
        written["product_metadata"], *texts
    )
    assert written["product_metadata"].schema == S.PRODUCT_METADATA
    assert written["pricing_stock"].schema == S.PRICING_STOCK


def test_products_served_normalized(spark, products, tmp_path):
    source = products[0].removesuffix("out") + "p.csv"
    written = plans.run_products(spark, source, str(tmp_path / "out"), serve_normalized=True)
    assert ("p1", "WOMEN") in rows(written["product_metadata"], "product_id", "category")


def test_products_with_broken_lines(spark, products, tmp_path):
    source = products[0].removesuffix("out") + "p.csv"
    written = plans.run_products(spark, source, str(tmp_path / "out"), rejects=True)
    assert {r.product_id for r in written["rejected_lines"].collect()} == {"p3"}
    assert set(rows(written["cleaned_data"])) == fx.PRODUCTS_CLEAN


def test_publish_products(spark, products, tmp_path):
    target = ParquetTarget(str(tmp_path / "db"))
    status = plans.publish_products(spark, products[0], target)
    raise_on_failure(status)
    assert rows(status, "n_rows") == {(3,): 3}


def test_rerun_overwrites(spark, music_in, tmp_path):
    out = str(tmp_path / "out")
    first = rows(plans.run_music(spark, music_in, out)["master_table"])
    assert rows(plans.run_music(spark, music_in, out)["master_table"]) == first


def test_dedupe_on_all_columns_is_distinct(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(dedupe_by_key(df, ["k"])) == {("a",): 1, (None,): 1}
