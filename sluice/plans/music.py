"""Music: artists, tracks and recommendations to serving tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice import schemas as S
from sluice.operators import (
    bridge,
    build_master,
    build_profile,
    clean_entity,
    edges,
    project,
    require_key,
    track_bridge,
    unlisted_rows,
)
from sluice.sinks import (
    TableSpec,
    publish,
    write_json_lines,
    write_parquet,
    write_parquets,
)
from sluice.sinks.publish import Target
from sluice.sources import broken_lines, scan_csv, scan_json_dict, scan_json_lines

# Names of the input files and of the datasets written.
ARTISTS_FILE = "artists.csv"
TRACKS_FILE = "tracks.csv"
DICTIONARY_FILE = "dict_artists.json"
LINES_FILE = "fixed_da.json"
REJECTED = "rejected/music"
CLEANED = ("artists", "recommendations", "tracks")
MASTER = "stage2/master_table"
EDGES, BRIDGE = "recommendations_exploded", "artist_track"
TRACK_METADATA, ARTIST_METADATA = "track_metadata", "artist_metadata"
# The inputs are cleaned into stage 1; the serving tables form stage 3.


def reshape_recommendations(spark: SparkSession, input_dir: str) -> None:
    """Writes the recommendation dictionary of ``input_dir`` as JSON Lines."""
    pivoted = scan_json_dict(spark, f"{input_dir}/{DICTIONARY_FILE}")
    write_json_lines(pivoted, f"{input_dir}/{LINES_FILE}", S.RECOMMENDATIONS_STORED_AS)


def clean_music(
    artists: DataFrame,
    recommendations: DataFrame,
    tracks: DataFrame,
    *,
    unique_recommendations: bool = False,
    track_columns: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """The three inputs with one row per id.

    ``unique_recommendations`` says that their ids are unique already, as those
    of a dictionary are. ``track_columns`` names those wanted of the tracks, all by default.
    """
    clean = require_key if unique_recommendations else clean_entity
    cleaned = (
        clean_entity(artists, "id", ["name"]),
        clean(recommendations, "id"),
        clean_entity(tracks, "id", ["name"], keep=track_columns),
    )
    return dict(zip(CLEANED, cleaned, strict=True))


def music_tables(
    artists: DataFrame, recommendations: DataFrame, tracks: DataFrame
) -> dict[str, DataFrame]:
    """The narrow serving tables, from cleaned inputs."""
    return {
        EDGES: edges(recommendations, "id", "related_ids", "related_id"),
        BRIDGE: bridge(tracks, ["id"], "id_artists", "artist_id"),
        TRACK_METADATA: project(tracks, S.TRACK_METADATA_COLUMNS),
        ARTIST_METADATA: project(artists, S.ARTIST_METADATA_COLUMNS),
    }


def run_music(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    *,
    recommendations: str = "dictionary",
    keep_left_key: bool = False,
    outer: bool = False,
    hot_rows: int | None = None,
    check_header: bool = True,
    multiline: bool = False,
    rejects: bool = False,
    measures: bool = False,
) -> dict[str, DataFrame]:
    """Writes all datasets below ``output_dir`` and returns them by name.

    ``recommendations`` says which input to take: the ``"dictionary"`` or its
    JSON ``"lines"`` form. Later stages start from the written ones, not from
    the sources, so all outputs see the same surviving rows.

    ``hot_rows`` salts artists listed more often than that (see ``left_enrich``).
    Tracks without a readable artist list are in no bridge and, unless ``outer``,
    not in the master table; ``unlisted_tracks`` is a query that shows them.
    ``multiline`` reads CSV fields with line breaks. ``rejects`` also writes
    ``rejected_lines``, at the price of another scan: the CSV lines with a cell
    that does not fit its column, and the broken JSON lines. ``measures`` carries
    danceability, energy and tempo of the tracks into the master table, which
    else lacks them (published as NULL).
    """
    if recommendations not in ("dictionary", "lines"):
        raise ValueError(f"recommendations must be 'dictionary' or 'lines': {recommendations!r}")

    def csv(file: str, schema: T.StructType, corrupt: str | None = None) -> DataFrame:
        return scan_csv(
            spark, f"{input_dir}/{file}", schema,
            multiline=multiline, check_header=check_header, corrupt_column=corrupt,
        )

    def lines(corrupt: str | None = None) -> DataFrame:
        return scan_json_lines(
            spark, f"{input_dir}/{LINES_FILE}", S.RECOMMENDATIONS, S.RECOMMENDATIONS_STORED_AS,
            corrupt_column=corrupt,
        )

    from_dictionary = recommendations == "dictionary"
    related = scan_json_dict(spark, f"{input_dir}/{DICTIONARY_FILE}") if from_dictionary else lines()
    artists, tracks = csv(ARTISTS_FILE, S.ARTISTS), csv(TRACKS_FILE, S.TRACKS)
    stage1 = clean_music(artists, related, tracks, unique_recommendations=from_dictionary)
    first = {f"stage1/{name}": df for name, df in stage1.items()}
    if rejects:
        scans = [(ARTISTS_FILE, csv(ARTISTS_FILE, S.ARTISTS, "line")), (TRACKS_FILE, csv(TRACKS_FILE, S.TRACKS, "line"))]
        scans += [] if from_dictionary else [(LINES_FILE, lines("line"))]
        broken = [broken_lines(df, "id", "line").select(F.lit(file).alias("file"), "*") for file, df in scans]
        first[REJECTED] = reduce(DataFrame.unionByName, broken)
    written = write_parquets(first, output_dir)
    cleaned = {name: written[f"stage1/{name}"] for name in CLEANED}
    rejected = {"rejected_lines": written[REJECTED]} if rejects else {}
    profile = write_parquet(
        build_profile(
            cleaned["artists"], cleaned["recommendations"], keep_left_key=keep_left_key
        ),
        f"{output_dir}/stage2/artist_profile",
    )
    bridged = track_bridge(cleaned["tracks"], outer=outer, extra=S.TRACK_MEASURES if measures else ())
    if hot_rows is not None:
        bridged = write_parquet(bridged, f"{output_dir}/stage2/track_bridge")
    master = build_master(bridged, profile, keep_left_key=keep_left_key, hot_rows=hot_rows)
    serving = music_tables(**cleaned)
    written = write_parquets(
        {MASTER: master} | {f"stage3/{name}": df for name, df in serving.items()}, output_dir
    )
    unlisted = unlisted_rows(cleaned["tracks"], "id_artists").select("id", "id_artists")
    return {
        **cleaned,
        "master_table": written[MASTER],
        **{name: written[f"stage3/{name}"] for name in serving},
        "unlisted_tracks": unlisted,
        **rejected,
    }


def publish_music(
    spark: SparkSession, input_dir: str, target: Target, *, master_mode: str = "overwrite"
) -> DataFrame:
    """Publishes the master and serving tables; returns the status per table.

    ``master_mode="append"`` adds to the master table on every run.
    """

    def spec(path: str, mode: str, schema: T.StructType, ids: tuple, keys: tuple = ()) -> TableSpec:
        lengths = {column: S.ID_LENGTH for column in ids}
        table = path.split("/")[-1]
        return TableSpec(f"{input_dir}/{path}", table, mode, schema, keys, lengths)

    related, listed = ("id", "related_id"), ("id", "artist_id")
    return publish(
        spark,
        [
            spec(MASTER, master_mode, S.MUSIC_MASTER, ("track_id", "artist_id")),
            spec(f"stage3/{EDGES}", "overwrite", S.RECOMMENDATION_EDGES, related),
            spec(f"stage3/{BRIDGE}", "overwrite", S.ARTIST_TRACK, listed),
            spec(f"stage3/{TRACK_METADATA}", "overwrite", S.TRACK_METADATA, ("id",), ("id",)),
            spec(f"stage3/{ARTIST_METADATA}", "overwrite", S.ARTIST_METADATA, ("id",), ("id",)),
        ],
        target,
    )
