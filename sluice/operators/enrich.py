"""Left enrichment of a fact table and the denormalised music master table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import named
from sluice.operators.shape import bridge
from sluice.session import scratch_dir

def left_enrich(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    take: Mapping[str, str],
    *,
    keep_left_key: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """``left`` with columns of ``right`` attached; ``take`` maps new name to column.

    ``right`` must hold each key once, so every left row appears exactly once; a
    key that it repeats gives a row for each. The key column shows the *right*
    side's key, NULL where nothing matched; ``keep_left_key`` shows the left
    side's instead.

    Without ``hot_rows`` this is one left join: Spark broadcasts ``right`` if its
    size is below the session's threshold, and otherwise adaptive execution
    splits a partition swollen by a hot key. With ``hot_rows`` the keys that have
    more left rows than that are salted, whatever the session's settings: see
    ``_salted``. That pays where ``right`` is too large to broadcast; a million
    rows or so, what one task joins with ease, is a good value.
    """
    key = named(left_key, "l") if keep_left_key else F.col("r._key")
    kept = [key.alias(c) if c == left_key else named(c, "l") for c in left.columns]
    attached = [named(name, "r") for name in take]
    right = right.select(
        named(right_key).alias("_key"), *[named(c).alias(name) for name, c in take.items()]
    )
    match = named(left_key, "l") == F.col("r._key")
    if hot_rows is not None:
        left, right = _salted(left, right, left_key, hot_rows)
        match &= F.col("l._salt") == F.col("r._salt")
    return left.alias("l").join(right.alias("r"), match, "left").select(*kept, *attached)


def _salted(
    left: DataFrame, right: DataFrame, left_key: str, hot_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt`` that cuts each hot key into parts of ``hot_rows``.

    The counts are exact and combine before their shuffle. All hot keys are
    salted: their list, of at most ``rows of left / hot_rows`` keys, is written
    below the shared scratch folder, so Spark knows its size and broadcasts it
    only below the session's threshold. As many copies at most are added to
    ``right``. Left rows take their part from a hash of their place in a written
    file, so equal rows part too, and a task that is run again puts rows where it
    did before; a ``left`` that does not come straight from Parquet files is
    written first. NULL keys, which match nothing, are spread too.
    """
    if hot_rows < 1:
        raise ValueError(f"hot_rows must be at least 1: {hot_rows}")
    left = _placed(left)
    rows = left.groupBy(named(left_key).alias("_hot")).agg(F.count("*").alias("_rows"))
    hot = _written(
        rows.filter(F.col("_rows") > hot_rows).select(
            "_hot", F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_parts")
        ),
        "hot-keys",
    )
    part = F.pmod(F.xxhash64("_place"), F.coalesce("_parts", F.lit(1))).cast("int")
    kept = [named(c) for c in left.columns if c != "_place"]
    left = left.join(hot, named(left_key).eqNullSafe(F.col("_hot")), "left").select(
        *kept, part.alias("_salt")
    )
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    kept = [named(c) for c in right.columns]
    right = right.join(hot, F.col("_key").eqNullSafe(F.col("_hot")), "left").select(
        *kept, F.explode(parts).alias("_salt")
    )
    return left, right


def _placed(df: DataFrame) -> DataFrame:
    """``df`` with ``_place``, the file and the place in it that a row is read from."""
    place = F.struct("_metadata.file_path", "_metadata.row_index").alias("_place")
    try:
        return df.select("*", place)
    except AnalysisException:
        return _written(df, "left").select("*", place)


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def track_bridge(
    tracks: DataFrame, *, outer: bool = False, extra: Sequence[str] = ()
) -> DataFrame:
    """``(track_id, track_name, track_popularity, artist_id)`` per listed artist.

    ``extra`` columns of the track stand before the artist's id.
    """
    named = tracks.select(
        F.col("id").alias("track_id"),
        F.col("name").alias("track_name"),
        F.col("popularity").alias("track_popularity"),
        *extra,
        "id_artists",
    )
    columns = ("track_id", "track_name", "track_popularity", *extra)
    return bridge(named, columns, "id_artists", "artist_id", outer=outer)


def build_profile(
    artists: DataFrame, recommendations: DataFrame, *, keep_left_key: bool = False
) -> DataFrame:
    """All that is known about an artist, one row per id.

    Artists and recommendations are joined to each other first, so that the far
    larger bridge meets them in a single join and is shuffled once at most. Rows
    known only from recommendations matter only when unmatched keys are kept.
    """
    known = artists.select(
        "id",
        F.col("name").alias("artist_name"),
        "followers",
        "genres",
        F.col("popularity").alias("artist_popularity"),
    )
    related = recommendations.select("id", "related_ids")
    return known.join(related, "id", "full" if keep_left_key else "left")


def build_master(
    bridge: DataFrame,
    profile: DataFrame,
    *,
    keep_left_key: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per row of ``bridge`` with what is known of its artist.

    ``bridge`` comes from ``track_bridge``, ``profile`` from ``build_profile``.
    Give the profile as a written table where it may be large: Spark then knows
    its true size when choosing the join, and both join inputs come straight
    from a shuffle, which adaptive skew splitting needs.
    """
    attributes = ("artist_name", "followers", "genres", "artist_popularity", "related_ids")
    return left_enrich(
        bridge,
        profile,
        "artist_id",
        "id",
        {name: name for name in attributes},
        keep_left_key=keep_left_key,
        hot_rows=hot_rows,
    )
