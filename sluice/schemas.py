"""Declared schemas of the input files and of the published tables."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()
STRINGS = T.ArrayType(T.StringType())


def table(**columns: T.DataType) -> T.StructType:
    """Schema from ``name=type`` pairs, in the order written."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names, order and types of the input files. Fractional
# columns are doubles, because a 32-bit float loses whole numbers above 2^24.
ARTISTS = table(id=STRING, followers=DOUBLE, genres=STRING, name=STRING, popularity=INT)

RECOMMENDATIONS = table(id=STRING, related_ids=STRINGS)

TRACKS = table(
    id=STRING, name=STRING, popularity=INT, duration_ms=INT, explicit=INT,
    artists=STRING, id_artists=STRING, release_date=STRING,
    danceability=DOUBLE, energy=DOUBLE, key=INT, loudness=DOUBLE, mode=INT,
    speechiness=DOUBLE, acousticness=DOUBLE, instrumentalness=DOUBLE,
    liveness=DOUBLE, valence=DOUBLE, tempo=DOUBLE, time_signature=INT,
)

PRODUCTS = table(
    product_id=STRING, product_name=STRING, category=STRING, subcategory=STRING,
    price=DOUBLE, stock=INT, brand=STRING, color=STRING, size=STRING,
    rating=DOUBLE, reviews=INT,
)

# The list field of the JSON Lines form is stored under a name
# with a space.
RECOMMENDATIONS_STORED_AS = {"related_ids": "related ids"}

# Columns kept by the narrow serving tables.
TRACK_METADATA_COLUMNS = (
    "id", "name", "popularity", "duration_ms", "danceability", "energy", "tempo",
)
TRACK_BRIDGE_COLUMNS = ("id", "name", "popularity", "id_artists")
TRACK_MEASURES = ("danceability", "energy", "tempo")
ARTIST_METADATA_COLUMNS = ("id", "name", "followers", "popularity")
PRODUCT_METADATA_COLUMNS = (
    "product_id", "product_name", "category", "subcategory", "brand", "color", "size",
)
PRICING_STOCK_COLUMNS = ("product_id", "price", "stock", "rating", "reviews")

# Replacements for missing product measures and product texts.
PRODUCT_DEFAULTS = {"price": 0.0, "stock": 0, "rating": 0.0, "reviews": 0}
TEXT_DEFAULT = "Unknown"

# Published tables, and the length allowed for identifier columns.
ID_LENGTH = 50

MUSIC_MASTER = table(
    track_id=STRING, track_name=STRING, track_popularity=INT,
    artist_id=STRING, artist_name=STRING, followers=DOUBLE, genres=STRING,
    artist_popularity=INT, danceability=DOUBLE, energy=DOUBLE, tempo=DOUBLE,
    related_ids=STRINGS,
)
RECOMMENDATION_EDGES = table(id=STRING, related_id=STRING)
ARTIST_TRACK = table(id=STRING, artist_id=STRING)
TRACK_METADATA = table(
    id=STRING, name=STRING, popularity=INT, duration_ms=INT,
    danceability=DOUBLE, energy=DOUBLE, tempo=DOUBLE,
)
ARTIST_METADATA = table(id=STRING, name=STRING, followers=DOUBLE, popularity=INT)
PRODUCT_MASTER = PRODUCTS
PRODUCT_METADATA = table(**{name: STRING for name in PRODUCT_METADATA_COLUMNS})
PRICING_STOCK = table(
    product_id=STRING, price=DOUBLE, stock=INT, rating=DOUBLE, reviews=INT,
)
