"""Music and product inputs derived from the test tables.

Every input comes row by row from a whole table. Missing keys, missing values,
empty lists and broken lists arise from values the tables already hold, because
the tables themselves contain no NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.functions import list_text
from sluice.operators import conform


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def day(column: str) -> Column:
    """A date or timestamp as text."""
    return F.date_format(column, "yyyy-MM-dd")


def missing(column: str, value: object) -> Column:
    """``column``, NULL where it holds ``value``."""
    return F.nullif(F.col(column), F.lit(value))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as tracks; a line number may repeat within its order.

    The listed ids are the line's part, which artists know, and its order, which
    they mostly do not. Untaxed lines have an empty list and undiscounted ones a
    list that breaks off.
    """
    whole = list_text(F.col("l_partkey"), F.col("l_orderkey"))
    listed = (
        F.when(F.col("l_tax") == 0, "[]")
        .when(F.col("l_discount") == 0, F.concat(F.lit("['"), "l_partkey", F.lit("',")))
        .otherwise(whole)
    )
    lines = read(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("name"),
        F.col("l_quantity").cast("int").alias("popularity"),
        F.col("l_suppkey").cast("int").alias("duration_ms"),
        (F.col("l_returnflag") == "R").cast("int").alias("explicit"),
        list_text(F.col("l_returnflag"), F.col("l_linestatus")).alias("artists"),
        listed.alias("id_artists"),
        day("l_shipdate").alias("release_date"),
        F.col("l_discount").alias("danceability"),
        F.col("l_tax").alias("energy"),
        F.col("l_linenumber").alias("key"),
        (-F.col("l_quantity")).alias("loudness"),
        (F.col("l_linestatus") == "O").cast("int").alias("mode"),
        (F.col("l_discount") * 2).alias("speechiness"),
        (F.col("l_tax") * 2).alias("acousticness"),
        (F.col("l_discount") + F.col("l_tax")).alias("instrumentalness"),
        (F.col("l_extendedprice") / 2).alias("liveness"),
        (F.col("l_quantity") / 2).alias("valence"),
        F.col("l_extendedprice").alias("tempo"),
        (F.col("l_linenumber") + 1).cast("int").alias("time_signature"),
    )
    return conform(lines, S.TRACKS)


def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as artists."""
    parts = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_retailprice").alias("followers"),
        list_text(F.col("p_type")).alias("genres"),
        F.col("p_name").alias("name"),
        F.col("p_size").alias("popularity"),
    )
    return conform(parts, S.ARTISTS)


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as recommendations; an artist's id is a part's, so most have none."""
    related = F.array(F.col("o_custkey").cast("string"), "o_orderpriority")
    orders = read(spark, sf_dir, "orders")
    return conform(
        orders.select(F.col("o_orderkey").alias("id"), related.alias("related_ids")),
        S.RECOMMENDATIONS,
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products; brand and size together make a key that repeats."""
    parts = read(spark, sf_dir, "part").select(
        F.concat("p_brand", F.lit("/"), missing("p_size", 1)).alias("product_id"),
        missing("p_name", "small ring").alias("product_name"),
        missing("p_type", "ECONOMY").alias("category"),
        F.lower("p_type").alias("subcategory"),
        F.when(F.col("p_type") != "PROMO", F.col("p_retailprice")).alias("price"),
        missing("p_size", 7).alias("stock"),
        missing("p_brand", "Brand#1").alias("brand"),
        F.element_at(F.split("p_name", " "), 1).alias("color"),
        F.col("p_size").alias("size"),
        F.when(F.col("p_size") > 10, F.col("p_retailprice") / 2).alias("rating"),
        F.col("p_partkey").cast("int").alias("reviews"),
    )
    return conform(parts, S.PRODUCTS)
