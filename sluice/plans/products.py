"""Fashion products: one CSV to cleaned, normalised and serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice import schemas as S
from sluice.operators import clean_entity, fill_nulls, normalize_text, project
from sluice.sinks import TableSpec, publish, write_parquets
from sluice.sinks.publish import Target
from sluice.sources import broken_lines, scan_csv

# Names of the datasets written.
CLEANED = "stage1/cleaned_data"
MASTER = "stage2/master_table"
SERVING = {"product_metadata": "stage3/product_metadata", "pricing_stock": "stage3/pricing_stock"}
REJECTED = "rejected/products"


def clean_products(products: DataFrame) -> DataFrame:
    """One row per product id, with defaults for missing measures and texts."""
    cleaned = clean_entity(products, "product_id", ["product_name"])
    return fill_nulls(cleaned, S.PRODUCT_DEFAULTS, S.TEXT_DEFAULT)


def product_master(cleaned: DataFrame) -> DataFrame:
    """Cleaned products with title-cased names and upper-cased categories."""
    return normalize_text(cleaned, title=["product_name"], upper=["category", "subcategory"])


def product_tables(products: DataFrame) -> dict[str, DataFrame]:
    """The two narrow serving tables."""
    return {
        "product_metadata": project(products, S.PRODUCT_METADATA_COLUMNS),
        "pricing_stock": project(products, S.PRICING_STOCK_COLUMNS),
    }


def run_products(
    spark: SparkSession,
    input_file: str,
    output_dir: str,
    *,
    serve_normalized: bool = False,
    multiline: bool = False,
    check_header: bool = True,
    rejects: bool = False,
) -> dict[str, DataFrame]:
    """Writes all datasets below ``output_dir`` and returns them by name.

    The serving tables carry the texts as cleaned; ``serve_normalized`` takes
    them from the normalised master instead. The file is scanned once, and once
    more for ``rejects``: they also write ``rejected_lines``, the lines with a
    cell that does not fit its column.
    """
    options = {"multiline": multiline, "check_header": check_header}
    products = scan_csv(spark, input_file, S.PRODUCTS, **options)
    first = {CLEANED: clean_products(products)}
    if rejects:
        broken = scan_csv(spark, input_file, S.PRODUCTS, corrupt_column="line", **options)
        first[REJECTED] = broken_lines(broken, "product_id", "line")
    stage1 = write_parquets(first, output_dir)
    cleaned = stage1[CLEANED]
    master = product_master(cleaned)
    served = product_tables(master if serve_normalized else cleaned)
    later = {MASTER: master} | {SERVING[name]: df for name, df in served.items()}
    written = write_parquets(later, output_dir)
    return {
        "cleaned_data": cleaned,
        "master_table": written[MASTER],
        **{name: written[path] for name, path in SERVING.items()},
        **({"rejected_lines": stage1[REJECTED]} if rejects else {}),
    }


def publish_products(spark: SparkSession, input_dir: str, target: Target) -> DataFrame:
    """Publishes the master and serving tables; returns the status per table."""
    lengths = {"product_id": S.ID_LENGTH}
    tables = [
        (MASTER, "master_table", S.PRODUCT_MASTER, ("product_id",)),
        (SERVING["product_metadata"], "product_metadata", S.PRODUCT_METADATA, ()),
        (SERVING["pricing_stock"], "pricing_stock", S.PRICING_STOCK, ()),
    ]
    return publish(
        spark,
        [
            TableSpec(f"{input_dir}/{path}", table, "overwrite", schema, keys, lengths)
            for path, table, schema, keys in tables
        ],
        target,
    )
