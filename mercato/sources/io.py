"""Readers, writers and boundary guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .csv_records import read_csv

# fixed values: strings a CSV reader treats as missing (pandas defaults)
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
               "n/a", "nan", "null"]


class MissingTableError(FileNotFoundError):
    pass


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def read_table(spark: SparkSession, root: str, name: str, schema: StructType | None = None,
               fmt: str | None = None, multi_line: bool = True) -> DataFrame:
    """Read ``root/name`` (parquet dir/file or CSV); fail clearly when absent.

    With a ``schema``, its columns must be there; CSV text is cast to its types by column name
    (text that doesn't parse -> NULL), parquet keeps the types it has.  Large CSV files are split over
    tasks, those with quoted line breaks (``multi_line``) too."""
    candidates = [f"{root}/{name}.parquet", f"{root}/{name}", f"{root}/{name}.csv"]
    for path in candidates:
        if _exists(spark, path):
            kind = fmt or ("csv" if path.endswith(".csv") else "parquet")
            if kind == "csv":
                raw = read_csv(spark, path) if multi_line else \
                    spark.read.option("header", True).option("escape", '"').option("inferSchema", False).csv(path)
                raw = normalize_nulls(raw.toDF(*[c.removeprefix("\ufeff") for c in raw.columns]))
                return typed(raw, schema, name) if schema is not None else raw
            df = spark.read.parquet(path)
            return require(df, schema.fieldNames(), name) if schema is not None else df
    raise MissingTableError(f"table '{name}' not found under {root} (tried {candidates})")


def typed(df: DataFrame, schema: StructType, what: str = "table") -> DataFrame:
    """The columns of ``schema``, by name, cast to its types; text that doesn't parse -> NULL."""
    require(df, schema.fieldNames(), what)
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


_TYPES = {"string": StringType(), "int": IntegerType(), "bigint": LongType(), "double": DoubleType()}


def _schema(columns: str) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(","))])


# fixed values: columns of the nine marketplace tables (timestamps are coerced after reading)
SCHEMAS = {name: _schema(columns) for name, columns in {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
              "order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, "
              "order_estimated_delivery_date string",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, price double, "
                   "freight_value double",
    "payments": "order_id string, payment_sequential int, payment_type string, payment_installments int, "
                "payment_value double",
    "reviews": "review_id string, order_id string, review_score int, review_comment_title string, "
               "review_comment_message string, review_creation_date string, review_answer_timestamp string",
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix bigint, "
                 "customer_city string, customer_state string",
    "sellers": "seller_id string, seller_zip_code_prefix bigint, seller_city string, seller_state string",
    "products": "product_id string, product_category_name string, product_weight_g double, product_length_cm double, "
                "product_height_cm double, product_width_cm double, product_photos_qty double",
    "geolocation": "geolocation_zip_code_prefix bigint, geolocation_lat double, geolocation_lng double, "
                   "geolocation_city string, geolocation_state string",
    "category_translation": "product_category_name string, product_category_name_english string",
}.items()}
MULTI_LINE = {"reviews"}            # the only table with free text


def load_marketplace(spark: SparkSession, root: str, schemas: dict[str, StructType] | None = None
                     ) -> dict[str, DataFrame]:
    """The nine marketplace tables from a folder of parquet/CSV files, with their columns checked."""
    schemas = SCHEMAS if schemas is None else schemas
    t = {n: read_table(spark, root, n, schemas[n], multi_line=n in MULTI_LINE) for n in SCHEMAS}
    t["orders"] = coerce_timestamps(t["orders"], ORDER_TIMESTAMPS)
    t["reviews"] = coerce_timestamps(t["reviews"], REVIEW_TIMESTAMPS)
    return t


ORDER_TIMESTAMPS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                    "order_delivered_customer_date", "order_estimated_delivery_date"]
REVIEW_TIMESTAMPS = ["review_creation_date", "review_answer_timestamp"]


def normalize_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """String null tokens -> NULL on string columns."""
    targets = set(cols or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"])
    return df.select(*[
        F.when(F.col(c).isin(NULL_TOKENS), F.lit(None)).otherwise(F.col(c)).alias(c)
        if c in targets else F.col(c) for c in df.columns])


def coerce_timestamps(df: DataFrame, cols: list[str]) -> DataFrame:
    """S3: cast to timestamp_ntz; unparseable -> NULL (already-typed columns pass)."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("timestamp_ntz") if df.schema[c].dataType.typeName() == "string"
                           else F.col(c).cast("timestamp_ntz") for c in present})


def require(df: DataFrame, cols: list[str], what: str = "table") -> DataFrame:
    """Plan-time required-column guard."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required columns {missing}")
    return df


def write_table(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", sort_within: list[str] | None = None) -> str:
    """Persist as parquet, optionally partitioned and clustered."""
    path = f"{root}/{name}"
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
