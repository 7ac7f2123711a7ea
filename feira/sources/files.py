"""Source CSV files, nested JSON documents and the transformations of the initial load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from feira.functions import dates, geo
from feira.operators.sets import pick_per_key
from feira.schemas import DOCUMENT_SCHEMAS, SOURCE_COLUMNS

# Tables with free text, and how many rows a file of them holds at most.
FREE_TEXT = {"order_reviews": 200_000}


def read_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One source table with its types; dates that cannot be parsed become NULL, other bad fields fail.

    Free text may hold line breaks. Files of such tables can't be split, so they are written in many
    parts; all other tables are read line by line.
    """
    columns = SOURCE_COLUMNS[name]
    raw = ", ".join(f"{c} {'string' if kind == 'timestamp_ntz' else kind}" for c, kind in columns)
    df = spark.read.schema(raw).option("header", True).option("escape", '"').option("mode", "FAILFAST").option(
        "multiLine", name in FREE_TEXT).csv(f"{folder}/{name}")
    return df.select(*[
        dates.lenient_timestamp(F.col(c)).alias(c) if kind == "timestamp_ntz" else F.col(c) for c, kind in columns])


def write_source(df: DataFrame, folder: str, name: str) -> None:
    """Writes a source table as CSV with a header."""
    df.select(*[c for c, _ in SOURCE_COLUMNS[name]]).write.mode("overwrite").option("header", True).option(
        "escape", '"').option("maxRecordsPerFile", FREE_TEXT.get(name, 0)).csv(f"{folder}/{name}")


def with_point(df: DataFrame, lng: str, lat: str, name: str) -> DataFrame:
    return df.withColumn(name, geo.point(F.col(lng), F.col(lat)))


def conform_orders(orders: DataFrame, customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders keyed by the real customer, and one row per real customer.

    The source names a customer per order; of several rows of one real customer the one with
    the smallest per-order id gives the address.
    """
    names = customers.select("customer_id", "customer_unique_id")
    conformed = orders.join(names, "customer_id").drop("customer_id")
    real = pick_per_key(customers, ["customer_unique_id"], F.col("customer_id"), latest=False).drop("customer_id")
    return conformed, real


def build_category_dim(products: DataFrame, translation: DataFrame,
                       column: str = "product_category_name") -> tuple[DataFrame, DataFrame]:
    """Category dimension with English names, and products that refer to it by id.

    Ids are ranks of the distinct names: one row per category, so one ordered window.
    """
    names = products.where(F.col(column).isNotNull()).select(column).distinct()
    english = pick_per_key(
        translation.select(column, f"{column}_english"), [column], F.col(f"{column}_english"), latest=False)
    dim = names.join(english, column, "left").select(
        F.dense_rank().over(Window.orderBy(column)).alias("category_id"), F.col(column).alias("category_name"),
        F.col(f"{column}_english").alias("category_name_english"))
    keys = dim.select("category_id", F.col("category_name").alias(column))
    return dim, products.join(keys, column, "left").drop(column)


def with_dimensions(df: DataFrame, length: str = "length_cm", height: str = "height_cm", width: str = "width_cm",
                    weight: str = "weight_g") -> DataFrame:
    """Four physical columns as one ``dimensions`` struct."""
    packed = F.struct(
        F.col(length).cast("decimal(8,2)").alias("length_cm"), F.col(height).cast("decimal(8,2)").alias("height_cm"),
        F.col(width).cast("decimal(8,2)").alias("width_cm"), F.col(weight).cast("decimal(10,2)").alias("weight_g"))
    return df.withColumn("dimensions", packed).drop(length, height, width, weight)


def _plain(value: Column, kind: T.DataType) -> Column:
    """Replaces ``{"$date": ...}`` and ``{"$oid": ...}`` wrappers at any depth."""
    if isinstance(kind, T.StructType):
        if kind.names == ["$date"]:
            return value.getField("$date").cast("timestamp").cast("timestamp_ntz")
        if kind.names == ["$oid"]:
            return value.getField("$oid")
        if not _wrapped(kind):
            return value
        fields = [_plain(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType) and _wrapped(kind.elementType):
        return F.transform(value, lambda item: _plain(item, kind.elementType))
    return value


def _wrapped(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(f.name in ("$date", "$oid") or _wrapped(f.dataType) for f in kind.fields)
    return isinstance(kind, T.ArrayType) and _wrapped(kind.elementType)


def read_documents(spark: SparkSession, path: str, collection: str, multi_line: bool = False) -> DataFrame:
    """Documents of a collection with dates and ids unwrapped; one document per line by default."""
    raw = spark.read.schema(DOCUMENT_SCHEMAS[collection]).option("multiLine", multi_line).json(path)
    return raw.select(*[_plain(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in raw.schema.fields])
