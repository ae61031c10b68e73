"""Readers: nested XML, tab-separated text, JSON, and a dispatch on the file suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import schemas


# Files of items, plain or compressed.
ITEM_FILES = "*.{xml,xml.gz}"


def xml_items(spark: SparkSession, path: str, schema: str = schemas.ITEM, keep_corrupt: bool = False) -> DataFrame:
    """Every ``<item>`` of every ``.xml`` or ``.xml.gz`` file below ``path``, with a declared schema.

    The parser only materialises declared elements. Numbers are scanned as text and
    cast afterwards, so a value such as "N/A" becomes null where the parser itself
    would fail the whole job. Broken records are kept on request.
    """
    wanted = StructType.fromDDL(schema)
    scanned = schemas.as_text(wanted)
    reader = (
        spark.read.format("xml").option("rowTag", "item").option("mode", "PERMISSIVE")
        .option("pathGlobFilter", ITEM_FILES).option("recursiveFileLookup", "true")
    )
    if keep_corrupt:
        scanned = StructType([*scanned.fields, StructField(schemas.CORRUPT, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", schemas.CORRUPT)
    items = reader.schema(scanned).load(path)
    return typed_items(items, wanted)


def typed_items(items: DataFrame, wanted: StructType) -> DataFrame:
    """Cast scanned text to the wanted types, bad numbers to null; other columns stay."""
    casts = {
        f.name: F.col(f.name).try_cast(f.dataType) for f in wanted.fields if f.dataType != items.schema[f.name].dataType
    }
    return items.withColumns(casts) if casts else items


def user_collections(spark: SparkSession, path: str) -> DataFrame:
    """Rated items of users whose name is in the file or folder name ``user_<name>``."""
    items = xml_items(spark, path, schemas.COLLECTION_ITEM)
    in_file = F.regexp_extract("_metadata.file_name", r"^user_(.*)\.xml$", 1)
    in_folder = F.regexp_extract("_metadata.file_path", r"/(?:[^/=]+=)?user_([^/]+)/[^/]*$", 1)
    name = F.when(in_file != "", in_file).otherwise(in_folder)
    return items.select(
        name.alias("username"), F.col("_objectid").alias("item_id"),
        F.col("rating._value").try_cast("double").alias("rating"),
        F.try_to_timestamp(F.col("status._lastmodified"), F.lit("yyyy-MM-dd HH:mm:ss")).alias("lastmodified"),
    )


def parse_items(texts: DataFrame, column: str, schema: str = schemas.ITEM) -> DataFrame:
    """XML documents held in a column."""
    wanted = StructType.fromDDL(schema)
    parsed = texts.withColumn("_item", F.from_xml(F.col(column), schemas.as_text(wanted), {"rowTag": "item"}))
    return typed_items(parsed.select("_item.*"), wanted)


def tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated text with a header; lines that do not fit the schema are skipped."""
    return (
        spark.read.schema(schema).option("sep", "\t").option("header", "true")
        .option("mode", "DROPMALFORMED").option("enforceSchema", "true").csv(path)
    )


def read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Choose the format from the suffix: parquet, tsv, csv, json, jsonl, xml."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "xml":
        return xml_items(spark, path, schema or schemas.ITEM)
    if kind == "tsv":
        if schema is None:
            raise ValueError("a tsv file needs a schema")
        return tsv(spark, path, schema)
    reader = spark.read.schema(schema) if schema else spark.read
    if kind == "parquet":
        return reader.parquet(path)
    if kind == "csv":
        return reader.option("header", "true").csv(path)
    if kind == "jsonl":
        return reader.json(path)
    if kind == "json":
        return reader.option("multiLine", "true").json(path)
    raise ValueError(f"unknown file type: {kind}")


def manifest(spark: SparkSession, path: str, suffix: str = "xml") -> DataFrame:
    """Names, sizes and times of the files below a folder, without reading them."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}")
        .option("recursiveFileLookup", "true").load(path)
        .select("path", "length", "modificationTime")
    )
