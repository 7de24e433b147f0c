"""Sources (O-1 to O-9): records in JSON files, maps, lists and folders of images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.functions.names import unused

from .documents import json_entries, parsed
from .files import MOST_BYTES, with_contents

Schema = StructType | str


def json_array(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """O-1: files with a list of records each, of any size, read by ranges of bytes (sources.documents). Broken records
    have all fields null but _corrupt_record, if the schema has it."""
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return _fields(json_entries(spark, path), kind, [])


def _fields(entries: DataFrame, kind: StructType, first: list[str]) -> DataFrame:
    """The fields of entries' items as columns; _corrupt_record, if it is one of them, has the text of what is broken."""
    item = F.from_json("text", kind, {"mode": "PERMISSIVE"})
    rows = entries.withColumn("_item", F.when(F.col("error").isNull() & F.startswith("text", F.lit("{")), item))
    broken = F.when(F.col("_item").isNull(), F.col("text"))
    columns = [broken.alias(f.name) if f.name == "_corrupt_record" else F.col("_item").getField(f.name).alias(f.name) for f in kind.fields]
    return rows.select(*first, *columns)


def json_folder(spark: SparkSession, folder: str, schema: Schema, name: str = "*.json", deep: bool = False) -> DataFrame:
    """O-2 to O-4: one document a file, with the file in column source_file."""
    reader = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", name)
    return reader.option("recursiveFileLookup", deep).json(folder).withColumn("source_file", F.col("_metadata.file_path"))


def keyed_items(spark: SparkSession, path: str, item: str) -> DataFrame:
    """O-5, O-6: files {key: item, ...} of any size as one row (key, item's fields) for each entry; item is its type in DDL.

    A broken entry is a row with nulls; its text is in the field _corrupt_record if item has it, and its place and error are
    in json_entries(). Items that are no structs are in column value.
    """
    entries = json_entries(spark, path)
    if item.startswith("struct"):
        return _fields(entries, StructType.fromDDL(f"item {item}")["item"].dataType, ["key"])
    return parsed(entries, item).select("key", F.col("item").alias("value"))


def result_map(spark: SparkSession, path: str) -> DataFrame:
    """O-78: files {key: text or {"error": text}} as rows (key, text, error)."""
    entries = json_entries(spark, path)
    value = F.try_parse_json("text")
    text = F.when(F.startswith("text", F.lit('"')), F.try_variant_get(value, "$", "string"))
    failed = F.try_variant_get(value, "$.error", "string")
    other = F.when(text.isNull() & (F.col("text") != "null"), F.lit("neither a text nor an error"))
    return entries.select("key", F.when(F.col("error").isNull(), text).alias("text"), F.coalesce("error", failed, other).alias("error"))


def images(spark: SparkSession, folder: str, name: str = "*.png") -> DataFrame:
    """O-7: (path, content, base64)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", name).option("recursiveFileLookup", True).load(folder)
    return files.select("path", "content", F.base64("content").alias("base64"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """O-8: trimmed lines that are not empty, in column path."""
    return spark.read.text(path).select(F.trim("value").alias("path")).where("path <> ''")


def json_paths(spark: SparkSession, path: str, field: str = "path") -> DataFrame:
    """O-8: the field of every record of a JSON list, in column path; records without it go."""
    return json_array(spark, path, StructType().add(field, "string")).select(F.trim(field).alias("path")).where("path <> ''")


def complete_folders(spark: SparkSession, root: str, needed: tuple[str, ...] = ("original.png", "result.png", "result.json")) -> DataFrame:
    """O-9: folders that hold all needed files, by their listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    split = files.select(
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), F.regexp_extract("path", "([^/]*)$", 1).alias("name")
    ).where(F.col("name").isin(*needed))
    return split.groupBy("folder").agg(F.countDistinct("name").alias("n")).where(F.col("n") == len(needed)).select("folder")


def in_vocabulary(words: DataFrame, vocabulary: DataFrame, word: str = "word") -> DataFrame:
    """O-11: rows whose lower-cased word is in the vocabulary's column of that name; both may be of any size."""
    known = vocabulary.select(F.col(word).alias("_known"))
    return words.join(known, F.lower(words[word]) == known["_known"], "left_semi")


def _plain(path: Column) -> Column:
    """A path without its scheme and host."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def with_paths(rows: DataFrame, files: DataFrame, places: dict[str, Column]) -> DataFrame:
    """rows with the paths of their files, null where files(path) has none: {new column: place of the file}.

    The join is on the listing alone; other columns of files are not read.
    """
    for name, place in places.items():
        key, found = unused(rows, "_place", "_found")
        listed = files.select(F.col("path").alias(found)).withColumn(key, _plain(F.col(found))).dropDuplicates([key])
        rows = rows.withColumn(key, _plain(place)).join(listed, key, "left").drop(key).withColumnRenamed(found, name)
    return rows


def image_places(original_root: str, result_folder: str) -> dict[str, Column]:
    """O-53: where the images of items(key, id) lie: original root/id, result folder/key.png."""
    at = lambda folder, file: F.concat(F.lit(folder.rstrip("/")), F.lit("/"), file)
    return {"original": at(original_root, F.col("id")), "result": at(result_folder, F.concat("key", F.lit(".png")))}


def with_images(items: DataFrame, files: DataFrame, original_root: str, result_folder: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """O-53: items(key, id, ...) with the contents original and result, null where there is no file.

    files(path) as of listing() or images(); the folders are absolute, with or without a scheme. Each file is read once, in the
    task that needs it.
    """
    places = image_places(original_root, result_folder)
    names = unused(items, *(f"_{k}" for k in places))
    found = with_paths(items, files, dict(zip(names, places.values())))
    return with_contents(found, dict(zip(names, places)), most_bytes).drop(*names)
