"""Reading delimited, JSON and text files, file listings and generated tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyloom.functions.randomness import choice, uniform, uniform_int

# The file categories and the endings that belong to them.
FILE_CATEGORIES = {
    "images": ("jpg", "png", "gif", "bmp"),
    "documents": ("txt", "pdf", "docx"),
    "archives": ("zip", "rar", "tar", "gz"),
    "audio": ("mp3", "wav"),
}

# The products of the generated sales table.
SALES_PRODUCTS = ("Tablet", "Camera", "Phone")
SALES_FIRST_DAY = "2045-01-01"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    sep: str = ",",
    names: Sequence[str] | None = None,
    date_format: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited files with a header row.

    Types are inferred, at the price of a second pass, only without a schema.
    ``names`` replaces the header. ``multi_line`` reads line breaks inside quotes
    as part of the value; such files are not split, so they should be written in
    pieces (``maxRecordsPerFile``). An empty text is read as null.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("escape", '"')
    if date_format is not None:
        reader = reader.option("dateFormat", date_format)
    if multi_line:
        # only the writer's own line end ends a row, and no blanks are cut
        reader = reader.option("multiLine", True).option("lineSep", "\n")
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    df = reader.csv(path if isinstance(path, str) else list(path))
    return df if names is None else df.toDF(*names)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path)


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file; only for folders of small files."""
    return spark.read.text(path, wholetext=True)


def read_sheets(
    spark: SparkSession, folder: str, schema: T.StructType | str, sheets: Sequence[str] | None = None
) -> DataFrame:
    """A folder with one ``sheet=<name>`` sub-folder of CSV files per sheet, as one table.

    Naming the sheets prunes the others before any file is opened.
    """
    full = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*full.fields, T.StructField("sheet", T.StringType())])
    df = spark.read.schema(full).option("header", True).option("escape", '"').csv(folder)
    return df if sheets is None else df.filter(F.col("sheet").isin(*sheets))


def explode_dated_records(documents: DataFrame, column: str) -> DataFrame:
    """JSON of the form ``{date: {field: text}}`` as (day, record) rows."""
    parsed = F.from_json(column, "map<string, map<string, string>>")
    return documents.select(F.explode(parsed).alias("day", "record"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below ``folder`` with its ending and category; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("bytes"))
    )
    ending = F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1))
    return files.withColumn("ending", ending).withColumn("category", file_category(F.col("ending")))


def file_category(ending: Column) -> Column:
    known = {e: c for c, endings in FILE_CATEGORIES.items() for e in endings}
    pairs = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.element_at(pairs, ending), F.lit("others"))


def records_to_table(spark: SparkSession, rows: Sequence[Mapping], schema: str) -> DataFrame:
    """A table from a driver-side list of dicts, so only for lists typed by hand."""
    fields = T.StructType.fromDDL(schema)
    columns = {f: [r.get(f) for r in rows] for f in fields.names}
    return spark.createDataFrame(pa.table(columns, to_arrow_schema(fields)))


def generate_sales(keys: DataFrame, key: str, seed: int) -> DataFrame:
    """One made-up sale per key: daily dates, product, price 50..200, quantity 1..14."""
    k = F.col(key)
    return keys.select(
        k.alias("sale_id"),
        F.date_add(F.lit(SALES_FIRST_DAY).cast("date"), (k % 3650).cast("int")).alias("date"),
        choice(SALES_PRODUCTS, k, seed).alias("product"),
        F.round(uniform(k, seed + 1, 50.0, 200.0), 2).alias("price"),
        uniform_int(k, seed + 2, 1, 15).alias("quantity"),
    )
