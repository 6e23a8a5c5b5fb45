"""Readers: tables, CSV of all kinds, workbooks, partitioned warehouse layers, polygons, logs; column resolvers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeframe.operators.spatial import with_rings

ENCODINGS = ("UTF-8", "ISO-8859-1", "windows-1252")


def resolve(columns: Sequence[str], name: str, prefixes: Sequence[str] = ("", "F_", "?", "﻿"), contains: bool = False, suffixes: Sequence[str] = ("",)) -> str | None:
    """The column that stands for a name: exact, prefixed or suffixed, then ignoring case, then one that contains it."""
    for want in (f"{p}{name}{s}" for s in suffixes for p in prefixes):
        if want in columns:
            return want
    folded = [c for c in columns if c.lower() == name.lower()]
    if folded:
        return folded[0]
    return next((c for c in columns if name.lower() in c.lower()), None) if contains else None


def fields(df: DataFrame, wanted: dict[str, T.DataType] | T.StructType, **options) -> DataFrame:
    """df with exactly the wanted columns: resolved, cast without failing, null where absent."""
    wanted = {f.name: f.dataType for f in wanted} if isinstance(wanted, T.StructType) else wanted
    out: list[Column] = []
    for name, kind in wanted.items():
        found = resolve(df.columns, name, **options)
        out.append((F.col(f"`{found}`").try_cast(kind) if found else F.lit(None).cast(kind)).alias(name))
    return df.select(*out)


def table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: str | None = None) -> DataFrame:
    """Parquet with column pruning and pushed-down filter."""
    df = spark.read.parquet(path)
    df = df.filter(where) if where else df
    return df.select(*columns) if columns else df


def csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as text."""
    return spark.read.csv(path, header=True, inferSchema=False, mode="PERMISSIVE", multiLine=True, escape='"')


def csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True, multiLine=True, escape='"')


def csv_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE", multiLine=True, escape='"')


def csv_any_encoding(spark: SparkSession, path: str, encodings: Sequence[str] = ENCODINGS) -> DataFrame:
    """CSV by the first encoding in which no replacement character turns up."""
    for e in encodings:
        df = spark.read.csv(path, header=True, encoding=e, multiLine=True, escape='"')
        bad = F.lit(False)
        for c in df.columns:
            bad = bad | F.coalesce(F.col(f"`{c}`").contains("�"), F.lit(False))
        if "�" not in "".join(df.columns) and df.filter(bad).isEmpty():
            return df
    return df


def with_file_date(df: DataFrame, pattern: str = r"(\d{4}-\d{2}-\d{2})", name: str = "data_vintage", whole_path: bool = False) -> DataFrame:
    """df with the date in its file's name, or, with whole_path, the first in its path."""
    text = F.col("_metadata.file_path" if whole_path else "_metadata.file_name")
    return df.withColumn(name, F.try_to_timestamp(F.regexp_extract(text, pattern, 1), F.lit("yyyy-MM-dd")))


def workbook(spark: SparkSession, path: str, sheets: Sequence[str]) -> dict[str, DataFrame]:
    """Sheets as text tables without blank rows. Needs pandas with an Excel engine on the driver; workbooks are small."""
    import pandas as pd

    out = {}
    for sheet, pdf in pd.read_excel(path, sheet_name=list(sheets), dtype=str).items():
        pdf = pdf.dropna(how="all")
        out[sheet] = spark.createDataFrame(pdf.where(pdf.notna(), None), T.StructType([T.StructField(str(c), T.StringType()) for c in pdf.columns]))
    return out


def warehouse(spark: SparkSession, name: str, ds: str, new_only: bool = False, limit: int | None = None) -> DataFrame:
    """One day's partition of a warehouse table, all rows or those new in the release."""
    df = spark.table(name).filter(F.col("ds") == ds)
    df = df.filter(F.col("new_record") == "new") if new_only else df
    return df.limit(limit) if limit else df


#: Layers of the parcel release: table suffix and columns that are numbers or dates.
LAYERS = {
    "parcels": {"computed_acres": "double"}, "parcel_changes": {"computed_acres": "double", "change_date": "date"},
    "transactions": {"computed_acres": "double", "transaction_amount": "double", "transaction_date": "date"},
}


def layer(spark: SparkSession, prefix: str, kind: str, ds: str, new_only: bool = False) -> DataFrame:
    df = warehouse(spark, f"{prefix}{kind}", ds, new_only)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in LAYERS[kind].items() if c in df.columns})


def points(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """df with numeric latitude and longitude; rows without them are left out."""
    return df.withColumns({"latitude": F.col(lat).try_cast("double"), "longitude": F.col(lon).try_cast("double")}).filter("latitude IS NOT NULL AND longitude IS NOT NULL")


def service_features(df: DataFrame, attributes: str, column: str = "value") -> DataFrame:
    """Features of a layer service's answers, one JSON page per row: attributes (a schema) with latitude and longitude, null without a geometry.

    Fetching the pages is left to the caller, which has the network; they may be files read by spark.read.text(wholetext=True).
    """
    shape = f"features array<struct<attributes:struct<{attributes}>,geometry:struct<x:double,y:double>>>"
    f = df.select(F.explode(F.from_json(column, shape)["features"]).alias("f"))
    return f.select("f.attributes.*", F.col("f.geometry.y").alias("latitude"), F.col("f.geometry.x").alias("longitude"))


def polygons(df: DataFrame, wkt: str = "geometry_wkt") -> DataFrame:
    return with_rings(df, wkt)


def first_available(spark: SparkSession, names: Sequence[str], read: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame | None:
    """The first table that exists and has a row."""
    for n in names:
        if read is None and not spark.catalog.tableExists(n):
            continue
        df = read(spark, n) if read else spark.table(n)
        if not df.isEmpty():
            return df
    return None


def id_set(spark: SparkSession, ids: Sequence[str], name: str = "unique_id") -> DataFrame:
    return spark.createDataFrame([(i,) for i in ids], f"{name} string").distinct()


def priority_table(spark: SparkSession, path: str) -> DataFrame:
    """Priority sites with the ids they may go by and the keyword of their label (clusterid, gpu_owner, cluster, num_instances)."""
    df = csv_text(spark, path)
    word = F.element_at(F.split("cluster", r"[\s_-]+"), -1)
    ids = F.array_distinct(F.array(F.col("clusterid"), F.concat(F.lit("SEMI_"), F.col("clusterid")), F.concat(F.lit("dcm_"), F.col("clusterid")), F.concat(F.lit("DCH_"), F.col("clusterid"))))
    return df.select(F.col("clusterid").alias("id"), ids.alias("candidate_ids"), "cluster", F.col("gpu_owner").alias("company"), word.alias("keyword"), F.col("num_instances").try_cast("int").alias("num_instances"))


def session_log(spark: SparkSession, path: str, limit: int = 3) -> DataFrame:
    """Dated sections of a markdown log, newest first: day, title, body."""
    text = spark.read.text(path, wholetext=True)
    part = F.explode(F.filter(F.split("value", r"(?m)^## "), lambda s: s.rlike(r"^\d{4}-\d{2}-\d{2}")))
    s = text.select(part.alias("s"))
    head = F.substring_index("s", "\n", 1)
    out = s.select(F.regexp_extract("s", r"^(\d{4}-\d{2}-\d{2})", 1).alias("day"), F.trim(F.regexp_replace(head, r"^\d{4}-\d{2}-\d{2}[\s:-]*", "")).alias("title"), F.regexp_replace(F.substring(F.col("s"), F.length(head) + 1, F.length("s")), r"^\s+|\s+$", "").alias("body"))
    return out.orderBy(F.desc("day"), "title").limit(limit)


def catalog(spark: SparkSession, pattern: str = "*") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(pattern=pattern))
