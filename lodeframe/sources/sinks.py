"""Writers: refresh by source, schema changes, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def refresh(df: DataFrame, path: str, parts: Sequence[str] = ("source", "feed")) -> None:
    """Replace the partitions of the sources in df and leave the others: running it twice changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def feed_of(unique_id: str = "unique_id") -> Column:
    """Feed within a source: ids of the lease feed begin with DCH_L_."""
    return F.when(F.col(unique_id).startswith("DCH_L_"), "lease").otherwise("main")


def without_feed(df: DataFrame, prefix: str, but: str | None = None) -> DataFrame:
    """df without rows whose id begins with prefix, except those that begin with but."""
    own = F.col("unique_id").startswith(prefix)
    return df.filter(~(own & ~F.col("unique_id").startswith(but)) if but else ~own)


def without_source(df: DataFrame, source: str) -> DataFrame:
    return df.filter(~F.col("source").eqNullSafe(F.lit(source)))


def conformed(df: DataFrame, schema: T.StructType, lengths: dict[str, int] | None = None) -> DataFrame:
    """df in a declared schema: absent columns null, texts cut at their lengths, other columns dropped."""
    lengths = lengths or {}
    have = {c.lower(): c for c in df.columns}
    out = []
    for f in schema:
        c = F.col(have[f.name.lower()]).cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)
        out.append((F.substring(c, 1, lengths[f.name]) if f.name in lengths else c).alias(f.name))
    return df.select(*out)


def updated(df: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """df with columns taken from changes where it has a value for the key."""
    new = changes.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    joined = df.join(new, key, "left")
    return joined.withColumns({c: F.coalesce(f"__{c}", c) if c in df.columns else F.col(f"__{c}") for c in columns}).drop(*(f"__{c}" for c in columns))


def with_fields(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    have = {c.lower() for c in df.columns}
    return df.withColumns({n: F.lit(None).cast(k) for n, k in wanted.items() if n.lower() not in have}) if any(n.lower() not in have for n in wanted) else df


def without_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def essential(df: DataFrame) -> DataFrame:
    return df.filter("is_essential = 1")


def with_load(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with load or a status, counts of why rows are in)."""
    load, state = F.coalesce(F.col("it_load") > 0, F.lit(False)), F.coalesce(F.trim("new_build_status") != "", F.lit(False))
    counts = df.agg(F.count("*").alias("rows"), F.count_if(load).alias("with_load"), F.count_if(state).alias("with_status"), F.count_if(load | state).alias("kept"))
    return df.filter(load | state), counts


def _flat(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), F.round(c, 6) if f.name in ("latitude", "longitude") else c)
        elif isinstance(f.dataType, (T.TimestampType, T.DateType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with six places for coordinates, plain dates, and empty fields for null and NaN."""
    _flat(df).write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="")


def geojson(df: DataFrame) -> DataFrame:
    """One feature per row with coordinates, as JSON text in column value."""
    rest = [c for c in df.columns if c not in ("latitude", "longitude")]
    placed = _flat(df.filter("latitude IS NOT NULL AND longitude IS NOT NULL"))
    shape = F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates"))
    return placed.select(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*rest).alias("properties"))).alias("value"))


#: Features that one document may hold.
MOST_FEATURES = 100_000


def export_geojson(df: DataFrame, path: str) -> None:
    """Newline-delimited features: written in parallel, no document has to fit one task."""
    geojson(df).write.mode("overwrite").text(path)


def feature_collection(df: DataFrame, name: str) -> str:
    """One GeoJSON document, made on the driver, for small layers; more than MOST_FEATURES rows raise: use export_geojson."""
    if df.limit(MOST_FEATURES + 1).count() > MOST_FEATURES:
        raise ValueError(f"more than {MOST_FEATURES} features for one document")
    return '{"type":"FeatureCollection","name":"%s","features":[%s]}' % (name, ",".join(r["value"] for r in geojson(df).toLocalIterator()))


def export_all(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Parquet copies of tables; the manifest: rows of each."""
    counts = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        counts[name] = df.sparkSession.read.parquet(f"{folder}/{name}").count()
    return counts


def manifest(counts: dict[str, int], as_of: str) -> str:
    return f"# Export of {as_of}\n\n| table | rows |\n|---|---|\n" + "".join(f"| {n} | {c:,} |\n" for n, c in sorted(counts.items()))


def export_matches(found: DataFrame, left_only: DataFrame, right_only: DataFrame, folder: str) -> None:
    for name, df in (("matches", found), ("left_only", left_only), ("right_only", right_only)):
        export_csv(df, f"{folder}/{name}")


def conflicts(pairs: DataFrame, pct: float = 10.0, mw: float = 10.0) -> DataFrame:
    return pairs.filter((F.col("delta_pct") >= pct) | (F.abs("delta_mw") >= mw))


def change_report(diff: DataFrame, key: str, top: int = 50) -> str:
    """Markdown of added, removed and changed keys, the first of each."""
    out = []
    for change in ("added", "removed", "changed"):
        part = diff.filter(F.col("change") == change)
        rows = part.orderBy(key).limit(top).collect()
        out.append(f"## {change}: {part.count()}\n\n" + "".join(f"- {r[key]} {', '.join(r['fields'])}\n" for r in rows))
    return "\n".join(out)


def sorted_for_reads(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sorted within files, so that statistics of row groups prune reads by these keys."""
    return df.sortWithinPartitions(*keys)


def crosswalk(labelled: DataFrame, parcel: str = "apn", campus: str = "campus_id") -> DataFrame:
    return labelled.select(parcel, campus).distinct()
