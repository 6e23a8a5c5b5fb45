"""Distance joins as equi-joins on grid cells with an exact residual.

Cells are bands of latitude cut into columns. A band's columns are wide enough for the search radius
at its neighbours' highest latitude, columns close round the globe, so the 3 x 3 cells around a
point hold everything within the radius, at the poles and the meridian too. One side is spread over
its neighbour cells, the other keeps one row; the shuffle is on the cell, and a crowded cell is
split by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeframe.functions.config import EARTH_RADIUS_M
from lodeframe.functions.scalars import haversine, planar_degrees
from lodeframe.operators.components import checkpointed

DEGREE_M = EARTH_RADIUS_M * 3.141592653589793 / 180
#: Cells are this much wider than the radius, against rounding.
SLACK = 1.0001
#: Rows of a table that is sent to every task at most.
FEW = 10_000


def _columns(band: Column, size: float) -> Column:
    """Columns of a band: each spans the radius in longitude at the highest latitude near the band."""
    top = (F.abs(band + F.lit(0.5)) + F.lit(1.5)) * F.lit(size)
    return F.when(top >= 89.9, F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(360.0 * F.cos(F.radians(top)) / size))).cast("long")


def _column(lon: Column, n: Column) -> Column:
    return F.floor(F.pmod(lon + 180.0, F.lit(360.0)) / (F.lit(360.0) / n)).cast("long") % n


def _cells(df: DataFrame, size: float, spread: bool) -> DataFrame:
    df = df.withColumn("__band", F.floor(F.col("latitude") / size).cast("long"))
    if not spread:
        return df.withColumn("__col", _column(F.col("longitude"), _columns(F.col("__band"), size)))
    df = df.withColumn("__band", F.explode(F.array(*(F.col("__band") + d for d in (-1, 0, 1)))))
    n = _columns(F.col("__band"), size)
    around = F.array_distinct(F.array(*(F.pmod(_column(F.col("longitude"), n) + d, n) for d in (-1, 0, 1))))
    return df.withColumn("__col", F.explode(around))


def _sides(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    for df in (left, right):
        if {"id", "latitude", "longitude"} - set(df.columns):
            raise ValueError("needs the columns id, latitude and longitude")
    place = "latitude IS NOT NULL AND longitude IS NOT NULL"
    return left.filter(place), right.filter(place)


def _named(df: DataFrame, side: str, keys: Sequence[str]) -> DataFrame:
    own = ("__band", "__col", *keys)
    return df.select(*own, *(F.col(c).alias(f"{side}_{c}") for c in df.columns if c not in own))


def band_join(left: DataFrame, right: DataFrame, metres: float, block: Sequence[str] = ()) -> DataFrame:
    """All pairs within metres: block columns, left_* and right_* columns, distance_m. Rows without coordinates have no pairs."""
    left, right = _sides(left, right)
    size = metres / DEGREE_M * SLACK
    a = _named(_cells(left, size, True), "left", block)
    b = _named(_cells(right, size, False), "right", block)
    pairs = a.join(b, ["__band", "__col", *block]).drop("__band", "__col")
    return pairs.withColumn("distance_m", haversine("left_latitude", "left_longitude", "right_latitude", "right_longitude")).filter(F.col("distance_m") <= metres)


def placed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(distinct places: place, latitude, longitude; df's rows that have one, with place instead of coordinates)."""
    df = df.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    at = checkpointed(df.select("latitude", "longitude").distinct()).withColumn("place", F.monotonically_increasing_id())
    at = checkpointed(at)
    return at, df.join(at, ["latitude", "longitude"]).drop("latitude", "longitude")


def self_pairs(df: DataFrame, metres: float, block: Sequence[str] = ()) -> DataFrame:
    """Unordered pairs of one table within metres."""
    return band_join(df, df, metres, block).filter("left_id < right_id")


def close_cell(metres: float) -> Column:
    """A cell of latitude and longitude in which any two points are within metres; null without a place."""
    size = 0.7 * metres / DEGREE_M
    band = F.floor(F.col("latitude") / size).cast("long")
    # the cell is widest where the band is nearest the equator; 0.7 of the radius each way leaves the diagonal below it
    low = F.least(F.abs(band), F.abs(band + 1)) * size
    width = F.lit(size) / F.greatest(F.cos(F.radians(F.when((band == -1) | (band == 0), 0.0).otherwise(low))), F.lit(1e-6))
    return F.struct(band.alias("band"), F.floor(F.col("longitude") / width).cast("long").alias("column"))


def planar_join(left: DataFrame, right: DataFrame, metres: float) -> DataFrame:
    """Pairs within metres / 111000 degrees, measured in the plane of degrees."""
    degrees = metres / 111000.0
    left, right = _sides(left, right)
    cell = lambda c, d=0: F.floor(F.col(c) / (degrees * SLACK)).cast("long") + d
    near = [F.struct(cell("latitude", i).alias("y"), cell("longitude", j).alias("x")) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    a = left.withColumn("__c", F.explode(F.array(*near))).select(F.col("__c.y").alias("__band"), F.col("__c.x").alias("__col"), *left.columns)
    b = right.select(cell("latitude").alias("__band"), cell("longitude").alias("__col"), *right.columns)
    pairs = _named(a, "left", ()).join(_named(b, "right", ()), ["__band", "__col"]).drop("__band", "__col")
    return pairs.withColumn("distance_deg", planar_degrees("left_latitude", "left_longitude", "right_latitude", "right_longitude")).filter(F.col("distance_deg") <= degrees)


#: First search radius, and how much wider each next ring is.
FIRST_RING_M, RING_FACTOR = 100.0, 5.0


def _best(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """The nearest right row per value of `by`: an aggregate, so a row with very many neighbours is reduced before it is shuffled."""
    return pairs.groupBy(*by).agg(F.min_by(F.struct(*pairs.columns), F.struct("distance_m", "right_id")).alias("best")).select("best.*")


def _nearest_by_rings(left: DataFrame, right: DataFrame, metres: float, block: Sequence[str], per: Sequence[str]) -> DataFrame:
    """Rows that find a neighbour within a ring are done, as all nearer ones lie in it too; the others look further out."""
    names = {f"__per_{c}": c.removeprefix("right_") for c in per}
    left, right = _sides(left, right)
    columns = [*block, *(f"left_{c}" for c in left.columns if c not in block), *(f"right_{c}" for c in right.columns if c not in block), "distance_m"]
    right = right.withColumns({n: F.col(c) for n, c in names.items()})
    if per:  # one search per value; a null value finds nothing, as in a join
        values = checkpointed(right.select(*names).dropna().distinct())
        left = left.crossJoin(F.broadcast(values) if values.limit(FEW + 1).count() <= FEW else values)
    rest, done, radius = checkpointed(left), [], min(FIRST_RING_M, metres)
    while True:
        found = checkpointed(_best(band_join(rest, right, radius, [*block, *names]), ["left_id", *names]))
        done.append(found.select(*columns))
        if radius >= metres:
            break
        keys = found.select(F.col("left_id").alias("id"), *names)
        rest = checkpointed(rest.join(keys, ["id", *names], "left_anti"))
        if rest.isEmpty():
            break
        radius = min(radius * RING_FACTOR, metres)
    return reduce(DataFrame.unionByName, done)


def nearest(left: DataFrame, right: DataFrame, metres: float, block: Sequence[str] = (), per: Sequence[str] = (), k: int = 1) -> DataFrame:
    """The k nearest right rows of each left row (and each value of the right_ columns `per`), by distance, then right id.

    One nearest row is searched in growing rings, so that a wide radius costs no more pairs than a row's near surroundings have.
    """
    if k == 1:
        return _nearest_by_rings(left, right, metres, block, per).withColumn("rank", F.lit(1))
    order = Window.partitionBy("left_id", *per).orderBy("distance_m", "right_id")
    return band_join(left, right, metres, block).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def radius_search(df: DataFrame, lat: float, lon: float, metres: float, company: str | None = None, limit: int | None = 10) -> DataFrame:
    """Rows within metres of a point, nearest first; a bounding box prunes the scan."""
    dy = metres / DEGREE_M * SLACK
    near = df.filter(F.col("latitude").between(lat - dy, lat + dy))
    if company is not None:
        near = near.filter(F.col("company_clean") == company)
    found = near.withColumn("distance_m", haversine(F.lit(lat), F.lit(lon), "latitude", "longitude")).filter(F.col("distance_m") <= metres)
    found = found.orderBy("distance_m", "id")
    return found.limit(limit) if limit else found


def flag_near(df: DataFrame, reference: DataFrame, metres: float, name: str = "near_reference") -> DataFrame:
    """df with Y or N: is a reference point within metres?"""
    hits = band_join(df, reference, metres).select(F.col("left_id").alias("id")).distinct().withColumn(name, F.lit("Y"))
    return df.join(hits, "id", "left").fillna("N", [name])


def group_pairs(df: DataFrame, group: str, metres: float | None = None) -> DataFrame:
    """Pairs i < j inside a group with their distance."""
    a, b = df.select(group, *(F.col(c).alias(f"left_{c}") for c in df.columns if c != group)), df.select(group, *(F.col(c).alias(f"right_{c}") for c in df.columns if c != group))
    pairs = a.join(b, group).filter("left_id < right_id")
    pairs = pairs.withColumn("distance_m", haversine("left_latitude", "left_longitude", "right_latitude", "right_longitude"))
    return pairs if metres is None else pairs.filter(F.col("distance_m") <= metres)


def threshold_overlap(left: DataFrame, right: DataFrame, limits: Sequence[float] = (250, 500, 1000, 2000)) -> DataFrame:
    """Per threshold with pairs: pairs, distinct left and distinct right rows. Distances are taken between distinct places, once, at the widest."""
    sides = [placed(df.select("id", "latitude", "longitude")) for df in (left, right)]
    many = lambda k: sides[k][1].groupBy("place").agg(F.count("*").alias("n"))
    at = lambda k: sides[k][0].join(many(k), "place").withColumnRenamed("place", "id")
    near = checkpointed(band_join(at(0), at(1), max(limits)).select(F.col("left_id").alias("p"), F.col("right_id").alias("q"), (F.col("left_n") * F.col("right_n")).alias("n"), "distance_m"))
    each = F.explode(F.array(*(F.lit(float(x)) for x in limits))).alias("threshold_m")
    out = near.select("*", each).filter("distance_m <= threshold_m").groupBy("threshold_m").agg(F.sum("n").alias("pairs"))
    for k, (end, name) in enumerate((("p", "left_rows"), ("q", "right_rows"))):
        # a row is within a threshold when its nearest neighbour is; rows that share an id count once
        least = near.groupBy(F.col(end).alias("place")).agg(F.min("distance_m").alias("d")).join(sides[k][1], "place")
        least = least.filter("id IS NOT NULL").groupBy("id").agg(F.min("d").alias("d"))
        counts = least.agg(*(F.count_if(F.col("d") <= float(x)).alias(f"c{i}") for i, x in enumerate(limits)))
        rows = counts.select(F.explode(F.array(*(F.struct(F.lit(float(x)).alias("threshold_m"), F.col(f"c{i}").alias(name)) for i, x in enumerate(limits)))).alias("e")).select("e.*")
        out = out.join(F.broadcast(rows.distinct()), "threshold_m")  # a row per threshold
    return out


def distance_coverage(pairs: DataFrame, distance: str, limits: Sequence[float] = (250, 500, 1000, 2000, 5000)) -> DataFrame:
    """Per limit: how many distances it covers, and their share. One aggregate."""
    wide = pairs.agg(F.count(distance).alias("total"), *(F.count_if(F.col(distance) <= x).alias(f"__{i}") for i, x in enumerate(limits)))
    each = F.array(*(F.struct(F.lit(float(x)).alias("upto"), F.col(f"__{i}").alias("n")) for i, x in enumerate(limits)))
    return wide.select("total", F.explode(each).alias("e")).select("e.*", F.when(F.col("total") > 0, 100 * F.col("e.n") / F.col("total")).otherwise(0.0).alias("pct"))


# --- polygons


def _ring_points(wkt: Column) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON as arrays of (x, y)."""
    rings = F.regexp_extract_all(wkt, F.lit(r"\(([-+0-9.eE, \t\r\n]+)\)"), F.lit(1))
    point = lambda p: F.struct(F.get(F.split(F.trim(p), r"\s+"), F.lit(0)).cast("double").alias("x"), F.get(F.split(F.trim(p), r"\s+"), F.lit(1)).cast("double").alias("y"))
    return F.transform(rings, lambda r: F.transform(F.split(r, ","), point))


def with_rings(polygons: DataFrame, wkt: str = "geometry_wkt") -> DataFrame:
    """Rings, bounding box and mean of the vertices; polygons that hold no ring are dropped."""
    df = polygons.withColumn("rings", _ring_points(F.col(wkt))).filter(F.size("rings") > 0)
    flat = F.flatten("rings")
    xs, ys = F.transform(flat, lambda p: p["x"]), F.transform(flat, lambda p: p["y"])
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / F.size(a)
    return df.withColumns({"x0": F.array_min(xs), "x1": F.array_max(xs), "y0": F.array_min(ys), "y1": F.array_max(ys), "centroid_lon": mean(xs), "centroid_lat": mean(ys)})


def inside(rings: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over all rings: an odd number of edges cross the ray to the right. Holes come out as outside."""

    def crossings(ring: Column) -> Column:
        edges = F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, i + 1).alias("b")))
        hit = lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"])
        return F.when(F.size(ring) >= 2, F.size(F.filter(edges, hit))).otherwise(0)

    return F.aggregate(F.transform(rings, crossings), F.lit(0), lambda s, v: s + v) % 2 == 1


def point_in_polygon(points: DataFrame, polygons: DataFrame, cell: float = 0.05) -> DataFrame:
    """Pairs of points (id, latitude, longitude) and polygons (polygon_id, rings, box) that hold them.

    Polygons are spread over the cells of their bounding box, points fall in one cell.
    """
    to = lambda c: F.floor(F.col(c) / cell).cast("long")
    p = points.filter("latitude IS NOT NULL AND longitude IS NOT NULL").withColumns({"__y": to("latitude"), "__x": to("longitude")})
    q = polygons.withColumn("__y", F.explode(F.sequence(to("y0"), to("y1")))).withColumn("__x", F.explode(F.sequence(to("x0"), to("x1"))))
    both = p.join(q, ["__y", "__x"]).filter(F.col("longitude").between(F.col("x0"), F.col("x1")) & F.col("latitude").between(F.col("y0"), F.col("y1")))
    return both.filter(inside(F.col("rings"), F.col("longitude"), F.col("latitude"))).drop("__y", "__x")


def parcel_match(sites: DataFrame, parcels: DataFrame, metres: float = 1000.0) -> DataFrame:
    """One parcel per site: one that holds it, of its company if there is one; else the nearest centroid of its company.

    sites: id, latitude, longitude, company; parcels: polygon_id, company, rings, box, centroid. A holding
    parcel of another company still rules out the centroids.
    """
    held = point_in_polygon(sites.withColumnRenamed("company", "site_company"), parcels)
    held = held.groupBy("id").agg(F.min_by("polygon_id", F.struct((F.col("company") != F.col("site_company")).cast("int").alias("other"), "polygon_id")).alias("polygon_id"))
    held = held.select("id", "polygon_id", F.lit("polygon").alias("method"), F.lit(0.0).alias("distance_m"))
    rest = sites.join(held.select("id"), "id", "left_anti").select("id", "latitude", "longitude", "company")
    centres = parcels.select(F.col("polygon_id").alias("id"), F.col("centroid_lat").alias("latitude"), F.col("centroid_lon").alias("longitude"), "company")
    near = nearest(rest, centres, metres, ["company"]).select(F.col("left_id").alias("id"), F.col("right_id").alias("polygon_id"), F.lit("centroid").alias("method"), "distance_m")
    return held.unionByName(near)
