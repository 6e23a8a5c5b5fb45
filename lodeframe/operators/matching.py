"""One-to-one matching, tiers, scored intake, staged look-ups."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeframe.functions import config as C
from lodeframe.functions.scalars import alias_company, fuzzy_score, intake_company, token_similarity
from lodeframe.operators.components import checkpointed, connected_components
from lodeframe.operators.spatial import FEW, band_join, placed


def greedy_match(pairs: DataFrame, left: str = "left_id", right: str = "right_id", by: str = "distance_m", max_rounds: int | None = None) -> DataFrame:
    """One-to-one matches as if pairs were taken in the order (by, left, right) while both ends are free.

    Pairs that rank first on both sides are exactly those that the ordered pass takes before any
    other pair of theirs; they are taken together, their ends removed, and so on until none is left.
    Every round takes a pair at least, so there are no more rounds than pairs; with max_rounds, a
    match that is not complete by then raises.
    """
    order = F.struct(by, left, right)
    left_over = checkpointed(pairs)
    most = left_over.count() if max_rounds is None else max_rounds
    out, new = checkpointed(left_over.limit(0)), []
    for taken in range(most + 1):
        a, b = left_over.groupBy(left).agg(F.min(order).alias("__a")), left_over.groupBy(right).agg(F.min(order).alias("__b"))
        now = checkpointed(left_over.join(a, left).join(b, right).filter((F.col("__a") == order) & (F.col("__b") == order)).select(*pairs.columns))
        if now.isEmpty():
            break
        if taken == most:
            raise RuntimeError(f"greedy matching is not complete after {most} rounds")
        new.append(now)
        if len(new) == 16:  # one table instead of a union that grows with the rounds
            out, new = checkpointed(reduce(DataFrame.unionByName, [out, *new])), []
        left_over = checkpointed(left_over.join(now.select(left), left, "left_anti").join(now.select(right), right, "left_anti"))
    return reduce(DataFrame.unionByName, [out, *new])


#: Rows and pairs of places of one connected part that one task may match; larger ones are matched in rounds over pairs of rows.
PART_ROWS, PART_EDGES = 2_000_000, 5_000_000


def _ordered_pass() -> Callable:
    """A function of (rows, edges) that matches one connected part as the ordered pass would, over pairs of places.

    rows: side (0 left, 1 right), place, alias, id; edges: place of the left, place of the right, distance.
    Rows of one place and alias are alike but for their ids, so they are taken from the least id on and
    a pointer says how far. Places at the same distance are served in the order of left ids, as pairs are.
    The function is local, so that workers need no import of this package.
    """

    def matched(rows, edges):
        import heapq
        from itertools import groupby

        import pyarrow as pa

        blocks = ({}, {})
        for side, place, alias, key in sorted(zip(*(rows.column(c).to_pylist() for c in ("side", "place", "alias", "id"))), key=lambda r: r[3]):
            blocks[side].setdefault(place, {}).setdefault(alias, []).append(key)
        left, right = ([(p, a, ids) for p, kinds in side.items() for a, ids in kinds.items()] for side in blocks)
        at = [{}, {}]
        for found, side in zip(at, (left, right)):
            for i, (p, _, _) in enumerate(side):
                found.setdefault(p, []).append(i)
        i_at, j_at = [0] * len(left), [0] * len(right)
        out = ([], [], [])
        for metres, near in groupby(sorted(zip(*(edges.column(c).to_pylist() for c in ("distance_m", "p", "q")))), key=lambda e: e[0]):
            meets = {}
            for _, p, q in near:
                for i in at[0].get(p, ()):
                    if i_at[i] < len(left[i][2]):
                        a = left[i][1]
                        js = [j for j in at[1].get(q, ()) if j_at[j] < len(right[j][2]) and (a is None or right[j][1] is None or a == right[j][1])]
                        if js:
                            meets.setdefault(i, []).extend(js)
            heap = [(left[i][2][i_at[i]], i) for i in meets]
            heapq.heapify(heap)
            while heap:
                key, i = heap[0]
                free = [(right[j][2][j_at[j]], j) for j in meets[i] if j_at[j] < len(right[j][2])]
                if not free:
                    heapq.heappop(heap)
                    continue
                other, j = min(free)
                i_at[i] += 1
                j_at[j] += 1
                for column, v in zip(out, (key, other, metres)):
                    column.append(v)
                if i_at[i] < len(left[i][2]):
                    heapq.heapreplace(heap, (left[i][2][i_at[i]], i))
                else:
                    heapq.heappop(heap)
        kind = rows.schema.field("id").type
        return pa.table({"left_id": pa.array(out[0], kind), "right_id": pa.array(out[1], kind), "distance_m": pa.array(out[2], pa.float64())})

    return matched


def _match_by_place(left: DataFrame, right: DataFrame, metres: float, alias: Column | None) -> DataFrame | None:
    """left_id, right_id, distance_m as spatial_match() takes them, without a row per pair; None where ids repeat, differ in type or a connected part is too large."""
    if left.schema["id"].dataType != right.schema["id"].dataType:
        return None
    slim = lambda df, k: df.filter("id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL").select(F.lit(k).alias("side"), "id", "latitude", "longitude", (F.lit(None).cast("string") if alias is None else alias).alias("alias"))
    both = checkpointed(slim(left, 0).unionByName(slim(right, 1)))
    repeats = both.groupBy("side", "id").agg(F.count("*").alias("n")).filter("n > 1")
    if not repeats.isEmpty():
        return None
    at, rows = placed(both)
    on = lambda k: at.join(rows.filter(F.col("side") == k).select("place").distinct(), "place", "left_semi").withColumnRenamed("place", "id")
    edges = checkpointed(band_join(on(0), on(1), metres).select(F.col("left_id").alias("p"), F.col("right_id").alias("q"), "distance_m"))
    parts = connected_components(edges, "p", "q", few=PART_EDGES).select(F.col("node").alias("place"), "component")
    met = edges.select(F.explode(F.array("p", "q")).alias("place")).distinct()
    rows = rows.join(met, "place").join(parts, "place", "left").select(F.coalesce("component", "place").alias("part"), "side", "place", "alias", "id")
    edges = edges.join(parts, F.col("p") == F.col("place"), "left").select(F.coalesce("component", "p").alias("part"), "p", "q", "distance_m")
    by = ["part"]
    if alias is not None and rows.filter("alias IS NULL").isEmpty():  # companies never meet, so each is a part of its own
        rows = rows.withColumn("own", F.col("alias"))
        edges = edges.join(rows.select("part", "own").distinct(), "part")
        by.append("own")
    rows, edges = checkpointed(rows), checkpointed(edges)
    for df, most in ((rows, PART_ROWS), (edges, PART_EDGES)):
        largest = df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        if (largest or 0) > most:
            return None
    kind = left.schema["id"].dataType.simpleString()
    return rows.groupBy(*by).cogroup(edges.groupBy(*by)).applyInArrow(_ordered_pass(), f"left_id {kind}, right_id {kind}, distance_m double")


def spatial_match(left: DataFrame, right: DataFrame, metres: float = 500.0, company: str | None = None) -> DataFrame:
    """Greedy one-to-one matches within metres; with company (a column of both), equal aliases or a missing company on either side.

    Rows of one place are matched together, so that n rows at one place don't make n * n pairs.
    """
    named = lambda df, n: df.select(*(F.col(c).alias(f"{n}_{c}") for c in df.columns))
    found = _match_by_place(left, right, metres, alias_company(company) if company else None)
    if found is not None:
        found = checkpointed(found)
        both = named(left, "left").join(found, "left_id").join(named(right, "right"), "right_id")
        return both.select(*(f"left_{c}" for c in left.columns), *(f"right_{c}" for c in right.columns), "distance_m")
    pairs = band_join(left, right, metres)
    if company:
        a, b = alias_company(f"left_{company}"), alias_company(f"right_{company}")
        pairs = pairs.filter(a.isNull() | b.isNull() | (a == b))
    return greedy_match(pairs)


def match_sides(left: DataFrame, right: DataFrame, metres: float = 500.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matches, left only, right only); rows without coordinates are among the unmatched."""
    found = checkpointed(spatial_match(left, right, metres))
    only = lambda df, c: df.join(found.select(F.col(c).alias("id")), "id", "left_anti")
    return found, only(left, "left_id"), only(right, "right_id")


def key_match(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Per key on both sides: rows, summed value, first id; side tells both, left or right."""
    side = lambda df, n: df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(f"{n}_rows"), F.sum(value).alias(f"{n}_{value}"), F.min("id").alias(f"{n}_first"))
    both = side(left, "left").join(side(right, "right"), key, "full_outer")
    return both.withColumn("side", F.when(F.col("right_rows").isNull(), "left").when(F.col("left_rows").isNull(), "right").otherwise("both"))


def closest_per_key(df: DataFrame, keys: Sequence[str], distance: str = "distance_m", tie: str = "id") -> DataFrame:
    """The row with the least distance per key; a null distance is farther than any other, zero is nearest."""
    order = F.struct(F.col(distance).isNull().alias("none"), F.col(distance).alias("d"), F.col(tie).alias("t"))
    return df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), order).alias("best")).select("best.*")


def permit_tiers(sites: DataFrame, permits: DataFrame) -> DataFrame:
    """Best permit per site. Tier 1: equal permit id; 2: within 250 m and a holder score of 95; 3: within 500 m and 85; 4: within 1 km, same state and county.

    sites: id, permit_id, developer, latitude, longitude, state_abbr, county; permits: id, permit_id, permit_holder, latitude, longitude, state, county.
    """
    # of permits with one id the least right id counts; of one holder and area at one place too, and of those the nearest
    a = sites.filter(F.trim("permit_id") != "").select(F.col("id").alias("left_id"), "permit_id")
    b = permits.groupBy("permit_id").agg(F.min("id").alias("right_id"))
    by_id = a.join(b, "permit_id").select("left_id", "right_id", F.lit(1).alias("tier"), F.lit(0.0).alias("distance_m"), F.lit(100.0).alias("score"))
    s_at, s = placed(sites.select("id", "developer", "state_abbr", "county", "latitude", "longitude"))
    p_at, p = placed(permits.select("id", "permit_holder", "state", F.col("county").alias("permit_county"), "latitude", "longitude"))
    s_kinds, s = _kinds(s, ["developer", "state_abbr", "county"], "site_kind")
    p_kinds, p = _kinds(p, ["permit_holder", "state", "permit_county"], "permit_kind")
    near = band_join(s_at.withColumnRenamed("place", "id"), p_at.withColumnRenamed("place", "id"), 1000.0).select(F.col("left_id").alias("p"), F.col("right_id").alias("place"), "distance_m")
    near = near.join(p.groupBy("place", "permit_kind").agg(F.min("id").alias("right_id")), "place").groupBy("p", "permit_kind").agg(F.min(F.struct("distance_m", "right_id")).alias("n"))
    tried = checkpointed(s.select(F.col("place").alias("p"), "site_kind").distinct().join(near, "p").select("p", "site_kind", "permit_kind", "n.*"))
    texts = tried.select("site_kind", "permit_kind").distinct().join(s_kinds, "site_kind").join(p_kinds, "permit_kind")
    area = (F.lower("state_abbr") == F.lower("state")) & (F.lower("county") == F.lower("permit_county"))
    texts = texts.select("site_kind", "permit_kind", fuzzy_score("developer", "permit_holder").alias("score"), area.alias("area"))
    # with score and area given, the tier rises with the distance, so no permit of a kind beats the nearest
    tier = F.when((F.col("distance_m") <= 250) & (F.col("score") >= 95), 2).when((F.col("distance_m") <= 500) & (F.col("score") >= 85), 3).when(F.col("area"), 4)
    ranked = lambda: F.min(F.struct("tier", (-F.col("score")).alias("less"), "distance_m", "right_id")).alias("best")
    found = tried.join(checkpointed(texts), ["site_kind", "permit_kind"]).withColumn("tier", tier).filter("tier IS NOT NULL").groupBy("p", "site_kind").agg(ranked()).select(F.col("p").alias("place"), "site_kind", "best.*")
    found = s.join(found, ["place", "site_kind"]).select(F.col("id").alias("left_id"), "right_id", "tier", "distance_m", (-F.col("less")).alias("score"))
    best = by_id.unionByName(found).groupBy("left_id").agg(ranked()).select("left_id", "best.*")
    return best.select("left_id", "right_id", "tier", "distance_m", (-F.col("less")).alias("score"))


def _kinds(df: DataFrame, columns: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(distinct values of columns, null too, with a number called name; df with that number instead of them)."""
    kinds = checkpointed(checkpointed(df.select(*columns).distinct()).withColumn(name, F.monotonically_increasing_id()))
    k = kinds.select(name, *(F.col(c).alias(f"__{c}") for c in columns))
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns))
    return kinds, df.join(k, same).drop(*columns, *(f"__{c}" for c in columns))


def _words(c: str) -> Column:
    """Distinct tokens as token_similarity() takes them; a text of white space only counts as one token, as it equals its like."""
    words = F.array_distinct(F.filter(F.split(F.trim(F.lower(F.col(c))), r"\s+"), lambda w: w != ""))
    return F.when(F.col(c) == "", F.array().cast("array<string>")).when(F.size(words) == 0, F.array(F.lit(" "))).otherwise(words)


def _leading(c: str, least: float) -> Column:
    """Of texts with a token similarity of at least `least`, two share one of these: the first tokens by hash."""
    words = F.transform(_words(c), lambda w: F.struct(F.xxhash64(w).alias("h"), w.alias("w")))
    n = F.size(words)
    return F.slice(F.array_sort(words), 1, F.greatest(F.lit(0), n - F.ceil(n * F.lit(least) - 1e-9).cast("int") + 1))["w"]


def _least(df: DataFrame, by: Sequence[str], top: int | None) -> DataFrame:
    """The top rows of least id per value of by; all of them without top."""
    if top is None:
        return df
    order = Window.partitionBy(*by).orderBy("right_id", "c_row")
    return df.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= top).drop("__n")


def _closest(asked: DataFrame, edges: DataFrame, rows: DataFrame, keys: Sequence[str], top: int, metres: float) -> DataFrame:
    """Per place p and keys asked for: rows by distance, as many as can be among the best `top` by distances rounded to 0.1 m.

    Searched in growing rings: where a ring holds enough, all that lies further out is worse.
    """
    rest, done, radius = checkpointed(asked), [], min(150.0, metres)
    while True:
        near = rest.join(edges.filter(F.col("distance_m") <= radius), "p").join(rows, ["place", *keys])
        group = Window.partitionBy("p", *keys)
        near = near.withColumn("__n", F.row_number().over(group.orderBy("distance_m", "right_id", "c_row"))).withColumn("__d", F.min(F.when(F.col("__n") == top, F.col("distance_m"))).over(group))
        enough = F.lit(True) if radius >= metres else F.coalesce(F.col("__d") + 0.2 <= radius, F.lit(False))
        found = checkpointed(near.filter(enough & (F.col("__d").isNull() | (F.col("distance_m") < F.col("__d") + 0.2))).drop("__n", "__d"))
        done.append(found)
        if radius >= metres:
            break
        rest = checkpointed(rest.join(found.select("p", *keys).distinct(), ["p", *keys], "left_anti"))
        if rest.isEmpty():
            break
        radius = min(radius * 3, metres)
    return reduce(DataFrame.unionByName, done)


def _near_candidates(r: DataFrame, c: DataFrame, metres: float, top: int) -> DataFrame:
    """Rows of r and c within metres that can be among the best `top` of a row of r; rows of one city (and company) at one place differ by id only."""
    r_at, r = placed(r)
    c_at, c = placed(c)
    r, c = checkpointed(r.withColumnRenamed("place", "p")), checkpointed(c.withColumn("__city", F.coalesce(F.concat(F.lit("c"), "right_city"), F.lit(""))))
    edges = checkpointed(band_join(r_at.withColumnRenamed("place", "id"), c_at.withColumnRenamed("place", "id"), metres).select(F.col("left_id").alias("p"), F.col("right_id").alias("place"), "distance_m"))
    # whatever company: the nearest of each city
    cities = edges.join(c.select("place", "__city").distinct(), "place").select("p", "__city").distinct()
    anyone = _closest(cities, edges, checkpointed(_least(c, ["place", "__city"], top)), ["__city"], top, metres)
    # the company asked for: the nearest of each city
    wanted = r.filter("__company IS NOT NULL").select("p", "__company").distinct()
    own = c.withColumn("__company", F.col("right_company")).filter("__company IS NOT NULL")
    cities = wanted.join(edges, "p").join(own.select("place", "__company", "__city").distinct(), ["place", "__company"]).select("p", "__company", "__city").distinct()
    own = _closest(cities, edges, checkpointed(_least(own, ["place", "__company", "__city"], top)), ["__company", "__city"], top, metres)
    # names that share a word
    a = r.withColumn("__word", F.explode(_words("left_campus_name"))).select("l_row", "p", "__word")
    b = c.withColumn("__word", F.explode(_words("right_canonical_name")))
    b = b.join(a.select("__word").distinct(), "__word", "left_semi")
    named = r.join(a.join(edges, "p").join(b, ["place", "__word"]).drop("p", "__word"), "l_row")
    out = [r.join(anyone, "p"), r.join(own, ["p", "__company"]), named]
    return reduce(DataFrame.unionByName, (x.select(*(k for k in r.columns if k not in ("p", "__company")), *(k for k in c.columns if k not in ("place", "__city")), "distance_m") for x in out)).dropDuplicates(["l_row", "c_row"])


def _named_candidates(r: DataFrame, c: DataFrame, top: int | None) -> DataFrame:
    """Rows of one company whose names or cities are alike enough; with top, of campuses with one name or one city those of least id."""
    c = c.filter("right_company IS NOT NULL").withColumn("__company", F.col("right_company"))
    r = r.filter("__company IS NOT NULL")
    asked, known = r.select("__company", "left_city").distinct(), c.select("__company", "right_city").distinct()
    cities = asked.withColumn("__word", F.explode(_leading("left_city", C.NAME_MATCH))).join(known.withColumn("__word", F.explode(_leading("right_city", C.NAME_MATCH))), ["__company", "__word"])
    cities = cities.filter(token_similarity("left_city", "right_city") >= C.NAME_MATCH).select("__company", "left_city", "right_city").distinct()
    by_city = r.join(cities, ["__company", "left_city"]).join(_least(c, ["__company", "right_city"], top), ["__company", "right_city"])
    a = r.withColumn("__word", F.explode(_leading("left_campus_name", C.NAME_MATCH)))
    b = _least(c, ["__company", "right_canonical_name"], top).withColumn("__word", F.explode(_leading("right_canonical_name", C.NAME_MATCH)))
    by_name = a.join(b, ["__company", "__word"]).drop("__word")
    return by_city.unionByName(by_name).dropDuplicates(["l_row", "c_row"])


def intake_scores(requests: DataFrame, campuses: DataFrame, metres: float = C.LOOSE_M, top: int | None = None) -> DataFrame:
    """All candidates of requests with a confidence, ranked; with top, those up to that rank only, found without scoring all pairs.

    requests: id, company, city, campus_name, latitude, longitude; campuses: id, canonical_name, company, city,
    latitude, longitude. Half the score is nearness, 0.3 an equal company, up to 0.2 the names; beyond
    250 m another company costs 30 %. Requests without coordinates match by company and name.
    """
    named = lambda df, side, *own: df.select(*own, *(F.col(k).alias(f"{side}_{k}") for k in df.columns if k not in (*own, "latitude", "longitude")))
    asked = checkpointed(requests.withColumns({"__company": intake_company("company"), "l_row": F.monotonically_increasing_id()}))
    known = checkpointed(campuses.withColumn("c_row", F.monotonically_increasing_id()))
    company_match = F.coalesce(intake_company("left_company") == F.col("right_company"), F.lit(False))
    name = lambda: F.greatest(token_similarity("left_campus_name", "right_canonical_name"), token_similarity("left_campus_name", "right_city"))
    if top is None:
        near = band_join(asked, known, metres)
    else:
        near = _near_candidates(named(asked, "left", "l_row", "__company").join(asked.select("l_row", "latitude", "longitude"), "l_row"), named(known, "right", "c_row").join(known.select("c_row", "latitude", "longitude"), "c_row"), metres, top)
    near = near.withColumn("company_match", company_match)
    close = F.greatest(F.lit(0.0), 1 - F.col("distance_m") / metres)
    text = F.greatest(name(), token_similarity("left_city", "right_city"))
    score = F.least(F.lit(1.0), close * 0.5 + F.when(F.col("company_match"), 0.3).otherwise(0.0) + text * 0.2)
    score = F.when((F.col("distance_m") > C.HIGH_CONFIDENCE_M) & ~F.col("company_match"), score * 0.7).otherwise(score)
    by_place = near.select("left_id", "right_id", F.round("distance_m", 1).alias("distance_m"), "company_match", F.round(score, 3).alias("confidence"), F.lit("SPATIAL").alias("match_type"))

    unplaced = named(asked.filter("latitude IS NULL OR longitude IS NULL"), "left", "l_row", "__company")
    pairs = _named_candidates(unplaced, named(known, "right", "c_row"), top)
    text = F.greatest(token_similarity("left_campus_name", "right_canonical_name"), token_similarity("left_city", "right_city"))
    by_name = pairs.withColumn("text", text).filter(F.col("text") >= C.NAME_MATCH)
    by_name = by_name.select("left_id", "right_id", F.lit(None).cast("double").alias("distance_m"), F.lit(True).alias("company_match"), F.round(F.col("text") * 0.7 + 0.3, 3).alias("confidence"), F.lit("NAME").alias("match_type"))
    order = Window.partitionBy("left_id").orderBy(F.desc("confidence"), "distance_m", "right_id")
    ranked = by_place.unionByName(by_name).withColumn("rank", F.row_number().over(order))
    return ranked if top is None else ranked.filter(F.col("rank") <= top)


def intake_match(requests: DataFrame, campuses: DataFrame, metres: float = C.LOOSE_M) -> DataFrame:
    """Best campus per request and up to three alternatives."""
    top = intake_scores(requests, campuses, metres, 4)
    other = F.array_sort(F.collect_list(F.when(F.col("rank") > 1, F.struct("rank", "right_id", "confidence"))))  # three at most
    return top.groupBy("left_id").agg(F.max_by(F.struct("right_id", "distance_m", "company_match", "confidence", "match_type"), -F.col("rank")).alias("best"), other.alias("alternatives")).select("left_id", "best.*", "alternatives")


def relevance_search(df: DataFrame, text: str, column: str = "canonical_name", limit: int = 10) -> DataFrame:
    """Rows whose name contains the text, most similar first."""
    found = df.filter(F.lower(column).contains(text.lower())).withColumn("similarity", token_similarity(column, F.lit(text)))
    return found.orderBy(F.desc("similarity"), "id").limit(limit)


def staged_look_up(keys: DataFrame, table: DataFrame, key: str, name: str, value: str) -> DataFrame:
    """value for each key by exact name, then ignoring case, then the first name (least value) that begins with it."""
    exact = table.groupBy(F.col(name).alias(key)).agg(F.min(value).alias("__exact"))
    lower = table.groupBy(F.lower(name).alias("__lower")).agg(F.min(value).alias("__folded"))
    # names are looked up under their beginnings of the lengths that keys have; one row holds the lengths
    lengths = keys.agg(F.collect_set(F.length(key)).alias("__lengths"))
    begun = F.transform(F.filter("__lengths", lambda n: n <= F.length("__l")), lambda n: F.substring(F.col("__l"), F.lit(1), n))
    starts = table.withColumn("__l", F.lower(name)).crossJoin(F.broadcast(lengths)).withColumn("__start", F.explode(begun))
    starts = starts.groupBy("__start").agg(F.min_by(value, F.struct("__l", value)).alias("__begun"))
    out = keys.join(exact, key, "left").withColumn("__lower", F.lower(key)).join(lower, "__lower", "left").join(starts, F.col("__lower") == F.col("__start"), "left")
    stage = F.when(F.col("__exact").isNotNull(), "exact").when(F.col("__folded").isNotNull(), "folded").when(F.col("__begun").isNotNull(), "prefix")
    return out.select(*keys.columns, F.coalesce("__exact", "__folded", "__begun").alias(value), stage.alias("stage"))


def cascade(candidates: Sequence[tuple[int, DataFrame]], key: str = "id", value: str = "match") -> DataFrame:
    """First match per key over ranked candidate tables (key, value)."""
    out = None
    for rank, df in candidates:
        df = df.select(key, value, F.lit(rank).alias("rank"))
        out = df if out is None else out.unionByName(df)
    return out.groupBy(key).agg(F.min(F.struct("rank", value)).alias("m")).select(key, "m.*")


def _grams(text: Column, sizes: Sequence[int]) -> Column:
    """All distinct parts of the given sizes."""
    of = lambda k: F.when(F.length(text) >= k, F.transform(F.sequence(F.lit(1), F.length(text) - k + 1), lambda i: F.substring(text, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*(of(k) for k in sizes)))


def _holding(long: DataFrame, text: str, short: DataFrame, part: str, gram: int = 3) -> DataFrame:
    """Pairs in which text of long contains part of short (not blank): an equi-join on the part's first letters, then the exact test."""
    short = short.filter(F.length(part) > 0).withColumn("__gram", F.substring(F.col(part), 1, gram))
    sizes = sorted(r[0] for r in short.select(F.length("__gram")).distinct().collect())  # gram numbers at most
    if not sizes:
        return long.crossJoin(short).limit(0)
    return long.withColumn("__gram", F.explode(_grams(F.col(text), sizes))).join(short, "__gram").filter(F.col(text).contains(F.col(part))).drop("__gram")


def priority_sites(sites: DataFrame, campuses: DataFrame) -> DataFrame:
    """Campus per priority site: by id, exact name, part of the name, keyword, company with keyword; of equal rank the least id.

    sites: id, candidate_ids (array), cluster, company, keyword; campuses: id, source_id, campus_name, company.
    Each test is an equi-join, on an id, a name, a company or the first letters of what must be contained; blank names and keywords match nothing.
    """
    s = sites.select(F.col("id").alias("s_id"), "candidate_ids", F.lower("cluster").alias("own"), F.lower("company").alias("s_company"), F.lower("keyword").alias("word"))
    c = campuses.select(F.col("id").alias("match"), "source_id", F.lower("source_id").alias("low_id"), F.lower("campus_name").alias("name"), F.lower("company").alias("c_company"))
    worded = s.filter(F.length("word") > 3)
    tests = [
        s.select("s_id", F.explode("candidate_ids").alias("source_id")).join(c, "source_id"),
        s.filter("own <> ''").join(c, F.col("own") == F.col("name")),
        _holding(c, "name", s, "own").select("s_id", "match").unionByName(_holding(s, "own", c, "name").select("s_id", "match")),
        _holding(c, "name", worded, "word"),
        worded.join(c, F.col("s_company") == F.col("c_company")).filter(F.col("low_id").contains(F.col("word"))),
    ]
    return cascade([(k + 1, t.select(F.col("s_id").alias("id"), "match")) for k, t in enumerate(tests)])


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, numbers: dict[str, float], texts: Sequence[str] = ()) -> DataFrame:
    """key, change (added, removed, changed, same) and changed fields; numbers change by more than their tolerance."""
    a, b = (df.select(key, *(F.col(c).alias(f"{n}_{c}") for c in (*numbers, *texts))).withColumn(f"__{n}", F.lit(True)) for df, n in ((old, "old"), (new, "new")))
    both = a.join(b, key, "full_outer")
    moved = [F.when(F.abs(F.coalesce(f"old_{c}", F.lit(0.0)) - F.coalesce(f"new_{c}", F.lit(0.0))) > t, F.lit(c)) for c, t in numbers.items()]
    moved += [F.when(~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")), F.lit(c)) for c in texts]
    both = both.withColumn("fields", F.array_compact(F.array(*moved)))
    change = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").when(F.size("fields") > 0, "changed").otherwise("same")
    return both.withColumn("change", change).withColumn("fields", F.when(F.col("change") == "changed", F.col("fields")).otherwise(F.array().cast("array<string>"))).drop("__old", "__new")


def key_totals(left: DataFrame, right: DataFrame, key: str, value: str, tolerance: float) -> DataFrame:
    """Both sides' sums per key; a missing side counts as 0; ok within the tolerance."""
    sums = lambda df, n: df.groupBy(key).agg(F.sum(value).alias(n))
    both = sums(left, "left_sum").join(sums(right, "right_sum"), key, "full_outer").fillna(0.0, ["left_sum", "right_sum"])
    return both.withColumn("ok", F.abs(F.col("left_sum") - F.col("right_sum")) <= tolerance)


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys found on one side only."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def in_set(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ids; a short list goes to every task."""
    ids = ids.select(key).distinct()
    return df.join(F.broadcast(ids) if ids.limit(FEW + 1).count() <= FEW else ids, key, "left_semi")


def unmatched(df: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among those found; rows without a key are unmatched."""
    return df.join(found.select(key).distinct(), key, "left_anti")


def key_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """All distinct keys of both sides with the side they are on: left, right or both. One aggregate, no join."""
    tag = left.select(key, F.lit(1).alias("s")).unionByName(right.select(key, F.lit(2).alias("s"))).filter(F.col(key).isNotNull())
    return tag.groupBy(key).agg(F.min("s").alias("a"), F.max("s").alias("b")).select(key, F.when(F.col("a") < F.col("b"), "both").when(F.col("a") == 1, "left").otherwise("right").alias("side"))


def mapped_keys(df: DataFrame, mapping: DataFrame, key: str, ids: str, value: str, separator: str = "; ") -> DataFrame:
    """df with value, from a table whose ids are joined lists of keys."""
    long = mapping.select(F.explode(F.split(ids, separator)).alias(key), value).groupBy(key).agg(F.min(value).alias(value))
    return df.join(long, key, "left")


def nested_ids(members: DataFrame, tight: str, loose: str) -> DataFrame:
    """Loose ids that hold several tight ids."""
    return members.groupBy(loose).agg(F.array_sort(F.collect_set(tight)).alias("tight_ids")).filter(F.size("tight_ids") > 1)


def parameter_grid(**values: Sequence) -> list[dict]:
    """All combinations of a few parameters; the data are read once and exploded against them."""
    out: list[dict] = [{}]
    for name, options in values.items():
        out = [o | {name: v} for o in out for v in options]
    return out
