"""Readers, sinks, streams and workflows over the driver's tables: what is written is read again, beside its SQL.

Files are written below the shared checkpoint folder, which all executors see.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeframe.operators import clusters, land
from lodeframe.operators.components import shared_folder
from lodeframe.plans import workflows
from lodeframe.plans.check_queries import _found
from lodeframe.plans.feed_queries import _HYPER, _SIDES, B, _raw
from lodeframe.plans.queries import AS_OF, CLUSTERED, buildings, of_source, query, rounded, table, truth
from lodeframe.sources import adapters, readers, sinks
from lodeframe.streaming import refresh as streaming


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/io-{uuid.uuid4().hex}"


def _named_table(spark: SparkSession, df: DataFrame) -> str:
    """df under a name of its own, as a catalog's table."""
    name = f"t_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")


def _as_csv(spark, df: DataFrame, **options) -> str:
    path = _folder(spark)
    df.write.csv(path, header=True, **options)
    return path


# --- scans


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, round(c_acctbal, 2) AS balance FROM customer")
def scan_02_csv_text(spark, sf):
    df = readers.csv_text(spark, _as_csv(spark, _customers(spark, sf)))
    return df.select("c_custkey", "c_name", F.round(F.col("c_acctbal").cast("double"), 2).alias("balance"))


@query("SELECT c_custkey, '2024-01-20' AS vintage FROM customer")
def scan_03_file_date(spark, sf):
    """The vintage of a feed from its file's name."""
    path = _folder(spark)
    _customers(spark, sf).write.csv(f"{path}/2024-01-20-feed", header=True)
    df = readers.with_file_date(readers.csv_text(spark, f"{path}/2024-01-20-feed"), r"(\d{4}-\d{2}-\d{2})", "data_vintage", whole_path=True)
    return df.select(F.col("c_custkey").cast("long").alias("c_custkey"), F.date_format("data_vintage", "yyyy-MM-dd").alias("vintage"))


@query("SELECT count(*) AS n, sum(c_custkey)::BIGINT AS keys, round(sum(c_acctbal), 2) AS balance FROM customer")
def scan_05_csv_inferred(spark, sf):
    df = readers.csv_inferred(spark, _as_csv(spark, _customers(spark, sf)))
    return df.agg(F.count("*").alias("n"), F.sum("c_custkey").cast("long").alias("keys"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("SELECT c_custkey, 'Zürich ' || c_custkey AS city FROM customer")
def scan_06_csv_encodings(spark, sf):
    """A file in an old encoding, found by trying one after another."""
    odd = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("Zürich "), F.col("c_custkey").cast("string")).alias("city"))
    df = readers.csv_any_encoding(spark, _as_csv(spark, odd, encoding="ISO-8859-1"))
    return df.select(F.col("c_custkey").cast("long").alias("c_custkey"), "city")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def scan_08_warehouse_day(spark, sf):
    """One partition of a warehouse table."""
    name = _named_table(spark, table(spark, sf, "orders").withColumn("ds", F.col("o_orderpriority")))
    return readers.warehouse(spark, name, "1-URGENT").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
def strm_02_new_records(spark, sf):
    """Only what is new in a release."""
    o = table(spark, sf, "orders").withColumns({"ds": F.col("o_orderpriority"), "new_record": F.when(F.col("o_orderstatus") == "F", "new").otherwise("old")})
    return readers.warehouse(spark, _named_table(spark, o), "1-URGENT", new_only=True).select("o_orderkey")


@query("SELECT o_orderkey AS id, o_totalprice AS transaction_amount, CASE WHEN o_orderkey % 5 > 0 THEN 2.5::DOUBLE END AS computed_acres FROM orders WHERE o_orderstatus = 'P'")
def scan_09_layer(spark, sf):
    """A layer preset: numbers and dates from text, what is none being null."""
    o = table(spark, sf, "orders")
    raw = o.select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("string").alias("transaction_amount"), F.when(F.col("o_orderkey") % 5 > 0, "2.5").otherwise("n/a").alias("computed_acres"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("transaction_date"), F.col("o_orderstatus").alias("ds"), F.lit("new").alias("new_record"),
    )
    prefix = f"acres_{uuid.uuid4().hex}_"
    raw.createOrReplaceTempView(f"{prefix}transactions")
    return readers.layer(spark, prefix, "transactions", "P").select("id", "transaction_amount", "computed_acres")


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 > 0 THEN 30.5::DOUBLE END AS latitude, -90.25::DOUBLE AS longitude FROM supplier WHERE s_suppkey % 4 > 0")
def scan_10_points(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 4 > 0, "30.5").otherwise("none").alias("lat"), F.lit("-90.25").alias("lon"))
    return readers.points(s, "lat", "lon").select("id", "latitude", "longitude")


@query("SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 3 > 0 THEN 30.5::DOUBLE END AS latitude FROM supplier")
def scan_12_service_layer(spark, sf):
    """Answers of a layer service, a page of features per nation."""
    s = table(spark, sf, "supplier")
    feature = F.struct(
        F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).alias("attributes"), F.when(F.col("s_suppkey") % 3 > 0, F.struct(F.lit(-90.0).alias("x"), F.lit(30.5).alias("y"))).alias("geometry"),
    )
    pages = s.groupBy("s_nationkey").agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("value"))
    return readers.service_features(pages, "id bigint, name string").select("id", "name", "latitude")


@query("SELECT c_custkey AS facility_id, c_name AS name FROM customer")
def scan_14_lease_resolver(spark, sf):
    """Headers with a damaged byte-order mark."""
    odd = _customers(spark, sf).select(F.col("c_custkey").alias("?facility_id"), F.col("c_name").alias("F_name"))
    return readers.fields(odd, {"facility_id": T.LongType(), "name": T.StringType()})


@query("SELECT c_custkey AS id, c_name AS apn FROM customer")
def scan_16_contains_resolver(spark, sf):
    odd = _customers(spark, sf).select(F.col("c_custkey").alias("row_id_number"), F.col("c_name").alias("parcel_APN_text"))
    return readers.fields(odd, {"id": T.LongType(), "apn": T.StringType()}, contains=True)


@query("SELECT c_custkey AS id, c_name AS site FROM customer")
def scan_17_suffix_resolver(spark, sf):
    """Columns that a join has given a suffix."""
    odd = _customers(spark, sf).select(F.col("c_custkey").alias("id_1"), F.col("c_name").alias("site"))
    return readers.fields(odd, {"id": T.LongType(), "site": T.StringType()}, suffixes=("", "_1"))


@query("SELECT c_custkey FROM customer")
def scan_18_first_available(spark, sf):
    """The first table that exists and has rows."""
    none = _named_table(spark, _customers(spark, sf).limit(0))
    return readers.first_available(spark, [f"absent_{uuid.uuid4().hex}", none, _named_table(spark, _customers(spark, sf))]).select("c_custkey")


@query("SELECT c_name FROM customer WHERE c_name IN ('Customer#000000007', 'Customer#000000011', 'Customer#000000012')")
def scan_19_id_set(spark, sf):
    ids = readers.id_set(spark, ["Customer#000000007", "Customer#000000011", "Customer#000000012", "Customer#000000012", "nobody"], "c_name")
    return _customers(spark, sf).join(ids, "c_name", "left_semi").select("c_name")


@query("SELECT s_suppkey::VARCHAR AS id, s_suppkey::VARCHAR || ';SEMI_' || s_suppkey || ';dcm_' || s_suppkey || ';DCH_' || s_suppkey AS ids, 'x' || s_suppkey AS keyword, (s_suppkey % 9)::INT AS num_instances FROM supplier")
def scan_20_priority_csv(spark, sf):
    k = F.col("s_suppkey").cast("string")
    raw = table(spark, sf, "supplier").select(k.alias("clusterid"), F.col("s_name").alias("gpu_owner"), F.concat(F.lit("Site-x"), k).alias("cluster"), (F.col("s_suppkey") % 9).alias("num_instances"))
    return readers.priority_table(spark, _as_csv(spark, raw)).select("id", F.array_join("candidate_ids", ";").alias("ids"), "keyword", "num_instances")


@query("SELECT strftime(day, '%Y-%m-%d') AS day, 'Work of ' || n AS title, 'done ' || n AS body FROM (SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 3)")
def scan_21_session_log(spark, sf):
    """Dated sections of one markdown file, the newest three."""
    days = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    part = F.concat(F.lit("## "), "day", F.lit(" - Work of "), F.col("n").cast("string"), F.lit("\n\ndone "), F.col("n").cast("string"), F.lit("\n"))
    path = _folder(spark)
    # one document, as the log is; a line per day
    days.agg(F.array_join(F.collect_list(part), "\n").alias("value")).coalesce(1).write.text(path)
    return readers.session_log(spark, path)


@query("SELECT 2 AS n")
def scan_22_catalog(spark, sf):
    """Tables by pattern."""
    mark = uuid.uuid4().hex
    for t in ("nation", "region"):
        table(spark, sf, t).createOrReplaceTempView(f"{t}_{mark}")
    return spark.createDataFrame([(len(readers.catalog(spark, f"*{mark}")),)], "n int")


# --- sinks


@query("SELECT c_custkey, count(*) AS n FROM (SELECT c_custkey FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) GROUP BY 1")
def sink_01_append(spark, sf):
    path, c = _folder(spark), _customers(spark, sf)
    sinks.append(c, path)
    sinks.append(c.filter("c_custkey % 2 = 0"), path)
    return spark.read.parquet(path).groupBy("c_custkey").agg(F.count("*").alias("n"))


@query(f"{B} SELECT source, count(*) AS n, round(sum(CASE WHEN source IN ('DataCenterMap', 'NPM') THEN 1 ELSE full_capacity_mw END), 2) AS mw FROM b GROUP BY 1")
def sink_04_refresh_by_source(spark, sf):
    """Two sources are replaced, twice; the others stay as they were (SINK-4 to SINK-9)."""
    path = _folder(spark)
    b = buildings(spark, sf).select("id", "full_capacity_mw", "source").withColumn("feed", F.lit("main"))
    sinks.refresh(b, path)
    new = b.filter(F.col("source").isin("DataCenterMap", "NPM")).withColumn("full_capacity_mw", F.lit(1.0))
    for _ in range(2):
        sinks.refresh(new, path)
    return rounded(spark.read.parquet(path).groupBy("source").agg(F.count("*").alias("n"), F.sum("full_capacity_mw").alias("mw")), "mw", places=2)


@query(f"{B} SELECT source, count(*) AS n FROM b WHERE source <> 'Semianalysis' GROUP BY 1")
def sink_07_without_source(spark, sf):
    return sinks.without_source(buildings(spark, sf), "Semianalysis").groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0")
def sink_10_replace(spark, sf):
    path, c = _folder(spark), _customers(spark, sf)
    sinks.replace(c, path)
    sinks.replace(c.filter("c_custkey % 3 = 0"), path)
    return spark.read.parquet(path).select("c_custkey")


@query("SELECT c_custkey::INT AS c_custkey, substr(c_name, 1, 8) AS c_name, NULL::DOUBLE AS extra FROM customer")
def sink_11_declared_table(spark, sf):
    """A table in its declared schema: texts cut, absent columns null, others dropped."""
    path = _folder(spark)
    declared = T.StructType([T.StructField("c_custkey", T.IntegerType()), T.StructField("c_name", T.StringType()), T.StructField("extra", T.DoubleType())])
    sinks.replace(sinks.conformed(_customers(spark, sf), declared, {"c_name": 8}), path)
    return spark.read.parquet(path)


@query(f"{CLUSTERED} SELECT cluster, min(company_clean) AS company_clean, count(*) AS building_count FROM g GROUP BY 1")
def sink_13_clusters_table(spark, sf):
    path = _folder(spark)
    kinds = T.StructType([T.StructField("cluster", T.LongType()), T.StructField("company_clean", T.StringType()), T.StructField("building_count", T.LongType())])
    sinks.replace(sinks.conformed(clusters.cluster_table(clusters.proximity_clusters(buildings(spark, sf))), kinds), path)
    return spark.read.parquet(path)


@query("SELECT c_custkey FROM customer WHERE c_custkey % 4 = 0")
def sink_15_filtered_table(spark, sf):
    path = _folder(spark)
    sinks.replace(sinks.essential(_customers(spark, sf).withColumn("is_essential", (F.col("c_custkey") % 4 == 0).cast("int"))), path)
    return spark.read.parquet(path).select("c_custkey")


@query("SELECT c_custkey FROM customer")
def sink_18_dropped_fields(spark, sf):
    return sinks.without_fields(_customers(spark, sf), ["c_name", "c_acctbal", "absent"])


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal FROM customer")
def sink_19_renamed_fields(spark, sf):
    return sinks.renamed(_customers(spark, sf), {"c_custkey": "id", "c_name": "name"})


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE false")
def sink_20_empty_like(spark, sf):
    return sinks.empty_like(_customers(spark, sf))


@query("SELECT 'customers' AS name, count(*) AS n FROM customer UNION ALL SELECT 'nations', count(*) FROM nation")
def sink_23_all_outputs(spark, sf):
    """Copies of all tables, and how many rows each has."""
    counts = sinks.export_all({"customers": _customers(spark, sf), "nations": table(spark, sf, "nation")}, _folder(spark))
    return spark.createDataFrame(sorted(counts.items()), "name string, n long")


@query("SELECT '| nations | ' || count(*) || ' |' AS line FROM nation UNION ALL SELECT '| regions | ' || count(*) || ' |' FROM region")
def sink_24_manifest(spark, sf):
    text = sinks.manifest(sinks.export_all({"nations": table(spark, sf, "nation"), "regions": table(spark, sf, "region")}, _folder(spark)), AS_OF)
    return spark.createDataFrame([(x,) for x in text.splitlines() if x.startswith(("| nations", "| regions"))], "line string")


@query(f"""{_SIDES}, p AS (SELECT l.id AS x, r.id AS y FROM l JOIN r ON l.id + 1 = r.id AND l.id % 5 > 0) SELECT 'matches' AS part, count(*) AS n FROM p UNION ALL SELECT 'left_only', count(*) FROM l WHERE id NOT IN (SELECT x FROM p) UNION ALL SELECT 'right_only', count(*) FROM r WHERE id NOT IN (SELECT y FROM p)""")
def sink_25_match_files(spark, sf):
    """Pairs and the rows of either side, as files, read again."""
    path = _folder(spark)
    found, left_only, right_only, *_ = _found(spark, sf)
    sinks.export_matches(found, left_only, right_only, path)
    count = lambda part: readers.csv_text(spark, f"{path}/{part}").agg(F.lit(part).alias("part"), F.count("*").alias("n"))
    return count("matches").unionByName(count("left_only")).unionByName(count("right_only"))


@query("""WITH a AS (SELECT o_orderkey AS k, o_totalprice AS mw FROM orders WHERE o_orderkey % 10 < 8), b AS (SELECT o_orderkey AS k, o_totalprice + CASE WHEN o_orderkey % 7 = 0 THEN 5 ELSE 0 END AS mw FROM orders WHERE o_orderkey % 10 > 1)
    SELECT '## ' || c || ': ' || count(*) AS line FROM (SELECT CASE WHEN a.mw IS NULL THEN 'added' WHEN b.mw IS NULL THEN 'removed' WHEN abs(a.mw - b.mw) > 0.1 THEN 'changed' ELSE 'same' END AS c FROM a FULL JOIN b USING (k)) WHERE c <> 'same' GROUP BY c""")
def sink_28_change_report(spark, sf):
    from lodeframe.operators.matching import snapshot_diff

    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("mw"))
    new = o.filter("k % 10 > 1").withColumn("mw", F.col("mw") + F.when(F.col("k") % 7 == 0, 5).otherwise(0))
    report = sinks.change_report(snapshot_diff(o.filter("k % 10 < 8"), new, "k", {"mw": 0.1}), "k")
    return spark.createDataFrame([(x,) for x in report.splitlines() if x.startswith("## ")], "line string")


@query("SELECT o_orderkey FROM orders WHERE o_custkey BETWEEN 10 AND 20")
def sink_29_sorted_for_reads(spark, sf):
    """Files sorted by a key, so that a filter on it skips row groups."""
    path = _folder(spark)
    sinks.replace(sinks.sorted_for_reads(table(spark, sf, "orders"), ["o_custkey"]), path)
    return readers.table(spark, path, ["o_orderkey"], "o_custkey BETWEEN 10 AND 20")


@query("SELECT DISTINCT o_custkey AS apn, o_orderpriority AS campus_id FROM orders")
def sink_30_crosswalk(spark, sf):
    return sinks.crosswalk(table(spark, sf, "orders").select(F.col("o_custkey").alias("apn"), F.col("o_orderpriority").alias("campus_id")))


# --- adapters, streams, workflows


@query("""WITH x AS (SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 95.0 ELSE 30.0 END AS y, (c_custkey % 300 - 150)::DOUBLE AS x FROM customer)
    SELECT k, y IS NOT NULL AND y <= 90 AS placed, CASE WHEN y IS NULL THEN 'UNKNOWN' WHEN y > 90 THEN 'INVALID' WHEN x <= -30 THEN 'AMER' WHEN x BETWEEN -25 AND 65 THEN 'EMEA' WHEN x > 65 THEN 'APAC' ELSE 'OTHER' END AS region FROM x""")
def proj_09_truth_import(spark, sf):
    k = F.col("c_custkey")
    raw = table(spark, sf, "customer").select(k.alias("k"), F.when(k % 5 == 0, None).when(k % 5 == 1, 95.0).otherwise(30.0).alias("latitude"), (k % 300 - 150).cast("double").alias("longitude"), F.concat(F.lit("D"), k).alias("region"), F.lit("2024-01-02").alias("latest_milestone_date"))
    placed, other = adapters.truth_import(raw)
    return placed.withColumn("placed", F.lit(True)).unionByName(other.withColumn("placed", F.lit(False))).select("k", "placed", F.col("region_derived").alias("region"))


@query("SELECT 'WDMAC_' || c_custkey AS unique_id, CASE WHEN c_custkey % 3 = 0 THEN 'D' || c_custkey END AS developer, CASE WHEN c_custkey % 2 = 0 THEN 2.0::DOUBLE END AS mw FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 2 = 0")
def pred_04_milestone_rows(spark, sf):
    """Rows with neither a name nor a developer nor capacity are left out."""
    k = F.col("c_custkey")
    raw = table(spark, sf, "customer").select(k.cast("string").alias("id_site"), F.when(k % 3 == 0, F.concat(F.lit("D"), k.cast("string"))).alias("developer_name"), F.when(k % 2 == 0, "2").alias("existing_capacity__mw"), F.lit("30").alias("latitude"), F.lit("-90").alias("longitude"))
    return adapters.milestone(raw, AS_OF).select("unique_id", F.col("company_clean").alias("developer"), F.col("full_capacity_mw").alias("mw"))


@query("SELECT date_trunc('week', ts)::DATE AS week, event_type, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def strm_01_weekly_sums(spark, sf):
    """The events as a stream: weekly sums with a watermark, written by a query that ends when all is read."""
    path = _folder(spark)
    e = table(spark, sf, "events")
    stream = spark.readStream.schema(e.schema).parquet(f"{sf}/events*")
    sums = streaming.weekly_sums(stream, "ts", "value", "event_type", late="400 days")
    # every micro-batch writes the sums that it changed; the last one counts
    streaming.latest_sums(sums, f"{path}/sums", f"{path}/checkpoint", ["week", "event_type"]).awaitTermination()
    return rounded(streaming.read_latest(spark, f"{path}/sums", ["week", "event_type"]), "total")


def _workflow_feeds(spark, sf):
    grid = _raw(spark, sf, **{"Data Center ID": "concat('or:data_center:', id)", "Name": "campus_name", "Data Center Status": "'Operating'", "Owner": "company_clean", "Owner Type": "'Wholesale'", "Power Capacity (MW)": "'12'", "Latitude (Degrees)": "latitude", "Longitude (Degrees)": "longitude"})
    return {"hyperscale": _raw(spark, sf, **_HYPER), "grid": grid}


_INGESTED = f"""{CLUSTERED.replace(' e AS (SELECT', ' i AS (SELECT id, company_clean, latitude, longitude FROM b WHERE id % 10 <> 0 UNION ALL SELECT id + 1000000, company_clean, latitude, longitude FROM b), e AS (SELECT', 1).replace('FROM b x JOIN b y', 'FROM i x JOIN i y').replace('SELECT id, id FROM b UNION', 'SELECT id, id FROM i UNION').replace('SELECT b.*, cluster FROM b JOIN k', 'SELECT i.*, cluster FROM i JOIN k')}"""


@query(f"""{_INGESTED} SELECT 'ingested' AS step, count(*) AS n FROM g UNION ALL SELECT 'buildings', count(*) FROM g UNION ALL SELECT 'campuses', count(DISTINCT cluster) FROM g UNION ALL SELECT 'combined', count(*) + count(DISTINCT cluster) FROM g""")
def orch_01_full(spark, sf):
    """The whole run over two raw feeds; rows of its tables."""
    run = workflows.full(_workflow_feeds(spark, sf), AS_OF)
    return spark.createDataFrame([(k, run.rows[k]) for k in ("ingested", "buildings", "campuses", "combined")], "step string, n long")


@query(f"""{_INGESTED} SELECT count(DISTINCT cluster) AS campuses, count(*) AS buildings, (SELECT count(*) FROM b WHERE id % 10 <> 0 AND id % 50 = 1) + (SELECT count(*) FROM b WHERE id % 50 = 1) AS essential FROM g""")
def orch_02_after_ingestion(spark, sf):
    """The steps after ingestion, with curated ids."""
    raw = adapters.ingest(_workflow_feeds(spark, sf), AS_OF)
    ids = buildings(spark, sf).filter("id % 50 = 1").select(F.explode(F.array(F.concat(F.lit("DCH_"), F.col("id")), F.concat(F.lit("OREN_"), F.col("id")))).alias("unique_id"))
    run = workflows.after_ingestion(workflows.Run(), raw, AS_OF, ids)
    return spark.createDataFrame([(run.rows["campuses"], run.rows["flagged"], run.tables["flagged"].filter("is_essential = 1").count())], "campuses long, buildings long, essential long")


@query(f"""{B} SELECT 'fresh' AS step, (SELECT count(*) FROM b) AS n UNION ALL SELECT 'buildings', (SELECT count(*) FROM b WHERE id % 10 <> 0) + (SELECT count(*) FROM b) UNION ALL SELECT 'unmatched and matched', (SELECT count(*) FROM b WHERE id % 10 <> 0)""")
def orch_03_refresh_and_compare(spark, sf):
    """One feed taken in anew, then both sources matched; pairs and rows of one side add up to the rows."""
    feeds = _workflow_feeds(spark, sf)
    old = adapters.ingest(feeds, AS_OF)
    run = workflows.refresh_and_compare(old, {"grid": feeds["grid"]}, "DataCenterHawk", "Orennia", AS_OF)
    rows = [("fresh", run.rows["fresh"]), ("buildings", run.rows["buildings"]), ("unmatched and matched", run.rows["matches"] + run.rows["left_only"])]
    return spark.createDataFrame(rows, "step string, n long")


@query(f"{B} SELECT 'sources' AS part, source AS k, count(*) AS n FROM b GROUP BY source UNION ALL SELECT 'freshness', source, count(*) FROM b GROUP BY source UNION ALL SELECT 'consensus', 'campuses', count(DISTINCT id % 400) FROM b")
def orch_04_report_metrics(spark, sf):
    """The tables of the report."""
    b = buildings(spark, sf).withColumns({"ucid": F.col("id") % 400, "state": F.lit("x"), "state_abbr": F.lit("xx"), "data_vintage": F.lit("2024-01-20").cast("timestamp")})
    m = workflows.metrics(b, AS_OF)
    row = lambda part, k, n: m[part].select(F.lit(part).alias("part"), k.alias("k"), F.col(n).cast("long").alias("n"))
    tally = m["consensus"].agg(F.sum("campuses").alias("n")).select(F.lit("consensus").alias("part"), F.lit("campuses").alias("k"), "n")
    return row("sources", F.col("source"), "n").unionByName(row("freshness", F.col("source"), "rows")).unionByName(tally)


@query("SELECT round(avg(v), 3) AS mean FROM (SELECT 1 AS v) WHERE v = 1")
def samp_02_resample(spark, sf):
    """A resample of a constant column gives the constant, whatever is drawn."""
    from lodeframe.operators import accuracy

    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.lit(1.0).alias("v"))
    return accuracy.bootstrap(o, "v", resamples=200).select("mean")
