from pyspark.sql import functions as F

from lodeframe.operators import accuracy
from lodeframe.plans import queries as Q


def test_query_takes_all_resamples(spark, tmp_path):
    rows = [(i, float(i * i % 97)) for i in range(40)]
    spark.createDataFrame(rows, "o_orderkey long, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    orders = spark.read.parquet(str(tmp_path / "orders.parquet")).select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"))
    got = Q.QUERIES["stat_12_bootstrap"](spark, str(tmp_path)).first()
    whole, few = accuracy.bootstrap(orders, "v", resamples=1000).first(), accuracy.bootstrap(orders, "v", resamples=20).first()
    assert list(got) == [round(x, 3) for x in whole]
    assert list(got) != [round(x, 3) for x in few]
