"""First rows of a group, where one group holds everything."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexiloom.operators import integrate, ranks


def test_one_group_of_a_million_values(spark, monkeypatch):
    """No window of the ranking holds more than a few times the rows that it may."""
    monkeypatch.setattr(ranks, "VALUES", 50_000)
    seen = []
    plain = ranks.ranged
    monkeypatch.setattr(ranks, "ranged", lambda *args: seen.append(plain(*args)) or seen[-1])
    # All rows under one leading value, in no order, and one small group.
    rows = spark.range(1_000_000).select(
        F.lit("hot").alias("intent"), F.struct(F.lit(1).alias("block"), (F.col("id") * 7919 % 1_000_003).alias("doc"), F.lit(0).alias("sent")).alias("seq"))
    few = spark.range(40).select(F.lit("few").alias("intent"), F.struct(F.lit(2).alias("block"), F.col("id").alias("doc"), F.lit(0).alias("sent")).alias("seq"))
    targets = spark.createDataFrame([("hot", 654_321), ("few", 7), ("absent", 3)], "intent string, target long")
    got = integrate.first_n_per_group(rows.union(few), "intent", targets)
    counted = {r.intent: (r.n, r.last) for r in got.groupBy("intent").agg(F.count("*").alias("n"), F.max("seq.doc").alias("last")).collect()}
    wanted = sorted(i * 7919 % 1_000_003 for i in range(1_000_000))[654_320]
    assert counted == {"hot": (654_321, wanted), "few": (7, 6)}
    assert len(seen) == 1  # the leading values are few
    sizes = [r["count"] for r in seen[0].groupBy("intent", "_bucket").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 150_000


def test_against_a_window(spark, monkeypatch):
    monkeypatch.setattr(ranks, "VALUES", 20)
    rows = spark.range(3000).selectExpr(
        "concat('g', id * id % 5) AS g", "named_struct('a', CAST(id * 31 % 7 AS INT), 'b', concat('x', id * 17 % 11), 'c', id) AS seq")
    targets = spark.createDataFrame([(f"g{i}", n) for i, n in enumerate((1, 250, 10_000, 3, 77))], "g string, target long")
    got = {r.seq.c for r in integrate.first_n_per_group(rows, "g", targets).collect()}
    place = F.row_number().over(Window.partitionBy("g").orderBy("seq"))
    want = {r.seq.c for r in rows.withColumn("p", place).join(targets, "g").filter("p <= target").collect()}
    assert got == want
    one = rows.select("g", F.struct("seq.c").alias("seq"))
    got = {r.seq.c for r in integrate.first_n_per_group(one, "g", targets).collect()}
    want = {r.seq.c for r in one.withColumn("p", place).join(targets, "g").filter("p <= target").collect()}
    assert got == want
