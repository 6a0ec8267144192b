"""Presentation rank across many partitions, and publishing in both formats."""

import random
import tempfile

from pyspark.sql import functions as F

from covtab.plans.publish import publish_tables, published_order, read_published


def test_published_order_across_partitions(spark):
    rnd = random.Random(7)
    names = [f"N{rnd.randrange(100000):05d}" for _ in range(3000)] + ["TOTAL", None, None]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "org_name string, v long").repartition(9)
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = published_order(df, keys=("org_name",)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    ranks = sorted(r["rank"] for r in ranked)
    assert ranks == list(range(1, len(names) + 1))
    by_rank = [r.org_name for r in sorted(ranked, key=lambda r: r["rank"])]
    expected = [None, None] + sorted(n for n in names if n is not None)
    assert by_rank == expected


def test_publish_both_formats(spark):
    df = spark.createDataFrame([("b", "2"), ("a", "1"), ("TOTAL", "3")], "org_name string, x string")
    for fmt in ("csv", "parquet"):
        root = tempfile.mkdtemp(prefix="covtab-pub-")
        written = publish_tables({"t": df}, root, fmt)
        back = read_published(spark, written["t"], fmt)
        assert [r.org_name for r in back.collect()] == ["TOTAL", "a", "b"]
        assert back.where(F.col("org_name") == "a").first().x == "1"
