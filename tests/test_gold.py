import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from silverline.operators.ranking import dense_rank_within


def test_dense_rank_matches_window_with_a_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        # one group holds about a third of the rows, values repeat
        g = "hot" if i % 3 == 0 else f"g{rnd.randrange(40)}"
        rows.append((g, f"c{i}", rnd.randrange(200) if i % 11 else None))
    df = spark.createDataFrame(rows, "grp string, channel string, views bigint")
    got = dense_rank_within(df, "grp", "views", rank_column="r", partitions=16)
    want = df.withColumn(
        "r", F.dense_rank().over(Window.partitionBy("grp").orderBy(F.col("views").desc_nulls_last()))
    )
    assert sorted(got.collect()) == sorted(want.collect())



def test_register_silver_table(spark, tmp_path):
    from silverline.operators.gold import register_table

    path = str(tmp_path / "t")
    spark.createDataFrame([("kaggle", "US", 1), ("kaggle", "GB", 2)], "source string, region string, v int").write.partitionBy(
        "source", "region"
    ).parquet(path)
    register_table(spark, "silver_t_test", path)
    assert spark.sql("SELECT sum(v) AS s FROM silver_t_test WHERE region = 'GB'").first().s == 2
    spark.sql("DROP TABLE silver_t_test")
