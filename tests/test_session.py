from pyspark.sql import functions as F

from ebbline import session


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in files.mkString("\n").split("\n") if "/shuffle_" in name}


def test_shuffle_files_go_with_the_table_written(spark):
    """Not when the driver happens to collect garbage; the session's own setting stays."""
    spark.conf.set(session.SHUFFLES_GO, "false")
    before = shuffle_files(spark)
    summed = spark.range(0, 10_000, 1, 4).groupBy((F.col("id") % 1_000).alias("k")).agg(F.sum("id").alias("n"))
    table = session.written(summed.repartition(3, "n"))
    assert not shuffle_files(spark) - before
    assert spark.conf.get(session.SHUFFLES_GO) == "false"
    assert table.count() == 1_000 and table.agg(F.sum("n")).first()[0] == 49_995_000
    session.discard(table)
