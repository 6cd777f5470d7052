import os
import time

from pyspark.sql import functions as F

from fathomline.llm.shared import checkpointed


def test_a_checkpoint_leaves_no_shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {name for folder in manager.localDirsString() for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}

    before = files()
    out = checkpointed(spark.range(10_000).repartition(7, "id").groupBy(F.col("id") % 100).agg(F.count("*").alias("n")))
    for _ in range(50):  # they are removed beside the job
        if files() - before:
            time.sleep(0.1)
    assert not files() - before
    assert out.count() == 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_arrow_batches_of_a_checkpoint_are_bounded_by_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield batch.from_pydict({"bytes": [batch.nbytes]})

    wide = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 1 << 18).alias("text"))
    assert checkpointed(wide.mapInArrow(sizes, "bytes long")).agg(F.max("bytes")).first()[0] < 10 << 20
