import gc

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def plans_are_freed():
    """Frames of a test stay referenced from Python, plans and all, until Python looks for cycles."""
    yield
    gc.collect()


@pytest.fixture()
def one_column(spark):
    """Apply a column function to a list of texts and collect the results in order."""
    from pyspark.sql import functions as F

    def apply(function, texts):
        df = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
        rows = df.select("i", function(F.col("t")).alias("x")).orderBy("i").collect()
        return [row.x for row in rows]

    return apply
