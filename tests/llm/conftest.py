import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


QA = "id string, question string, answer string, metadata struct<source:string,category:string>, language string, extra string, text string"
STEPS = "trajectory_id string, step_id int, content string, source string, text string"


@pytest.fixture
def tables(spark, tmp_path):
    """A function that writes a table and returns the folder."""

    def write(**frames):
        for name, (rows, schema) in frames.items():
            spark.createDataFrame(rows, schema).coalesce(2).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write
