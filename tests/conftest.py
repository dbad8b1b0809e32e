import pytest
from pyspark.sql import SparkSession

from orderlens.session import tune


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return tune(s)
