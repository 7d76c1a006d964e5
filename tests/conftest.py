import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def utterances(spark):
    """A few commands with entities, in order."""
    rows = [
        (1, "bật đèn phòng khách", "bật", [("device", "đèn"), ("living_space", "phòng khách")]),
        (2, "mở cửa lúc 9 giờ tối", "mở", [("device", "cửa"), ("time_at", "9 giờ tối")]),
        (3, "giảm loa trong phòng ngủ", "giảm", [("device", "loa"), ("living_space", "phòng ngủ")]),
        (4, "dừng", "dừng", []),
        (5, "bật đèn, đèn nào đó", "bật", [("device", "đèn")]),
        (6, "   ", "trống", []),
        (7, "tắt TV sau 5 phút", "tắt", [("device", "TV"), ("delay_duration", "5 phút")]),
        (8, "BẬT  quạt", "bật", [("device", None)]),
    ]
    schema = ("n int, sentence string, intent string, entities array<struct<type:string,filler:string>>")
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr("struct(n) AS seq", "CAST(n AS STRING) AS sample_id", "sentence", "intent", "entities")
