import datetime

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from runledger.plans.sheets import read_date


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()


def test_read_date(spark):
    day = datetime.date
    cases = {
        "SAT 30 NOV 2024": day(2024, 11, 30), "December 17, 2016": day(2016, 12, 17), "H28.12.17": day(2016, 12, 17), "平成28年12月17日": day(2016, 12, 17), "S63.1.7": day(1988, 1, 7), "令和2年2月29日": day(2020, 2, 29),
        "2016年12月17日": day(2016, 12, 17), "17/12/2016": day(2016, 12, 17), "12/17/2016": day(2016, 12, 17), "7/7/2016": day(2016, 7, 7), "3/4/2016": None, "13/13/2016": None,
        "SAT 31 FEB 2024": None, "Smarch 1, 2016": None, "H29.2.29": None, "": None, "17 12 2016": None, "x" * 20000: None, None: None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", read_date(F.col("t")).alias("d")).collect()
    assert {r["t"]: r["d"] for r in rows} == cases
