import numpy as np
import pytest
from pyspark.sql import SparkSession

from factorspark.params import Params
from factorspark.plans.run import FactorRun
from panels import PANEL, swinging_panel


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("factorspark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("staging")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def params():
    return Params(min_universe=5, max_gap_days=5)


@pytest.fixture(scope="session")
def noisy_run(spark):
    """A finished run over 20 names and 900 days, slopes from 0.3 to 1.5."""
    prices = spark.createDataFrame(swinging_panel(np.linspace(0.3, 1.5, 20), 900, 0.006), PANEL)
    return FactorRun(prices, Params(min_universe=5))
