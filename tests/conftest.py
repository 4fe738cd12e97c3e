import os
from dataclasses import fields, replace

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("viewloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def two_bus_dir(spark, tmp_path_factory):
    from tests.two_bus import write_study

    path = tmp_path_factory.mktemp("two_bus")
    write_study(spark, path)
    return path


@pytest.fixture(scope="session")
def two_bus(spark, two_bus_dir):
    from viewloom import load_study

    study = load_study(spark, str(two_bus_dir))
    tables = {
        f.name: spark.createDataFrame(getattr(study, f.name).toArrow())
        for f in fields(study)
        if f.name not in ("view", "simulation")
    }
    return replace(study, **tables)
