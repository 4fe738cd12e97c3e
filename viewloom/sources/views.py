"""View sinks and the re-opened view."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from viewloom.schemas import VIEW_COLUMNS
from viewloom.staging import ROW_GROUP_OPTION, ROW_GROUP_ROWS, file_system

# Codec and level of every written table.
PARQUET_CODEC = "zstd"
PARQUET_CODEC_LEVEL = 3

#: The folders of a view that is kept by run: ``run=<id>``. The column is not part of the view.
RUN = "run"


def _writer(df: DataFrame) -> DataFrameWriter:
    return (
        df.write.option("compression", PARQUET_CODEC)
        .option("parquet.compression.codec.zstd.level", PARQUET_CODEC_LEVEL)
        .option(ROW_GROUP_OPTION, ROW_GROUP_ROWS)
    )


def _write_run(view: DataFrame, path: str, run: str) -> None:
    """Replaces the rows of ``run`` in the view at ``path``; those of other runs stay.

    Spark writes beside the view and moves the finished files in when all tasks are done, so a run that fails
    leaves what was there.
    """
    if not run:
        raise ValueError("A run needs an id")
    rows = view.select(*VIEW_COLUMNS).withColumn(RUN, F.lit(run))
    _writer(rows).option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(RUN).parquet(path)


def write_view(view: DataFrame, results: str, run: str | None = None) -> str:
    """Write the view as ``<results>/view<UTC stamp>.parquet`` and return that path.

    With ``run``, rows are kept by run, and later runs can be appended and repeated (``append_view``).
    """
    # Fixed value: the name that views are found by.
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")
    path = f"{results.rstrip('/')}/view{stamp}.parquet"
    if run is None:
        _writer(view).parquet(path)
    else:
        _write_run(view, path, run)
    return path


def append_view(view: DataFrame, path: str, run: str | None = None) -> None:
    """Add the rows of a later run to an existing view.

    With ``run`` the same run can be appended again, after a failure or with other rows: its rows are replaced. That
    needs a view that was written by run. Without ``run`` rows are added each time.
    """
    by_run = _kept_by_run(view.sparkSession, path)
    if run is not None and by_run is False:
        raise ValueError(f"{path} is not kept by run, so its rows cannot be replaced by run")
    if run is None and by_run:
        raise ValueError(f"{path} is kept by run: say which run the rows are of")
    if run is None:
        _writer(view).mode("append").parquet(path)
    else:
        _write_run(view, path, run)


def _kept_by_run(spark: SparkSession, path: str) -> bool | None:
    """Whether the rows at ``path`` are kept by run; None if there are none."""
    files, where = file_system(spark, path)
    if not files.exists(where):
        return None
    names = [str(entry.getPath().getName()) for entry in files.listStatus(where)]
    names = [name for name in names if not name.startswith(("_", "."))]
    return any(name.startswith(f"{RUN}=") for name in names) if names else None


def read_view(spark: SparkSession, path: str) -> DataFrame:
    """The view's rows, of all runs."""
    view = spark.read.parquet(path)
    return view.drop(RUN) if RUN in view.columns and RUN not in VIEW_COLUMNS else view


# Intermediate tables are lazy by default; these keep one for later use.


def write_filtered(filtered: DataFrame, path: str) -> DataFrame:
    _writer(filtered).parquet(path)
    return filtered.sparkSession.read.schema(filtered.schema).parquet(path)


def write_structure(structure: DataFrame, path: str) -> DataFrame:
    _writer(structure).parquet(path)
    return structure.sparkSession.read.schema(structure.schema).parquet(path)


def write_granular(granular: DataFrame, path: str) -> DataFrame:
    """Partitioned by catalog, where there is one, and metric. Rows are dealt out by these and evenly
    within them first, so that a task writes few files and a large metric many."""
    folders = [name for name in ("catalog_key", "metric_id") if name in granular.columns]
    _writer(granular.hint("rebalance", *folders)).partitionBy(*folders).parquet(path)
    return granular.sparkSession.read.schema(granular.schema).parquet(path)
