"""A chain that stops for people to review a batch and goes on when they have.

A run is a folder with what the jobs write and a log: one row per finished
stage, written after the stage's files. What is logged is not done again; a
stage that broke off has no row and is done anew over what it left. Nothing but
log rows and the name of the reviewed batch reaches the driver.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lexiloom.config import Settings
from lexiloom.operators import profile
from lexiloom.plans import jobs
from lexiloom.sources import readers

GENERATION, INTEGRATION = "generation", "integration"
LOG = ("stamp string, settings string, input_samples bigint, generated bigint, reviewed string, review_digest string, "
       "strategy string, final_samples bigint, augmentation_ratio double")


def settings_digest(settings: Settings) -> str:
    return hashlib.sha256(json.dumps(asdict(settings), sort_keys=True, default=str).encode()).hexdigest()


def _log(spark: SparkSession, folder: str, stage: str, stamp: str, **values) -> Row:
    row = spark.createDataFrame([tuple({"stamp": stamp, **values}.get(c.split()[0]) for c in LOG.split(", "))], LOG)
    row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/runs/{stamp}/{stage}")
    return row.first()


def log_of(spark: SparkSession, folder: str, stage: str, stamp: str | None = None) -> Row | None:
    """The log row of a stage: of one run, or of the run with the last stamp."""
    try:
        rows = spark.read.schema(LOG).json(f"{folder}/runs/{stamp or '*'}/{stage}")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows.orderBy(F.desc("stamp")).first()


def start(df: DataFrame, settings: Settings, folder: str, stamp: str, test_mode: bool = False,
          max_review_samples: int = 100) -> Row:
    """Generates variants and a review batch; a run that has them already is left alone.

    Raises where the run was made with other settings.
    """
    spark = df.sparkSession
    found = log_of(spark, folder, GENERATION, stamp)
    if found is not None:
        return _same_settings(found, settings)
    result = jobs.generate(df, settings, test_mode, max_review_samples)
    jobs.write_generation(result, folder, stamp, mode="overwrite")
    # The profile holds every utterance once under its intent; a trial run profiles its head only.
    whole = df.count() if test_mode else result.profile.filter(F.col("dimension") == profile.INTENT).agg(F.sum("n")).first()[0] or 0
    return _log(spark, folder, GENERATION, stamp, settings=settings_digest(settings), input_samples=whole,
                generated=result.augmentations.count())


def _same_settings(run: Row, settings: Settings) -> Row:
    if run["settings"] != settings_digest(settings):
        raise ValueError(f"run {run['stamp']} was made with other settings")
    return run


def review_digest(reviewed: DataFrame) -> str:
    """Rows and an order-free sum of their hashes: changes with any cell."""
    n, total = reviewed.agg(F.count("*"), F.sum(F.xxhash64(F.to_json(F.struct("*"))).cast("decimal(38,0)"))).first()
    return f"{n}:{total or 0}"


def resume(spark: SparkSession, settings: Settings, folder: str, stamp: str | None = None, strategy: str = "balanced",
           batches: str = "reviewed_samples_*", by: str = "time") -> Row | None:
    """Integrates the newest reviewed batch of the folder; None while there is none.

    The run is the one named, or the last. Without a change of the batch, its
    contents or the strategy, a second call changes nothing; with one, the run's
    part of the final set is replaced (and removed if nothing is approved now).
    """
    run = log_of(spark, folder, GENERATION, stamp)
    if run is None:
        raise ValueError(f"no finished generation in {folder}")
    run, stamp = _same_settings(run, settings), run["stamp"]
    newest = readers.newest_batch(spark, f"{folder}/review/{batches}", by)
    if newest is None:
        return None
    reviewed = readers.read_review(spark, newest)
    wanted = (newest, review_digest(reviewed), strategy)
    done = log_of(spark, folder, INTEGRATION, stamp)
    if done is not None and (done["reviewed"], done["review_digest"], done["strategy"]) == wanted:
        return done
    result = jobs.integrate_review(reviewed, settings, strategy)
    if result is None:
        _remove(spark, f"{folder}/final/batch={stamp}")
        n = 0
    else:
        jobs.write_integration(result, folder, stamp, mode="overwrite")
        n = result.final.count()
    size = run["input_samples"]
    return _log(spark, folder, INTEGRATION, stamp, settings=run["settings"], input_samples=size, generated=run["generated"],
                reviewed=newest, review_digest=wanted[1], strategy=strategy, final_samples=n,
                augmentation_ratio=(n / size - 1) * 100 if size else 0.0)


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
