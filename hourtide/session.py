"""Session defaults and the shared folder for cut points."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "hourtide", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for; ``conf`` overrides any of them.

    Shuffles start with many partitions and adaptive execution merges small ones; it can split skewed
    joins but not aggregates, so the number must suit the largest shuffle. The object-hash threshold keeps grouped min_by / collect_list aggregates in a hash map
    for more than the default 128 groups before they fall back to sorting.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": "4000",
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where the setting is absent (tests, a laptop) a fresh temporary folder is made and set.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        chosen = context._jsc.sc().getCheckpointDir()
        folder = chosen.get() if chosen.isDefined() else None
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="hourtide-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")
