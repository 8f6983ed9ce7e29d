"""SparkSession helpers.

The library never creates a session behind the caller's back: every public function
takes the session (or a DataFrame) it works on. ``local_session`` is for tests, the
bench and the command line; on a cluster, pass the cluster's own session.
"""

from __future__ import annotations

import getpass
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every analysis relies on. ANSI stays on (division by zero raises, as the
# source dialect does); the session time zone is UTC so that event dates and epoch
# micros never depend on the host.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "webevents",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks (UI off, no server opened)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("WEBEVENTS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # size post-shuffle partitions by bytes, not by the core count
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    )
    # spark.checkpoint.dir is left as the environment configures it; a session without
    # one gets the user's own folder from ensure_checkpoint_dir (local sessions only).
    for key, value in {**REQUIRED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def session_id(spark: SparkSession) -> str:
    """Identifier of the running Spark application."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for derived tables and ``checkpoint()``.

    It is the folder the cluster names in ``spark.checkpoint.dir`` (read from the
    session, never replaced). Only a local session without one -- a test session -- gets
    one folder for all such sessions of the user, so that derived tables are found again;
    a cluster session without one is an error, since a machine-local folder is not visible
    to other executors.
    """
    sc = _context(spark)
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and sc is not None:
        folder = sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", None) or (sc.master if sc is not None else "")
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on shared storage for "
                "derived tables and checkpoints (a machine-local folder is not visible "
                "to other executors)"
            )
        folder = os.path.join(tempfile.gettempdir(), f"webevents-{getpass.getuser()}")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder
