"""Session helpers.

The library never hard-codes cluster settings.  ``get_spark`` is a
convenience for tests and the bench (local mode); on a cluster the caller
passes its own session.  ``checkpoint_dir`` reads the shared folder named by
the cluster and only invents one when it is unset (local runs, tests).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, partitions: int | None = None,
              app: str = "orchard") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    partitions = partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ORCHARD_DRIVER_MEM", "16g"))
        .config("spark.sql.ansi.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the session's setting, else a local one.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach (HDFS/S3/...).  Only when nothing is configured (local tests) do we
    create a scratch folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="orchard-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder.

    Used by iterative operators (value iteration, boosting, ICA ...) so the
    plan does not grow with the number of iterations and a lost executor
    recomputes from the last written state, not from iteration 0.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``orchard`` importable in the Python workers.

    Operators that run Python in tasks (``mapInPandas``, pandas UDFs) refer
    to functions of this package; when the workers' path does not contain
    the repository (another working directory, a cluster), the package is
    zipped once per SparkContext and shipped with ``addPyFile`` - the
    runtime form of ``--py-files``.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="orchard-py-")
    atexit.register(shutil.rmtree, out_dir, ignore_errors=True)      # the driver serves it until it ends
    path = os.path.join(out_dir, "orchard.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
