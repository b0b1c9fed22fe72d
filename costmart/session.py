"""Session helpers: one place for the settings every job in the mart relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

MONTHS_AT_ONCE = 8  # jobs side by side where each month is done by its own

# Settings the mart depends on. ANSI stays on (the Spark 4 default): bad casts fail loudly and
# the code uses try_* functions where bad input is expected.
_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(app: str = "costmart", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. ``master`` is only for local runs; on a cluster leave it unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset and the master is local (tests) do we pick a folder of
    our own and register it, so ``DataFrame.checkpoint()`` and our scratch tables land in one place. On
    a cluster a folder of one machine would be lost on the others, so there an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="costmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root, unique per call (never reused, never deleted)."""
    return f"{checkpoint_root(spark)}/costmart-scratch/{name}-{uuid.uuid4().hex[:12]}"


def together(*steps, at_once: int = 0) -> None:
    """Run independent jobs side by side (all, or ``at_once`` of them), so that small ones don't wait for each other; the first
    error is raised when all have ended."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=at_once or max(1, len(steps))) as pool:
        running = [pool.submit(step) for step in steps]
    for step in running:
        step.result()


_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def size_in_bytes(text: str) -> int:
    """A size as Spark's settings give it (``64m``, ``67108864b``, ``1024``) in bytes."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def exchanged_in_parts_of(spark: SparkSession, most: int):
    """Within the block, adaptive execution deals exchanged rows out in parts of at most about ``most`` bytes, or of the session's own
    size where that is smaller. The setting is the session's, so no other job of it should run meanwhile."""
    was = spark.conf.get(_ADVISORY)
    if size_in_bytes(was) <= most:
        yield
        return
    spark.conf.set(_ADVISORY, str(most))
    try:
        yield
    finally:
        spark.conf.set(_ADVISORY, was)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few local-only helpers (tests) that need a plain path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
