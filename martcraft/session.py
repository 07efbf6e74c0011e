"""Session defaults, sizing, and the shared checkpoint folder."""
from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# The JVM never compiles methods longer than this (bytes of code); Spark's default lets them run interpreted, several times slower.
LONGEST_METHOD = "8000"
_LIMIT = "spark.sql.codegen.hugeMethodLimit"
DEFAULT_CONF[_LIMIT] = LONGEST_METHOD

TARGET_BYTES = 256 << 20


def get_session(master: str | None = None, app: str = "martcraft", conf: dict[str, str] | None = None,
                input_bytes: int | None = None, total_cores: int = 1) -> SparkSession:
    """Build (or reuse) a session with UTC time, ANSI on and AQE with skew-join splitting.

    With ``input_bytes`` it is sized by ``scale_conf``; ``conf`` has the last word.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    sized = scale_conf(input_bytes, total_cores) if input_bytes is not None else {}
    for k, v in {**DEFAULT_CONF, **sized, **(conf or {})}.items():
        b = b.config(k, v)
    return b.getOrCreate()


_own_folders: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local-mode session (tests) gets a fresh folder of its own when the
    setting is absent; on a cluster, local-cluster included, a missing setting
    is an error, because a machine-local folder would not survive the loss of
    an executor.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        if sc.applicationId not in _own_folders:
            _own_folders[sc.applicationId] = tempfile.mkdtemp(prefix="martcraft-ckpt-")
        path = _own_folders[sc.applicationId]
    sc.setCheckpointDir(path)
    return path


def compiled_only(spark: SparkSession) -> None:
    """Steps whose generated method is too long to be compiled run as several shorter ones; a session's own limit stays."""
    if spark.conf.get(_LIMIT, "0") == "0":  # the default isn't among the settings made
        spark.conf.set(_LIMIT, LONGEST_METHOD)


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Sizing for a given input volume, by one rule at every size (AQE refines it at run time).

    - scan splits and shuffle partitions aim at ``TARGET_BYTES`` each: AQE merges
      partitions that turn out smaller, but it does not split larger ones
      outside skewed joins and REBALANCE, so the count follows the whole input
      (at least 3 per core);
    - a partition over four times the target and 5x the median counts as skewed
      and is split in joins (a key owning a third of the rows lands in one
      partition).
    """
    partitions = max(3 * total_cores, -(-input_bytes // TARGET_BYTES))
    return {
        "spark.sql.files.maxPartitionBytes": str(TARGET_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * TARGET_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }
