"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Runtime SQL settings every plan here relies on. Joins carry no forced
# broadcast hint: adaptive execution picks a broadcast from measured sizes and
# otherwise splits a hot key of a sort-merge join across tasks.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "wardmetrics", master: str | None = None, **conf: str) -> SparkSession:
    """Session for jobs and tests; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset a folder below the warehouse, unless that is a local folder of a cluster."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("/", "file:")) and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors reach; {warehouse} is local to one machine")
    return f"{warehouse}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared folder, never reused by another run."""
    return f"{_shared_root(spark)}/wardmetrics/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Plan nodes that cost no more to run twice than a scan does.
_SCAN_NODES = {"Project", "Filter", "SubqueryAlias", "LogicalRelation", "Relation", "LocalRelation", "Range", "LogicalRDD", "Union"}


def is_plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` only reads, picks and filters: no join, aggregate, sort, window or Python above its files."""

    def plain(node) -> bool:
        children = node.children()
        return node.nodeName().split(" ")[0] in _SCAN_NODES and all(plain(children.apply(i)) for i in range(children.size()))

    return plain(df._jdf.queryExecution().optimizedPlan())


def read_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` for two uses: as it is where that is a plain scan, else written once and read from there."""
    return df if is_plain_scan(df) else written(df, name)
