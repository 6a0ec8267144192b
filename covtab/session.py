"""Session helpers: building a local session for tests and benchmarks,
materialising a stage so later actions do not re-run its lineage, and the
tables of a run."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "covtab") -> SparkSession:
    """A local session with the settings the library is tested under.

    On a cluster use the cluster's session instead; nothing in the library
    depends on this function.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("COVTAB_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the checkpoint folder named by the session.

    ``spark.checkpoint.dir`` wins when the cluster sets it. Only when nothing
    is set and the session is local (tests, benchmarks) a fresh scratch
    folder is created; on a cluster a machine-local folder would not be seen
    by other executors, so an unset folder is an error there.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if sc is None:  # Spark Connect: the server uses spark.checkpoint.dir itself
        if conf_dir:
            return conf_dir
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if fallback is None and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    path = fallback or tempfile.mkdtemp(prefix="covtab-ckpt-")
    sc.setCheckpointDir(path)
    return path


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # not available under Spark Connect
        return None


class Scratch:
    """The stages of one run: parquet tables in a folder of their own below the
    shared checkpoint folder. Nothing of the session or the context is changed,
    so runs in one session do not touch each other. Use it as a context manager,
    or call :meth:`close`; either deletes the run's tables, also after a failure."""

    def __init__(self, spark: SparkSession, name: str = "run"):
        self.spark = spark
        self.id = uuid.uuid4().hex
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{self.id}"
        self._tables: list[str] = []

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, computed once and read back: later readers prune columns, and
        Spark knows its size."""
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, name: str, by: str = "entity_id", buckets: int | None = None) -> DataFrame:
        """:meth:`table` bucketed and sorted by one column: a join or an
        aggregation on it shuffles neither this table nor another one with as
        many buckets. The rows are dealt by the hash that Spark buckets by, so a
        task writes one file. ``buckets``: one for each shuffle partition."""
        n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        full = f"covtab_{name}_{self.id}_{len(self._tables)}"
        self._tables.append(full)
        (df.repartition(n, by).write.option("compression", "zstd").bucketBy(n, by).sortBy(by)
         .option("path", f"{self.path}/{full}").format("parquet").saveAsTable(full))
        return self.spark.table(full)

    def close(self) -> None:
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables.clear()
        delete_path(self.spark, self.path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        self.close()


def _file(spark: SparkSession, path: str):
    """The path and its file system, by Spark's own client, wherever it is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder or file, if it is there."""
    target, fs = _file(spark, path)
    fs.delete(target, True)


def list_path(spark: SparkSession, path: str) -> list[str]:
    """The files and folders directly below ``path``; none if it is not there."""
    target, fs = _file(spark, path)
    return [str(s.getPath().toString()) for s in fs.listStatus(target)] if fs.exists(target) else []


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    target, fs = _file(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file that must not be there yet; false, and nothing done,
    if it is. The text goes to a file beside it first and is renamed, so the
    file is never seen in part."""
    target, fs = _file(spark, path)
    fs.mkdirs(target.getParent())
    beside, _ = _file(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    java = spark.sparkContext._jvm
    context = java.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri() if beside.toUri().getScheme() else fs.getUri(),
                                                                   spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(java.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = java.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(target), options)
        return True
    except Exception:
        if fs.exists(target):
            return False
        raise
    finally:
        fs.delete(beside, False)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, write it to the shared checkpoint folder and cut
    its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_table(df: DataFrame, name: str = "table") -> DataFrame:
    """:meth:`Scratch.table` of a run that the caller does not end: the table
    stays in the checkpoint folder."""
    return Scratch(df.sparkSession, name).table(df, name)


def materialize_layout(df: DataFrame, by: str = "entity_id") -> DataFrame:
    """:meth:`Scratch.bucketed` of a run that the caller does not end."""
    return Scratch(df.sparkSession, "layout").bucketed(df, "layout", by)
