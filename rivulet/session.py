"""Session settings and reliable materialisation."""

from __future__ import annotations

import pickle
import tempfile
import uuid

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession

def local_session(cpus: int = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the benchmark; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rivulet")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder inside the one the session names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="rivulet-checkpoint-")
        sc.setCheckpointDir(folder)
        folder = sc.getCheckpointDir()
    return f"{folder}/rivulet-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, and tells the optimizer the real
    size, so that a small result is broadcast and a large one is not.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` or a bucketed write put into the shared folder, when nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            if folder.rsplit("/", 1)[-1].startswith("rivulet-"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


class Shared:
    """A broadcast value that executors can read without a copy of this package; it is loaded once per task."""

    def __init__(self, data: Broadcast):
        self.data = data

    @property
    def value(self):
        if not hasattr(self, "_value"):
            self._value = pickle.loads(self.data.value)
        return self._value

    def __getstate__(self) -> dict:
        return {"data": self.data}


def share(spark: SparkSession, value) -> Shared:
    """Broadcast a value that holds objects of this package."""
    return Shared(spark.sparkContext.broadcast(cloudpickle.dumps(value)))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a table of fewer partitions than cores one partition per core, before work that reads it many times.

    ``df`` should be a scan or a materialised table; a wider one stays as it lies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
