"""A stored table that is changed bucket by bucket, with a manifest per version.

Rows are dealt into a fixed number of buckets by a hash of their key. A version is a manifest: a small file
that names the folders of every bucket. A change reads and writes only the buckets its rows fall into, into
a new folder, and then puts a new manifest into place by one rename. Until that rename readers see the old
version, and after a failed write they go on seeing it; earlier versions stay readable.

Buckets should hold some hundred megabytes; their number is chosen when the table is created. A change that
finds another one's version in place is refused, and can be tried again. Keys should not be null: a row with
a null key equals no other.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators import publish as pb
from rivulet.session import materialize

BUCKETS = 16
BUCKET = "_bucket"


class StoredTable:
    """The table under ``path``, in any store that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.path_of = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> StoredTable:
        """A new table of ``rows``, whose keys are distinct."""
        if BUCKET in rows.columns:
            raise ValueError(f"a column may not be called {BUCKET}")
        table = cls(rows.sparkSession, path)
        if table.versions():
            raise ValueError(f"there is a table already: {path}")
        head = {"version": 0, "keys": keys, "buckets": buckets, "schema": rows.schema.jsonValue(), "folders": {}}
        table._commit(head, table._write(table._placed(rows, head)))
        return table

    # ------------------------------------------------------------ versions
    def versions(self) -> list[int]:
        folder = self.path_of(f"{self.path}/manifests")
        if not self.files.exists(folder):
            return []
        return sorted(int(s.getPath().getName()[:-5]) for s in self.files.listStatus(folder) if s.getPath().getName().endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        version = self.versions()[-1] if version is None else version
        return json.loads(self.spark.read.text(self._manifest_file(version), wholetext=True).first()[0])

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a version, by default the newest, of all or some buckets."""
        head = self.manifest(version)
        schema = T.StructType.fromJson(head["schema"])
        folders = [f"{self.path}/{f}" for b, found in head["folders"].items() if buckets is None or int(b) in buckets for f in found]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    # ------------------------------------------------------------ changes
    def upsert(self, incoming: DataFrame, arrival: str) -> list[int]:
        """The latest arrival per key stays; incoming rows win a tie. Returns the buckets that were written anew."""
        head = self.manifest()
        placed, touched = self._touched(incoming, head)
        if not touched:
            return []
        merged = pb.upsert(self.read(head["version"], touched), placed.drop(BUCKET), head["keys"], arrival)
        self._commit(head, self._write(self._placed(merged, head)), touched)
        return touched

    def insert_ignore(self, incoming: DataFrame) -> list[int]:
        """Rows of new keys are added to their buckets, whose files stay; returns those buckets."""
        head = self.manifest()
        placed, touched = self._touched(incoming, head)
        if not touched:
            return []
        keys, rest = head["keys"], [c for c in incoming.columns if c not in head["keys"]]
        one = placed.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
        new = one.join(self.read(head["version"], touched).select(*keys), keys, "left_anti").select(*[f["name"] for f in head["schema"]["fields"]])
        added = self._write(self._placed(new, head))
        if added:
            self._commit(head, {b: [*head["folders"].get(b, []), *f] for b, f in added.items()})
        return sorted(map(int, added))

    def replace_version(self, incoming: DataFrame, column: str) -> list[int]:
        """Rows whose value of ``column`` is among the incoming ones are replaced by them; returns the buckets written anew."""
        head = self.manifest()
        placed, touched = self._touched(incoming, head)
        named = materialize(incoming.select(column).distinct())
        held = self._placed(self.read(head["version"]).join(named, column, "left_semi"), head)
        touched = sorted({*touched, *(r[0] for r in held.select(BUCKET).distinct().collect())})  # at most one row per bucket
        if not touched:
            return []
        rest = self.read(head["version"], touched).join(named, column, "left_anti").select(*incoming.columns)
        self._commit(head, self._write(self._placed(rest.unionByName(placed.drop(BUCKET)), head)), touched)
        return touched

    # ------------------------------------------------------------ inside
    def _manifest_file(self, version: int) -> str:
        return f"{self.path}/manifests/{version:010d}.json"

    def _placed(self, rows: DataFrame, head: dict) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*head["keys"]), F.lit(head["buckets"])).cast("int"))

    def _touched(self, incoming: DataFrame, head: dict) -> tuple[DataFrame, list[int]]:
        placed = materialize(self._placed(incoming, head))
        return placed, sorted(r[0] for r in placed.select(BUCKET).distinct().collect())  # at most one row per bucket

    def _write(self, placed: DataFrame) -> dict[str, list[str]]:
        """Write rows into a new folder; the folder of every bucket that has some."""
        name = f"data/{uuid.uuid4().hex}"
        placed.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{name}")
        found = [s.getPath().getName() for s in self.files.listStatus(self.path_of(f"{self.path}/{name}"))]
        return {f.split("=")[1]: [f"{name}/{f}"] for f in found if f.startswith(f"{BUCKET}=")}

    def _commit(self, head: dict, written: dict[str, list[str]], emptied=()) -> None:
        """Put the next version's manifest into place: ``written`` buckets change, ``emptied`` ones lose their old folders."""
        kept = {b: f for b, f in head["folders"].items() if int(b) not in set(emptied)}
        new = head | {"version": head["version"] + 1, "folders": kept | written}
        draft, place = self.path_of(f"{self.path}/drafts/{uuid.uuid4().hex}"), self.path_of(self._manifest_file(new["version"]))
        out = self.files.create(draft)
        out.write(json.dumps(new).encode())
        out.close()
        self.files.mkdirs(place.getParent())
        if self.files.exists(place) or not self.files.rename(draft, place):
            raise RuntimeError(f"version {new['version']} was written by another change; try again")
