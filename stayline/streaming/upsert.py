"""A table with one row per key, kept current by micro-batches.

The table is a folder of Parquet files in hash buckets of the key. Every micro-batch adds a
version: one file for each bucket that it touches, so what is written grows with the batch.
Files of one bucket carry its number, so Spark reads a bucket as one partition and takes
the newest row of each key without a shuffle. `merge` rewrites only the buckets that have
several versions, shuffles nothing, and notes in a manifest which versions it replaces.

Reading never depends on the manifest for right results: the newest rows over too many
versions are the same rows. So a merge may stop anywhere.
"""

import json
import uuid

from pyspark.sql import functions as F

from stayline import schema as S

BUCKETS = 16
MANIFEST = "_manifest"


class BucketedTable:
    """Newest row per key of everything written to `folder`.

    `schema` is the DDL of the rows, `order` the columns that decide which row is newest (a
    row without them loses; ties go to the larger of the following columns). `folder` and
    `buckets` must stay the same for the life of the table.
    """

    def __init__(self, spark, folder, schema, key=S.ID, order=("ts", "event_id"), buckets=BUCKETS):
        self.spark, self.folder, self.key, self.order, self.buckets = spark, folder.rstrip("/"), key, tuple(order), buckets
        self.columns = [f.name for f in spark.createDataFrame([], schema).schema.fields]
        self.name = f"upsert_{uuid.uuid5(uuid.NAMESPACE_URL, self.folder).hex}"
        self.session_schema = schema

    def _open(self, spark):
        """The table in the catalogue of the session, with all partitions of the folder."""
        fs, root = self._fs(self.folder)
        fs.mkdirs(root)
        fields = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}"
            for f in spark.createDataFrame([], self.session_schema).schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({fields}, _bucket INT, _version STRING) USING parquet "
            f"PARTITIONED BY (_bucket, _version) CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.folder}'")
        spark.sql(f"MSCK REPAIR TABLE {self.name}")
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name)

    def _bucket(self):
        """The bucket Spark itself files a key under."""
        return F.pmod(F.hash(self.key), F.lit(self.buckets))

    def _newest(self, rows, *by):
        payload = F.struct(*[c for c in self.columns if c != self.key])
        order = F.struct(*[F.col(c) for c in self.order])
        return rows.groupBy(self.key, *by).agg(F.max_by(payload, order).alias("_row")).select(self.key, *by, "_row.*")

    def _put(self, spark, rows, version):
        """Write rows of distinct keys as a version; the same version is replaced."""
        placed = rows.select(*self.columns, self._bucket().alias("_bucket"), F.lit(version).alias("_version"))
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            placed.write.mode("overwrite").insertInto(self.name)
        finally:
            spark.conf.set(setting, before)

    def write(self, batch, batch_id, run="0"):
        """Add the newest row per key of a micro-batch.

        A replayed batch replaces its own version. Batch numbers start again with a new
        checkpoint, so `run` names the checkpoint.
        """
        spark = batch.sparkSession
        self._open(spark)
        # Keys are combined first, so a frequent key is one row a task; the batch is dealt by bucket.
        newest = self._newest(batch.select(*self.columns)).repartition(self.buckets, self.key)
        self._put(spark, newest, f"{run}-{batch_id}")

    def sink(self, run="0", transform=lambda batch: batch):
        """foreachBatch function."""
        return lambda batch, batch_id: self.write(transform(batch), batch_id, run)

    def _fs(self, path):
        location = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return location.getFileSystem(self.spark._jsc.hadoopConfiguration()), location

    def covered(self):
        """{bucket: versions that a merge has replaced}, from the newest manifest."""
        fs, root = self._fs(f"{self.folder}/{MANIFEST}")
        if not fs.exists(root):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        if not numbers:
            return {}
        text = self.spark.read.text(f"{self.folder}/{MANIFEST}/{max(numbers)}.json", wholetext=True).first().value
        return {int(b): set(v) for b, v in json.loads(text).items()}

    def _publish(self, covered, number):
        """Write the manifest beside its place and rename it, so that no reader sees half of it."""
        fs, part = self._fs(f"{self.folder}/{MANIFEST}/.{uuid.uuid4().hex}")
        stream = fs.create(part)
        stream.write(bytearray(json.dumps({b: sorted(v) for b, v in covered.items()}).encode()))
        stream.close()
        fs.rename(part, self._fs(f"{self.folder}/{MANIFEST}/{number}.json")[1])

    def versions(self):
        """{bucket: versions still needed}. Names of folders only: buckets times versions."""
        covered = self.covered()
        fs, root = self._fs(self.folder)
        found = {}
        if fs.exists(root):
            for status in fs.globStatus(self._fs(f"{self.folder}/_bucket=*/_version=*")[1]) or ():
                path = status.getPath()
                bucket = int(path.getParent().getName().split("=")[1])
                version = path.getName().split("=", 1)[1]
                if version not in covered.get(bucket, ()):
                    found.setdefault(bucket, set()).add(version)
        return found

    def _rows(self, versions):
        """The rows of some versions of some buckets, as a scan by buckets."""
        rows = self._open(self.spark)
        if not versions:
            return rows.where(F.lit(False))
        # Buckets with the same versions share a condition; conditions only name partitions.
        groups = {}
        for bucket, own in versions.items():
            groups.setdefault(frozenset(own), []).append(bucket)
        condition = F.lit(False)
        for own, buckets in groups.items():
            condition = condition | (F.col("_bucket").isin(sorted(buckets)) & F.col("_version").isin(sorted(own)))
        return rows.where(condition)

    def read(self):
        """One row per key: the newest over all versions. No shuffle."""
        return self._newest(self._rows(self.versions()))

    def merge(self, most=1):
        """Rewrite each bucket with more than `most` versions as one; gives their numbers.

        Only these buckets are read and written, each by a task of its own. Run it while no
        batch is written.
        """
        versions = {b: v for b, v in self.versions().items() if len(v) > most}
        if not versions:
            return []
        covered = self.covered()
        number = 1 + max([int(v.split("-")[1]) for own in covered.values() for v in own if v.startswith("merge-")]
                         + [int(v.split("-")[1]) for own in versions.values() for v in own if v.startswith("merge-")] + [0])
        self._put(self.spark, self._newest(self._rows(versions)), f"merge-{number}")
        self._publish({b: covered.get(b, set()) | versions.get(b, set()) for b in {*covered, *versions}}, number)
        return sorted(versions)

    def vacuum(self):
        """Delete the files of replaced versions. Run it while nobody reads."""
        for bucket, own in self.covered().items():
            for version in own:
                fs, path = self._fs(f"{self.folder}/_bucket={bucket}/_version={version}")
                fs.delete(path, True)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
