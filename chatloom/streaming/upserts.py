"""Tables that are fed in batches: later rows of a key win, and a batch that comes again changes nothing.

Rows are dealt to `buckets` by their key. A batch rewrites only the buckets that it has keys of, into a folder of its own version, and a manifest says which version of each bucket counts
and which batches are in. The next manifest is written under a name of its own and renamed, which either happens or not: a batch that dies half way leaves files that no manifest names.
Readers take the manifest with the highest number. Rows of a key are compared by `order`; equal ones by all other columns, so the order of batches doesn't matter."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


class Upserts:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], buckets: int = BUCKETS):
        """A table in the folder `path`, which driver and executors share."""
        self.spark, self.path, self.keys, self.order, self.buckets = spark, path.rstrip("/"), keys, order, buckets
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _file(self, name: str):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self._conf)

    def manifest(self) -> dict:
        """number, files (folder of each bucket), batches (that are in), schema."""
        folder, fs = self._file("manifests")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."]
        if not numbers:
            return {"number": 0, "files": {}, "batches": [], "schema": None}
        text = self.spark.read.option("wholetext", "true").text(f"{self.path}/manifests/{max(numbers)}.json").first()[0]
        return json.loads(text)

    def _commit(self, state: dict) -> None:
        temporary, fs = self._file(f"manifests/.{uuid.uuid4().hex}")
        out = fs.create(temporary)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        final, _ = self._file(f"manifests/{state['number']}.json")
        if fs.exists(final) or not fs.rename(temporary, final):
            raise RuntimeError(f"another writer committed {final}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _latest(self, rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in self.keys + self.order]
        picked = rows.groupBy(*self.keys).agg(F.max(F.struct(*self.order, *others)).alias("r"))
        return picked.select(*(F.col(c) if c in self.keys else F.col(f"r.{c}").alias(c) for c in rows.columns))

    def table(self, state: dict | None = None, only: list[int] | None = None) -> DataFrame | None:
        """The rows as of a manifest (the last one), of some buckets or all; null before the first batch."""
        state = state or self.manifest()
        paths = [p for b, p in state["files"].items() if only is None or int(b) in only]
        if not paths:
            return None if state["schema"] is None else self.spark.createDataFrame([], state["schema"])
        return self.spark.read.schema(state["schema"]).parquet(*(f"{self.path}/{p}" for p in paths))

    def apply(self, batch: DataFrame, ident: int | str) -> bool:
        """Put a batch in; False if it is in already. As foreachBatch: lambda df, n: upserts.apply(df, n)."""
        state = self.manifest()
        if str(ident) in state["batches"]:
            return False
        rows = self._latest(batch)
        touched = [r[0] for r in rows.select(self._bucket()).distinct().collect()]  # no more than buckets
        schema = state["schema"] or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema)
        before = self.table(state, touched)
        if before is not None:
            rows = self._latest(before.select(batch.columns).unionByName(rows))
        version = f"v{state['number'] + 1}-{uuid.uuid4().hex[:8]}"
        if touched:
            rows.withColumn("_bucket", self._bucket()).repartition(self.buckets, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{version}")
        files = state["files"] | {str(b): f"{version}/_bucket={b}" for b in touched}
        self._commit({"number": state["number"] + 1, "files": files, "batches": [*state["batches"], str(ident)], "schema": schema})
        return True
