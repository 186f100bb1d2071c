"""Tables that are upserted batch by batch, each at its own cost.

A table is a folder of a base, cut into buckets of the keys' hash, and of runs: the rows of one batch or of several merged ones.
A batch writes a run of its own rows and one line of the log, so it costs what it holds, not what the table holds. Readers
merge: rows of the base whose keys no run has pass straight through, where they lie; only those with a newer version, and the
runs, are combined by key. Runs are levelled: ``fanout`` of a level become one of the next, so there are few of them
and a row is rewritten a logarithm of times; ``compact`` folds the runs into those buckets of the base that they touch.

A version is a file of the log, which lists its base and runs and the tokens of the batches in it. It is created,
never replaced: of two writers that work at once one fails (where a file system's move onto a file fails), and a batch whose token is in the log is not taken twice, so a
stream's batch that runs again after a failure changes nothing. ``vacuum`` deletes what the last versions do not name.

Rules for rows of one key:

* ``last``: the row with the largest ``seq`` (then of the later batch, then the largest row) is the row;
* ``first``: each column has its first value that is not null, in order of batches, then of ``seq``.

Rows without a key are left out. Later batches may bring columns that earlier ones did not have.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Keys of runs that readers send to every task: beyond so many, base and runs are shuffled once and combined by key.
BROADCAST_ROWS = 1_000_000
BUCKET, BATCH = "__bucket", "__batch"


class MergeTable:
    """A merge-on-read table under a path."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ("id",), seq: str = "seq", rule: str = "last", buckets: int = 16, fanout: int = 8):
        if rule not in ("last", "first"):
            raise ValueError("the rule is last or first")
        self.spark, self.path, self.keys, self.seq, self.rule, self.buckets, self.fanout = spark, path, list(keys), seq, rule, buckets, fanout

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> MergeTable:
        """A table that has been written, with the keys and the rule that its log names."""
        table = cls(spark, path)
        manifest = table.manifest()
        table.keys, table.seq, table.rule = manifest["keys"], manifest["seq"], manifest["rule"]
        return table

    # --- the log

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        fs = self._fs()
        if not fs.exists(self._path("log")):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(self._path("log")))
        return sorted(int(n) for n in names if n.isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """What a version is made of: its base by bucket, its runs, and the tokens that it has taken."""
        known = self.versions()
        if version is None and not known:
            return {"keys": self.keys, "seq": self.seq, "rule": self.rule, "base": {}, "buckets": self.buckets, "runs": [], "tokens": {}, "batches": 0}
        return json.loads(self.spark.read.text(f"{self.path}/log/{known[-1] if version is None else version}", wholetext=True).head().value)

    def _commit(self, manifest: dict, after: int) -> int:
        """Writes the version after one; fails where another writer has done so already.

        The file is written aside and moved, so that it appears whole.
        """
        fs, aside, to = self._fs(), self._path(f"log/.{uuid.uuid4().hex}"), self._path(f"log/{after + 1}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if fs.exists(to) or not fs.rename(aside, to):
            fs.delete(aside, False)
            raise RuntimeError(f"version {after + 1} of {self.path} has been written by another writer")
        return after + 1

    # --- writing

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _write_run(self, rows: DataFrame, level: int) -> dict:
        name, seen = f"run/{uuid.uuid4().hex}", Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/{name}")
        # A plan that is found to be empty beforehand observes nothing.
        return {"path": name, "level": level, "rows": seen.get.get("n", 0)}

    def upsert(self, batch: DataFrame, token: tuple[str, int] | None = None) -> int:
        """Takes a batch; returns the version that has it. ``token`` is a source's name and its batch number, which rises."""
        manifest, at = self.manifest(), (self.versions() or [0])[-1]
        if token is not None and manifest["tokens"].get(token[0], -1) >= token[1]:
            return at
        number = manifest["batches"] + 1
        keyed = batch.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in self.keys]))
        run = self._write_run(keyed.withColumn(BATCH, F.lit(number).cast("long")), 0)
        runs = manifest["runs"] + ([run] if run["rows"] else [])
        tokens = manifest["tokens"] | ({token[0]: token[1]} if token else {})
        return self._commit(manifest | {"runs": self._levelled(runs), "tokens": tokens, "batches": number}, at)

    def _levelled(self, runs: list[dict]) -> list[dict]:
        """Merges ``fanout`` runs of a level, oldest level last, until none has so many."""
        level = 0
        while any(r["level"] >= level for r in runs):
            same = [r for r in runs if r["level"] == level]
            if len(same) >= self.fanout:
                merged = self._merged(self._rows(same))
                runs = [r for r in runs if r["level"] != level] + [self._write_run(merged, level + 1)]
            level += 1
        return runs

    def compact(self, buckets: int | None = None) -> int:
        """Folds all runs into the base; only buckets that runs touch are written. A new number of buckets writes all of them."""
        manifest, at = self.manifest(), (self.versions() or [0])[-1]
        n = buckets or manifest["buckets"]
        base = manifest["base"]
        if not manifest["runs"] and n == manifest["buckets"]:
            return at
        if n != manifest["buckets"] or not base:
            touched, kept = None, {}
        else:
            ids = self._rows(manifest["runs"]).select(self._bucket(n).alias("b")).distinct()
            # At most as many as there are buckets.
            touched = [r.b for r in ids.collect()]
            kept = {b: p for b, p in base.items() if int(b) not in touched}
        rows = self._read(manifest, touched)
        name = f"base/{uuid.uuid4().hex}"
        dealt = rows.withColumn(BUCKET, self._bucket(n))
        # A bucket is as many files as it has megabytes, whatever its share of the rows.
        dealt.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{name}")
        fs = self._fs()
        written = [s.getPath().getName() for s in fs.listStatus(self._path(name))]
        base = kept | {w.rpartition("=")[2]: name for w in written if w.startswith(f"{BUCKET}=")}
        return self._commit(manifest | {"base": base, "buckets": n, "runs": []}, at)

    def vacuum(self, keep: int = 1) -> int:
        """Deletes the log before the last ``keep`` versions, and all data that those do not name; returns how many folders went."""
        fs, known = self._fs(), self.versions()
        for v in known[:-keep]:
            fs.delete(self._path(f"log/{v}"), False)
        manifests = [self.manifest(v) for v in known[-keep:]]
        named = {r["path"] for m in manifests for r in m["runs"]} | {f"{p}/{BUCKET}={b}" for m in manifests for b, p in m["base"].items()}
        gone = 0
        for top in ("run", "base"):
            for s in fs.listStatus(self._path(top)) if fs.exists(self._path(top)) else ():
                name = f"{top}/{s.getPath().getName()}"
                parts = [name] if top == "run" else [f"{name}/{p.getPath().getName()}" for p in fs.listStatus(self._path(name)) if p.isDirectory()]
                dead = [p for p in parts if p not in named]
                for p in [name] if len(dead) == len(parts) else dead:
                    fs.delete(self._path(p), True)
                    gone += 1
        return gone

    # --- reading

    def _rows(self, runs: list[dict]) -> DataFrame:
        """The rows of some runs; columns that one does not have are null."""
        return self.spark.read.option("mergeSchema", len(runs) > 1).parquet(*[f"{self.path}/{r['path']}" for r in runs])

    def _merged(self, rows: DataFrame) -> DataFrame:
        """One row for each key, by the rule."""
        rest = [c for c in rows.columns if c not in (*self.keys, self.seq, BATCH)]
        if self.rule == "last":
            best = F.max(F.struct(self.seq, BATCH, *rest)).alias("__row")
            return rows.groupBy(*self.keys).agg(best).select(*self.keys, *[F.col(f"__row.`{c}`") for c in (self.seq, BATCH, *rest)])
        order = F.struct(BATCH, self.seq)
        first = [F.min(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("v")))).alias(c) for c in rest]
        found = rows.groupBy(*self.keys).agg(F.min(order).alias("__o"), *first)
        return found.select(*self.keys, F.col(f"__o.`{self.seq}`"), F.col(f"__o.{BATCH}"), *[F.col(f"`{c}`.v").alias(c) for c in rest])

    def _base(self, manifest: dict, buckets: Sequence[int] | None) -> DataFrame | None:
        folders = {int(b): p for b, p in manifest["base"].items() if buckets is None or int(b) in buckets}
        if not folders:
            return None
        # Buckets are folders: those that are not asked for are never listed.
        return self.spark.read.option("mergeSchema", len(set(folders.values())) > 1).parquet(*[f"{self.path}/{p}/{BUCKET}={b}" for b, p in sorted(folders.items())])

    def _read(self, manifest: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        base, runs = self._base(manifest, buckets), None
        if manifest["runs"]:
            runs = self._rows(manifest["runs"])
            if buckets is not None:
                runs = runs.where(self._bucket(manifest["buckets"]).isin(list(buckets)))
        if base is None and runs is None:
            raise ValueError(f"there is nothing to read in {self.path}")
        if runs is None:
            return base
        if base is None:
            # A run that is merged of others has a key once.
            return runs if len(manifest["runs"]) == 1 and manifest["runs"][0]["level"] > 0 else self._merged(runs)
        if sum(r["rows"] for r in manifest["runs"]) > BROADCAST_ROWS:
            # The base would be shuffled to be told apart, and again to be merged: it is merged at once, each row a single time.
            return self._merged(base.unionByName(runs, allowMissingColumns=True))
        ids = F.broadcast(runs.select(*self.keys))
        newer = base.join(ids, self.keys, "left_semi").unionByName(runs, allowMissingColumns=True)
        return base.join(ids, self.keys, "left_anti").unionByName(self._merged(newer), allowMissingColumns=True)

    def read(self, version: int | None = None) -> DataFrame:
        """The table's rows as of a version, the last one by default."""
        return self._read(self.manifest(version)).drop(BATCH)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys; only the buckets that they fall into are read."""
        manifest = self.manifest()
        wanted = keys.select(*self.keys).distinct()
        buckets = [r.b for r in wanted.select(self._bucket(manifest["buckets"]).alias("b")).distinct().collect()]
        held = buckets if manifest["runs"] else [b for b in buckets if str(b) in manifest["base"]]
        if not held:
            return self.read().limit(0)
        return self._read(manifest, held).drop(BATCH).join(wanted, self.keys, "left_semi")
