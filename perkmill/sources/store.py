"""Account snapshots and changes, the append-only ledger, and stamps, as parquet folders per run.

Run ids sort in run order. A run writes whole folders of its own, and last of all one row of the commit
table: that row is what makes it count. What a run wrote that has no such row, since it died on the way,
is in no reader's sight: not its ledger rows, not its stamps, not its changes. So either a payment is in
the ledger and in the balances, or it's in neither, and a later run makes it. The same run may also be
run again under its id.

Accounts lie in buckets by a hash of the customer, and so do changes. A snapshot writes new versions of
the buckets that changed since the last one and then a manifest of them; the accounts after a run are
each bucket's last version with the changes since the last snapshot.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ledger import append_new, apply_changes, fold_changes
from ..plans.jobs import JobResult
from ..schemas import CHANGES, COMMITS, LEDGER, REJECTS, SNAPSHOTS, STORED, schema_of

_RUN = T.StructField("run_id", T.StringType())
_BUCKET = T.StructField("bucket", T.IntegerType())


@dataclass(frozen=True)
class Store:
    """`buckets` is taken when a store is started; later runs keep to it."""

    spark: SparkSession
    root: str
    buckets: int = 64

    def folder(self, table: str, run_id: str) -> str:
        return f"{self.root}/{table}/run_id={run_id}"

    def start(self, run_id: str, account: DataFrame, ledger: DataFrame) -> None:
        """Takes over the balances and ledger kept so far as the first run."""
        known = set(ledger.columns)
        rows = ledger.select(
            *[(F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER]
        )
        self._write_ledger(run_id, rows)
        for name in ["rejects", *STORED]:
            nothing = self.spark.createDataFrame([], self._schema(name))
            nothing.write.mode("overwrite").parquet(self.folder(name, run_id))
        self._write_buckets("changes", run_id, self.spark.createDataFrame([], CHANGES), self.buckets)
        given = account.select(*[F.col(f.name).cast(f.dataType) for f in schema_of("account")])
        self._write_buckets("account", run_id, given, self.buckets)
        self._append("snapshots", SNAPSHOTS, [(run_id, b, self.buckets) for b in range(self.buckets)])
        self._append("commits", COMMITS, [(run_id, None, None)])

    def _schema(self, table: str) -> T.StructType:
        return {"ledger": LEDGER, "rejects": REJECTS, "changes": CHANGES}.get(table) or schema_of(table)

    def _append(self, table: str, schema: T.StructType, rows: list[tuple]) -> None:
        """One file: it's there whole or not at all."""
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{table}")

    # --- which runs count

    def committed(self) -> DataFrame:
        """`run_id`, `job`, `previous` of every run that ended."""
        return self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")

    def is_committed(self, run_id: str) -> bool:
        return not self.committed().filter(F.col("run_id") == run_id).isEmpty()

    def last_run(self) -> str:
        """The last run that ended."""
        return self.committed().agg(F.max("run_id")).first()[0]

    def _committed_rows(self, table: str, which: Column) -> DataFrame:
        """Rows of the committed runs that `which`, a condition on run_id, names; other folders are pruned."""
        schema = self._schema(table)
        extra = [_RUN, _BUCKET] if table == "changes" else [_RUN]
        stored = self.spark.read.schema(T.StructType([*schema.fields, *extra])).parquet(f"{self.root}/{table}")
        runs = self.committed().filter(which).select("run_id").distinct()
        return stored.filter(which).join(runs, "run_id", "left_semi")

    def before(self, table: str, run_id: str) -> DataFrame:
        """Rows that earlier runs wrote to a table, those that ended."""
        return self._committed_rows(table, F.col("run_id") < run_id).select(*self._schema(table).names)

    def ledger_before(self, run_id: str) -> DataFrame:
        return self.before("ledger", run_id)

    # --- accounts

    def _versions(self, run_id: str) -> list[T.Row]:
        """Run, bucket and number of buckets of every bucket's last version up to a run."""
        known = self.spark.read.schema(SNAPSHOTS).parquet(f"{self.root}/snapshots").filter(F.col("run_id") <= run_id)
        return known.groupBy("bucket").agg(F.max("run_id").alias("run_id"), F.max("buckets").alias("buckets")).collect()

    def _account(self, run_id: str, versions: list[T.Row], buckets: list[int] | None = None) -> DataFrame:
        """Accounts after a run, with their bucket; all or those of some buckets."""
        schema = schema_of("account")
        paths = [f"{self.folder('account', v.run_id)}/bucket={v.bucket}" for v in versions if buckets is None or v.bucket in buckets]
        # A bucket without customers has no folder.
        reader = self.spark.read.schema(T.StructType([*schema.fields, _BUCKET, _RUN])).option("basePath", f"{self.root}/account")
        base = reader.parquet(*[p for p in paths if self._exists(p)] or [f"{self.root}/account"])
        if buckets is not None:
            base = base.filter(F.col("bucket").isin(*buckets))
        fold = fold_changes(self._changes(versions, run_id, buckets))
        return apply_changes(base.drop("run_id"), fold)

    def _changes(self, versions: list[T.Row], run_id: str, buckets: list[int] | None = None) -> DataFrame:
        """Changes since the last snapshot before or at a run."""
        since = F.col("run_id") > max(v.run_id for v in versions)
        found = self._committed_rows("changes", since & (F.col("run_id") <= run_id))
        return found if buckets is None else found.filter(F.col("bucket").isin(*buckets))

    def _exists(self, path: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def account(self, run_id: str) -> DataFrame:
        """Accounts after a run that ended."""
        return self._account(run_id, self._versions(run_id)).drop("bucket")

    def snapshot(self, run_id: str) -> list[int]:
        """Writes the buckets that changed since the last snapshot, so that later runs start from there;
        returns them. A bucket's older versions stay, for the accounts after earlier runs."""
        versions = self._versions(run_id)
        touched = sorted(r.bucket for r in self._changes(versions, run_id).select("bucket").distinct().collect())
        if touched:
            rows = self._account(run_id, versions, touched)
            rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self.folder("account", run_id))
            self._append("snapshots", SNAPSHOTS, [(run_id, b, versions[0].buckets) for b in touched])
        return touched

    # --- writing

    def _write_ledger(self, run_id: str, rows: DataFrame) -> None:
        """Split by job, as the checks of what's paid ask for one job's rows or two's."""
        rows.write.mode("overwrite").partitionBy("job").parquet(self.folder("ledger", run_id))

    def _write_buckets(self, table: str, run_id: str, rows: DataFrame, buckets: int) -> None:
        bucket = F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).cast("int")
        dealt = rows.withColumn("bucket", bucket).repartition("bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(self.folder(table, run_id))

    def written(self, table: str, run_id: str) -> DataFrame:
        """What a run wrote to a table, ended or not."""
        schema = self._schema(table)
        return self.spark.read.schema(schema).parquet(self.folder(table, run_id)).select(*schema.names)

    def tables(self, inputs: Mapping[str, DataFrame], run_id: str, previous: str) -> dict[str, DataFrame]:
        """Inputs of a run: the shop's tables, with the accounts after the run before it and what all
        earlier runs paid or counted: ledger, suborder stamps, reward log, likes."""
        if not self.is_committed(previous):
            raise ValueError(f"run {previous} did not end; the last that did is {self.last_run()}")
        log = self.before("review_reward_log", run_id)
        given = inputs.get("review_reward_log")
        return {
            **{name: inputs[name] for name in inputs},
            "account": self.account(previous),
            "ledger": self.ledger_before(run_id),
            **{name: self.before(name, run_id) for name in STORED},
            "review_reward_log": log if given is None else log.unionByName(given.select(*log.columns)),
        }

    def commit(self, run_id: str, job: str, tables: Mapping[str, DataFrame], result: JobResult, previous: str | None = None) -> None:
        """Writes what a job hands back, and then the row by which it counts. A run that ended is not
        written again."""
        if self.is_committed(run_id):
            raise ValueError(f"run {run_id} has ended")
        self._write_ledger(run_id, append_new(tables["ledger"], result.ledger, [job]))
        result.rejects.write.mode("overwrite").parquet(self.folder("rejects", run_id))
        for name, df in result.tables.items():
            df.select(*[F.col(f.name).cast(f.dataType) for f in schema_of(name)]).write.mode("overwrite").parquet(self.folder(name, run_id))
        self._write_buckets("changes", run_id, result.changes, self._versions(run_id)[0].buckets)
        self._append("commits", COMMITS, [(run_id, job, previous)])
