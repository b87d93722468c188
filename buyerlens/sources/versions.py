"""Versioned tables: immutable folders of rows and an append-only table of commits.

A write stages its rows in a new folder and validates them on the way, in the same job. When the job has
ended, one row is appended to ``commits``; only then does the version exist. Publishing appends a row too, which
names one committed version. Nothing is overwritten: a reader takes a snapshot of the commits once and
reads its folders for as long as it likes, and between two commits it sees one or the other, never a gap.
Writers that meet take the same number; the commit's id decides, alike for all readers.

The commits are the catalogue of the table as well: dates, row counts, reports and the newest and the
published version are known without a look at rows or a listing of files.

Rows of a table with a ``key`` lie in buckets by its hash, sorted by it, with bloom filters. The exchange by
bucket also brings equal keys together, so the same write counts repeated keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from buyerlens.session import checkpointed, file_names, remove_path

REPORT = "array<struct<check:string,passed:boolean,severity:string,violations:bigint,detail:string>>"
COMMITS = (
    "version bigint, commit string, kind string, partition string, data string, row_count bigint, buckets int, "
    f"passed boolean, report {REPORT}, facts map<string,string>, created_at timestamp"
)
BUCKET_ROWS = 1_000_000
#: Requested keys up to which they are pushed into the scan; more meet the rows in a join.
PUSHED_KEYS = 1_000
# columns that the folders of a table are named by
BUCKET, COMMIT, PART = "_bucket", "_commit", "_part"
KEY_CHECK = "primary_key_unique"


class RejectedWrite(ValueError):
    """The staged rows broke a check; they were dropped and the report was kept."""

    def __init__(self, dataset: str, report: list[tuple]):
        self.report = report
        broken = "; ".join(f"{r[0]}: {r[4]}" for r in report if not r[1] and r[2] == "error")
        super().__init__(f"Validação falhou para {dataset}: {broken}")


@dataclass(frozen=True)
class Snapshot:
    """The committed versions that one reader sees: the newest of each partition, and the published one."""

    live: dict[str, Row]
    published: Row | None
    last: int = 0

    @property
    def newest(self) -> Row | None:
        """The version of the greatest partition, published or not."""
        return self.live[max(self.live)] if self.live else None

    @property
    def current(self) -> Row | None:
        return self.published or self.newest


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    root: str
    schema: T.StructType
    name: str = "table"
    key: str | None = None
    bucket_rows: int = BUCKET_ROWS
    options: dict[str, str] = field(default_factory=dict)

    # --- the catalogue -----------------------------------------------------------------

    def commits(self) -> DataFrame:
        if file_names(self.spark, f"{self.root}/commits") is None:
            return self.spark.createDataFrame([], COMMITS)
        return self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")

    def snapshot(self) -> Snapshot:
        """One row per partition and one publication are fetched, in one job on the commits alone."""
        of = F.when(F.col("kind") == "write", F.col("partition")).otherwise("")
        newest = self.commits().groupBy("kind", of.alias("of")).agg(
            F.max_by(F.struct("*"), F.struct("version", "commit")).alias("c")).select("kind", "c").collect()
        return Snapshot(
            {r["c"]["partition"]: r["c"] for r in newest if r["kind"] == "write"},
            next((r["c"] for r in newest if r["kind"] == "publish"), None), max((r["c"]["version"] for r in newest), default=0))

    def _append(self, seen: Snapshot, kind: str, **entry) -> Row:
        return self._append_all(seen, kind, [entry])[0]

    def _append_all(self, seen: Snapshot, kind: str, entries: list[dict]) -> list[Row]:
        """Commits that readers see together: their rows are one file, which appears at once."""
        schema = T.StructType.fromDDL(COMMITS.rpartition(", ")[0])
        rows = [dict.fromkeys(schema.names) | {"version": seen.last + 1, "kind": kind} | entry for entry in entries]
        (
            self.spark.createDataFrame([tuple(row[f.name] for f in schema) for row in rows], schema)
            .withColumn("created_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
        )
        return [Row(**row) for row in rows]

    # --- writing --------------------------------------------------------------------------

    def write(self, rows: DataFrame, partition: str | Callable[[dict], str], counts: dict[str, Column] | None = None,
              facts: dict[str, Column] | None = None, explain: Callable[[str, int], str] | None = None,
              upstream: Callable[[], list[tuple]] | None = None, strict: bool = True, expected_rows: int | None = None) -> Row:
        """Stage, judge and commit ``rows`` as the new version of a partition; return the commit.

        ``counts`` are aggregates of violations and ``facts`` further ones, all observed by the write itself;
        ``upstream`` gives report rows that the same job has filled in further up. A partition given as a function is
        named from the facts. With ``strict`` a violated error check drops
        the staged rows, records the rejection and raises ``RejectedWrite``. Counts of an observed stage can be too high
        when a lost executor's tasks run again, but zero stays zero; ``row_count`` is that of the write."""
        commit = uuid.uuid4().hex
        folder = self._folder(commit)
        seen, buckets, before = Observation(), None, self.snapshot()
        observed = {f"v:{k}": v for k, v in (counts or {}).items()} | {f"f:{k}": v for k, v in (facts or {}).items()}
        laid = rows.select(*self.schema.names)
        if self.key:
            if expected_rows is None:
                if before.newest is None:
                    laid = checkpointed(laid)
                expected_rows = before.newest["row_count"] if before.newest is not None else laid.count()
            buckets = max(1, -(-expected_rows // self.bucket_rows))
            laid, copies = self._bucketed(laid, buckets)
            observed[f"v:{KEY_CHECK}"] = F.count_if(copies > 1)
        observed["rows"] = F.count(F.lit(1))
        laid = laid.observe(seen, *[v.alias(k) for k, v in observed.items()]).select(
            *self.schema.names, *([BUCKET] if buckets else []))
        writer = laid.write.options(**self.options)
        if buckets:
            distinct = str(self.bucket_rows)
            writer = writer.partitionBy(BUCKET).options(**{
                f"parquet.bloom.filter.enabled#{self.key}": "true", f"parquet.bloom.filter.expected.ndv#{self.key}": distinct})
        writer.parquet(folder)
        try:
            entry = self._verdict(seen.get, upstream, explain) | {
                "commit": commit, "data": commit, "buckets": buckets,
                "partition": partition(found_facts(seen.get)) if callable(partition) else partition}
            if strict and not entry["passed"]:
                self._append(before, "reject", **entry | {"data": None})
                raise RejectedWrite(self.name, entry["report"])
        except Exception:
            remove_path(self.spark, folder)
            raise
        # another writer may have committed in the meantime, so the number is taken now
        return self._append(self.snapshot(), "write", **entry)

    def write_parts(self, rows: DataFrame, part: Column, facts: dict[str, dict[str, str]], seen: Snapshot) -> list[Row]:
        """One job that writes new versions of several partitions, named by ``part``, and one commit of all.

        ``facts`` names the partitions; one without rows is committed empty. A hot partition is many files. What
        was decided on ``seen`` comes right after it: of two writers that saw the same, one wins for all readers."""
        commit = uuid.uuid4().hex
        named = rows.select(*self.schema.names, part.alias(PART))
        named.hint("rebalance", PART).write.partitionBy(PART).parquet(self._folder(commit))
        stored = self.spark.read.schema(self._stored_schema([PART])).parquet(self._folder(commit))
        counts = {r[PART]: r["count"] for r in stored.groupBy(PART).count().collect()}
        return self._append_all(seen, "write", [
            {"commit": commit, "data": f"{commit}/{PART}={name}" if name in counts else None, "partition": name,
             "row_count": counts.get(name, 0), "facts": of}
            for name, of in facts.items()])

    def _verdict(self, found: dict, upstream: Callable[[], list[tuple]] | None, explain: Callable[[str, int], str] | None) -> dict:
        report = list(upstream()) if upstream else []
        for check, n in ((k[2:], v) for k, v in found.items() if k.startswith("v:")):
            report.append((check, n == 0, "error", n, explain(check, n) if explain else ("ok" if n == 0 else str(n))))
        return {
            "row_count": found["rows"], "report": report, "passed": all(r[1] or r[2] != "error" for r in report),
            "facts": {k: None if v is None else str(v) for k, v in found_facts(found).items()}}

    def _bucketed(self, rows: DataFrame, buckets: int) -> tuple[DataFrame, Column]:
        """Rows by bucket, each sorted by the key, and the number of each row among those of its key.

        A key has few rows, so the window's groups are small; both use one exchange."""
        of = Window.partitionBy(BUCKET, self.key).orderBy(F.lit(1))
        dealt = rows.withColumn(BUCKET, bucket_of(F.col(self.key), buckets)).repartition(buckets, BUCKET)
        return dealt.withColumn("_copy", F.row_number().over(of)), F.col("_copy")

    def publish(self, partition: str, **facts: str) -> Row:
        """Make the newest version of a partition the current one; an absent partition is an error."""
        seen = self.snapshot()
        written = seen.live.get(partition)
        if written is None:
            raise FileNotFoundError(f"{self.name} has no committed version of {partition}")
        return self._append(
            seen, "publish", commit=uuid.uuid4().hex, data=written["data"], partition=partition, row_count=written["row_count"],
            buckets=written["buckets"], passed=written["passed"], facts={k: str(v) for k, v in facts.items()})

    def _folder(self, commit: str) -> str:
        return f"{self.root}/data/{COMMIT}={commit}"

    def _stored_schema(self, folders: list[str]) -> T.StructType:
        return T.StructType([*self.schema, *[T.StructField(c, T.IntegerType() if c == BUCKET else T.StringType()) for c in folders]])

    # --- reading --------------------------------------------------------------------------

    def _scan(self, commits: list[Row]) -> DataFrame:
        commits = [c for c in commits if c["data"]]
        schema = self._stored_schema([COMMIT, *([BUCKET] if self.key else []), *([PART] if any("/" in c["data"] for c in commits) else [])])
        if not commits:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(
            *[self._folder(c["data"]) for c in commits])

    def read(self, *commits: Row | None) -> DataFrame:
        """The rows of the given versions, in one scan; none give an empty table."""
        return self._scan([c for c in commits if c is not None]).select(*self.schema.names)

    def all(self) -> DataFrame:
        """The newest version of each partition."""
        return self.read(*self.snapshot().live.values())

    def current(self) -> DataFrame:
        """The published version; the newest one where nothing was published."""
        return self.read(self.snapshot().current)

    def matching(self, keys: DataFrame, commit: Row | None) -> DataFrame:
        """Rows of a version whose key is among ``keys``, a table with the key column.

        Few keys prune buckets, row groups and pages of the scan; beyond ``PUSHED_KEYS`` the rows meet the
        keys in a semi join, for which Spark plans its own run-time filter."""
        if commit is None:
            return self.read()
        column = F.col(self.key)
        wanted = keys.select(column.cast(self.schema[self.key].dataType)).where(column.isNotNull()).distinct()
        few = [r[0] for r in wanted.limit(PUSHED_KEYS + 1).collect()]
        rows = self._scan([commit])
        if len(few) > PUSHED_KEYS:
            return rows.join(wanted, self.key, "left_semi").select(*self.schema.names)
        local = self.spark.createDataFrame([(k,) for k in few], wanted.schema)
        numbers = [r[0] for r in local.select(bucket_of(column, commit["buckets"])).distinct().collect()]
        return rows.where(F.col(BUCKET).isin(numbers) & column.isin(few)).select(*self.schema.names)


def found_facts(found: dict) -> dict:
    return {k[2:]: v for k, v in found.items() if k.startswith("f:")}


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
