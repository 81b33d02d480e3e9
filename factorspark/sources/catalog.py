"""Tables of a run in a catalog schema."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from factorspark.params import Params
from factorspark.plans.contract import KEYS
from factorspark.sources.staging import compact


class LoadError(RuntimeError):
    """A table does not hold the rows that were sent to it."""


class Tables:
    """Reads ``schema.<name>`` as attribute ``<name>``; writes replace the table.

    A replacement is written to a table beside the old one and its rows are counted there; only then do
    the names change. If the write or the count fails, the old table stays as it is. Should a process die
    between the two renamings, the next write finds the old table under ``<name>__old`` and restores it.
    """

    signals_stored = True

    def __init__(self, spark: SparkSession, schema: str = "core"):
        self._spark = spark
        self._schema = schema

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self._spark.table(f"{self._schema}.{name}")

    def ensure_schema(self) -> None:
        self._spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self._schema}")

    def _exists(self, name: str) -> bool:
        return self._spark.catalog.tableExists(f"{self._schema}.{name}")

    def _drop(self, name: str) -> None:
        self._spark.sql(f"DROP TABLE IF EXISTS {self._schema}.{name}")

    def _rename(self, old: str, new: str, partitioned: bool) -> None:
        self._spark.sql(f"ALTER TABLE {self._schema}.{old} RENAME TO {self._schema}.{new}")
        if partitioned:  # some catalogs forget the partitions of a renamed table
            self._spark.sql(f"ALTER TABLE {self._schema}.{new} RECOVER PARTITIONS")

    def _partitions(self, name: str) -> list[str]:
        columns = self._spark.catalog.listColumns(f"{self._schema}.{name}")
        return [column.name for column in columns if column.isPartition]

    def _swap(self, side: str, name: str) -> None:
        """Give the name to the table beside it; the old one goes last."""
        old = f"{name}__old"
        if self._exists(name):
            self._drop(old)
            self._rename(name, old, bool(self._partitions(name)))
        try:
            self._rename(side, name, bool(self._partitions(side)))
        except Exception:
            if self._exists(old) and not self._exists(name):
                self._rename(old, name, bool(self._partitions(old)))
            raise
        self._drop(old)

    def materialize(
        self,
        df: DataFrame,
        name: str,
        bucket_by: str | Sequence[str] | None = None,
        buckets: int | None = None,
        partition_by: str | None = None,
        sort_by: Sequence[str] = (),
    ) -> DataFrame:
        """Replace the table and verify that all rows arrived.

        With ``bucket_by`` rows are spread by these columns into ``buckets`` buckets, a number that the
        catalog keeps: later windows and joins over them read the table without a shuffle. The
        repartition gives every bucket a single file, in which rows lie by ``sort_by``: values that follow
        from row to row take less disk. With ``partition_by`` each value has a folder of
        its own, in few files (``replace_partitions`` renews some of them)."""
        if not self._exists(name) and self._exists(f"{name}__old"):
            self._rename(f"{name}__old", name, bool(self._partitions(f"{name}__old")))
        sent = Observation(name)
        rows = df.observe(sent, F.count("*").alias("n"))
        if bucket_by:
            keys = [bucket_by] if isinstance(bucket_by, str) else list(bucket_by)
            writer = rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
            writer = writer.sortBy(*sort_by) if sort_by else writer
        elif partition_by:
            writer = self._dealt(rows, partition_by).write.partitionBy(partition_by)
        else:
            writer = rows.write
        side = f"{name}__{uuid.uuid4().hex[:12]}"
        try:
            writer.format("parquet").options(**compact(df)).saveAsTable(f"{self._schema}.{side}")
            self._verify(name, sent.get["n"], getattr(self, side).count())
        except Exception:
            self._drop(side)
            raise
        self._swap(side, name)
        return getattr(self, name)

    def _dealt(self, rows: DataFrame, key: str) -> DataFrame:
        """Rows by partition value, in a stated number of tasks: merged into few, they would write their
        many small files one after the other."""
        return rows.repartition(int(self._spark.conf.get("spark.sql.shuffle.partitions")), key)

    @staticmethod
    def _verify(name: str, sent: int, loaded: int) -> None:
        if sent != loaded:
            raise LoadError(f"{name}: sent {sent} rows, loaded {loaded}")

    def replace_partitions(self, df: DataFrame, name: str, values: Sequence) -> None:
        """Replace the partitions with these values by the rows of ``df``, which has no others; all other
        folders stay untouched. A value without rows loses its partition."""
        (key,) = self._partitions(name)
        sent = Observation(name)
        rows = df.select(*getattr(self, name).columns).observe(sent, F.count("*").alias("n"))
        target = f"{self._schema}.{name}"
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self._spark.conf.get(mode)
        self._spark.conf.set(mode, "dynamic")  # insertInto does not take it as an option
        try:
            self._dealt(rows, key).write.mode("overwrite").insertInto(target)
        finally:
            self._spark.conf.set(mode, before)
        stored = getattr(self, name).filter(F.col(key).isin(list(values)))
        written = {row[0] for row in df.select(key).distinct().collect()}
        for value in set(values) - written:
            self._spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({key} = '{value}')")
        self._verify(name, sent.get["n"], stored.count())

    def register_views(self, names: Sequence[str]) -> None:
        """Temporary views under the plain table names, for ad-hoc SQL."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)

    def query(self, sql: str) -> DataFrame:
        """Ad-hoc SQL; column names come back in lower case."""
        result = self._spark.sql(sql)
        return result.toDF(*[c.lower() for c in result.columns])

    def load_prices(self, prices: DataFrame, buckets: int = Params.daily_buckets) -> DataFrame:
        """Replace ``raw_prices`` with the typed columns."""
        self.ensure_schema()
        typed = prices.select(*KEYS, F.col("adj_close").cast("double").alias("adj_close"))
        return self.materialize(typed, "raw_prices", "ticker", buckets, sort_by=KEYS)
