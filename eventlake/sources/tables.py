"""Reading and writing the tables of the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.config import Settings
from eventlake.schemas import create_tables


class TableStore:
    """The lake's tables by short name; columns are matched by name, not by place."""

    def __init__(self, spark: SparkSession, settings: Settings = Settings()):
        self.spark = spark
        self.settings = settings

    def create(self, *names: str) -> None:
        create_tables(self.spark, self.settings, list(names) or None)

    def full_name(self, name: str) -> str:
        return f"{self.settings.database}.{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.table(self.full_name(name))

    def columns(self, name: str) -> list[str]:
        return self.read(name).columns

    def append(self, df: DataFrame, name: str) -> None:
        df.select(*self.columns(name)).write.insertInto(self.full_name(name))

    def overwrite_partition(self, df: DataFrame, name: str, column: str, value: object) -> None:
        """Replace one partition, so that a rerun leaves the same rows as one run.

        The partition is named in the statement, so an empty result clears it.
        """
        rest = [c for c in self.columns(name) if c != column]
        others = "".join(f", {c}" for c in self._partitions(name) if c != column)
        # the session of the rows: inside foreachBatch it is not the store's own
        df.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {self.full_name(name)} "
            f"PARTITION ({column} = '{value}'{others}) SELECT * FROM {{rows}}",
            rows=df.select(*rest),
        )

    def overwrite_day(self, df: DataFrame, name: str, column: str, day: str) -> None:
        self.overwrite_partition(df, name, column, day)

    def overwrite_partitions(self, df: DataFrame, name: str) -> None:
        """Replace every partition that the rows have a row for, in one job; the others stay (see `by_partition`)."""
        rows = df.select(*self.columns(name))
        if self.settings.provider == "iceberg":
            rows.writeTo(self.full_name(name)).overwritePartitions()
        else:
            rows.write.insertInto(self.full_name(name), overwrite=True)

    def by_partition(self) -> TableStore:
        """The same tables in a session of their own, in which an overwrite replaces single partitions.

        The mode belongs to a session, and jobs beside this one rely on the other.
        """
        session = self.spark.newSession()
        for key, value in (
            ("spark.sql.session.timeZone", self.spark.conf.get("spark.sql.session.timeZone")),
            ("spark.sql.sources.partitionOverwriteMode", "dynamic"),
        ):
            session.conf.set(key, value)
        return TableStore(session, self.settings)

    def overwrite(self, df: DataFrame, name: str) -> None:
        """Replace the whole table."""
        select = df.select(*self.columns(name))
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.full_name(name)} SELECT * FROM {{rows}}", rows=select)

    def _partitions(self, name: str) -> list[str]:
        listed = self.spark.catalog.listColumns(self.full_name(name))
        return [c.name for c in listed if c.isPartition]


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append") -> None:
    """Copy a result to a serving database."""
    df.write.jdbc(url=url, table=table, mode=mode, properties=properties)
