"""Raw JSON to bronze table to silver view."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stopwise.config import Settings
from stopwise.plans.decorators import expect_or_drop, table, temporary_view
from stopwise.sinks.tables import write_table
from stopwise.sinks.views import preview, show_full
from stopwise.sources.json_tree import read_json_tree
from stopwise.sources.tables import read_table

# Column names, view names and the silver predicate.
BRONZE_TIME = "ingest_ts"
SILVER_TIME = "silver_ingest_ts"
BRONZE_VIEW = "bronze_view"
SILVER_VIEW = "silver_view"
SILVER_CONDITION = "is_assigned = True"


def stamp(df: DataFrame, column: str) -> DataFrame:
    """Add the time of the query that reads or writes the rows."""
    return df.withColumn(column, F.current_timestamp())


@dataclass(frozen=True)
class Medallion:
    """The three steps over one raw tree and one bronze table.

    Silver is a view and never stored, so ``silver_ingest_ts`` is the time of each query;
    ``ingest_ts`` is the time of the bronze write.
    """

    spark: SparkSession
    raw_path: str
    bronze_path: str
    fmt: str = "parquet"
    raw_schema: StructType | str | None = None
    bronze_view_name: str = BRONZE_VIEW
    silver_view_name: str = SILVER_VIEW

    @classmethod
    def configured(cls, spark: SparkSession, settings: Settings | None = None) -> Medallion:
        """Raw tree and table folder from the environment."""
        settings = settings or Settings()
        bronze_path = settings.table_path("bronze")
        return cls(spark, settings.raw_path, bronze_path, settings.table_format)

    def bronze(self) -> DataFrame:
        @table("bronze", path=self.bronze_path, fmt=self.fmt)
        def bronze():
            return stamp(read_json_tree(self.spark, self.raw_path, self.raw_schema), BRONZE_TIME)

        return bronze()

    def bronze_view(self) -> DataFrame:
        @temporary_view(self.bronze_view_name)
        def bronze_view():
            return read_table(self.spark, self.bronze_path, self.fmt)

        return bronze_view()

    def silver_view(self) -> DataFrame:
        @temporary_view(self.silver_view_name)
        @expect_or_drop("assigned", SILVER_CONDITION)
        def silver_view():
            return stamp(read_table(self.spark, self.bronze_path, self.fmt), SILVER_TIME)

        return silver_view()

    def run(self) -> DataFrame:
        self.bronze()
        self.bronze_view()
        return self.silver_view()


def land_raw(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    fmt: str = "parquet",
    show: bool = False,
) -> DataFrame:
    """First-generation bronze: replace table and schema by the raw rows, return a preview."""
    raw = read_json_tree(spark, raw_path)
    if show:
        show_full(raw)
    return preview(write_table(raw, bronze_path, replace_schema=True, fmt=fmt))
