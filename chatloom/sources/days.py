"""A data source that is asked day by day: one partition a day, retries in the task, failed days as rows instead of lost ones.

`fetch(day)` gives the Arrow batches of one day from wherever they are (a service, an archive); it must give the same rows whenever it is asked. Filters on `day` are pushed, so days outside them are
never asked for. A day that fails `tries` times gives one row with its error and nulls, and `days_failed` lists these; nothing else is held up by it."""

from __future__ import annotations

import datetime
import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

DAY, ERROR = "day", "error"


class OneDay(InputPartition):
    def __init__(self, day: datetime.date):
        super().__init__(day)


class DayReader(DataSourceReader):
    def __init__(self, fetch: Callable[[datetime.date], Iterable[pa.RecordBatch]], schema: StructType, first: datetime.date, last: datetime.date, tries: int, wait: float):
        self.fetch, self.schema, self.first, self.last, self.tries, self.wait = fetch, schema, first, last, tries, wait

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        one = datetime.timedelta(days=1)
        for f in filters:
            if getattr(f, "attribute", None) != (DAY,) or not isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                yield f
                continue
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, f.value + one * isinstance(f, GreaterThan))
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                self.last = min(self.last, f.value - one * isinstance(f, LessThan))

    def partitions(self) -> list[InputPartition]:
        return [OneDay(self.first + datetime.timedelta(days=i)) for i in range((self.last - self.first).days + 1)]

    def read(self, partition: OneDay) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        for n in range(self.tries):
            try:
                batches = list(self.fetch(partition.value))  # whole or not at all: a day that breaks off half way is asked again
                break
            except Exception as e:
                problem = f"{type(e).__name__}: {e}"
                time.sleep(self.wait * 2**n)
        else:
            yield pa.RecordBatch.from_arrays([pa.array([partition.value if f.name == DAY else problem if f.name == ERROR else None], f.type) for f in schema], schema=schema)
            return
        for b in batches:
            given = {DAY: pa.array([partition.value] * len(b), pa.date32()), ERROR: pa.nulls(len(b), pa.string())}
            yield pa.RecordBatch.from_arrays([(given[f.name] if f.name in given else b.column(f.name)).cast(f.type) for f in schema], schema=schema)


def read_days(spark: SparkSession, fetch: Callable[[datetime.date], Iterable[pa.RecordBatch]], columns: str, first: datetime.date, last: datetime.date, tries: int = 3, wait: float = 1.0) -> DataFrame:
    """day, error and the columns (as a schema text) of all days from first to last."""
    schema = f"{DAY} date, {columns}, {ERROR} string"

    class Days(DataSource):
        @classmethod
        def name(cls) -> str:
            return "days"

        def schema(self) -> str:
            return schema

        def reader(self, schema: StructType) -> DayReader:
            return DayReader(fetch, schema, first, last, tries, wait)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Days)
    return spark.read.format("days").load()


def days_failed(rows: DataFrame) -> DataFrame:
    """day, error of days that couldn't be read."""
    return rows.where(F.col(ERROR).isNotNull()).select(DAY, ERROR)
