"""Named handles to the business tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.sources.layout import in_months, in_window
from rivulet.sources.lots import DATE_OF_PARENT, Lots, in_ranges
from rivulet.sources.schema import DATE_COLUMN, TABLE_COLUMNS, canonical_schema


class Tables:
    """The 21 tables by name. A table is built on first use, so an unused one costs nothing."""

    def __init__(
        self,
        spark: SparkSession,
        makers: Mapping[str, Callable[[], DataFrame]],
        extra: Mapping[str, Callable[[], DataFrame]] | None = None,
        lots: Mapping[str, Lots] | None = None,
    ):
        """`extra` holds parameter tables (list prices, targets) that are not part of the schema; `lots` the
        stored tables that are read by month."""
        self.spark = spark
        self._lots = dict(lots or {})
        self._names = list(makers)
        self._makers = {**makers, **(extra or {})}
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in self._makers:
                raise KeyError(f"table {name} is not loaded")
            self._frames[name] = self._makers[name]()
        return self._frames[name]

    def names(self) -> list[str]:
        return list(self._names)

    def between(self, name: str, start: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
        """A dated table cut to `start <= date < before`."""
        rows = self._lots[name].read(start, before) if name in self._lots else self[name]
        return in_window(rows, DATE_COLUMN[name], start, before)

    def months(self, name: str, start: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
        """A table dated by another, cut to the months of a window where it is stored by month. Rows whose
        parent was sent again with another month are kept, whichever month they lie in."""
        if name not in self._lots or (start is None and before is None):
            return in_months(self[name], start, before)
        parent, key = DATE_OF_PARENT[name]
        moved = self._lots[parent].resent(start, before) if parent in self._lots else []
        also = in_ranges(F.col(key), moved) if moved else None
        return in_months(self._lots[name].read(start, before, moved), start, before, also)

    def register_views(self) -> None:
        """Temp views under the table names, for SQL users."""
        for name in self.names():
            self[name].createOrReplaceTempView(name)

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> Tables:
        return cls(spark, {name: (lambda df=df: df) for name, df in frames.items()})

    @classmethod
    def from_parquet(
        cls,
        spark: SparkSession,
        path: str,
        names: Iterable[str] = tuple(TABLE_COLUMNS),
        as_of: dt.date | None = None,
    ) -> Tables:
        """Tables as `load_all` writes them, by the declared schema. With `as_of`, customers, routes and all
        other tables that a load replaces are those known on that day; facts carry days of their own."""
        lots = {n: Lots(spark, f"{path}/{n}", n, as_of) for n in names}
        return cls(spark, {n: lots[n].read for n in lots}, lots=lots)

    @classmethod
    def from_rows(cls, spark: SparkSession, rows: Mapping[str, list[dict]]) -> Tables:
        """Small hand-written tables; columns left out are NULL."""

        def maker(name: str) -> Callable[[], DataFrame]:
            schema = canonical_schema(name)
            data = [tuple(row.get(f.name) for f in schema.fields) for row in rows.get(name, [])]
            return lambda: spark.createDataFrame(data, schema)

        return cls(spark, {name: maker(name) for name in TABLE_COLUMNS})
