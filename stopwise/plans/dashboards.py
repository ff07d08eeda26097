"""Every report of a schedule dashboard, for one network by route or several by tag."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.functions.schedule import DEFAULT_HOUR, hour_before
from stopwise.operators import bitmaps, kpis, selection, summaries
from stopwise.operators.activity import (
    ROWS,
    TRIPS,
    arrivals_of,
    at_hour,
    chosen,
    present,
    tally,
    trips_of,
)
from stopwise.operators.joins import attach_stops
from stopwise.operators.ranking import MAP_ROWS, TOP_STOPS, busiest, exact_sample
from stopwise.scratch import release_scratch, scratch_dir
from stopwise.sinks.tables import batch_done, finish_replacing, replace_partitions, write_table
from stopwise.sources.feeds import TAG
from stopwise.sources.tables import read_table

MAP_COLUMNS = ("stop_name", "stop_lat", "stop_lon")


@dataclass(frozen=True)
class Layout:
    """What tells the two dashboards apart."""

    by: str
    noun: str
    map_keys: tuple[str, ...]
    rank_keys: tuple[str, ...]
    stop_join: str
    distinct: dict[str, str]
    tally_keys: tuple[str, ...]
    stop_keys: tuple[str, ...] = ("stop_id",)


BY_ROUTE = Layout(
    by="route_id",
    noun="subway routes",
    map_keys=("stop_id", "route_id", "route_color"),
    rank_keys=("stop_id",),
    stop_join="left",
    distinct={"unique_stops": "stop_id", "directions": "direction_id"},
    tally_keys=("hour", "stop_id", "route_id", "direction_id", "route_color"),
)

BY_BOROUGH = Layout(
    by=TAG,
    noun="regions",
    map_keys=("stop_id", TAG, "route_id"),
    rank_keys=("stop_id", TAG),
    stop_join="inner",
    distinct={"unique_routes": "route_id", "unique_stops": "stop_id"},
    tally_keys=("hour", "stop_id", "route_id", TAG),
)


@dataclass(frozen=True)
class Dashboard:
    """Reports over ``arrivals``, which may be single rows or the result of ``digest``."""

    stops: DataFrame
    arrivals: DataFrame
    layout: Layout
    tags: tuple[str, ...] | None = None

    @property
    def spark(self) -> SparkSession:
        return self.arrivals.sparkSession

    def digest(self) -> DataFrame:
        """The arrivals counted to the keys any report needs."""
        return tally(self.arrivals, *self.layout.tally_keys)

    def stored(self, path: str) -> Dashboard:
        """The same reports over a stored digest, partitioned by hour, sorted by selector.

        The schedule is read and joined once, here. Each report then reads the digest, the
        hourly ones only their one or two partitions of it, and of those the row groups that
        may hold selected values.
        """
        digest = write_table(
            self.digest(), path, partition_cols=["hour"], sort_cols=[self.layout.by]
        )
        return replace(self, arrivals=digest)

    def merged_into(self, path: str, once: tuple[str, int] | None = None) -> Dashboard:
        """Add these arrivals to the digest that ``stored`` wrote, and read reports from there.

        New arrivals are counted alone and merged with the stored counts of the hours they fall
        into; the partitions of those hours are replaced, and the rest is neither read nor
        written. With ``once``, a stream and an ascending batch number, a batch that is merged
        again changes nothing, even if the first attempt died halfway.
        """
        spark, keys = self.spark, self.layout.tally_keys
        finish_replacing(spark, path)
        if not (once and batch_done(spark, path, *once)):
            place = scratch_dir(spark, "digest-delta")
            self.digest().write.parquet(place)
            delta = spark.read.parquet(place)
            both = _same_hours(read_table(spark, path), delta).unionByName(delta)
            whole = both.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in (ROWS, TRIPS)])
            replace_partitions(whole, path, sort_cols=[self.layout.by], once=once)
            release_scratch(spark, [place])
        return replace(self, arrivals=read_table(spark, path))

    def indexed(self, path: str) -> DistinctIndex:
        """Bitmaps of what the reports count distinctly, per hour and selector value, stored."""
        index = DistinctIndex(self.spark, path, self.layout)
        index.build(self)
        return index

    def domain(self) -> DataFrame:
        """What can be selected: the feeds' tags in their own order, or all routes, sorted."""
        if self.tags is not None:
            return selection.listed_values(self.spark, self.tags, self.layout.by)
        return selection.distinct_values(self.arrivals, self.layout.by)

    def status(self, selected: Sequence[str] | None = None) -> DataFrame:
        if selected is None and self.tags is not None:
            selected = self.tags
        if selected is None:
            return selection.full_selection_status(
                self.arrivals, self.layout.by, self.layout.noun
            )
        return selection.selection_status(self.spark, selected, self.layout.noun)

    def summary(self, selected: Sequence[str] | None = None) -> DataFrame:
        return summaries.summary(self.arrivals, self.layout.by, self.layout.distinct, selected)

    def trend(self, selected: Sequence[str] | None = None) -> DataFrame:
        return summaries.hourly_trend(self.arrivals, self.layout.by, selected)

    def density(self, hour: int = DEFAULT_HOUR, selected: Sequence[str] | None = None) -> DataFrame:
        """Arrivals of one hour per stop and route, with the place of the stop."""
        layout = self.layout
        counts = summaries.stop_counts(
            self.arrivals, layout.map_keys, "stop_count", hour, layout.by, selected
        )
        return attach_stops(counts, self.stops, MAP_COLUMNS, layout.stop_join, layout.stop_keys)

    def city_map(
        self,
        hour: int = DEFAULT_HOUR,
        selected: Sequence[str] | None = None,
        rows: int = MAP_ROWS,
        seed: int = 42,
    ) -> DataFrame:
        """``density``, thinned to an exact random ``rows`` points."""
        layout = self.layout
        counts = summaries.stop_counts(
            self.arrivals, layout.map_keys, "stop_count", hour, layout.by, selected
        )
        return self._named(
            counts,
            MAP_COLUMNS,
            lambda df, ties, many: exact_sample(
                df, rows, layout.map_keys, seed, prefilter=many, ties=ties
            ),
        )

    def top_stops(
        self, hour: int = DEFAULT_HOUR, selected: Sequence[str] | None = None, rows: int = TOP_STOPS
    ) -> DataFrame:
        """The busiest stops of one hour."""
        layout = self.layout
        counts = summaries.stop_counts(
            self.arrivals, layout.rank_keys, "arrivals", hour, layout.by, selected
        )
        return self._named(
            counts,
            ["stop_name"],
            lambda df, ties, _: busiest(df, "arrivals", [*layout.rank_keys, *ties], rows),
        )

    def _named(
        self,
        counts: DataFrame,
        columns: Sequence[str],
        narrow: Callable[[DataFrame, Sequence[str], bool], DataFrame],
    ) -> DataFrame:
        """The few rows ``narrow`` keeps of ``counts`` joined to the stops.

        A left join gives each count a row or more, so the rows kept in the end come from
        the counts kept before it: narrowing first leaves the join a handful of rows. An
        inner join can lose counts, so there narrowing waits. ``narrow`` is told whether
        its rows may be many.
        """
        layout = self.layout
        first = layout.stop_join == "left"
        if first:
            counts = narrow(counts, (), True)
        named = attach_stops(counts, self.stops, columns, layout.stop_join, layout.stop_keys)
        return narrow(named, columns, not first)

    def kpi(self, hour: int = DEFAULT_HOUR, selected: Sequence[str] | None = None) -> DataFrame:
        return kpis.hour_kpi(self.arrivals, hour, self.layout.by, selected)

    def kpi_day(self, selected: Sequence[str] | None = None) -> DataFrame:
        return kpis.hour_kpi_all(self.arrivals, self.layout.by, selected)

    def kpi_table(
        self, hour: int = DEFAULT_HOUR, selected: Sequence[str] | None = None
    ) -> DataFrame:
        return kpis.kpi_table(self.kpi(hour, selected))


def _same_hours(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """The stored rows of the hours that ``delta`` has: a handful, so the scan prunes to them."""
    hours = [row.hour for row in delta.select("hour").distinct().collect()]
    known = F.col("hour").isin([hour for hour in hours if hour is not None])
    return stored.filter(known | F.col("hour").isNull() if None in hours else known)


@dataclass(frozen=True)
class DistinctIndex:
    """Stored bitmaps that answer the reports with distinct counts, whatever is selected.

    ``path`` holds the bitmaps, partitioned by hour, and beside them a table of numbers for each
    counted column. Batches are merged in like into a digest: only their hours are replaced.
    """

    spark: SparkSession
    path: str
    layout: Layout

    @property
    def columns(self) -> list[str]:
        return sorted({"route_id", "stop_id", *self.layout.distinct.values()})

    def _numbers_path(self, column: str) -> str:
        return f"{self.path.rstrip('/')}__numbers_{column}"

    def _numbers(self) -> dict[str, DataFrame]:
        return {c: read_table(self.spark, self._numbers_path(c)) for c in self.columns}

    def _maps(self, arrivals: DataFrame) -> DataFrame:
        """Bitmaps of arrivals; their values have numbers by now."""
        sums = {ROWS: arrivals_of(arrivals), TRIPS: trips_of(arrivals)}
        return bitmaps.bitmaps(
            present(arrivals, self.layout.by), ["hour", self.layout.by], self._numbers(), sums
        )

    def build(self, dashboard: Dashboard) -> None:
        for column in self.columns:
            fresh = bitmaps.numbered(dashboard.arrivals.select(column))
            write_table(fresh, self._numbers_path(column))
        write_table(
            self._maps(dashboard.arrivals), self.path, partition_cols=["hour"],
            sort_cols=[self.layout.by],
        )

    def merge(self, dashboard: Dashboard, once: tuple[str, int] | None = None) -> None:
        """Add the arrivals of ``dashboard``. Bits that are set again stay set, but arrivals are
        added up: pass ``once`` where a batch may be repeated."""
        finish_replacing(self.spark, self.path)
        if once and batch_done(self.spark, self.path, *once):
            return
        for column in self.columns:
            known = read_table(self.spark, self._numbers_path(column))
            fresh = bitmaps.numbered(dashboard.arrivals.select(column), known)
            write_table(fresh, self._numbers_path(column), mode="append")
        place = scratch_dir(self.spark, "index-delta")
        self._maps(dashboard.arrivals).write.parquet(place)
        delta = self.spark.read.parquet(place)
        both = _same_hours(read_table(self.spark, self.path), delta).unionByName(delta)
        whole = bitmaps.merged(both, ["hour", self.layout.by], [ROWS, TRIPS])
        replace_partitions(whole, self.path, sort_cols=[self.layout.by], once=once)
        release_scratch(self.spark, [place])

    def _selected(self, selected: Sequence[str] | None) -> DataFrame:
        return chosen(read_table(self.spark, self.path), self.layout.by, selected)

    def summary(self, selected: Sequence[str] | None = None) -> DataFrame:
        """``Dashboard.summary`` from the bitmaps of the selected values."""
        found = bitmaps.counted(
            self._selected(selected), [self.layout.by], self.layout.distinct, [TRIPS]
        )
        names = [F.col(name) for name in self.layout.distinct]
        return found.select(self.layout.by, F.col(TRIPS).alias("total_arrivals"), *names)

    def hourly(self, selected: Sequence[str] | None = None) -> DataFrame:
        """Arrivals, distinct routes and distinct stops per hour of the selection."""
        found = bitmaps.counted(
            self._selected(selected), ["hour"], {"routes": "route_id", "stops": "stop_id"}, [ROWS]
        )
        return found.select("hour", F.col(ROWS).alias("arrivals"), "routes", "stops")

    def kpi(self, hour: int = DEFAULT_HOUR, selected: Sequence[str] | None = None) -> DataFrame:
        return kpis.compared(at_hour(self.hourly(selected), hour, hour_before(hour)), hour)

    def kpi_day(self, selected: Sequence[str] | None = None) -> DataFrame:
        return kpis.compared_all(self.hourly(selected))


def route_dashboard(stops: DataFrame, arrivals: DataFrame) -> Dashboard:
    return Dashboard(stops, arrivals, BY_ROUTE)


def borough_dashboard(
    stops: DataFrame, arrivals: DataFrame, tags: Sequence[str] | None = None
) -> Dashboard:
    """``tags``, as ``load_feeds`` returns them, spare the domain and the default status a scan."""
    return Dashboard(stops, arrivals, BY_BOROUGH, None if tags is None else tuple(tags))
