"""User functions over the series of each point."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
import pickle

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_per_point(
    observations: DataFrame,
    start: Callable[[], object],
    step: Callable[[object, pd.DataFrame], object],
    finish: Callable[[object], dict],
    schema: str,
    order: Sequence[str] = ("date",),
    key: str = "point_id",
) -> DataFrame:
    """Any function of a point's series in date order, given as a fold.

    The rows of a point reach ``step`` in order and in pieces, with the state that the
    piece before left; ``finish`` turns the last state into the point's values.  A task
    streams its points one after the other and holds one piece and one state, so the
    length of a series has no limit.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        point, state, begun = None, None, False
        for batch in batches:
            done = []
            for now, rows in batch.groupby(key, sort=False, dropna=False):
                now = None if pd.isna(now) else int(now)
                if begun and now != point:
                    done.append({key: point, **finish(state)})
                    begun = False
                if not begun:
                    point, state, begun = now, start(), True
                state = step(state, rows)
            if done:
                yield pd.DataFrame(done)
        if begun:
            yield pd.DataFrame([{key: point, **finish(state)}])

    return observations.repartition(key).sortWithinPartitions(key, *order).mapInPandas(run, f"{key} bigint, {schema}")


def fold_ranges(
    observations: DataFrame,
    start: Callable[[], object],
    step: Callable[[object, pd.DataFrame], object],
    order: Sequence[str] = ("date",),
    key: str = "point_id",
    ranges: int | None = None,
) -> DataFrame:
    """(key, range_no, n_rows, state): each point's series cut into ranges, each folded on its own.

    Rows are dealt by ranges of (key, order), so a point that owns much of the table spreads over
    many tasks, and the ranges of a point follow each other in the order of their numbers.
    Rows with equal key and order stay together.  A state must be picklable.
    """
    parts = ranges or int(observations.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, point, state, rows, begun = TaskContext.get().partitionId(), None, None, 0, False

        def folded() -> dict:
            return {key: point, "range_no": part, "n_rows": rows, "state": pickle.dumps(state)}

        for batch in batches:
            done = []
            for now, piece in batch.groupby(key, sort=False, dropna=False):
                now = None if pd.isna(now) else int(now)
                if begun and now != point:
                    done.append(folded())
                    begun = False
                if not begun:
                    point, state, rows, begun = now, start(), 0, True
                state, rows = step(state, piece), rows + len(piece)
            if done:
                yield pd.DataFrame(done)
        if begun:
            yield pd.DataFrame([folded()])

    cut = observations.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order)
    return cut.mapInPandas(run, f"{key} bigint, range_no int, n_rows bigint, state binary")


def merge_ranges(partial: DataFrame, merge: Callable[[object, object], object], finish: Callable[[object], dict], schema: str, key: str = "point_id") -> DataFrame:
    """The values of each point from the states of its ranges, merged in their order.

    A point has at most one state in each range, so this second step moves few small rows.
    """

    def step(state: list, rows: pd.DataFrame) -> list:
        for one in map(pickle.loads, rows["state"]):
            state = [merge(state[0], one)] if state else [one]
        return state

    return fold_per_point(partial, list, step, lambda state: finish(state[0]), schema, ["range_no"], key)


def merge_per_point(
    observations: DataFrame,
    start: Callable[[], object],
    step: Callable[[object, pd.DataFrame], object],
    merge: Callable[[object, object], object],
    finish: Callable[[object], dict],
    schema: str,
    order: Sequence[str] = ("date",),
    key: str = "point_id",
) -> DataFrame:
    """A fold in date order whose states can be merged: no point's series is one task's work.

    ``merge(earlier, later)`` must give the state that one fold over both ranges would leave.
    """
    return merge_ranges(fold_ranges(observations, start, step, order, key), merge, finish, schema, key)


def combine_per_point(
    observations: DataFrame,
    partial: Callable[[pd.DataFrame], dict],
    partial_schema: str,
    merge: Sequence[Column],
    key: str = "point_id",
) -> DataFrame:
    """A function of a point's series given as partial results plus a Spark merge.

    ``partial`` gets some rows of one point and returns a dictionary of values;
    ``merge`` holds the aggregates over those values.  No point is ever gathered:
    partial results are made batch by batch and merged with map-side combining.
    """

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([{key: point, **partial(rows)} for point, rows in batch.groupby(key)])

    return observations.mapInPandas(pieces, f"{key} bigint, {partial_schema}").groupBy(key).agg(*merge)
