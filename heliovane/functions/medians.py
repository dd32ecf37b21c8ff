"""Exact medians of many columns without gathering a column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Distinct values of one column that the last, windowed step may hold.
WINDOW_VALUES = 1_000_000
_MARGIN = 0.0005
_ACCURACY = 10_000


def _narrow(df: DataFrame, inside: dict, margin: float) -> dict:
    """Value bracket around the wanted ranks of each column, from mergeable sketches."""
    asks = []
    for c, s in inside.items():
        middle = (s["target"] + 0.5) / s["rows"]
        points = [max(0.0, middle - margin), min(1.0, middle + margin)]
        values = F.when(F.col(c).between(s["lo"], s["hi"]), F.col(c))
        asks.append(F.percentile_approx(values, points, _ACCURACY).alias(c))
    brackets = df.agg(*asks).first()
    sides = []
    for c in inside:
        lo, hi = brackets[c]
        kept = F.col(c).between(inside[c]["lo"], inside[c]["hi"])
        sides.append(F.count_if(kept & (F.col(c) < lo)).alias(f"below_{c}"))
        sides.append(F.count_if(F.col(c).between(lo, hi)).alias(f"rows_{c}"))
    counts = df.agg(*sides).first()
    out = {}
    for c, s in inside.items():
        below, rows = counts[f"below_{c}"], counts[f"rows_{c}"]
        # The sketch may miss by its error; keep the old bracket on a miss.
        hit = below <= s["target"] and s["target"] + s["width"] < below + rows
        out[c] = (
            {**s, "lo": brackets[c][0], "hi": brackets[c][1], "rows": rows, "target": s["target"] - below}
            if hit
            else s
        )
    return out


def column_ranges(df: DataFrame, columns: Sequence[str]) -> dict:
    """(number of values, smallest, largest) per column."""
    row = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.min(c).alias(f"lo_{c}") for c in columns],
        *[F.max(c).alias(f"hi_{c}") for c in columns],
    ).first()
    return {c: (row[f"n_{c}"], row[f"lo_{c}"], row[f"hi_{c}"]) for c in columns}


def _few_values(df: DataFrame, column: str, bracket: dict) -> bool:
    """Whether few different values are left inside the bracket, however many rows they have."""
    inside = df.where(F.col(column).between(bracket["lo"], bracket["hi"])).select(column).distinct()
    return inside.limit(WINDOW_VALUES + 1).count() <= WINDOW_VALUES


def exact_medians(
    df: DataFrame, columns: Sequence[str], ranges: dict | None = None, window_values: int = WINDOW_VALUES
) -> dict:
    """Median per column, NULLs skipped; None for a column without values.

    Brackets around the middle rank are narrowed about a thousandfold per pass with
    approximate quantiles and exact counts, until few distinct values are left;
    those are ranked with their multiplicities.  The result is exact.
    """
    ranges = column_ranges(df, columns) if ranges is None else ranges
    state = {}
    for c in columns:
        n, lo, hi = ranges[c]
        if n:
            # Ranks target .. target + width (0-based) average to the median.
            state[c] = {"lo": lo, "hi": hi, "rows": n, "target": (n - 1) // 2, "width": 0 if n % 2 else 1}
    medians: dict = {c: None for c in columns}
    wide = {c: s for c, s in state.items() if s["rows"] > window_values and s["lo"] < s["hi"]}
    margin = _MARGIN
    while wide:
        narrowed, before = _narrow(df, wide, margin), {c: s["rows"] for c, s in wide.items()}
        state.update(narrowed)
        # Where no bracket shrank, the sketch missed or its ends are heavy: ask for a wider pair, then for a tighter one.
        shrank = any(s["rows"] < before[c] for c, s in narrowed.items())
        margin = _MARGIN if shrank else margin * 4 if margin < 0.1 else _MARGIN / 7
        wide = {c: s for c, s in narrowed.items() if s["rows"] > window_values and s["lo"] < s["hi"] and not (s["rows"] == before[c] and _few_values(df, c, s))}
    if not state:
        return medians

    names = list(state)
    kept = F.array(
        *[
            F.struct(
                F.lit(c).alias("name"),
                F.when(F.col(c).between(state[c]["lo"], state[c]["hi"]), F.col(c)).alias("value"),
            )
            for c in names
        ]
    )
    counted = (
        df.select(F.inline(kept)).where("value IS NOT NULL").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("last_rank", F.sum("n").over(upto) - 1).withColumn(
        "first_rank", F.col("last_rank") - F.col("n") + 1
    )

    def at(name: str, rank: int):
        held = (F.col("name") == name) & F.lit(rank).between(F.col("first_rank"), F.col("last_rank"))
        return F.max(F.when(held, F.col("value")))

    middles = []
    for c in names:
        low, high = state[c]["target"], state[c]["target"] + state[c]["width"]
        middles.append(((at(c, low) + at(c, high)) / 2).alias(c))
    found = ranked.agg(*middles).first()
    medians.update({c: found[c] for c in names})
    return medians
