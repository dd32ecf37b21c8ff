"""Cluster quality: Davies-Bouldin, adjusted Rand, k sweep, gates, report text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.operators.features import fit_scaling
from heliovane.operators.silhouette import silhouette
from heliovane.operators.sweep import fit_settings
from heliovane.schema import (
    DAVIES_BOULDIN_THRESHOLD,
    DEFAULT_SEED,
    SILHOUETTE_THRESHOLD,
    STABILITY_THRESHOLD,
)
from heliovane.session import cleared, settle

# About how many labels of one labelling are compared with a label in one row.
LABELS = 4096


def _long(df: DataFrame, features: Sequence[str], labellings: Sequence[str]) -> DataFrame:
    """One row per point and labelling; aggregated before it is ever shuffled."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("labelling"), F.col(c).cast("bigint").alias("label")) for c in labellings]
    )
    return df.select(*features, F.inline(pairs))


def davies_bouldin(df: DataFrame, features: Sequence[str], labellings: Sequence[str], at_once: int = LABELS) -> DataFrame:
    """Davies-Bouldin index per labelling; 0 if all spreads or all separations are 0.

    Two passes over the points (means, then mean distance to the own mean), both
    with map-side combining.  The label means are joined to the points, Spark choosing
    how by their size.  The one-row-per-label table is written; each label is then
    compared in place with arrays of about ``at_once`` labels of its labelling, so no
    row holds them all.  Points without a label are left out, as the silhouette does.
    """
    table = _long(df, features, labellings).where("label IS NOT NULL")
    means = table.groupBy("labelling", "label").agg(F.struct(*[F.avg(f).alias(f) for f in features]).alias("mean"))

    def gap(a: Column, b: Column) -> Column:
        return F.sqrt(reduce(lambda x, y: x + y, [(a[f] - b[f]) * (a[f] - b[f]) for f in features]))

    own = F.struct(*[F.col(f) for f in features])
    spread = settle(
        table.join(means, ["labelling", "label"])
        .withColumn("_d", gap(own, F.col("mean")))
        .groupBy("labelling", "label")
        .agg(F.first("mean").alias("mean"), F.avg("_d").alias("s"))
    )
    sizes = spread.groupBy("labelling").agg(F.ceil(F.count(F.lit(1)) / at_once).cast("int").alias("_blocks"))
    dealt = spread.join(sizes, "labelling").select("labelling", "_blocks", F.struct("label", "mean", "s").alias("one"))
    block = F.pmod(F.xxhash64("one.label"), F.col("_blocks")).cast("int")
    blocks = dealt.groupBy("labelling", block.alias("_block")).agg(F.collect_list("one").alias("others"))
    each = dealt.select("labelling", "one", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))

    def ratio(one: Column, two: Column) -> Column:
        apart = gap(one["mean"], two["mean"])
        return F.when((one["label"] == two["label"]) | (apart == 0), F.lit(0.0)).otherwise(
            (one["s"] + two["s"]) / apart
        )

    met = each.join(blocks, ["labelling", "_block"])
    worst = F.array_max(F.transform("others", lambda two: ratio(F.col("one"), two)))
    by_label = met.groupBy("labelling", "one.label").agg(F.max(worst).alias("worst"))
    value = F.when(F.count(F.lit(1)) > 1, F.avg("worst"))
    return by_label.groupBy("labelling").agg(value.alias("davies_bouldin"))


def label_counts(df: DataFrame, labellings: Sequence[str]) -> DataFrame:
    """Number of labels in use per labelling."""
    used = _long(df, (), labellings).groupBy("labelling", "label").agg(F.count(F.lit(1)).alias("n"))
    return used.groupBy("labelling").agg(F.count(F.lit(1)).alias("n_labels"))


def adjusted_rand(df: DataFrame, labellings: Sequence[str]) -> DataFrame:
    """Adjusted Rand index of every pair of labelling columns of one table.

    A point carries all its labels, so a pair is two columns of the same row: no
    self-join.  The contingency counts combine before they are shuffled; from there on
    there is one row per pair of labels.
    """
    names = list(labellings)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    if not pairs:
        raise ValueError("adjusted_rand needs at least two labellings")
    listed = F.array(
        *[
            F.struct(
                F.lit(a).alias("run_a"),
                F.lit(b).alias("run_b"),
                F.col(a).cast("bigint").alias("label_a"),
                F.col(b).cast("bigint").alias("label_b"),
            )
            for a, b in pairs
        ]
    )
    cells = (
        df.select(F.inline(listed))
        .groupBy("run_a", "run_b", "label_a", "label_b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    keys, rows, columns = ["run_a", "run_b"], "label_a", "label_b"
    # Cells, row totals and column totals in one go; grouping_id tells them apart.
    totals = cells.groupingSets([[*keys, rows, columns], [*keys, rows], [*keys, columns]], *keys, rows, columns).agg(
        F.sum("n").alias("n"), F.grouping_id().alias("kind")
    )

    def pairs_within(kind: int) -> Column:
        return F.sum(F.when(F.col("kind") == kind, _choose2(F.col("n"))))

    sums = totals.groupBy(*keys).agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("n"),
        pairs_within(0).alias("index"),
        pairs_within(1).alias("a"),
        pairs_within(2).alias("b"),
    )
    expected = F.try_divide(F.col("a") * F.col("b"), _choose2(F.col("n")))
    room = (F.col("a") + F.col("b")) / 2 - expected
    value = F.when(room.isNull() | (room == 0), F.lit(1.0)).otherwise((F.col("index") - expected) / room)
    return sums.select(*keys, value.alias("ari"))


def _choose2(n: Column) -> Column:
    n = n.cast("double")
    return n * (n - 1) / 2


def stability(pairs: DataFrame) -> DataFrame:
    """Mean and population deviation of the pairwise indices."""
    return pairs.agg(F.avg("ari").alias("ari_mean"), F.stddev_pop("ari").alias("ari_std"))


def valid_k(candidates: DataFrame, n_points: int) -> DataFrame:
    """Candidate k values with the verdict 2 <= k < number of points."""
    verdict = (F.col("k") >= 2) & (F.col("k") < n_points)
    n = F.lit(n_points).cast("bigint")
    return candidates.select("k").distinct().select("k", n.alias("n_points"), verdict.alias("is_valid"))


def skipped_note(skipped: Sequence[int], n_points: int) -> str | None:
    # Fixed value: wording of the note.
    return f"Se omitieron K={sorted(set(skipped))} por ser >= al numero de puntos ({n_points})." if skipped else None


def single_cluster_note(k: Column) -> Column:
    # Fixed value: wording of the note.
    return F.concat(F.lit("K="), k.cast("string"), F.lit(" produjo un unico cluster; se omite de silhouette/DB."))


def recommended_k(quality: DataFrame) -> DataFrame:
    """The k with the largest silhouette; the first listed (``position``) on ties."""
    known = quality.where(F.col("silhouette").isNotNull() & ~F.isnan("silhouette"))
    best = F.max_by(F.struct("k", "silhouette", "davies_bouldin"), F.struct("silhouette", -F.col("position")))
    return known.agg(best.alias("b")).select(
        F.col("b.k").alias("recommended_k"),
        F.col("b.silhouette").alias("silhouette"),
        F.col("b.davies_bouldin").alias("davies_bouldin"),
    )


def quality_gates(
    summary: DataFrame,
    silhouette_threshold: float = SILHOUETTE_THRESHOLD,
    davies_bouldin_threshold: float = DAVIES_BOULDIN_THRESHOLD,
    stability_threshold: float = STABILITY_THRESHOLD,
) -> DataFrame:
    """Pass flags; stability is NULL where it was not measured and then does not count."""
    flags = summary.withColumns(
        {
            "passes_silhouette": F.col("silhouette") >= silhouette_threshold,
            "passes_davies_bouldin": F.col("davies_bouldin") < davies_bouldin_threshold,
            "passes_stability": F.col("ari_mean") >= stability_threshold,
        }
    )
    steady = F.coalesce("passes_stability", F.lit(True))
    return flags.withColumn("passes_all", F.col("passes_silhouette") & F.col("passes_davies_bouldin") & steady)


def three_decimals(value: Column) -> Column:
    """The number itself, not its shortest text, rounded to three decimals; halves to the even digit.

    The part after the point is taken as an exact count of 2**-63 (parts too small for
    that are far below 0.0005 and round to zero), so the rounding is integer arithmetic.
    """
    size = F.abs(value)
    whole = F.floor(size)
    unit = F.lit("9223372036854775808").cast("decimal(20,0)")
    parts = ((size - whole) * F.lit(2.0**62) * 2.0).cast("long").cast("decimal(20,0)") * F.lit(1000).cast("decimal(4,0)")
    down = F.floor(parts / unit).cast("long")
    down = F.when(down.cast("decimal(20,0)") * unit > parts, down - 1).otherwise(down)
    twice = (parts - down.cast("decimal(4,0)") * unit) * F.lit(2).cast("decimal(1,0)")
    up = (twice > unit) | ((twice == unit) & (down % 2 == 1))
    thousandths = whole.cast("long") * 1000 + down + up.cast("long")
    sign = F.when(value < 0, "-").otherwise("")
    return F.concat(sign, F.floor(thousandths / 1000).cast("string"), F.lit("."), F.lpad((thousandths % 1000).cast("string"), 3, "0"))


def quality_text(
    gates: DataFrame,
    silhouette_threshold: float = SILHOUETTE_THRESHOLD,
    davies_bouldin_threshold: float = DAVIES_BOULDIN_THRESHOLD,
    stability_threshold: float = STABILITY_THRESHOLD,
    out: str = "report",
) -> DataFrame:
    """The report as text, one line per finding, with the notes at the end."""

    # Wording of the report.
    def verdict(flag: str) -> Column:
        return F.when(F.col(flag), "PASA").otherwise("NO PASA")

    k = F.col("recommended_k").cast("string")
    lines = [
        F.concat(F.lit("K recomendado: "), k),
        F.concat(
            F.lit("Silhouette("), k, F.lit(") = "), three_decimals(F.col("silhouette")), F.lit(" ("), verdict("passes_silhouette"),
            F.lit(f", umbral >= {silhouette_threshold})"),
        ),
        F.concat(
            F.lit("Davies-Bouldin("), k, F.lit(") = "), three_decimals(F.col("davies_bouldin")), F.lit(" ("),
            verdict("passes_davies_bouldin"), F.lit(f", umbral < {davies_bouldin_threshold})"),
        ),
        F.when(
            F.col("ari_mean").isNotNull(),
            F.concat(
                F.lit("Estabilidad (ARI promedio de "), F.col("stability_runs").cast("string"), F.lit(" corridas) = "),
                three_decimals(F.col("ari_mean")), F.lit(" +/- "), three_decimals(F.col("ari_std")), F.lit(" ("), verdict("passes_stability"),
                F.lit(f", umbral >= {stability_threshold})"),
            ),
        ),
        F.array_join(F.transform("notes", lambda note: F.concat(F.lit("Nota: "), note)), "\n"),
    ]
    # An empty notes list must not leave an empty last line.
    lines[-1] = F.nullif(lines[-1], F.lit(""))
    return gates.withColumn(out, F.concat_ws("\n", *lines))


def _point_table(df: DataFrame, id_col: str, features: Sequence[str]) -> DataFrame:
    """The ids and features as a written table; one that is just that already is not written again."""
    wanted = [id_col, *features]
    return df if hasattr(df, "settled_at") and df.columns == wanted else settle(df.select(*wanted))


def fit_label_columns(
    plain: DataFrame, features: Sequence[str], settings: Sequence[tuple[int, int]], n_init: int = 1
) -> tuple[DataFrame, list[str], list]:
    """Scaled features with one label column per (k, seed), and the fitted models.

    ``plain`` is a written table; its scaled form is written once more, and all fits
    advance together over one scan of that in each round.
    """
    scaling = fit_scaling(plain, features)
    scaled = settle(scaling.standardize(plain))
    models = fit_settings(scaled, scaling, settings, n_init)
    names = [f"k{k}_seed{seed}" for k, seed in settings]
    labelled = scaled.withColumns({name: model.label_column() for name, model in zip(names, models)})
    return settle(labelled), names, models


def quality_by_k(
    df: DataFrame,
    features: Sequence[str],
    k_values: Sequence[int] = tuple(range(2, 11)),
    seed: int = DEFAULT_SEED,
    id_col: str = "point_id",
    n_init: int = 1,
) -> DataFrame:
    """Inertia, silhouette and Davies-Bouldin for each valid k, same seed for each.

    All fits read one written table, and each metric is one job for all k.  Only the
    result stays of the tables written on the way.
    """
    with cleared() as kept:
        result = settle(_quality_by_k(_point_table(df, id_col, features), features, k_values, seed, id_col, n_init))
        kept.append(result)
        return result


def _quality_by_k(plain: DataFrame, features: Sequence[str], k_values: Sequence[int], seed: int, id_col: str, n_init: int) -> DataFrame:
    spark = plain.sparkSession
    n_points = plain.count()
    valid = [k for k in k_values if 2 <= k < n_points]
    if not valid:
        raise ValueError("no valid k value for this number of points")
    table, names, models = fit_label_columns(plain, features, [(k, seed) for k in valid], n_init)
    fits = spark.createDataFrame(
        [(name, i, k, m.inertia) for i, (name, k, m) in enumerate(zip(names, valid, models))],
        "labelling STRING, position INT, k INT, inertia DOUBLE",
    )
    scores = (
        label_counts(table, names)
        .join(silhouette(table, features, names, id_col), "labelling")
        .join(davies_bouldin(table, features, names), "labelling")
    )
    several = F.col("n_labels") > 1
    return fits.join(scores, "labelling").select(
        "position",
        "k",
        "inertia",
        F.when(several, F.col("silhouette")).alias("silhouette"),
        F.when(several, F.col("davies_bouldin")).alias("davies_bouldin"),
        "n_labels",
        F.when(~several, single_cluster_note(F.col("k"))).alias("note"),
    )


def evaluate_stability(
    df: DataFrame,
    features: Sequence[str],
    k: int,
    n_runs: int = 10,
    base_seed: int = 0,
    id_col: str = "point_id",
) -> DataFrame:
    """Mean and deviation of the adjusted Rand index over runs with different seeds."""
    with cleared() as kept:
        plain = _point_table(df, id_col, features)
        table, names, _ = fit_label_columns(plain, features, [(k, base_seed + i) for i in range(n_runs)])
        result = settle(stability(adjusted_rand(table, names)))
        kept.append(result)
        return result


def evaluate_k_range(
    df: DataFrame,
    features: Sequence[str],
    k_values: Sequence[int] = tuple(range(2, 11)),
    seed: int = DEFAULT_SEED,
    stability_runs: int = 0,
    silhouette_threshold: float = SILHOUETTE_THRESHOLD,
    davies_bouldin_threshold: float = DAVIES_BOULDIN_THRESHOLD,
    stability_threshold: float = STABILITY_THRESHOLD,
    id_col: str = "point_id",
    n_init: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """(quality by k, one-row report with the recommended k, gates, notes and text).

    Of the tables written on the way only the first result's stays.
    """
    spark = df.sparkSession
    with cleared() as kept:
        df = _point_table(df, id_col, features)
        n_points = df.count()
        by_k = quality_by_k(df, features, k_values, seed, id_col, n_init)
        best = recommended_k(by_k).first()
        if best["recommended_k"] is None:
            raise ValueError("no k value has a silhouette")
        notes = [skipped_note([k for k in k_values if not 2 <= k < n_points], n_points)]
        notes += [row["note"] for row in by_k.where("note IS NOT NULL").orderBy("position").select("note").collect()]
        ari = (None, None)
        if stability_runs > 1:
            ari = tuple(evaluate_stability(df, features, best["recommended_k"], stability_runs, 0, id_col).first())
        kept.append(by_k)
    report = spark.createDataFrame(
        [
            (
                best["recommended_k"],
                best["silhouette"],
                best["davies_bouldin"],
                *ari,
                stability_runs if ari[0] is not None else 0,
                [n for n in notes if n],
            )
        ],
        "recommended_k INT, silhouette DOUBLE, davies_bouldin DOUBLE, ari_mean DOUBLE, ari_std DOUBLE, "
        "stability_runs INT, notes ARRAY<STRING>",
    )
    limits = (silhouette_threshold, davies_bouldin_threshold, stability_threshold)
    return by_k, quality_text(quality_gates(report, *limits), *limits)
