"""Feature analysis: correlation, ANOVA F, importance, scaling, PCA, selection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listlens.operators.counts import variances
from listlens.operators.ordering import first_reaching, top_k_per_group


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Numeric columns as one dense vector column."""
    return df.withColumn(output, array_to_vector(F.array(*[F.col(c).cast("double") for c in columns])))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r for every ordered pair: ``i, j, feature1, feature2, correlation`` (NaN for constants).

    Each pair is correlated over the rows that have both values. Tasks build the sums of all pairs as
    matrix products, centred at the columns' means, and one keyed aggregation adds the tasks up.
    """
    columns = list(columns)
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    ends = values.agg(*[f(f"c{i}") for f in (F.avg, F.min, F.max) for i in range(len(columns))]).head()
    n = len(columns)
    centre = [0.0 if v is None else v for v in ends[:n]]
    constant = [a == b for a, b in zip(ends[n : 2 * n], ends[2 * n :])]

    def sums(batches):
        import numpy as np
        import pandas as pd

        total = np.zeros((6, n, n))
        for pdf in batches:
            x = pdf.to_numpy(dtype=float) - np.array(centre)
            there = ~np.isnan(x)
            x[~there] = 0
            has = there.astype(float)
            total += np.stack([has.T @ has, x.T @ has, has.T @ x, (x * x).T @ has, has.T @ (x * x), x.T @ x])
        i, j = np.divmod(np.arange(n * n), n)
        yield pd.DataFrame({"i": i, "j": j} | {k: m.ravel() for k, m in zip(("n", "x", "y", "xx", "yy", "xy"), total)})

    total = values.mapInPandas(sums, "i int, j int, n double, x double, y double, xx double, yy double, xy double").groupBy("i", "j").agg(
        *[F.sum(k).alias(k) for k in ("n", "x", "y", "xx", "yy", "xy")]
    )
    spread = F.sqrt(F.greatest(F.col("n") * F.col("xx") - F.col("x") * F.col("x"), F.lit(0.0))) * F.sqrt(
        F.greatest(F.col("n") * F.col("yy") - F.col("y") * F.col("y"), F.lit(0.0))
    )
    flat = F.array(*[F.lit(k) for k in constant])
    r = F.try_divide(F.col("n") * F.col("xy") - F.col("x") * F.col("y"), spread)
    names = F.array(*[F.lit(c) for c in columns])
    return total.select(
        "i", "j", F.get(names, F.col("i")).alias("feature1"), F.get(names, F.col("j")).alias("feature2"),
        F.when(F.get(flat, F.col("i")) | F.get(flat, F.col("j")), F.lit(float("nan"))).otherwise(F.coalesce(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)), F.lit(float("nan")))).alias("correlation"),
    )


def correlated_pairs(matrix: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs listed once whose absolute correlation exceeds the threshold; NaN never does."""
    r = F.col("correlation")
    return matrix.where((F.col("i") < F.col("j")) & ~F.isnan(r) & (F.abs(r) > threshold)).select(
        "feature1", "feature2", "correlation"
    )


def redundant_features(pairs: DataFrame) -> DataFrame:
    """The later feature of every correlated pair: what to leave out to break all pairs."""
    return pairs.select(F.col("feature2").alias("feature")).distinct()


def rf_importance(
    df: DataFrame, columns: Sequence[str], label: str, trees: int = 100, seed: int = 42
) -> DataFrame:
    """``feature, rf_importance`` of a random forest."""
    model = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, seed=seed).fit(
        assemble(df, columns).select("features", label)
    )
    rows = [(c, float(v)) for c, v in zip(columns, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, rf_importance double")


def anova_f(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """One-way ANOVA F of each column against the label: ``feature, f_score``.

    One scan and a shuffle of one row per class and task.
    """
    stats = df.groupBy(label).agg(
        *[
            F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.var_pop(c).alias("var")).alias(c)
            for c in columns
        ]
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("s")) for c in columns])
    long = stats.select(F.inline(pairs)).select("feature", "s.*").where(F.col("n") > 0)
    # From here on: features x classes rows.
    w = Window.partitionBy("feature")
    grand = F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w)
    sums = (
        long.withColumn("grand", grand)
        .groupBy("feature")
        .agg(
            F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)).alias("between"),
            F.sum(F.col("n") * F.col("var")).alias("within"),
            F.count(F.lit(1)).alias("k"),
            F.sum("n").alias("n"),
        )
    )
    f = F.try_divide(
        F.try_divide(F.col("between"), F.col("k") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("k"))
    )
    return sums.select("feature", f.alias("f_score"))


def combine_scores(scores: DataFrame, a: str, b: str) -> DataFrame:
    """Min-max both score columns, average them, best first. One row per feature, so one small window."""
    everything = Window.partitionBy()

    def scaled(c: str) -> Column:
        lo, hi = F.min(c).over(everything), F.max(c).over(everything)
        return F.try_divide(F.col(c) - lo, hi - lo)

    return (
        scores.withColumn(f"{a}_normalized", scaled(a))
        .withColumn(f"{b}_normalized", scaled(b))
        .withColumn("combined_score", (F.col(f"{a}_normalized") + F.col(f"{b}_normalized")) / 2)
        .orderBy(F.desc("combined_score"), "feature")
    )


def select_by_share(scores: DataFrame, target: float = 0.95, score: str = "combined_score") -> DataFrame:
    """Best features until the running share of the score reaches the target; never fewer than one.

    Kept are all with share <= target, and the next one when the last kept is still below it.
    One row per feature, so one small window.
    """
    w = Window.orderBy(F.desc(score), F.asc("feature"))
    running = F.sum(score).over(w.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(score).over(Window.partitionBy())
    placed = scores.withColumn("cumulative_importance", F.try_divide(running, total)).withColumn(
        "position", F.row_number().over(w)
    )
    before = F.coalesce(F.lag("cumulative_importance").over(w), F.lit(0.0))
    return (
        placed.withColumn("__before", before)
        .where((F.col("cumulative_importance") <= target) | (F.col("__before") < target) | (F.col("position") == 1))
        .drop("__before")
    )


def constant_features(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns without any variance (one summary row is read)."""
    return [r["feature"] for r in variances(df, columns).where(F.col("variance") == 0).collect()]


@dataclass(frozen=True)
class Scaler:
    """Means and population standard deviations learned on training rows."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> Scaler:
        row = df.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
        ).head()
        return cls(
            tuple(columns),
            tuple(float(row[f"m{i}"] or 0.0) for i in range(len(columns))),
            tuple(float(row[f"s{i}"] or 0.0) or 1.0 for i in range(len(columns))),
        )

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                for c, m, s in zip(self.columns, self.means, self.deviations)
            }
        )


@dataclass(frozen=True)
class PcaState:
    """Fitted scaling and rotation; ``kept`` components reach the target variance."""

    scaler: Scaler
    model: PCAModel
    ratios: tuple[float, ...]
    kept: int
    dropped: tuple[str, ...]

    def facts(self, df: DataFrame) -> DataFrame:
        """One row describing the fit, to be stored beside the model."""
        row = [(len(self.ratios), self.kept, float(sum(self.ratios[: self.kept])), list(self.dropped))]
        return df.sparkSession.createDataFrame(
            row, "features int, components int, variance_explained double, zero_variance array<string>"
        )


def fit_pca(
    df: DataFrame, columns: Sequence[str], target: float = 0.95, n_components: int | None = None
) -> PcaState:
    """Standardise, drop constant columns, rotate; the covariance sums are built on the executors."""
    dropped = constant_features(df, columns)
    used = [c for c in columns if c not in dropped]
    scaler = Scaler.fit(df, used)
    model = PCA(k=len(used), inputCol="features", outputCol="pca").fit(
        assemble(scaler.apply(df.select(*used)), used)
    )
    ratios = tuple(float(v) for v in model.explainedVariance.toArray())
    kept, reached = len(ratios), 0.0
    for place, r in enumerate(ratios, 1):
        reached += r
        if reached >= target:
            kept = place
            break
    return PcaState(scaler, model, ratios, n_components or kept, tuple(dropped))


def explained_variance(df: DataFrame, state: PcaState) -> DataFrame:
    """``position, ratio, cum_share`` per component."""
    rows, reached = [], 0.0
    for place, r in enumerate(state.ratios, 1):
        reached += r
        rows.append((place, r, reached))
    return df.sparkSession.createDataFrame(rows, "position int, ratio double, cum_share double")


def apply_pca(df: DataFrame, state: PcaState, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns plus ``PC1..PCk``."""
    columns = list(state.scaler.columns)
    renamed = df.select(*[F.col(c).alias(f"__keep_{c}") for c in keep], *columns)
    rotated = state.model.transform(assemble(state.scaler.apply(renamed), columns))
    values = rotated.withColumn("__pc", vector_to_array("pca"))
    return values.select(
        *[F.col(f"__keep_{c}").alias(c) for c in keep],
        *[F.col("__pc")[i].alias(f"PC{i + 1}") for i in range(state.kept)],
    )


def components_for(df: DataFrame, state: PcaState, levels: Sequence[float] = (0.80, 0.85, 0.90, 0.95, 0.99)) -> DataFrame:
    """Components needed for each share of variance."""
    return first_reaching(explained_variance(df, state), levels)


def top_loadings(df: DataFrame, state: PcaState, components: int = 5, k: int = 5) -> DataFrame:
    """The ``k`` features with the largest absolute loading of the first components."""
    pc = state.model.pc.toArray()
    rows = [
        (f"PC{j + 1}", c, float(pc[i, j]))
        for j in range(min(components, pc.shape[1]))
        for i, c in enumerate(state.scaler.columns)
    ]
    long = df.sparkSession.createDataFrame(rows, "component string, feature string, loading double")
    return top_k_per_group(long, ["component"], [F.desc(F.abs("loading")), F.asc("feature")], k)


def selected_dataset(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    return df.select(*features, *([label] if label else []))
