"""Feature analysis from correlation to reduced data sets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from listlens.operators import analysis as an
from listlens.operators.sets import lookup_scores
from listlens.operators.stored_pca import save_pca
from listlens.sources import files


@dataclass
class Analysis:
    """Results of one run; ``summary`` has one row."""

    correlated: DataFrame
    scores: DataFrame
    selected: list[str]
    summary: DataFrame
    train_selected: DataFrame
    test_selected: DataFrame | None
    pca: an.PcaState | None
    train_pca: DataFrame | None
    test_pca: DataFrame | None


def analyse_features(
    train: DataFrame, label: str, features: Sequence[str] | None = None, test: DataFrame | None = None,
    target: float = 0.95, threshold: float = 0.8, pca: bool = True, output: str | None = None, trees: int = 100,
) -> Analysis:
    """Correlated pairs, forest + F scores, selection by share, PCA; written below ``output`` if given."""
    features = list(features or [c for c in train.columns if c != label])
    table = train.select(*features, label).persist()
    try:
        pairs = an.correlated_pairs(an.correlation_matrix(table, features), threshold)
        forest = an.rf_importance(table, features, label, trees)
        scores = an.combine_scores(
            lookup_scores(forest, an.anova_f(table, features, label).na.fill(0.0, ["f_score"])), "rf_importance", "f_score"
        )
        # One name per selected feature.
        chosen = [r["feature"] for r in an.select_by_share(scores, target).orderBy("position").collect()]
        state = an.fit_pca(table, features, target) if pca else None
        n_rows, n_pairs = table.count(), pairs.count()
    finally:
        table.unpersist()
    facts = [(
        len(features), len(chosen), (len(features) - len(chosen)) / len(features) * 100, n_pairs, target,
        n_rows, test.count() if test is not None else None,
        state.kept if state else None, float(sum(state.ratios[: state.kept])) if state else None,
    )]
    summary = train.sparkSession.createDataFrame(
        facts,
        "original_features int, selected_features int, feature_reduction_pct double, high_correlation_pairs int,"
        " target_variance double, train_rows bigint, test_rows bigint, pca_components int, pca_variance_explained double",
    )
    out = Analysis(
        pairs, scores, chosen, summary,
        an.selected_dataset(train, chosen, label),
        an.selected_dataset(test, chosen) if test is not None else None,
        state,
        an.apply_pca(train, state, [label]) if state else None,
        an.apply_pca(test, state) if state and test is not None else None,
    )
    if output:
        _write(out, output)
    return out


def _write(result: Analysis, output: str) -> None:
    tables = {
        "train_features_selected": result.train_selected, "test_features_selected": result.test_selected,
        "train_pca": result.train_pca, "test_pca": result.test_pca,
        "feature_scores": result.scores, "summary": result.summary,
    }
    for name, df in tables.items():
        if df is not None:
            files.write_parquet(df, f"{output}/{name}")
    if result.pca is not None:
        save_pca(result.pca, result.summary, f"{output}/pca")
