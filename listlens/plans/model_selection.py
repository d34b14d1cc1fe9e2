"""Grid search over several model families, comparison and choice."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listlens.operators import evaluate, models
from listlens.operators.analysis import assemble


@dataclass
class Selection:
    best: models.SearchResult
    results: list[models.SearchResult]
    metrics: DataFrame
    comparison: DataFrame


def select_model(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: str,
    quick: bool = True, grids: Mapping[str, tuple[Estimator, list]] | None = None, folds: int = 3,
    balance: Callable[[DataFrame], DataFrame] | None = None, output: str | None = None,
) -> Selection:
    """Cross-validate each family on the training rows; test rows only report.

    ``balance`` (feature columns, label, key -> same columns) is applied inside the training part
    of each fold. A failing family stops the run.
    """
    spec = grids or models.grids(quick, "label")

    def vectors(df: DataFrame) -> DataFrame:
        return assemble(df, features).withColumn("label", F.col(label).cast("double"))

    folded = models.stratified_folds(train, label, key, folds)
    rows, held = vectors(folded), vectors(test).select("label", "features")
    inner = (lambda df: vectors(balance(df.drop("features", "label")))) if balance else None
    if inner is None:
        rows = rows.select("label", "features", "fold")
    results = [
        models.grid_search(rows, est, grid, folds, "fold", "label", inner, held, name)
        for name, (est, grid) in spec.items()
    ]
    best = models.best_model(results)
    metrics = models.metrics_table(train.sparkSession, results)
    if output:
        for r in results:
            r.model.write().overwrite().save(f"{output}/models/{r.name}")
        best.model.write().overwrite().save(f"{output}/models/best_overall")
        metrics.write.mode("overwrite").parquet(f"{output}/metrics")
    return Selection(best, results, metrics, evaluate.compare(metrics))
