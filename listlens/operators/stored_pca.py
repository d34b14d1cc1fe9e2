"""Column list, scaling and rotation of a PCA as one pipeline that can be stored and applied to new rows."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listlens.operators.analysis import PcaState
from listlens.sources.files import load_model, require_columns, save_model, write_parquet


class ScaledColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The named columns, centred and scaled as learned, as one vector."""

    columns = Param(Params._dummy(), "columns", "feature columns in order", TypeConverters.toListString)
    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "deviation per column", TypeConverters.toListFloat)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns=(), means=(), deviations=(), outputCol="features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**{k: list(v) if isinstance(v, tuple) else v for k, v in self._input_kwargs.items()})

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = self.getOrDefault("columns")
        require_columns(df, columns)
        scaled = [
            (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
            for c, m, s in zip(columns, self.getOrDefault("means"), self.getOrDefault("deviations"))
        ]
        return df.withColumn(self.getOrDefault("outputCol"), array_to_vector(F.array(*scaled)))


class Components(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``PC1..PCk`` out of the rotated vector; the vectors and the ``spent`` columns go."""

    kept = Param(Params._dummy(), "kept", "number of components", TypeConverters.toInt)
    spent = Param(Params._dummy(), "spent", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, kept=1, spent=()):
        super().__init__()
        self._set(kept=self._input_kwargs.get("kept", kept), spent=list(self._input_kwargs.get("spent", ())))

    def _transform(self, df: DataFrame) -> DataFrame:
        spent = {*self.getOrDefault("spent"), "features", "pca"}
        rest = [c for c in df.columns if c not in spent]
        values = df.withColumn("__pc", vector_to_array("pca"))
        return values.select(*rest, *[F.col("__pc")[i].alias(f"PC{i + 1}") for i in range(self.getOrDefault("kept"))])


def pca_pipeline(state: PcaState) -> PipelineModel:
    """``fit_pca``'s result as one model from raw columns to components; other columns pass through."""
    scaler = state.scaler
    return PipelineModel(stages=[
        ScaledColumns(columns=list(scaler.columns), means=list(scaler.means), deviations=list(scaler.deviations)),
        state.model, Components(kept=state.kept, spent=[*scaler.columns, *state.dropped]),
    ])


def save_pca(state: PcaState, rows: DataFrame, path: str) -> None:
    """The pipeline, the share of variance per component and the facts of the fit below ``path``."""
    save_model(pca_pipeline(state), f"{path}/model")
    ratios = [(i, r) for i, r in enumerate(state.ratios, 1)]
    write_parquet(rows.sparkSession.createDataFrame(ratios, "position int, ratio double"), f"{path}/ratios")
    write_parquet(state.facts(rows), f"{path}/facts")


def load_pca(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(pipeline, shares of variance, facts) as ``save_pca`` stored them."""
    return load_model(f"{path}/model"), spark.read.parquet(f"{path}/ratios"), spark.read.parquet(f"{path}/facts")


def pca_checks(df: DataFrame, model: PipelineModel, ratios: DataFrame) -> DataFrame:
    """Per component of a stored fit: does it hold on the rows it was fitted on?

    ``share``: its variance over that of all input columns (one each after scaling) equals its ratio.
    ``descending``: no larger than the one before. ``uncorrelated``: to all others. ``unit``: loadings of length 1.
    """
    k = model.stages[-1].getOrDefault("kept")
    rows = PipelineModel(stages=model.stages[:-1]).transform(df).select("pca").persist()
    try:
        found = rows.agg(Summarizer.variance(F.col("pca")).alias("v"), F.count("pca").alias("n")).head()
        corr = Correlation.corr(rows, "pca").head()[0].toArray()
    finally:
        rows.unpersist()
    spread = found["v"].toArray() * (found["n"] - 1) / found["n"]
    pc = model.stages[1].pc.toArray()
    shares = {r["position"]: r["ratio"] for r in ratios.collect()}
    out = []
    for i in range(k):
        off = max([abs(corr[i, j]) for j in range(k) if j != i], default=0.0)
        out.append((
            i + 1, bool(abs(spread[i] / len(pc) - shares[i + 1]) < 1e-8),
            bool(i == 0 or shares[i + 1] <= shares[i] + 1e-12), bool(off < 1e-6), bool(abs((pc[:, i] ** 2).sum() - 1) < 1e-9),
        ))
    return df.sparkSession.createDataFrame(out, "position int, share boolean, descending boolean, uncorrelated boolean, unit boolean")
