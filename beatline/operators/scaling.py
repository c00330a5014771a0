"""Standardisation (M6, M7, M8).

Both scalers are fitted by one aggregate pass that yields one row (a mean and
a deviation per column); the fitted values are then inlined as literals, so
applying the scaler is a projection with no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class ColumnScaler:
    """Fitted per-column mean and deviation; ``(x - mean) / dev``."""
    columns: list[str]
    means: list[float]
    devs: list[float]
    suffix: str = "_z"

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        cols = [((F.col(c) - F.lit(m)) / F.lit(d)).alias(c + self.suffix)
                for c, m, d in zip(self.columns, self.means, self.devs)]
        return df.select(*keep, *cols)


def fit_scaler(df: DataFrame, columns: Sequence[str], ddof: int = 0,
               zero_dev: float = 1.0, suffix: str = "_z") -> ColumnScaler:
    """Mean and standard deviation per column in one pass.

    ``ddof=0``: population deviation (fit on train rows, apply to test: M7);
    ``ddof=1``: sample deviation. A zero deviation is replaced by
    ``zero_dev`` (1.0 leaves the centred value).
    """
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"m_{c}"), std(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    means = [float(row[f"m_{c}"]) if row[f"m_{c}"] is not None else 0.0 for c in columns]
    devs = []
    for c in columns:
        s = row[f"s_{c}"]
        devs.append(zero_dev if s is None or s == 0 else float(s))
    return ColumnScaler(list(columns), means, devs, suffix)


def fit_vector_scaler(df: DataFrame, columns: Sequence[str],
                      out: str = "features") -> PipelineModel:
    """Assemble + ``StandardScaler(withMean, withStd)`` as one ML pipeline
    (M6, M8): sample deviation, fitted on all rows; a constant column
    scales to 0."""
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="features_raw",
                        handleInvalid="error"),
        StandardScaler(inputCol="features_raw", outputCol=out, withMean=True, withStd=True),
    ])
    return pipe.fit(df)


def vector_columns(df: DataFrame, vec: str, names: Sequence[str],
                   keep: Sequence[str] = ()) -> DataFrame:
    """Split a vector column back into named double columns."""
    arr = vector_to_array(vec)
    return df.select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])
