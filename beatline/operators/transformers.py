"""Feature steps as Spark ML transformers that can be saved.

Each keeps its fitted values as parameters, so ``write``/``load`` of a
``PipelineModel`` that holds them gives the same rows again. All are projections or
filters of literals: no join, no shuffle, no Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.functions.text import DESCRIPTION_DEFAULT, DESCRIPTION_RULES, keyword_group


class _Saved(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer of one input column whose parameters are its whole state."""

    def _given(self, values: dict):
        return self._set(**{k: v for k, v in values.items() if v is not None})


class KeywordGrouper(_Saved, HasOutputCol):
    """The first keyword of ``needles`` that the text holds names its group, one of
    ``groups``; no match, or a null text, gives ``default``."""

    needles = Param(Params._dummy(), "needles", "keywords, in order", TypeConverters.toListString)
    groups = Param(Params._dummy(), "groups", "group of each keyword", TypeConverters.toListString)
    default = Param(Params._dummy(), "default", "group of other texts", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, needles=None, groups=None, default=None):
        super().__init__()
        self._setDefault(needles=[k for k, _ in DESCRIPTION_RULES], groups=[g for _, g in DESCRIPTION_RULES],
                         default=DESCRIPTION_DEFAULT)
        self._given(self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rules = list(zip(self.getOrDefault("needles"), self.getOrDefault("groups"), strict=True))
        return dataset.withColumn(self.getOutputCol(), keyword_group(
            self.getInputCol(), rules, self.getOrDefault("default")))


class RareBucketer(_Saved, HasOutputCol):
    """Values not among ``values``, nulls too, become ``other``."""

    values = Param(Params._dummy(), "values", "values kept", TypeConverters.toListString)
    other = Param(Params._dummy(), "other", "name of the bucket", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, values=None, other=None):
        super().__init__()
        self._setDefault(values=[], other="OTHER")
        self._given(self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        c = F.col(self.getInputCol())
        return dataset.withColumn(self.getOutputCol(), F.when(
            c.isin(self.getOrDefault("values")), c).otherwise(F.lit(self.getOrDefault("other"))))


class ValueFilter(_Saved):
    """The rows whose value is among ``values``; nulls go."""

    values = Param(Params._dummy(), "values", "values kept", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCol=None, values=None):
        super().__init__()
        self._setDefault(values=[])
        self._given(self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.filter(F.col(self.getInputCol()).isin(self.getOrDefault("values")))


class ColumnKeeper(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The columns ``names``, in order."""

    names = Param(Params._dummy(), "names", "columns kept", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, names: Sequence[str] | None = None):
        super().__init__()
        if names is not None:
            self._set(names=list(names))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(*self.getOrDefault("names"))
