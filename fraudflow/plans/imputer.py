"""Median imputation with exact medians (ML4), as an ML estimator of our own.

The medians come from ``profile.exact_quantiles``: values are counted, the
counted values are range-partitioned, and only the blocks that hold a middle
rank are searched.  With an even number of values the median is the mean of
the two in the middle.  Null and NaN are gaps.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.profile import exact_quantiles


def _present(df: DataFrame, column: str):
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v)


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """The median of each column; a column without values has none."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _present(df, c).alias("value")) for c in columns]))
    long = df.select(pairs.alias("p")).select("p.*").where("value is not null")
    return {r["column_name"]: r["median"] for r in exact_quantiles(long, {"median": 0.5}).collect()}


class MedianImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fits one median a column; a column without any value can't be fitted."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MedianImputerModel":
        columns = self.getInputCols()
        medians = exact_medians(dataset, columns)
        if missing := [c for c in columns if c not in medians]:
            raise ValueError(f"no values to impute from in {missing}")
        return MedianImputerModel(inputCols=columns, outputCols=self.getOutputCols(), surrogates=[medians[c] for c in columns])


class MedianImputerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fills gaps with the fitted medians; saved and loaded with the pipeline it is part of."""

    surrogates = Param(Params._dummy(), "surrogates", "the median of each input column", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None,
                 surrogates: list[float] | None = None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def medians(self) -> dict[str, float]:
        return dict(zip(self.getInputCols(), self.getOrDefault(self.surrogates)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = {o: F.coalesce(_present(dataset, c), F.lit(m))
                  for (c, m), o in zip(self.medians().items(), self.getOutputCols())}
        return dataset.withColumns(filled)
