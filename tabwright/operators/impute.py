"""Missing numbers filled with exact medians, as a pipeline stage that can be stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions import as_number, col_of
from tabwright.operators.values import NumberCounts


class MedianImputerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Each input column with its median in place of null and NaN."""

    medians = Param(Params._dummy(), "medians", "one per input column", typeConverter=TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = {
            out: F.coalesce(as_number(col_of(c)), F.lit(m))
            for c, out, m in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.medians))
        }
        return dataset.withColumns(filled)


class MedianImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the exact median of every input column, 0 for one without any value.

    Medians come from counts of distinct values, added up before the shuffle and ordered in slices, so
    no task sorts a whole column and one number per column reaches the driver.
    """

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        names = self.getInputCols()
        counts = NumberCounts(dataset, {f"c{i}": col_of(c) for i, c in enumerate(names)})
        found = {r["column"]: r["median"] for r in counts.quantiles({"median": 0.5}).collect()}
        model = MedianImputerModel()
        model._set(
            inputCols=names,
            outputCols=self.getOutputCols(),
            medians=[float(found.get(f"c{i}") or 0.0) for i in range(len(names))],
        )
        return model
