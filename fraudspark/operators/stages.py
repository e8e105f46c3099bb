"""The feature steps as Spark ML stages: estimators and models with params that fit into one ``Pipeline``.

A model's scalars are params, its table is Parquet beside the stage's metadata, so a pipeline model of
these stages is written and read like any other, and a loaded one gives the same numbers.  The stages
wrap the operators of ``encoders``, ``features`` and ``prune``; a fitted target encoder gives training rows
its out-of-fold means by ``out_of_fold``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession

from ..session import materialize
from . import encoders as enc
from . import features as fe
from . import prune


class _Shared(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns that the stage works on (absent ones are left out)", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label column, 0 or 1", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "card column", TypeConverters.toString)
    amountCol = Param(Params._dummy(), "amountCol", "amount column", TypeConverters.toString)
    smoothing = Param(Params._dummy(), "smoothing", "rows that the label mean weighs in a category's mean", TypeConverters.toFloat)
    normalize = Param(Params._dummy(), "normalize", "shares instead of counts", TypeConverters.toBoolean)
    threshold = Param(Params._dummy(), "threshold", "absolute correlation above which the later column goes", TypeConverters.toFloat)
    minCols = Param(Params._dummy(), "minCols", "as many columns or fewer are left alone", TypeConverters.toInt)
    prefix = Param(Params._dummy(), "prefix", "prefix of the columns that are pruned", TypeConverters.toString)
    foldCase = Param(Params._dummy(), "foldCase", "compare categories in lower case", TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="isFraud", keyCol="card1", amountCol="TransactionAmt", smoothing=1.0, normalize=True,
                         threshold=prune.PRUNE_THRESHOLD, minCols=prune.MIN_V_COLS, prefix="V", foldCase=True)

    def _given(self, values: dict) -> None:
        self._set(**{k: v for k, v in values.items() if v is not None})

    def _get(self, name: str):
        return self.getOrDefault(name)


class _TableWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.table.write.mode("overwrite").parquet(f"{path}/table")


class _TableReader(DefaultParamsReader):
    def __init__(self, cls):
        super().__init__(cls)
        self._kind = cls

    def load(self, path: str):
        found = super().load(path)
        found.table = SparkSession.active().read.parquet(f"{path}/table")
        return found


class _TableModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """A model whose state is a table (``table``) and its number of rows (``tableRows``)."""

    tableRows = Param(Params._dummy(), "tableRows", "rows of the fitted table", TypeConverters.toInt)
    tableBytes = Param(Params._dummy(), "tableBytes", "bytes of its keys and values", TypeConverters.toInt)
    table: DataFrame | None = None

    def write(self):
        return _TableWriter(self)

    @classmethod
    def read(cls):
        return _TableReader(cls)

    def copy(self, extra=None):
        out = super().copy(extra)
        out.table = self.table
        return out


class TargetEncoder(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Smoothed label mean of every category."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, labelCol: str | None = None, smoothing: float | None = None):
        super().__init__()
        self._setDefault(inputCols=enc.TARGET_ENCODE_COLS)
        self._given(self._input_kwargs)

    def _fit(self, df: DataFrame) -> TargetEncoderModel:
        fitted = enc.fit_target_encoding(df, self._get("inputCols"), self._get("labelCol"), self._get("smoothing"))
        model = self._copyValues(TargetEncoderModel())
        model._set(inputCols=fitted.cols, globalMean=fitted.global_mean, tableRows=fitted.state_rows, tableBytes=fitted.state_bytes)
        model.table = fitted.state
        return model


class TargetEncoderModel(_TableModel):
    globalMean = Param(Params._dummy(), "globalMean", "value of unseen and null categories", TypeConverters.toFloat)

    def encoding(self) -> enc.TargetEncoding:
        return enc.TargetEncoding(self._get("inputCols"), self._get("globalMean"), self._get("smoothing"), self.table, self._get("tableRows"), self._get("tableBytes"))

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.encoding().transform(df)

    def out_of_fold(self, train: DataFrame, fold: str) -> DataFrame:
        """The rows it was fitted on, each with the means of the other folds."""
        return enc.target_encode_out_of_fold(train, self.encoding(), self._get("labelCol"), fold)


class FrequencyEncoder(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Share (or count) of every category among the rows that have one."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, normalize: bool | None = None):
        super().__init__()
        self._setDefault(inputCols=enc.FREQ_ENCODE_COLS)
        self._given(self._input_kwargs)

    def _fit(self, df: DataFrame) -> FrequencyEncoderModel:
        fitted = enc.fit_frequency_encoding(df, self._get("inputCols"), self._get("normalize"))
        model = self._copyValues(FrequencyEncoderModel())
        model._set(inputCols=fitted.cols, tableRows=fitted.state_rows, tableBytes=fitted.state_bytes)
        model.table = fitted.state
        return model


class FrequencyEncoderModel(_TableModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return enc.FrequencyEncoding(self._get("inputCols"), self._get("normalize"), self.table, self._get("tableRows"), self._get("tableBytes")).transform(df)


class CardProfiler(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Amount statistics of every card."""

    @keyword_only
    def __init__(self, *, keyCol: str | None = None, amountCol: str | None = None):
        super().__init__()
        self._given(self._input_kwargs)

    def _fit(self, df: DataFrame) -> CardProfilerModel:
        id_col = "TransactionID" if "TransactionID" in df.columns else None
        profile = materialize(fe.card_profile(df, self._get("keyCol"), self._get("amountCol"), id_col), "card_profile")
        model = self._copyValues(CardProfilerModel())
        model._set(tableRows=profile.count())
        model.table = profile
        return model


class CardProfilerModel(_TableModel):
    """Adds log amount, z-score and the velocity proxies of the fitted cards."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return fe.add_card_features(df, self._get("keyCol"), self._get("amountCol"), self.table, self._get("tableRows"))


class CorrelationPruner(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Finds the columns with the prefix that an earlier one of them repeats."""

    @keyword_only
    def __init__(self, *, prefix: str | None = None, threshold: float | None = None, minCols: int | None = None):
        super().__init__()
        self._given(self._input_kwargs)

    def _fit(self, df: DataFrame) -> CorrelationPrunerModel:
        columns = [c for c in df.columns if c.startswith(self._get("prefix"))]
        dropped = []
        if len(columns) > self._get("minCols"):
            pairs = prune.columns_to_prune(prune.corr_pairs(df.select(*columns), columns), self._get("threshold"))
            dropped = [r["column_name"] for r in pairs.orderBy("j").collect()]  # a row a column at most
        return self._copyValues(CorrelationPrunerModel())._set(droppedCols=dropped)


class CorrelationPrunerModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    droppedCols = Param(Params._dummy(), "droppedCols", "columns that go", TypeConverters.toListString)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self._get("droppedCols"))


class OrdinalEncoder(Transformer, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Codes of listed categories (-1 for null and unlisted ones); the lists are a param as JSON."""

    categories = Param(Params._dummy(), "categories", "column -> categories in order of their codes, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, categories: str | None = None, foldCase: bool | None = None):
        super().__init__()
        self._setDefault(categories=json.dumps(fe.ORDINAL_COLS))
        self._given(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return fe.encode_ordinals(df, json.loads(self._get("categories")), self._get("foldCase"))


class NullIndicator(Transformer, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Flags of missing values."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=fe.NULL_FLAG_COLS)
        self._given(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return fe.add_null_indicators(df, self._get("inputCols"))
