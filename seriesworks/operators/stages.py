"""Feature building and boosted trees as Spark ML stages, saved and loaded as one pipeline."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame

from seriesworks import config
from seriesworks.functions.columns import feature_columns
from seriesworks.operators import boosting, splits
from seriesworks.operators.features import build_features


class _PanelParams(Params):
    """Which columns are keys, date and target."""

    keys = Param(Params._dummy(), "keys", "key columns of a series", TypeConverters.toListString)
    dateCol = Param(Params._dummy(), "dateCol", "day of a row", TypeConverters.toString)
    targetCol = Param(Params._dummy(), "targetCol", "value to predict", TypeConverters.toString)

    def _panel_defaults(self) -> None:
        self._setDefault(keys=list(config.KEYS), dateCol=config.DATE, targetCol=config.TARGET)


class FeatureBuilder(Transformer, _PanelParams, DefaultParamsReadable, DefaultParamsWritable):
    """A daily panel becomes its feature matrix, with the column ``split`` where ``testSize`` is above 0."""

    excludeCurrent = Param(Params._dummy(), "excludeCurrent", "features end on the row before", TypeConverters.toBoolean)
    testSize = Param(Params._dummy(), "testSize", "share of the last days that is for testing", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, keys=None, dateCol=None, targetCol=None, excludeCurrent=None, testSize=None):
        super().__init__()
        self._panel_defaults()
        self._setDefault(excludeCurrent=True, testSize=config.TEST_SIZE)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        matrix = build_features(
            dataset, get("keys"), get("dateCol"), get("targetCol"), exclude_current=get("excludeCurrent")
        )
        if get("testSize") <= 0:
            return matrix
        return splits.three_way_split(matrix, get("testSize"), keys=get("keys"), date=get("dateCol"))


class _TreeParams(_PanelParams):
    featureCols = Param(Params._dummy(), "featureCols", "numeric columns to learn from; all others if not set", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "columns that enter as ordered target statistics", TypeConverters.toListString)
    splitCol = Param(Params._dummy(), "splitCol", "train, valid or else", TypeConverters.toString)
    boosting = Param(Params._dummy(), "boosting", "settings besides config.BOOSTING_PARAMS")
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)

    def _tree_defaults(self) -> None:
        self._panel_defaults()
        self._setDefault(categoricalCols=[], splitCol="split", boosting={}, maxBins=boosting.MAX_BINS)


class BoostedTreesRegressor(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Histogram boosting (:func:`boosting.fit_trees`) as an estimator."""

    @keyword_only
    def __init__(
        self, *, keys=None, dateCol=None, targetCol=None, featureCols=None, categoricalCols=None, splitCol=None, boosting=None, maxBins=None
    ):
        super().__init__()
        self._tree_defaults()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        get = self.getOrDefault
        if self.isSet("featureCols"):
            names = get("featureCols")
        else:
            names = feature_columns(dataset, get("keys"), get("dateCol"), get("targetCol"))
        model = boosting.fit_trees(
            dataset, names, get("targetCol"), get("boosting"), get("categoricalCols"), get("splitCol"), get("dateCol"), get("maxBins")
        )
        return self._copyValues(BoostedTreesModel(model))


class BoostedTreesModel(Model, _TreeParams, MLReadable, MLWritable):
    """Adds ``predicted``; the trees themselves are in ``trees``."""

    def __init__(self, trees: boosting.BoostedTrees | None = None):
        super().__init__()
        self._tree_defaults()
        self.trees = trees

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.trees.transform(dataset)

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    """Settings as for any stage, and the trees as tables beside them."""

    def __init__(self, model: BoostedTreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        boosting.save_trees(self.model.trees, f"{path}/trees", self.sparkSession)


class _ModelReader(MLReader):
    def load(self, path: str) -> BoostedTreesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = BoostedTreesModel(boosting.load_trees(f"{path}/trees", self.sparkSession))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
