"""Response models as pipeline stages over built-in expressions."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from .arrays import angular
from .scoring import bernoulli, noise, parametric


class _Draws(Params):
    """Salt and key columns that identify a draw."""

    salt = Param(Params._dummy(), "salt", "salt of the draw", TypeConverters.toString)
    keys = Param(Params._dummy(), "keys", "columns that identify a row", TypeConverters.toListString)

    def draw(self):
        return self.getOrDefault(self.salt), *self.getOrDefault(self.keys)


class _Stage(Transformer, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset):
        return dataset.withColumn(self.getOutputCol(), self.value())

    def value(self):
        raise NotImplementedError


class NoiseStage(_Stage, _Draws):
    """Gaussian noise around ``mu``, cut at zero unless ``clipNegative`` is off."""

    mu = Param(Params._dummy(), "mu", "mean", TypeConverters.toFloat)
    sigma = Param(Params._dummy(), "sigma", "standard deviation", TypeConverters.toFloat)
    clipNegative = Param(Params._dummy(), "clipNegative", "replace negative values by 0", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, outputCol=None, salt="noise", keys=None, mu=0.0, sigma=1.0, clipNegative=True):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(salt="noise", mu=0.0, sigma=1.0, clipNegative=True)

    def value(self):
        salt, *keys = self.draw()
        return noise(self.getOrDefault(self.mu), self.getOrDefault(self.sigma), salt, *keys,
                     clip_negative=self.getOrDefault(self.clipNegative))


class BernoulliStage(_Stage, HasInputCol, _Draws):
    """1 with the probability in the input column."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, salt="bernoulli", keys=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(salt="bernoulli")

    def value(self):
        salt, *keys = self.draw()
        return bernoulli(self.getInputCol(), salt, *keys)


class ConstantStage(_Stage):
    constant = Param(Params._dummy(), "constant", "value of every row", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, outputCol=None, constant=0.0):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(constant=0.0)

    def value(self):
        return F.lit(self.getOrDefault(self.constant))


class RevenueStage(_Stage, HasInputCol):
    """Input column times the price column."""

    priceCol = Param(Params._dummy(), "priceCol", "price column", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, priceCol="price"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(priceCol="price")

    def value(self):
        return F.col(self.getInputCol()) * F.col(self.getOrDefault(self.priceCol))


class AngularStage(_Stage):
    """Angular similarity of two vector columns."""

    left = Param(Params._dummy(), "left", "first vector", TypeConverters.toString)
    right = Param(Params._dummy(), "right", "second vector", TypeConverters.toString)

    @keyword_only
    def __init__(self, left=None, right=None, outputCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def value(self):
        return angular(self.getOrDefault(self.left), self.getOrDefault(self.right))


class ParametricStage(_Stage):
    """Weighted sum of columns."""

    columns = Param(Params._dummy(), "columns", "summed columns", TypeConverters.toListString)
    weights = Param(Params._dummy(), "weights", "one weight per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, columns=None, weights=None, outputCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def value(self):
        return parametric(dict(zip(self.getOrDefault(self.columns), self.getOrDefault(self.weights))))


class ResponseEstimator(Estimator, HasOutputCol):
    """Base of response models that learn something before they become a stage."""
