"""tempora — time-series feature, back-test and evaluation operators on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or an MLlib
``Estimator``/``Model``) so the whole chain stays one lazy Catalyst plan.
"""

from tempora.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
