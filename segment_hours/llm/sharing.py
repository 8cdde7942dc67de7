"""Objects of this package as broadcasts, for executors that have no copy of it."""

from __future__ import annotations

import pickle

from pyspark import cloudpickle


def share(spark, thing):
    """Broadcasts ``thing`` together with its class; the caller bounds its size."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(thing))


def shared(broadcast):
    return pickle.loads(broadcast.value)
