"""Models as tasks carry them."""

from __future__ import annotations

from pyspark.ml.util import JavaMLReadable, JavaMLWritable
from pyspark.sql import SparkSession

from flowsift.session import scratch_dir


def reloaded(model: JavaMLWritable, spark: SparkSession) -> JavaMLReadable:
    """The model written to the shared folder and read back.

    A freshly fitted model holds its training summary, and with it the session, which tasks cannot
    always serialise; a stored model is only its parameters.
    """
    path = scratch_dir(spark, "model")
    model.write().save(path)
    return type(model).load(path)
