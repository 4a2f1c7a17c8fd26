"""Where tables that outlive a stage but not a session are written."""

import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the session names in ``spark.checkpoint.dir``.

    All executors have to reach it. Where the session names none, it is a folder in the warehouse,
    which they reach as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{base.rstrip('/')}/hourboard/{name}-{uuid.uuid4().hex}"
