"""Send this package to the executors, which need it to run the functions that operators hand to them."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT = "_sensormill_sent"
#: Rows that travel to a Python worker at once, in place of Spark's default: texts are long, and workers must stay small.
BATCH_SETTING, DEFAULT_BATCH, BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the running application, once. The driver serves the archive to every executor.

    Also lowers the session's Arrow batch size if it is the default.
    """
    if spark.conf.get(BATCH_SETTING) == DEFAULT_BATCH:
        spark.conf.set(BATCH_SETTING, BATCH)
    context = spark.sparkContext
    if getattr(context, _SENT, False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="sensormill-code-")) / "sensormill.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent).as_posix())
    context.addPyFile(str(archive))
    setattr(context, _SENT, True)
