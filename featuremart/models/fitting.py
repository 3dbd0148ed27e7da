"""Fits whose models hold no training summary, rows dealt evenly over the tasks
of a fit, and scored rows stored once.

A fitted model keeps its training data frame alive through its summary, and
every plan built on the model carries it along. A model read back from the
shared folder has its coefficients only; rows scored by it are stored, so
later aggregates read plain columns and never plan the model again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame

from featuremart.session import shared_dir, stored

# Rows of a training table that one task of a fit holds. MLlib keeps its inputs
# cached by partition, trees at up to 3 kB a row of 200 features.
ROWS_PER_TASK = 100_000


def spread(rows: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Stored ``rows`` dealt evenly over tasks of about ``per_task``, however they
    lie in files; a table of no more rows is left as it lies."""
    n = rows.count()
    if n <= per_task:
        return rows
    return rows.repartition(max(-(-n // per_task), rows.sparkSession.sparkContext.defaultParallelism))


def fitted(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """``pipeline`` fitted on ``rows``, saved to the shared folder and read back."""
    path = f"{shared_dir(rows.sparkSession)}/featuremart-models/fit-{uuid.uuid4().hex}"
    pipeline.fit(rows).write().save(path)
    return PipelineModel.load(path)


def scored(model: PipelineModel, rows: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """The named columns of the rows that ``model`` has scored, stored once."""
    return stored(model.transform(rows).select(*columns), "scored")
