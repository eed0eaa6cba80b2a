"""Writing report tables, documents, predictions and models."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.shared import kept
from tidemark.spec import PREDICTION_COLUMNS

LOG = logging.getLogger(__name__)


def write_report(
    report: DataFrame, path: str, may_be_empty: bool = False, one_file: bool = True
) -> bool:
    """A report table as CSV with a header; tells whether there was anything to write.

    An empty report is an error unless it may be empty. ``one_file`` is for tables whose size does
    not grow with the data: one task writes them.
    """
    with kept(report):
        if report.isEmpty():
            if may_be_empty:
                return False
            raise ValueError(f"nothing to write to {path}")
        parts = report.coalesce(1) if one_file else report
        parts.write.mode("overwrite").option("header", True).csv(path)
    return True


def _sorted_json(column: Column, data_type: T.DataType, name: str) -> Column:
    """The value with struct fields in name order; a NaN or infinite number fails when read."""
    if isinstance(data_type, T.StructType):
        fields = sorted(data_type.fields, key=lambda field: field.name)
        inner = [
            _sorted_json(column[f.name], f.dataType, f.name).alias(f.name) for f in fields
        ]
        return F.when(column.isNotNull(), F.struct(*inner))
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda item: _sorted_json(item, data_type.elementType, name))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        unfit = F.isnan(column) | (F.abs(column) == F.lit(float("inf")))
        return F.when(unfit, F.raise_error(F.lit(f"{name} is not a finite number"))).otherwise(
            column
        )
    if isinstance(data_type, (T.IntegralType, T.StringType, T.BooleanType)):
        return column
    return column.cast("string")


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON text per row: keys sorted, nulls written, dates and other types as text."""
    row = F.struct(
        *[
            _sorted_json(F.col(f.name), f.dataType, f.name).alias(f.name)
            for f in sorted(df.schema.fields, key=lambda field: field.name)
        ]
    )
    return df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("value"))


def write_json(df: DataFrame, path: str) -> None:
    json_lines(df).coalesce(1).write.mode("overwrite").text(path)


def write_predictions(predicted: DataFrame, path: str) -> None:
    predicted.select(*PREDICTION_COLUMNS).write.mode("overwrite").parquet(path)


def save_models(
    preprocessor: PipelineModel, model: LogisticRegressionModel, folder: str
) -> Mapping[str, object]:
    """Save both; a failure is logged and reported, not raised, so that reports still get written."""
    try:
        preprocessor.write().overwrite().save(f"{folder}/preprocessor")
        model.write().overwrite().save(f"{folder}/logistic_regression")
    except Exception as failure:
        LOG.warning("models not saved to %s: %s", folder, failure)
        return {"requested": True, "saved": False, "error": f"{type(failure).__name__}: {failure}"}
    return {"requested": True, "saved": True, "error": None}


def load_models(folder: str) -> tuple[PipelineModel, LogisticRegressionModel]:
    return (
        PipelineModel.load(f"{folder}/preprocessor"),
        LogisticRegressionModel.load(f"{folder}/logistic_regression"),
    )
