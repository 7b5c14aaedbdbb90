"""Saved models beside the table that explains their labels."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from labelflow.operators.heads import FIT_DEFAULTS
from labelflow.operators.split import split_hash
from labelflow.schema import CATEGORY_NAMES, FUNCTION_INDEX, FUNCTION_NAMES


def label_config(
    spark: SparkSession, categories: list[int],
    functions: dict[str, int] = FUNCTION_INDEX,
) -> DataFrame:
    """`(axis, label, code, name)`: what each label index of a model stands for."""
    rows = [("category", i, str(c), CATEGORY_NAMES.get(c, "")) for i, c in enumerate(categories)]
    rows += [("function", i, code, FUNCTION_NAMES.get(code, "")) for code, i in functions.items()]
    return spark.createDataFrame(rows, "axis string, label int, code string, name string")


def model_settings(
    prepared: DataFrame, key: str, test_size: float, seed: int, label: str = "category_id", **fit
) -> dict[str, str]:
    """What a model was trained with: the split, its content, and the options of the fit."""
    sides = prepared.groupBy("is_train").count().collect()
    rows = {r.is_train: r["count"] for r in sides}
    return {
        "key": key, "test_size": str(float(test_size)), "seed": str(seed),
        "train_rows": str(rows.get(True, 0)), "test_rows": str(rows.get(False, 0)),
        "split_hash": split_hash(prepared, key, label),
        **{name: str(value) for name, value in {**FIT_DEFAULTS, **fit}.items()},
    }


def save_model(
    model: PipelineModel, config: DataFrame, path: str, settings: dict[str, str] | None = None
) -> None:
    """The model, its label table and, if given, its settings as `(name, value)`."""
    model.write().overwrite().save(f"{path}/model")
    config.coalesce(1).write.mode("overwrite").parquet(f"{path}/label_config")
    if settings is not None:
        table = config.sparkSession.createDataFrame(sorted(settings.items()), "name string, value string")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")
