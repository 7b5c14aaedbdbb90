"""Saved models and their label tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class LabelConfig:
    """Codes behind the label indexes of a model, in index order."""

    categories: list[int]
    functions: list[str]
    category_names: dict[int, str]
    function_names: dict[str, str]


def read_label_config(spark: SparkSession, path: str) -> LabelConfig:
    rows = spark.read.parquet(f"{path}/label_config").orderBy("axis", "label").collect()
    categories = [r for r in rows if r.axis == "category"]
    functions = [r for r in rows if r.axis == "function"]
    return LabelConfig(
        [int(r.code) for r in categories], [r.code for r in functions],
        {int(r.code): r.name for r in categories}, {r.code: r.name for r in functions},
    )


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


# Settings that make two splits the same; a model may only be evaluated on its own.
SPLIT_SETTINGS = ("key", "test_size", "seed", "train_rows", "test_rows", "split_hash")


def read_settings(spark: SparkSession, path: str) -> dict[str, str] | None:
    """What the model was trained with; None for a model saved without."""
    try:
        rows = spark.read.parquet(f"{path}/settings").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return {r.name: r.value for r in rows}


def check_split(settings: dict[str, str], other: dict[str, str]) -> None:
    """Raise when rows that the model was trained on could be taken for held-out ones."""
    differ = [f"{n} was {settings.get(n)}, is {other.get(n)}" for n in SPLIT_SETTINGS if settings.get(n) != other.get(n)]
    if differ:
        raise ValueError("another split than the model's own: " + "; ".join(differ))


def check_dictionary(dictionary: DataFrame, config: LabelConfig) -> None:
    """Raise when the data holds a category that the model was not trained on."""
    unknown = dictionary.filter(~dictionary.category.isin(config.categories)).take(20)
    if unknown:
        raise ValueError(f"categories unknown to the model: {[r.category for r in unknown]}")
