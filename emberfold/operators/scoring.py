"""Configurable weighted risk score."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from pathlib import Path
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.functions.geo import sigmoid
from emberfold.functions.nested import dot_path
from emberfold.schemas import PREDICTION

MISSING_SCORE = 5.0


def _numeric(name: str, key: str, weight: float, direction: str, mapping: dict[str, float]) -> dict:
    return {
        "name": name, "data_key": key, "weight": weight,
        "type": "numerical_threshold", "direction": direction, "mapping": mapping,
    }


# The default criteria.
DEFAULT_CONFIG = {
    "criteria": [
        _numeric("Fire Intensity (Avg FRP)", "avg_frp", 0.30, "ascending",
                 {"100": 2.0, "500": 5.0, "1000": 8.0, "1500": 10.0}),
        _numeric("Hotspot Density", "point_count", 0.25, "ascending",
                 {"5": 2.0, "10": 4.0, "20": 7.0, "30": 10.0}),
        {
            "name": "Air Quality Impact",
            "data_key": "realtime_context.air_quality.air_quality_severity",
            "weight": 0.20,
            "type": "categorical",
            "mapping": {"low": 1.0, "moderate": 4.0, "high": 7.0, "severe": 10.0, "unknown": 3.0},
        },
        _numeric("Precipitation (Rain)", "realtime_context.weather.precipitation_mm", 0.15, "ascending",
                 {"0": 10.0, "0.1": 1.0}),
        _numeric("Relative Humidity", "realtime_context.weather.relative_humidity_percent", 0.05,
                 "descending", {"30": 10.0, "45": 8.0, "60": 5.0, "80": 3.0, "100": 1.0}),
        _numeric("Wind Speed", "realtime_context.weather.wind_speed_kmh", 0.05, "ascending",
                 {"10": 1.0, "20": 3.0, "35": 7.0, "50": 10.0}),
    ]
}


def load_config(spark: SparkSession, path: str, fallback: str | None = None) -> dict[str, Any]:
    """Read a criteria file from any file system Spark knows; try ``fallback`` if it is absent.

    Any other failure, such as missing rights or a broken file, is an error.
    """
    try:
        rows = spark.read.text(path, wholetext=True).collect()
    except AnalysisException as error:
        if fallback is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.read.text(fallback, wholetext=True).collect()
    return validate_config(json.loads(rows[0][0]))


def validate_config(config: dict[str, Any]) -> dict[str, Any]:
    """Fail before any job runs: criteria must be a list and the weights must add up to one."""
    criteria = config.get("criteria")
    if not isinstance(criteria, list):
        raise ValueError("the configuration needs a 'criteria' list")
    total = sum(c["weight"] for c in criteria)
    if not math.isclose(total, 1.0, rel_tol=1e-5, abs_tol=1e-8):
        raise ValueError(f"criteria weights must add up to 1.0, not {total}")
    return config


def criterion_score(criterion: dict[str, Any], value: Column) -> Column:
    """Score of one criterion; a missing value always scores 5."""
    mapping = {k: float(v) for k, v in criterion["mapping"].items()}
    if criterion["type"] == "categorical":
        text = F.lower(value.cast("string"))
        score = F.lit(MISSING_SCORE)
        for name, points in mapping.items():
            score = F.when(text == name, points).otherwise(score)
    elif criterion["type"] == "numerical_threshold":
        ascending = criterion.get("direction", "ascending") == "ascending"
        beyond = max(mapping.values()) if ascending else min(mapping.values())
        number = value.cast("double")
        score = F.lit(beyond)
        for threshold in sorted(mapping, key=float, reverse=True):
            score = F.when(number <= float(threshold), mapping[threshold]).otherwise(score)
    else:
        raise ValueError(f"unsupported criterion type: {criterion['type']}")
    return F.when(value.isNull(), MISSING_SCORE).otherwise(score)


def raw_score(df: DataFrame, config: dict[str, Any]) -> Column:
    total = F.lit(0.0)
    for criterion in validate_config(config)["criteria"]:
        value = dot_path(df.schema, criterion["data_key"])
        total = total + criterion_score(criterion, value) * F.lit(float(criterion["weight"]))
    return total - F.lit(5.0)


def criterion_scores(df: DataFrame, config: dict[str, Any], keys: list[str]) -> DataFrame:
    """Long form: one row per incident and criterion, with its weight."""
    entries = [
        F.struct(
            F.lit(c["name"]).alias("criterion"),
            criterion_score(c, dot_path(df.schema, c["data_key"])).alias("score"),
            F.lit(float(c["weight"])).alias("weight"),
        )
        for c in validate_config(config)["criteria"]
    ]
    return df.select(*keys, F.explode(F.array(*entries)).alias("e")).select(*keys, "e.*")


def score_incidents(
    incidents: DataFrame, scorer: dict[str, Any] | Callable | None = None
) -> DataFrame:
    """Predictions (instance_id, confidence_score, raw_score) for incident rows.

    ``scorer`` is a criteria configuration, evaluated as one projection, or a function from an
    iterator of pandas frames to an iterator of prediction frames, for a model of another kind.
    """
    if callable(scorer):
        return incidents.mapInPandas(scorer, PREDICTION)
    raw = raw_score(incidents, scorer or DEFAULT_CONFIG)
    named = dot_path(incidents.schema, "cluster_id")
    return incidents.select(
        F.coalesce(named.cast("string"), F.lit("unknown_instance")).alias("instance_id"), raw.alias("raw_score")
    ).select("instance_id", sigmoid(F.col("raw_score")).alias("confidence_score"), "raw_score")


def risk_tier(score: Column) -> Column:
    known = F.coalesce(score, F.lit(0.0))
    return F.when(known > 0.75, "High").when(known > 0.5, "Moderate").otherwise("Low")


def risk_colour(score: Column) -> Column:
    known = F.coalesce(score, F.lit(0.0))
    return F.when(known > 0.75, "red").when(known > 0.5, "orange").otherwise("green")
