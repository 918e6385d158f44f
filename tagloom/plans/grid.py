"""Parameter grids, run names, grid runs and their result table.

A grid has one entry per run, so it is driver-side planning data; the runs are Spark jobs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.plans.experiments import Run, supervised_bow, supervised_embedding
from tagloom.sources.results import load_results, save_model, save_results

# The order and labels of the parameters in a run name.
NAME_PARTS = [
    ("Classifier", "loss"), ("Vect", "vect"), ("var-level", "level"), ("nb_tags", "nb_tags"),
    ("body_min_df", "body_min_df"), ("body_max_df", "body_max_df"),
    ("title_min_df", "title_min_df"), ("title_max_df", "title_max_df"),
]
VECTORIZER_NAMES = {"count": "CountVectorizer", "tfidf": "TfidfVectorizer"}
LOSS_NAMES = {"hinge": "SVM", "squared_error": "squared_error"}
SHARES = ("body_min_df", "body_max_df", "title_min_df", "title_max_df")
RESULT_COLUMNS = [
    "classifier", "vectorizer", "nb_tags", "body_tokens", *SHARES, "score", "scaler",
]


def param_grid(values: Mapping[str, Sequence[Any]], defaults: Mapping[str, Any] | None = None) -> list[dict]:
    """Every combination, the last parameter varying fastest, laid over ``defaults``."""
    return [
        {**(defaults or {}), **dict(zip(values, combination))}
        for combination in itertools.product(*values.values())
    ]


def grid_frame(lists: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M12 on a one-row frame of value lists: one row per combination. Lists are unfolded
    one after the other, which needs no join."""
    grid = lists
    for c in columns:
        grid = grid.withColumn(c, F.explode(c))
    return grid.select(*columns)


NAME_DIGITS, TABLE_DIGITS = 3, 4


def shown(key: str, value: Any, digits: int = NAME_DIGITS) -> Any:
    """A parameter value as it appears in names and, with more digits, in tables."""
    if key == "loss":
        return LOSS_NAMES.get(value, value)
    if key == "vect":
        return VECTORIZER_NAMES.get(value, value)
    if key in SHARES:
        return f"{round(100 * value, digits)}%"
    return value


def config_name(*settings: Mapping[str, Any]) -> str:
    """``Classifier-SVM&Vect-...``, only parameters that are set."""
    merged = {k: v for s in settings for k, v in s.items()}
    return "&".join(f"{label}-{shown(key, merged[key])}" for label, key in NAME_PARTS if key in merged)


def config_name_column(columns: Iterable[str]) -> F.Column:
    """M14 on a grid frame, with the names of losses and vectorisers and shares as percentages."""
    present = set(columns)

    def named(key: str) -> F.Column:
        value = F.col(key).cast("string")
        if key in SHARES:
            return F.concat(F.round(100 * F.col(key).cast("double"), NAME_DIGITS).cast("string"), F.lit("%"))
        for old, new in {"loss": LOSS_NAMES, "vect": VECTORIZER_NAMES}.get(key, {}).items():
            value = F.when(F.col(key).cast("string") == old, new).otherwise(value)
        return value

    parts = [F.concat(F.lit(f"{label}-"), named(key)) for label, key in NAME_PARTS if key in present]
    return F.concat_ws("&", *parts)


def run_settings(config: Mapping[str, Any]) -> list[tuple[str, dict]]:
    """Every model setting with every data setting, under a name of its own: parameters
    that vary but have no place in the usual name are added at its end."""
    lists = {**config.get("model_params", {}), **config["params"]}
    named = {key for _, key in NAME_PARTS}
    varying = [key for key, values in lists.items() if len(values) > 1 and key not in named]
    settings = [
        {**m, **d} for m in param_grid(config.get("model_params", {})) for d in param_grid(config["params"])
    ]
    return [
        ("&".join([config_name(s), *(f"{key}-{shown(key, s[key])}" for key in varying)]), s) for s in settings
    ]


def result_row(run: Run) -> DataFrame:
    """One row."""
    p = run.params
    spark = run.predictions.sparkSession
    score = run.score().first()[0]
    known = [str(shown(k, p[k], TABLE_DIGITS)) if k in p else "N.A" for k in SHARES]
    row = (
        shown("loss", p["loss"]), shown("vect", p["vect"]), str(p["nb_tags"]), p.get("body_tokens", "N.A"),
        *known, score, bool(p["scaler"]),
    )
    strings = ", ".join(f"{c} string" for c in RESULT_COLUMNS[:8])
    return spark.createDataFrame([row], f"{strings}, score double, scaler boolean")


def run_grid(data: DataFrame, config: Mapping[str, Any], path: str, embeddings: DataFrame | None = None) -> list[str]:
    """Run every setting; predictions, result rows and models are stored below ``path``
    under the run's name. Returns the names."""
    names = []
    for name, setting in run_settings(config):
        if config.get("type", "bow") == "bow":
            run = supervised_bow(data, name=name, **setting)
        else:
            run = supervised_embedding(data, embeddings, name=name, **setting)
        save_results(run.predictions, f"{path}/predictions", name)
        save_results(result_row(run), f"{path}/results", name)
        if run.vectorizer is not None:
            save_model(data.sparkSession, f"{path}/models/{name}", name, run.vectorizer, run.model)
        names.append(name)
    return names


def results_table(spark, paths: Mapping[str, str | None]) -> DataFrame:
    """Union over experiments ``path -> vectoriser name or None to keep its own``."""
    tables = []
    for path, vectorizer in paths.items():
        table = load_results(spark, f"{path}/results")
        if vectorizer is not None:
            table = table.withColumn("vectorizer", F.lit(vectorizer))
        tables.append(table.select("run", *RESULT_COLUMNS))
    union = tables[0]
    for table in tables[1:]:
        union = union.unionByName(table)
    return union
