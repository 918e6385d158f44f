"""M5, M10, F12 with M1: supervised and topic-based tag prediction, scored on held-out rows."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import text
from tagloom.operators import labels, linear, relevance, topics, vectors
from tagloom.operators.membership import filter_by_doc_freq
from tagloom.operators.stats import most_used
from tagloom.session import materialise


@dataclass
class Run:
    """One trained and scored setting. ``predictions``: ``(Id, truth, predicted)`` of the
    test part."""

    name: str
    params: dict[str, Any]
    predictions: DataFrame
    vectorizer: PipelineModel | None = None
    model: relevance.TagModel | topics.TopicModel | None = None

    def score(self) -> DataFrame:
        return labels.jaccard_samples(self.predictions, "truth", "predicted")


def labelled_tokens(
    data: DataFrame, nb_tags: int, body_tokens: str, title_tokens: str,
    body_min_df: float, body_max_df: float, title_min_df: float, title_max_df: float,
    y_tokens: str = "ntags", stratum_tags: int | None = None, fit_on: str = "all",
    title_first: bool = True,
) -> DataFrame:
    """Filtered labels, split part and merged input tokens: ``(Id, truth, tokens, is_test)``,
    written once because vectoriser, fits and scoring all read it.

    ``fit_on='train'`` takes labels and vocabularies from the training part only. The split then cannot
    depend on the labels that are kept, so it is not stratified.
    """
    if fit_on not in ("all", "train"):
        raise ValueError(f"unknown fit_on: {fit_on}")
    narrow = materialise(
        data.select(
            "Id", F.col(y_tokens).alias("_tags"), F.col(f"`{body_tokens}`").alias("_body"),
            F.col(f"`{title_tokens}`").alias("_title"),
        )
    )
    if fit_on == "train":
        parts = labels.split_parts(narrow, "Id", None)
        whole = materialise(narrow.join(parts, "Id"))
        rows = labels.label_filter(whole, "Id", "_tags", nb_tags, "truth", fit_on=whole.where("not is_test"))
    else:
        filtered = labels.label_filter(narrow, "Id", "_tags", nb_tags, "truth")
        key = labels.stratum(F.col("truth"))
        if stratum_tags is not None:
            common = [r.tokens for r in most_used(narrow, "_tags", stratum_tags).select("tokens").collect()]
            key = labels.stratum(F.col("truth"), include=common)
        rows = filtered.join(labels.split_parts(filtered, "Id", key), "Id")
    source = None if fit_on == "all" else materialise(rows.where("not is_test").select("Id", "_body", "_title"))
    rows = filter_by_doc_freq(rows, "Id", "_body", "_b", body_min_df, body_max_df, fit_on=source or narrow)
    rows = filter_by_doc_freq(rows, "Id", "_title", "_t", title_min_df, title_max_df, fit_on=source or narrow)
    order = ("_t", "_b") if title_first else ("_b", "_t")
    merged = text.merge_tokens(*[F.col(c) for c in order])
    return materialise(rows.select("Id", "truth", merged.alias("tokens"), "is_test"))


def score_vectors(
    rows: DataFrame, features: str, classes: list[str], loss: str, max_iter: int, scaler: bool
) -> tuple[DataFrame, PipelineModel | None, relevance.TagModel]:
    """M1 with optional F4 in front; ``rows`` hold ``Id, truth, is_test, <features>``. Few features are standardised as vectors, many
    within the fit, whose weights are then those of the raw features."""
    stages, train = None, rows.where("not is_test")
    if scaler and linear.width_of(train, features) <= vectors.DENSE_FEATURES:
        stages, scaler = vectors.fit_scaler(train, features, "_scaled"), False
        rows, features = stages.transform(rows), "_scaled"
    train = materialise(rows.where("not is_test").select("truth", features))
    model = relevance.fit_tags(train, features, "truth", classes, loss, max_iter, scaler)
    scored = relevance.predict_tags(rows.where("is_test"), features, model)
    return scored.select("Id", "truth", "predicted"), stages, model


def supervised_bow(
    data: DataFrame, *, name: str = "run", nb_tags: int = 50, body_tokens: str = "body-tokens",
    title_tokens: str = "title-tokens", Y_tokens: str = "ntags", body_min_df: float = 0.0,
    body_max_df: float = 1.0, title_min_df: float = 0.0, title_max_df: float = 1.0, vect: str = "count",
    loss: str = "hinge", max_iter: int = relevance.MAX_ITER, scaler: bool = True, fit_on: str = "all", level: float | None = None,
) -> Run:
    """M5. ``level`` keeps the principal components below that share of the variance (F5); the features are
    standardised for them, so ``scaler`` then changes nothing but their scale (and nothing at all with many features)."""
    rows = labelled_tokens(
        data, nb_tags, body_tokens, title_tokens, body_min_df, body_max_df, title_min_df, title_max_df,
        Y_tokens, fit_on=fit_on,
    )
    vectorizer = vectors.fit_vectorizer(rows.where("not is_test"), "tokens", vect, "_bow")
    classes = labels.label_classes(rows, "truth")
    features, reducer = "_bow", None
    if level is not None:
        train = vectorizer.transform(rows.where("not is_test")).select("_bow")
        reducer, kept = vectors.pca_select(train, "_bow", "_components", level)
        if reducer is None:
            raise ValueError(f"no component stays below level {level}")
        features = "_components"
        if isinstance(reducer, PipelineModel):
            vectorizer = PipelineModel([*vectorizer.stages, *reducer.stages])
    if isinstance(reducer, vectors.Components):
        ready = reducer.transform(vectorizer.transform(rows))
        predictions, stages, model = score_vectors(ready, features, classes, loss, max_iter, False)
        # Scores are linear in the components and these in the counts: the model can be kept for the counts alone.
        model = relevance.TagModel(
            classes, reducer.weights @ model.weights, loss, reducer.constants @ model.weights + model.constants, model.gaps
        )
    else:
        predictions, stages, model = score_vectors(
            vectorizer.transform(rows), features, classes, loss, max_iter, scaler
        )
    params = {
        "nb_tags": nb_tags, "body_tokens": body_tokens, "vect": vect, "loss": loss, "scaler": scaler,
        "body_min_df": body_min_df, "body_max_df": body_max_df,
        "title_min_df": title_min_df, "title_max_df": title_max_df, **({"level": level} if level is not None else {}),
    }
    fitted = PipelineModel([*vectorizer.stages, *(stages.stages if stages else [])])
    return Run(name, params, predictions, fitted, model)


def supervised_embedding(
    data: DataFrame, embeddings: DataFrame, *, name: str = "run", nb_tags: int = 50, Y_tokens: str = "ntags",
    embedding: str = "vectors", loss: str = "squared_error", max_iter: int = relevance.MAX_ITER, scaler: bool = False,
) -> Run:
    """F12 + M1: tags from precomputed vectors ``(Id, embedding)``."""
    from pyspark.ml.functions import array_to_vector

    from tagloom.operators.features import embedding_features

    filtered = labels.label_filter(data.select("Id", F.col(Y_tokens).alias("_tags")), "Id", "_tags", nb_tags, "truth")
    parts = labels.split_parts(filtered, "Id", labels.stratum(F.col("truth")))
    rows = embedding_features(embeddings, filtered.join(parts, "Id"))
    vector = array_to_vector(F.transform("embedding", lambda v: v.cast("double")))
    rows = materialise(rows.select("Id", "truth", "is_test", vector.alias("features")))
    classes = labels.label_classes(rows, "truth")
    predictions, stages, model = score_vectors(rows, "features", classes, loss, max_iter, scaler)
    params = {"nb_tags": nb_tags, "vect": embedding, "loss": loss, "scaler": scaler}
    return Run(name, params, predictions, stages, model)


def unsupervised(
    data: DataFrame, *, name: str = "lda", nb_tags: int = 50, body_tokens: str = "body-tokens",
    title_tokens: str = "title-tokens", Y_tokens: str = "ntags", body_min_df: float = 0.0,
    body_max_df: float = 1.0, title_min_df: float = 0.0, title_max_df: float = 1.0, n_term: int = 5,
    num_topics: int = 10, nb_strat: int = 30, passes: int = 20, chunk_size: int = 2000, seed: int = 42,
) -> Run:
    """Topics of the training part; the best terms of a test document are its tags."""
    rows = labelled_tokens(
        data, nb_tags, body_tokens, title_tokens, body_min_df, body_max_df, title_min_df, title_max_df,
        Y_tokens, stratum_tags=nb_strat, title_first=False,
    )
    model = topics.fit_topics(
        rows.where("not is_test"), "tokens", num_topics, passes, chunk_size, seed
    )
    found = topics.predict(rows.where("is_test"), model, n_term=n_term)
    predicted = F.transform("terms", lambda t: t["term"]).alias("predicted")
    params = {"nb_tags": nb_tags, "body_tokens": body_tokens, "n_term": n_term, "num_topics": num_topics}
    return Run(name, params, found.select("Id", "truth", predicted), model=model)
