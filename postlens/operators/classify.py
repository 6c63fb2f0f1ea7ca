"""Training and applying the topic classifier."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, IndexToString, SQLTransformer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.operators.evaluate import classification_metrics
from postlens.operators.features import gram_counting, gram_weighting, hashed_stages, word_stage
from postlens.operators.labels import is_trainable
from postlens.session import kept

PREDICTED = "ml_predicted_label"
GIVEN_TEXT = "_given_text"
# Marks the rows of a table of term counts that train or test.
TRAINS = "_trains"
# Columns the stages add that no caller needs.
INNER_COLUMNS = ("words", "pairs", "grams", "raw_features", "weighted_features", "features", "rawPrediction", "probability", "prediction")


@dataclass(frozen=True)
class TrainedModel:
    """A model that turns a text into a label, its test metrics, and the predictions of all posts if they were asked for."""

    model: PipelineModel
    metrics: dict[str, float | int]
    predicted: DataFrame | None = None


def train(
    posts: DataFrame,
    label_col: str = "weak_label",
    text_col: str = "text",
    split_col: str = "split",
    features: str = "hashed",
    other: str = "other",
    min_rows: int = 10,
    max_iter: int | None = None,
    predict: Sequence[str] | None = None,
) -> TrainedModel:
    """Fit on the train rows of the labelled posts, measure on their test rows.

    ``features="hashed"``: hashed words, ridge weight 0.01, 50 iterations. ``features="grams"``: 1- and 2-grams over
    a vocabulary, ridge weight 1 / rows on unscaled features, 1,000 iterations.

    The label indexer sees training labels only and is not part of the model, so no class stands for unseen labels and
    every post gets a real label. The labelling keywords are part of the text, so the accuracy is optimistic.

    The texts are read once: a table of label, side and term counts is written to the shared folder (with ``grams`` one of
    the words before it, from which the vocabulary is made), and weights, fit and metrics read that.

    With ``predict``, columns of the posts, the table holds the other posts too, and ``predicted`` gives these columns of
    every post and its label from the table: what ``apply_model`` says, without reading the texts again.
    """
    columns = list(dict.fromkeys([label_col, split_col, *(predict or ()), TRAINS]))
    given = posts.withColumn(TRAINS, F.coalesce(is_trainable(text_col, label_col, other), F.lit(False)))
    given = given.filter(TRAINS) if predict is None else given.withColumn(text_col, F.coalesce(text_col, F.lit("")))
    if features == "hashed":
        counting = hashed_stages(text_col)[:2]
        every = kept(PipelineModel(counting).transform(given).select(*columns, "raw_features"), "training-rows")
    elif features == "grams":
        every = kept(word_stage(text_col).transform(given).select(*columns, "words"), "training-words")
    else:
        raise ValueError(f"unknown features: {features}")
    rows = every.filter(TRAINS)
    # One pass gives the sizes of both sides and the label order; there are as many rows as labels.
    by_label = rows.groupBy(label_col).agg(
        F.count_if(F.col(split_col) == "train").alias("train_rows"), F.count_if(F.col(split_col) == "test").alias("test_rows")
    ).collect()
    train_rows, test_rows = (sum(row[side] for row in by_label) for side in ("train_rows", "test_rows"))
    if train_rows + test_rows < min_rows:
        raise ValueError(f"not enough labelled posts to train a classifier: need {min_rows}")
    known = sorted((row for row in by_label if row["train_rows"]), key=lambda row: (-row["train_rows"], row[label_col]))
    names = [row[label_col] for row in known]
    indexer = StringIndexerModel.from_labels(names, inputCol=label_col, outputCol="label", handleInvalid="error")
    fits = F.col(split_col) == "train"
    if features == "hashed":
        learner = LogisticRegression(maxIter=max_iter or 50, regParam=0.01)
        weighting = [IDF(inputCol="raw_features", outputCol="features").fit(rows.filter(fits))]
    else:
        learner = LogisticRegression(maxIter=max_iter or 1000, regParam=1.0 / train_rows, standardization=False)
        grams = gram_counting(rows.filter(fits))
        every = kept(PipelineModel(grams).transform(every).select(*columns, "raw_features"), "training-rows")
        rows = every.filter(TRAINS)
        counting, weighting = [word_stage(text_col), *grams], gram_weighting(rows.filter(fits))
    weighted = PipelineModel(weighting).transform(every)
    fitted = learner.fit(indexer.transform(weighted.filter(F.col(TRAINS) & fits)).select("label", "features"))
    decoder = IndexToString(inputCol="prediction", outputCol=PREDICTED, labels=names)
    # A null text counts as empty when the model is applied; the marker is gone again before the text is.
    filler = SQLTransformer(statement=f"SELECT * EXCEPT ({text_col}), {text_col} AS {GIVEN_TEXT}, coalesce({text_col}, '') AS {text_col} FROM __THIS__")
    restore = SQLTransformer(statement=f"SELECT * EXCEPT ({text_col}, {GIVEN_TEXT}), {GIVEN_TEXT} AS {text_col} FROM __THIS__")
    model = PipelineModel([filler, *counting, *weighting, fitted, decoder, restore])
    answers = PipelineModel([fitted, decoder])
    tested = answers.transform(weighted.filter(F.col(TRAINS) & (F.col(split_col) == "test")))
    scores = classification_metrics(tested, label_col).first()
    metrics = {
        "f1": scores["f1"],
        "accuracy": scores["accuracy"],
        "train_rows": train_rows,
        "test_rows": test_rows,
    }
    return TrainedModel(model, metrics, None if predict is None else answers.transform(weighted).select(*predict, PREDICTED))


def apply_model(model: PipelineModel, posts: DataFrame) -> DataFrame:
    """All posts with their predicted label."""
    added = model.transform(posts).drop(*[c for c in INNER_COLUMNS if c not in posts.columns])
    return added.select(*posts.columns, *[c for c in added.columns if c not in posts.columns])


def metrics_frame(posts: DataFrame, trained: TrainedModel, **extra: str) -> DataFrame:
    """The metrics as a one-row frame."""
    values = {**trained.metrics, **extra}
    types = {int: "BIGINT", float: "DOUBLE", str: "STRING"}
    schema = ", ".join(f"{name} {types.get(type(value), 'DOUBLE')}" for name, value in values.items())
    return posts.sparkSession.createDataFrame([tuple(values.values())], schema)
