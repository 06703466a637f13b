"""L1-L4: batch scoring, text classifier, linear head on frozen features, classify texts.

Re-aimed from fine-tuning a network: the learning runs in Spark ML
(distributed ``LogisticRegression``) on features built with native
expressions; arbitrary scorers run in ``mapInPandas`` with one model per task
from a factory, so nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions.text import word_tokens

Scorer = Callable[[pd.DataFrame], pd.DataFrame]


def score_batches(df: DataFrame, scorer_factory: Callable[[], Scorer], schema: str) -> DataFrame:
    """L1: apply a scorer to every Arrow batch (no gradients, no driver round trip)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()  # once per task
        for pdf in batches:
            yield scorer(pdf)
    return df.mapInPandas(run, schema)


def argmax_scorer_factory(id_col: str, array_col: str, out_col: str = "pred") -> Callable[[], Scorer]:
    """A pure scorer: the index of the largest value of an array (first on ties)."""
    def make() -> Scorer:
        def score(pdf: pd.DataFrame) -> pd.DataFrame:
            if len(pdf) == 0:
                return pd.DataFrame({id_col: pdf[id_col], out_col: pd.Series([], dtype="int32")})
            mat = np.vstack([np.asarray(v, dtype=np.float64) for v in pdf[array_col]])
            return pd.DataFrame({id_col: pdf[id_col].values,
                                 out_col: mat.argmax(axis=1).astype("int32")})
        return score
    return make


def text_classifier(num_features: int = 1 << 18, max_iter: int = 50, reg: float = 0.0,
                    tokens_col: str = "tokens", label_col: str = "label") -> Pipeline:
    """L2 estimator: word tokens -> HashingTF -> IDF -> logistic regression."""
    return Pipeline(stages=[
        HashingTF(inputCol=tokens_col, outputCol="_wm_tf", numFeatures=num_features),
        IDF(inputCol="_wm_tf", outputCol="_wm_features"),
        LogisticRegression(featuresCol="_wm_features", labelCol=label_col, maxIter=max_iter,
                           regParam=reg, predictionCol="prediction",
                           probabilityCol="probability", rawPredictionCol="raw"),
    ])


def with_word_tokens(df: DataFrame, text_col: str, tokens_col: str = "tokens",
                     max_length: int | None = None) -> DataFrame:
    """Word tokens, cut to ``max_length``. Padding up to it adds nothing to a bag of words,
    so no pad tokens are made."""
    toks = word_tokens(text_col)
    return df.withColumn(tokens_col, toks if max_length is None else F.slice(toks, 1, max_length))


def longest_text(df: DataFrame, text_col: str) -> int:
    """The number of word tokens of the longest text: the cap of L4 after training on ``df``."""
    return int(df.agg(F.coalesce(F.max(F.size(word_tokens(text_col))), F.lit(0)).alias("m")).first()["m"])


def fit_text_classifier(train: DataFrame, text_col: str, label_col: str, max_length: int | None = None,
                        **kw) -> PipelineModel:
    """L2: fit on the training rows."""
    t = with_word_tokens(train, text_col, max_length=max_length).withColumn(
        label_col, F.col(label_col).cast("double"))
    return text_classifier(label_col=label_col, **kw).fit(t)


def classify(model: PipelineModel, df: DataFrame, text_col: str, out_col: str = "pred",
             max_length: int | None = None, probs_col: str | None = None) -> DataFrame:
    """L4 core: predicted class id per text; ``probs_col`` adds the class probabilities."""
    out = model.transform(with_word_tokens(df, text_col, max_length=max_length))
    out = out.withColumn(out_col, F.col("prediction").cast("int"))
    if probs_col:
        out = out.withColumn(probs_col, vector_to_array("probability"))
    return out.drop("tokens", "_wm_tf", "_wm_features", "raw", "probability", "prediction")


def fit_linear_head(train: DataFrame, features_col: str, label_col: str,
                    max_iter: int = 100, reg: float = 0.0):
    """L3: multinomial logistic regression on frozen feature arrays."""
    x = train.withColumn("_wm_v", array_to_vector(features_col)).withColumn(
        label_col, F.col(label_col).cast("double"))
    lr = LogisticRegression(featuresCol="_wm_v", labelCol=label_col, family="multinomial",
                            maxIter=max_iter, regParam=reg)
    return lr.fit(x)


def apply_linear_head(model, df: DataFrame, features_col: str, out_col: str = "pred",
                      probs_col: str | None = None) -> DataFrame:
    x = model.transform(df.withColumn("_wm_v", array_to_vector(features_col)))
    x = x.withColumn(out_col, F.col("prediction").cast("int"))
    if probs_col:
        x = x.withColumn(probs_col, vector_to_array("probability"))
    return x.drop("_wm_v", "rawPrediction", "probability", "prediction")


def quality_by(df: DataFrame, group_cols: Sequence[str], probs_col: str = "probs", pred_col: str = "pred",
               label_col: str = "label", floor: float = 1e-15) -> DataFrame:
    """Rows, mean cross-entropy of the labels, accuracy and the share of the largest class."""
    p = F.greatest(F.element_at(probs_col, F.col(label_col).cast("int") + 1), F.lit(floor))
    per_class = df.groupBy(*group_cols, label_col).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(-F.log(p)).alias("_l"),
        F.count_if(F.col(pred_col) == F.col(label_col)).alias("_c"))
    return per_class.groupBy(*group_cols).agg(
        F.sum("_n").alias("n_rows"), (F.sum("_l") / F.sum("_n")).alias("loss"),
        (F.sum("_c") / F.sum("_n")).alias("accuracy"), (F.max("_n") / F.sum("_n")).alias("majority"))


def accuracy_by(df: DataFrame, group_cols: Sequence[str], pred_col: str = "pred",
                label_col: str = "label") -> DataFrame:
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.try_divide(F.count_if(F.col(pred_col) == F.col(label_col)), F.count(F.lit(1))).alias("accuracy"))
