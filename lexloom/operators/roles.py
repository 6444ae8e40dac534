"""Roles of sentences and chunks: by nearest centroid, and by a trained classifier."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from lexloom.functions.vectors import argmax, cosine, softmax


def nearest_centroid(rows: DataFrame, centroids: dict[str, list[float]], vector: str = "v", role: str = "role") -> DataFrame:
    """With the role whose centroid has the largest cosine, the first of equals. The centroids are constants of the plan."""
    scores = F.array(*[F.struct(cosine(vector, F.array(*[F.lit(float(x)) for x in c])).alias("s"), F.lit(-i).alias("o"), F.lit(name).alias("role")) for i, (name, c) in enumerate(centroids.items())])
    return rows.withColumn(role, F.array_max(scores)["role"])


def classifier(features: int = 1 << 14) -> Pipeline:
    """Words hashed to counts, and logistic regression; an untrained pipeline over (text, role)."""
    labels = StringIndexer(inputCol="role", outputCol="label", handleInvalid="skip", stringOrderType="alphabetAsc")
    return Pipeline(stages=[labels, RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"\W+"), HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features), LogisticRegression(featuresCol="_tf", maxIter=20)])


def train(rows: DataFrame, features: int = 1 << 14) -> PipelineModel:
    return classifier(features).fit(rows.where("text is not null and role is not null"))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """With predicted_role, its confidence, and the probabilities of all roles."""
    for stage in model.stages[1:]:
        rows = stage.transform(rows)
    named = IndexToString(inputCol="prediction", outputCol="predicted_role", labels=model.stages[0].labels).transform(rows)
    each = _to_array("probability")
    top = F.array_max(each)
    names = F.array(*(F.lit(x) for x in model.stages[0].labels))
    return named.withColumn("probabilities", F.map_from_arrays(names, F.transform(each, lambda p: F.round(p, 6)))).withColumn("confidence", F.round(top, 4)).drop("_words", "_tf", "rawPrediction", "probability", "prediction")


def _to_array(column: str):
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(column)


def classified(rows: DataFrame, make_model: Callable[[], Callable[[list[str]], np.ndarray]], names: list[str], text: str = "text", limit: int = 512, batch: int = 32) -> DataFrame:
    """rows with predicted_role, confidence and probabilities by a model from outside.

    make_model() is called once in each Python worker and gives a function from a list of texts to a matrix of scores, a column for each
    name; scores become probabilities by softmax. Texts are cut to `limit` words (of anything but white space), and come sorted by
    their length within a task, so that those of a batch are alike. A null text is empty. Equal scores give the first name.
    """
    cut = F.regexp_extract(F.coalesce(F.col(text), F.lit("")), rf"^(?:\s*\S+){{0,{limit}}}", 0)

    def make() -> Callable[[np.ndarray], np.ndarray]:
        model = make_model()
        return lambda texts: np.asarray(model([str(t) for t in texts.ravel()]), dtype=np.float64)

    score = predict_batch_udf(make, return_type=ArrayType(DoubleType()), batch_size=batch)
    scored = rows.withColumn("_cut", cut).sortWithinPartitions(F.length("_cut")).withColumn("_p", score("_cut")).withColumn("_p", softmax(F.col("_p")))
    all_ = F.array(*(F.lit(n) for n in names))
    return scored.withColumns({"predicted_role": F.element_at(all_, argmax("_p") + 1), "confidence": F.round(F.array_max("_p"), 4), "probabilities": F.map_from_arrays(all_, F.transform("_p", lambda p: F.round(p, 6)))}).drop("_cut", "_p")


def distribution(rows: DataFrame, role: str = "role") -> DataFrame:
    return rows.groupBy(role).agg(F.count("*").alias("n"))


def label_codes(rows: DataFrame, label: str) -> DataFrame:
    """Distinct labels with numbers from 0 in their order."""
    sorted_ = F.array_sort(F.collect_set(label))
    return rows.agg(sorted_.alias("a")).select(F.posexplode("a").alias("code", label))


def accuracy(rows: DataFrame, truth: str = "role", predicted: str = "predicted_role") -> DataFrame:
    """(n, accuracy): the share of rows whose prediction is the truth; rows without a truth don't count, and of nothing it is null."""
    known = rows.where(F.col(truth).isNotNull())
    return known.agg(F.count("*").alias("n"), F.avg(F.coalesce(F.col(truth) == F.col(predicted), F.lit(False)).cast("double")).alias("accuracy"))


def classify_chunks(model: PipelineModel, chunks: DataFrame, name: str = "role_prediction") -> DataFrame:
    """chunks with a struct of their role and its confidence."""
    out = predict(model, chunks)
    return out.withColumn(name, F.struct(F.col("predicted_role").alias("role"), "confidence")).drop("predicted_role", "confidence", "probabilities")


def training_rows(chunks: DataFrame, text: str = "text", role: str = "role", names: list[str] | None = None) -> DataFrame:
    """(text, role, label) of annotated chunks: label is the role's place among the names, by default all roles in their order; rows of other
    roles, or without text, are left out."""
    rows = chunks.select(F.col(text).alias("text"), F.col(role).alias("role")).where("text is not null and role is not null")
    if names is not None:
        return rows.where(F.col("role").isin(*names)).withColumn("label", (F.array_position(F.array(*(F.lit(x) for x in names)), F.col("role")) - 1).cast("long"))
    return rows.join(label_codes(rows, "role").select("role", F.col("code").cast("long").alias("label")), "role")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def from_config(spark: SparkSession, config: dict) -> PipelineModel | None:
    """The model that a configuration names: none if roles are disabled; a saved one, which must exist; else one trained on its rows."""
    if not config.get("enabled", True):
        return None
    if config.get("use_finetuned", True):
        at = config.get("finetuned_model_path", "")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at or "missing")
        if not at or not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            raise FileNotFoundError(f"no saved role model at {at!r}")
        return load(at)
    return train(config["rows"])
