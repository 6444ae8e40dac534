"""The language of texts: by frequent words, and by a model of runs of characters."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

#: Characters of a text's beginning that decide.
HEAD = 2000
# Frequent words of each language.
COMMON = {
    "de": "der die und den das ist nicht von sich mit dem ein eine auf für im zu als auch wird".split(),
    "en": "the of and to is in that it was for on are with as this be by from at have".split(),
    "es": "que el los las y del por una con se lo su para es como más pero sus ha me".split(),
    "fr": "les des et est une du le dans qui pour pas au sur plus par ce il sont avec ne".split(),
    "it": "che di il della per un non sono gli del nel con alla dei anche più questo ma le si".split(),
    "pt": "que o os as não uma do da em para com na no dos mais como ao ele das seu".split(),
}


def by_words(text: Column | str, common: dict[str, list[str]] = COMMON, head: int = HEAD) -> Column:
    """(lang, prob): the language of which most words of the text's beginning are frequent ones, the first of equals, and its share of
    all hits, to 4 places; (unknown, 0) without hits or text. In the JVM alone."""
    words = F.split(F.lower(F.substring(text, 1, head)), r"[^\p{L}]+")

    def hits(own: list[str]) -> Column:
        return F.size(F.filter(words, lambda x: x.isin(*own)))

    scores = F.array(*(F.struct(hits(own).alias("s"), F.lit(-i).alias("o"), F.lit(lang).alias("lang")) for i, (lang, own) in enumerate(common.items())))
    total = F.aggregate(scores, F.lit(0), lambda a, x: a + x["s"])
    best = F.array_max(scores)
    found = F.struct(best["lang"].alias("lang"), F.round(best["s"] / total, 4).alias("prob"))
    return F.when(F.coalesce(best["s"] > 0, F.lit(False)), found).otherwise(F.struct(F.lit("unknown").alias("lang"), F.lit(0.0).alias("prob")))


def _runs(rows: DataFrame, text: str, head: int) -> DataFrame:
    plain = F.concat(F.lit(" "), F.lower(F.regexp_replace(F.substring(F.coalesce(text, F.lit("")), 1, head), r"[^\p{L}]+", " ")), F.lit(" "))
    # Characters are taken apart once: a substring by place is counted from the text's beginning, which takes time by its square.
    grams = F.expr("if(size(_chars) < 3, array(array_join(_chars, '')), transform(slice(_chars, 1, greatest(size(_chars) - 2, 0)), (c, i) -> concat(c, _chars[i + 1], _chars[i + 2])))")
    return rows.withColumn("_chars", F.split(plain, "")).withColumn("_grams", grams).drop("_chars")


def train(rows: DataFrame, text: str = "text", lang: str = "lang", head: int = HEAD, features: int = 1 << 14) -> PipelineModel:
    """A model of the runs of three characters of labelled texts; rows of null text or language are left out."""
    labelled = _runs(rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("_text"), F.col(lang).alias("_lang")), "_text", head)
    return Pipeline(stages=[StringIndexer(inputCol="_lang", outputCol="_label", stringOrderType="alphabetAsc"), HashingTF(inputCol="_grams", outputCol="_tf", numFeatures=features), NaiveBayes(featuresCol="_tf", labelCol="_label", predictionCol="_prediction", probabilityCol="_probability", rawPredictionCol="_raw")]).fit(labelled)


def detect(model: PipelineModel, rows: DataFrame, text: str = "text", head: int = HEAD) -> DataFrame:
    """rows with language and language_confidence (to 4 places); texts without letters are `unknown` with 0."""
    out = _runs(rows, text, head)
    for stage in model.stages[1:]:
        out = stage.transform(out)
    labels = F.array(*(F.lit(x) for x in model.stages[0].labels))
    some = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    out = out.withColumn("language", F.when(some, F.element_at(labels, F.col("_prediction").cast("int") + 1)).otherwise("unknown"))
    out = out.withColumn("language_confidence", F.when(some, F.round(F.array_max(vector_to_array("_probability")), 4)).otherwise(0.0))
    return out.drop("_grams", "_tf", "_raw", "_probability", "_prediction")
