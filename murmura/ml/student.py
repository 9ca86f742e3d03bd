"""The student: a multinomial logistic regression over hashed words and word pairs, trained on the teacher's labels."""
from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.operators.candidates import class_weights

LABELS = ("NEG", "NEU", "POS")


def train(rows: DataFrame, text: str, features: int = 1 << 14, iterations: int = 20) -> PipelineModel:
    """Labels weigh as much as each other."""
    weights = class_weights(rows).select("pred_label", "weight")
    number = F.array_position(F.array(*map(F.lit, LABELS)), F.col("pred_label")) - 1
    data = rows.join(F.broadcast(weights), "pred_label").withColumn("label", number.cast("double"))
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"\W+"), NGram(inputCol="__words", outputCol="__pairs"),
        HashingTF(inputCol="__words", outputCol="__f1", numFeatures=features), HashingTF(inputCol="__pairs", outputCol="__f2", numFeatures=features),
        VectorAssembler(inputCols=["__f1", "__f2"], outputCol="features"),
        LogisticRegression(weightCol="weight", maxIter=iterations, family="multinomial", regParam=0.01)]).fit(data)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows with pred_id, pred_label, confidence, p_neg, p_neu, p_pos."""
    p = vector_to_array("probability")
    size = model.stages[-1].numClasses
    out = model.transform(rows).withColumns({f"p_{x.lower()}": (p[i] if i < size else F.lit(0.0)).cast("float") for i, x in enumerate(LABELS)})
    return out.select(
        *rows.columns, F.col("prediction").cast("short").alias("pred_id"), F.array(*map(F.lit, LABELS))[F.col("prediction").cast("int")].alias("pred_label"),
        F.greatest("p_neg", "p_neu", "p_pos").alias("confidence"), "p_neg", "p_neu", "p_pos")
