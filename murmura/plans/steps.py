"""The review pipeline by steps. Tables stand only where one step hands over to another; a table that is complete is not made again."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.functions.times import parse
from murmura.ml import student
from murmura.ml.teacher import Teacher, label
from murmura.operators import aggregate, candidates, lexicon, serving, web
from murmura.sources import reviews

ORDER = ("00", "tag", "01", "02", "03", "05", "web")
# Other names of steps.
ALIASES = {"0": "00", "ingest": "00", "1": "01", "2": "02", "3": "03", "4": "03", "04": "03", "5": "05", "aggregate": "05"}
NEEDS = {"00": (), "tag": ("00",), "01": ("tag",), "02": ("01",), "03": ("01", "02"), "05": ("03",), "web": ("03",)}
KEY = ["doc_id", "sentence_idx", "hit_term"]


def normal_steps(text: str) -> list[str]:
    """Step names out of a list with commas, each once, in the order they run."""
    asked = [ALIASES.get(t.strip().lower(), t.strip().lower()) for t in text.split(",") if t.strip()]
    unknown = [t for t in asked if t not in ORDER]
    if unknown:
        raise ValueError(f"no such step: {', '.join(unknown)}")
    return [s for s in ORDER if s in asked]


def with_needs(steps: list[str]) -> list[str]:
    """The steps and those that they build on."""
    out = set(steps)
    for s in reversed(ORDER):
        if s in out:
            out |= set(NEEDS[s])
    return [s for s in ORDER if s in out]


@dataclass
class Run:
    """One run in a workspace."""

    spark: SparkSession
    source: str
    workspace: str
    domain: str
    terms: DataFrame
    teacher: Teacher
    threshold: float = 0.7
    samples: int = 2000
    shards: int = 16
    done: list[str] = field(default_factory=list)

    def path(self, name: str) -> str:
        return f"{self.workspace}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def complete(self, name: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name) + "/_SUCCESS")
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def write(self, name: str, made: Callable[[], DataFrame], *by: str) -> None:
        if not self.complete(name):
            writer = made().write.mode("overwrite").option("compression", "zstd")
            (writer.partitionBy(*by) if by else writer).parquet(self.path(name))

    def run(self, steps: str) -> list[str]:
        for s in with_needs(normal_steps(steps)):
            getattr(self, f"step_{s}")()
            self.done.append(s)
        return self.done

    def step_00(self) -> None:
        self.write("clean_sentences", lambda: reviews.clean_sentences(reviews.records(reviews.files(self.spark, self.source)), self.domain, self.source.removeprefix("file://")))

    def step_tag(self) -> None:
        self.write("aspect_sentences", lambda: lexicon.tag(self.read("clean_sentences"), self.terms))

    def step_01(self) -> None:
        rows = self.read("aspect_sentences")
        self.write("aspect_pairs", lambda: candidates.sharded(rows, KEY, self.shards).repartition("shard"), "shard")
        self.write("train_candidates", lambda: candidates.sample(candidates.single(rows, ["doc_id", "sentence_idx"]), KEY, self.samples))

    def step_02(self) -> None:
        self.write("train_pseudolabel", lambda: label(self.read("train_candidates"), self.teacher, "sentence"))

    def step_03(self) -> None:
        def made() -> DataFrame:
            model = student.train(self.read("train_pseudolabel"), "sentence")
            return student.predict(model, self.read("aspect_pairs"))

        self.write("predictions", made)

    def _preds(self) -> DataFrame:
        return self.read("predictions").withColumn("ts", parse("ctime"))

    def step_05(self) -> None:
        rows = self._preds()
        self.write("aspect_sentiment_all", lambda: aggregate.aggregate_all(rows))
        self.write("aspect_sentiment_hard", lambda: aggregate.aggregate_hard(rows, self.threshold))
        self.write("aspect_sentiment_soft", lambda: aggregate.aggregate_soft(rows))
        weekly, keys = aggregate.timed(rows, "week"), [*aggregate.KEYS, "time_bucket"]
        self.write("ts_all", lambda: aggregate.aggregate_all(weekly, keys))
        self.write("ts_hard", lambda: aggregate.aggregate_hard(weekly, self.threshold, keys))
        self.write("ts_soft", lambda: aggregate.aggregate_soft(weekly, keys))

    def step_web(self) -> None:
        rows = self._preds()
        self.write("web_products", lambda: web.tally(web.bucketed(rows, 10), ["brand", "model"]))
        self.write("web_overall_l1", lambda: web.tally(web.bucketed(rows, 10), ["bucket"]))
        self.write("daily_stats", lambda: serving.daily_stats(rows), "date")

    def manifest(self) -> DataFrame:
        """Rows of each table that is complete."""
        names = ("clean_sentences", "aspect_sentences", "aspect_pairs", "train_candidates", "train_pseudolabel", "predictions")
        parts = [self.read(n).agg(F.count("*").alias("rows")).withColumn("table", F.lit(n)) for n in names if self.complete(n)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
