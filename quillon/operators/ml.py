"""Text models with pyspark.ml: a calibrated classifier and one model per tag."""

from __future__ import annotations

import itertools
import json
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.store import exists


def word_terms(text: Column) -> Column:
    """Words of two characters or more, and pairs of neighbours."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
    pairs = F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)))).otherwise(F.array().cast("array<string>"))
    return F.concat(words, pairs)


def character_terms(text: Column, least: int = 3, most: int = 5) -> Column:
    """Runs of characters within words, each word with a blank on either side."""
    words = F.transform(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+"), lambda w: w != ""), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def runs(n: int) -> Column:
        cut = lambda w: F.when(F.char_length(w) >= n, F.transform(F.sequence(F.lit(1), F.char_length(w) - n + 1), lambda i: F.substr(w, i, F.lit(n)))).otherwise(F.array(w))
        return F.flatten(F.transform(words, cut))

    return F.concat(*[runs(n) for n in range(least, most + 1)])


def features(rows: DataFrame, text: str = "text") -> DataFrame:
    return rows.withColumns({"word_terms": word_terms(F.col(text)), "character_terms": character_terms(F.col(text))})


def _weights() -> Pipeline:
    stages = []
    for name, size in (("word", TERMS), ("character", TERMS)):
        stages += [HashingTF(inputCol=f"{name}_terms", outputCol=f"{name}_tf", numFeatures=size), IDF(inputCol=f"{name}_tf", outputCol=f"{name}_idf"), Normalizer(inputCol=f"{name}_idf", outputCol=f"{name}_norm")]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=["word_norm", "character_norm"], outputCol="features")])


#: Hashed terms of either kind.
TERMS = 1 << 16
#: Fits at a time.
PARALLEL = 8
MACHINES = "k int, label string, a double, b double"


class TextModel:
    """Linear SVMs, one for each label against the rest, with probabilities fitted on out-of-fold margins."""

    def __init__(self, weights: PipelineModel, machines: dict[str, tuple[LinearSVCModel, float, float]]):
        self.weights, self.machines = weights, machines

    def save(self, spark: SparkSession, folder: str, told: object = None) -> None:
        """Write the model in place of one there; ``told``, what training reported, goes to ``meta``."""
        self.weights.write().overwrite().save(f"{folder}/weights")
        rows = []
        for k, (label, (machine, a, b)) in enumerate(sorted(self.machines.items())):
            machine.write().overwrite().save(f"{folder}/machine_{k}")
            rows.append((k, label, a, b))
        spark.createDataFrame([(json.dumps({"labels": sorted(self.machines), "trained_on": told}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/meta")
        spark.createDataFrame(rows, MACHINES).coalesce(1).write.mode("overwrite").json(f"{folder}/labels")

    def scores(self, rows: DataFrame, text: str = "text", column: str = "scores", exclusive: bool = True) -> DataFrame:
        """``rows`` with a map of each label's probability, scaled to a sum of 1 if labels exclude each other."""
        out = self.weights.transform(features(rows, text))
        kept, found = list(rows.columns), {}
        for k, (label, (machine, a, b)) in enumerate(sorted(self.machines.items())):
            machine = machine.setRawPredictionCol(f"raw_{k}").setPredictionCol(f"pred_{k}")
            out = machine.transform(out)
            found[label] = 1 / (1 + F.exp(-(a * vector_to_array(f"raw_{k}")[1] + b)))
        total = sum(found.values(), F.lit(0.0)) if exclusive else F.lit(1.0)
        pairs = itertools.chain.from_iterable((F.lit(label), F.round(p / total, 4)) for label, p in found.items())
        return out.select(*kept, F.create_map(*pairs).alias(column))


def load_model(spark: SparkSession, folder: str) -> TextModel | None:
    """The model saved in a folder; None if there is none."""
    if not exists(spark, f"{folder}/labels/_SUCCESS"):
        return None
    rows = spark.read.schema(MACHINES).json(f"{folder}/labels").collect()
    return TextModel(PipelineModel.load(f"{folder}/weights"), {r["label"]: (LinearSVCModel.load(f"{folder}/machine_{r['k']}"), r["a"], r["b"]) for r in rows})


def _folds(rows: DataFrame, folds: int) -> Column | None:
    """A fold for each text, such that both labels occur in two folds or more; None if none is found, as with one text repeated."""
    for salt in range(16):
        fold = F.pmod(F.xxhash64("text", F.lit(salt)), F.lit(folds))
        spread = [r["label"] for r in rows.select("label", fold.alias("fold")).distinct().collect()]
        if min(spread.count(0.0), spread.count(1.0)) > 1:
            return fold
    return None


def _machine(rows: DataFrame, target: Column, folds: int, iterations: int, pool: ThreadPool) -> tuple[LinearSVCModel, float, float]:
    """A machine and its calibration; without folds, that is fitted on the margins of the rows it has seen."""
    rows = rows.select("features", target.cast("double").alias("label"), "text")
    make, fold = LinearSVC(maxIter=iterations, regParam=0.001), _folds(rows, folds)
    splits = [] if fold is None else [(rows.where(fold != k), rows.where(fold == k)) for k in range(folds)]
    machine, *seen = pool.map(inheritable_thread_target(rows.sparkSession)(make.fit), [rows, *(fitted for fitted, _ in splits)])
    judged = [(m, held) for m, (_, held) in zip(seen, splits)] or [(machine, rows)]
    margins = [m.transform(held).select("label", array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("margin")) for m, held in judged]
    fitted = LogisticRegression(featuresCol="margin", regParam=0.01).fit(reduce(DataFrame.unionAll, margins))
    return machine, float(fitted.coefficients[0]), float(fitted.intercept)


def train_classifier(rows: DataFrame, folds: int = 3, iterations: int = 30) -> tuple[TextModel, dict[str, int]]:
    """Fit on (text, label): two labels or more, each with two rows or more; the rows used by label."""
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2 or min(counts.values()) < 2:
        raise ValueError(f"two labels with two rows each are needed, not {counts}")
    return _train(rows, {label: F.col("label_") == label for label in counts}, "label", folds, iterations), counts


def train_tagger(rows: DataFrame, folds: int = 2, iterations: int = 30) -> tuple[TextModel, list[str]]:
    """Fit on (text, tags): tags with two rows for and two against; the others are returned as skipped."""
    total = rows.count()
    counts = {r["tag"]: r["n"] for r in rows.select(F.explode(F.array_distinct("tags")).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n")).collect()}
    kept = [t for t, n in counts.items() if n >= 2 and total - n >= 2]
    model = _train(rows, {t: F.array_contains("label_", t) for t in kept}, "tags", folds, iterations)
    return model, sorted(set(counts) - set(kept))


def _train(rows: DataFrame, targets: dict[str, Column], label: str, folds: int, iterations: int) -> TextModel:
    own = features(rows.select("text", F.col(label).alias("label_")))
    weights = _weights().fit(own)
    ready = weights.transform(own).select("features", "label_", "text").persist()
    with ThreadPool(PARALLEL) as fits, ThreadPool(PARALLEL) as labels:
        made = labels.map(inheritable_thread_target(rows.sparkSession)(lambda target: _machine(ready, target, folds, iterations, fits)), targets.values())
    ready.unpersist()
    return TextModel(weights, dict(zip(targets, made)))
