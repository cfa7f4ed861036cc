"""Toxicity categories by a chain of linear classifiers."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm._store import saved
from quillon.llm._words import NOT_ALNUM, buffers, find_words, inner_windows, slices
from quillon.llm.ppm import Table

_U = np.uint64
#: Features are told apart by so many bits of their hash.
FEATURE_BITS = _U(31)
#: Beginnings of words, in bytes, that are features beside whole words: compounds and inflections share them.
BEGINNINGS = (5, 6, 7)
#: Bytes of the windows inside words that are features too: words altered at either end share them.
INNER = 5
#: Chi-squared, with one degree of freedom, that a feature must reach: a chance of one in ten thousand.
LEAST_ASSOCIATION = 15.1
#: Features that the models use at most, those of the strongest association: about a megabyte of weights.
FEATURES = 50_000
FOLDS = 5
#: Training rows that one task turns into features. Their files are then as many as the sample asks for, however many parts the documents come in.
PER_TASK = 500
#: What the labels do not name is graded: toxic texts of which a large share are cues, and those with many kinds of cue.
GRADES = ("dense", "varied")


class Rows:
    """Training rows as sparse columns: ``value`` of ``column`` in row ``owner``; and dense columns beside them."""

    def __init__(self, owner: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, columns: int, dense: np.ndarray | None = None):
        self.owner, self.column, self.value, self.rows, self.columns = owner, column, value, rows, columns
        self.dense = np.ones((rows, 1)) if dense is None else dense

    @staticmethod
    def of(x: np.ndarray) -> Rows:
        """A small dense matrix."""
        none = np.zeros(0, np.int64)
        return Rows(none, none, np.zeros(0), len(x), 0, np.hstack([x, np.ones((len(x), 1))]))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=self.value * w[self.column], minlength=self.rows) + self.dense @ w[self.columns :]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.column, weights=self.value * r[self.owner], minlength=self.columns), self.dense.T @ r])

    def magnitude(self) -> Rows:
        return Rows(self.owner, self.column, np.abs(self.value), self.rows, self.columns, np.abs(self.dense))

    def beside(self, extra: np.ndarray) -> Rows:
        """With one more dense column, before the constant, which stays the last."""
        return Rows(self.owner, self.column, self.value, self.rows, self.columns, np.hstack([self.dense[:, :-1], extra[:, None], self.dense[:, -1:]]))

    def only(self, rows: np.ndarray, columns: np.ndarray) -> Rows:
        """The rows that a mask keeps, and the values of the columns that one keeps."""
        place = np.cumsum(rows) - 1
        keep = rows[self.owner] & columns[self.column]
        return Rows(place[self.owner[keep]], self.column[keep], self.value[keep], int(rows.sum()), self.columns, self.dense[rows])


def logistic(x: Rows, y: np.ndarray, penalty: float = 0.05, steps: int = 120, tolerance: float = 1e-2) -> np.ndarray:
    """Weights, the last for the constant, of a logistic regression by accelerated gradient steps."""
    size = x.columns + x.dense.shape[1]
    keep = np.full(size, penalty)
    keep[-1] = 1e-3
    # A diagonal that bounds the curvature: rare features then take longer steps than frequent ones.
    row_sums = np.bincount(x.owner, weights=np.abs(x.value), minlength=x.rows) + np.abs(x.dense).sum(1)
    step = 1 / (0.25 * x.magnitude().back(row_sums) + keep)
    w = ahead = np.zeros(size)
    for k in range(steps):
        new = ahead - step * (x.back(probability(x, ahead) - y) + keep * ahead)
        moved = float(np.abs(new - w).max())
        w, ahead = new, new + (k / (k + 3)) * (new - w)
        if moved < tolerance:
            break
    return w


def probability(x: Rows, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x.times(w), -30, 30)))


def association(present: np.ndarray, total: np.ndarray, rows: int, positive: int) -> np.ndarray:
    """Chi-squared of a feature's presence and a category; present: in positive rows, total: in all."""
    a, b = present.astype(float), (total - present).astype(float)
    c, d = positive - a, (rows - positive) - b
    under = (a + b) * (c + d) * positive * (rows - positive)
    return np.where(under > 0, rows * (a * d - b * c) ** 2 / np.maximum(under, 1), 0.0)


def _chi_squared(present: Column, total: Column, rows: int, positive: int) -> Column:
    """association() as a Column."""
    a, b = present.cast("double"), (total - present).cast("double")
    c, d = F.lit(float(positive)) - a, F.lit(float(rows - positive)) - b
    under = (a + b) * (c + d) * F.lit(float(positive)) * F.lit(float(rows - positive))
    return F.when(under > 0, F.lit(float(rows)) * F.pow(a * d - b * c, 2) / under).otherwise(0.0)


class Chain:
    """A linear model for each category on features and on the probabilities of earlier categories."""

    def __init__(self, names: list[str]):
        self.names = names
        self.features = np.zeros(0, np.uint64)
        self.weights: list[np.ndarray] = [np.append(np.zeros(k), -30.0) for k in range(len(names))]

    def fit(self, features: np.ndarray, x: Rows, labels: np.ndarray, folds: np.ndarray) -> Chain:
        """features: of the columns of x; labels: rows x categories; folds: for out-of-fold probabilities.

        A fold's probabilities are those of a model that has seen neither its rows nor
        columns that only look telling because of them.
        """
        self.features = features.astype(np.uint64)
        self.weights = []
        for k, y in enumerate(labels.T):
            self.weights.append(logistic(x, y))
            if k + 1 == labels.shape[1]:
                break
            unseen = np.zeros(x.rows)
            for fold in np.unique(folds):
                rest = folds != fold
                if not rest.any():
                    unseen[~rest] = y.mean()
                    continue
                seen = rest[x.owner]
                total = np.bincount(x.column[seen], minlength=x.columns)
                present = np.bincount(x.column[seen], weights=y[x.owner[seen]], minlength=x.columns)
                telling = association(present, total, int(rest.sum()), int(y[rest].sum())) >= LEAST_ASSOCIATION
                unseen[~rest] = probability(x.only(~rest, telling), logistic(x.only(rest, telling), y[rest]))
            x = x.beside(unseen)
        return self

    def predict(self, owner: np.ndarray, feature: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        """Probabilities, rows x categories, from the strengths of (row, feature) pairs."""
        out = np.zeros((rows, len(self.names)))
        n = len(self.features)
        for k, w in enumerate(self.weights):
            z = np.bincount(owner, weights=w[feature] * value, minlength=rows) + out[:, :k] @ w[n:-1] + w[-1]
            out[:, k] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def strength(count: np.ndarray, words: np.ndarray) -> np.ndarray:
    """How much a feature stands out that a text of so many words has ``count`` times."""
    return 10 * count / np.sqrt(words + 20)


def grades(x: Rows, counts: np.ndarray, totals: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """rows x GRADES, 0 or 1: toxic rows that hold more cues for their length, and more different ones, than half of them do.

    Cues are the features that stand in more toxic rows than others, whatever their language.
    """
    out = np.zeros((x.rows, len(GRADES)))
    present = np.bincount(x.column, weights=toxic[x.owner], minlength=x.columns)
    total = np.bincount(x.column, minlength=x.columns)
    positive = max(1.0, toxic.sum())
    cue = present / positive > (total - present) / max(1.0, x.rows - positive)
    used = cue[x.column]
    share = np.bincount(x.owner[used], weights=counts[used], minlength=x.rows) / np.maximum(totals, 1)
    kinds = np.bincount(x.owner[used], minlength=x.rows)
    rows = toxic > 0
    for k, measure in enumerate((share, kinds)):
        if rows.any():
            out[:, k] = rows & (measure > np.median(measure[rows]))
    return out


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature) of each word, of its beginnings and of the windows inside it, and the words of each row."""
    words = find_words(data, offsets, NOT_ALNUM, BEGINNINGS)
    counts = np.diff(words.first)
    owner = np.repeat(np.arange(len(counts)), counts)
    inner, at = inner_windows(data, offsets, words, INNER)
    kinds = [words.hashes, *words.beginnings]
    return np.concatenate([np.tile(owner, len(kinds)), owner[at]]), np.concatenate([*kinds, inner]) >> (_U(64) - FEATURE_BITS), counts


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, labels, fold) to (labels, fold, features, counts, total)."""
    for rows in batches:
        data, offsets = buffers(rows.column(0))
        features, counts, totals = [], [], []
        for d in range(rows.num_rows):
            _, found, total = _features(data, offsets[d : d + 2])
            names, n = np.unique(found, return_counts=True)
            features.append(names.astype(np.int32))
            counts.append(n.astype(np.int32))
            totals.append(int(total[0]))
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), pa.array(features, kind), pa.array(counts, kind), pa.array(totals, pa.int64())], ["labels", "fold", "features", "counts", "total"])


def _select(shared) -> Callable:
    """(labels, fold, features, counts, total) with the places of the chosen features only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = shared.value
        for rows in batches:
            places, counts = [], []
            for found, n in zip(rows.column(2), rows.column(3)):
                found, n = np.asarray(found.values), np.asarray(n.values)
                place = np.searchsorted(chosen, found)
                place[place == len(chosen)] = 0
                hit = chosen[place] == found if len(chosen) else np.zeros(len(found), bool)
                places.append(place[hit].astype(np.int32))
                counts.append(n[hit])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(places, kind), pa.array(counts, kind), rows.column(4)], rows.schema.names)

    return run


def _predict(shared, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        table, n = Table(chain.features, np.arange(len(chain.features))), max(1, len(chain.features))
        for rows in batches:
            data, offsets = buffers(rows.column(1))
            for lo, hi in slices(offsets):
                owner, features, totals = _features(data, offsets[lo : hi + 1])
                slot = table.find(features)
                hit = np.flatnonzero(slot >= 0)
                pairs, count = np.unique(owner[hit] * n + table.values[0][slot[hit]], return_counts=True)
                found = chain.predict(pairs // n, pairs % n, strength(count, totals[pairs // n]), hi - lo)
                found[totals == 0] = 0.0
                yield pa.RecordBatch.from_arrays([rows.column(0).slice(lo, hi - lo), *(pa.array(np.ascontiguousarray(c)) for c in found.T)], ["id", *names])

    return run


_TRAINING = "labels array<double>, fold int, features array<int>, counts array<int>, total long"


def train(labelled: DataFrame, names: list[str], decide: str) -> Chain:
    """Fit GRADES, then ``names``, on rows (text, labels array<double> in the order of names, fold).

    Features are counted by Spark; the driver gets those that tell a category apart and,
    for each row, the places of such features in it.
    """
    spark = labelled.sparkSession
    chain = Chain([*GRADES, *names])
    rows = saved(labelled.mapInArrow(_featurise, _TRAINING), "features")
    sums = rows.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(F.col("labels")[k]), F.lit(0.0)).alias(f"y{k}") for k in range(len(names))]).first()
    if not sums["n"]:
        return chain
    each = rows.select("labels", F.explode(F.arrays_zip("features", "counts")).alias("x")).select("labels", F.col("x.features").alias("feature"), F.col("x.counts").alias("count"))
    often = [(least, k) for least in (1, 2, 3) for k in range(len(names))]
    totals = [F.count_if(F.col("count") >= least).alias(f"n{least}") for least in (1, 2, 3)]
    presents = [F.sum(F.when(F.col("count") >= least, F.col("labels")[k]).otherwise(0.0)).alias(f"p{least}_{k}") for least, k in often]
    scores = [_chi_squared(F.col(f"p{least}_{k}"), F.col(f"n{least}"), sums["n"], int(sums[f"y{k}"])) for least, k in often]
    strongest = F.greatest(*scores) if len(scores) > 1 else scores[0]
    telling = each.groupBy("feature").agg(*totals, *presents).select("feature", strongest.alias("score")).where(F.col("score") >= LEAST_ASSOCIATION)
    chosen = np.sort(telling.orderBy(F.col("score").desc(), "feature").limit(FEATURES).toArrow()["feature"].to_numpy().astype(np.int32))
    shared = spark.sparkContext.broadcast(chosen)
    sample = rows.mapInArrow(_select(shared), _TRAINING).toArrow()
    shared.unpersist()
    places, counts = ([np.asarray(v.values) for v in sample[c].combine_chunks()] for c in ("features", "counts"))
    labels = np.array(sample["labels"].to_pylist(), float).reshape(-1, len(names))
    folds, totals = sample["fold"].to_numpy(), sample["total"].to_numpy()
    order = sorted(range(len(places)), key=lambda i: (labels[i].tolist(), folds[i], totals[i], zlib.crc32(counts[i].tobytes(), zlib.crc32(places[i].tobytes()))))
    labels, folds, totals = labels[order], folds[order], totals[order]
    owner = np.repeat(np.arange(len(order)), [len(places[i]) for i in order])
    column, count = (np.concatenate([v[i] for i in order]) for v in (places, counts))
    x = Rows(owner, column, strength(count, totals[owner]), len(order), len(chosen))
    graded = grades(x, count, totals, labels[:, names.index(decide)])
    return chain.fit(chosen, x, np.hstack([graded, labels]), folds)


def classify(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], decide: str, per_class: int = 4000, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, p_<category> for each, <decide>): one row per document; GRADES are the first categories.

    ``categories``, in the order of the chain, are 0/1 expressions over the columns of
    ``labels`` and ``text`` of the labelled documents; ``decide`` is the one whose
    probability of at least ``threshold`` sets the boolean column of its name. Before
    them the chain has GRADES of its positive rows, which are derived from the features
    that tell it apart in any language. Each model sees how often words, their
    beginnings and windows inside them occur, over all of a text, and the earlier
    categories' probabilities: out of fold while training, the chain's own while predicting.

    Models are fitted on a bounded sample of the labelled rows, about ``per_class`` with
    and as many without ``decide``'s label, drawn by a hash of the id. Rows with a null
    label, id or text are not learnt from; of repeated labels of an id the largest value
    of each column counts. Null, empty and wordless texts have probabilities of 0.
    Without labelled rows nothing is toxic. Rows are predicted each, repeated ones
    alike; ids may be null. An empty table gives no rows.
    """
    spark = docs.sparkSession
    names = list(categories)
    known = labels.where(F.col(id_col).isNotNull() & F.col(decide).isNotNull()).select(F.col(id_col).cast("long").alias("id"), *[c for c in labels.columns if c not in (id_col, text_col, "id")])
    known = known.groupBy("id").agg(*[F.max(c).alias(c) for c in known.columns if c != "id"])
    counts = {r["y"]: r["n"] for r in known.groupBy(F.col(decide).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = F.when(F.col(decide).cast("int") == 1, min(1.0, per_class / max(1, counts.get(1, 0)))).otherwise(min(1.0, per_class / max(1, sum(n for y, n in counts.items() if y != 1))))
    drawn = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < rate * 1_000_000)
    # About 2 * per_class rows, by the rates above: small enough for every executor.
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = source.where("text is not null").join(F.broadcast(drawn), "id")
    # Ids may repeat, so their rows are counted; this reads no text.
    tasks = max(1, -(-source.select("id").join(F.broadcast(drawn.select("id")), "id").count() // PER_TASK))
    label = F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in categories.values()])
    labelled = rows.select("text", label.alias("labels"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold"))
    chain = train(labelled.repartition(tasks), names, decide)
    columns = [f"p_{n}" for n in chain.names]
    out = source.select("id", "text").mapInArrow(_predict(spark.sparkContext.broadcast(chain), columns), "id long, " + ", ".join(f"{c} double" for c in columns))
    return out.select(F.col("id").alias(id_col), *columns, (F.col(f"p_{decide}") >= threshold).alias(decide))


def default_categories() -> dict[str, Column]:
    """The one category that the labels name."""
    return {"toxic": F.col("toxic") == 1}
