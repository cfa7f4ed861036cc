"""Language identification: the family first, then one-versus-one linear SVMs within it."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm._store import saved
from quillon.llm._words import LOWER, NOT_ALNUM, buffers, by_document, find_words, slices

_U = np.uint64
#: Hash buckets of byte trigrams, and as many of words.
BUCKETS = 1 << 16
#: Features that models use: those in most documents of the sample.
FEATURES = 4096
#: Families of ISO 639-1 codes (fixed values); a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro wa",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt uz",
    "indo-aryan": "as bn gu hi mr ne or pa sa sd si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv mg mi ms sm su tl",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().split("-")[0].split("_")[0], lang)


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the trigram at each byte, whether it lies inside its document)."""
    low = LOWER[data[int(offsets[0]) : int(offsets[-1])]].astype(np.uint32)
    inside = np.zeros(len(low), bool)
    if len(low) < 3:
        return np.zeros(len(low), np.int64), inside
    key = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    bucket = np.zeros(len(low), np.int64)
    bucket[:-2] = ((key * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    inside[:] = True
    ends = offsets[1:] - offsets[0]
    for back in (1, 2):
        at = ends - back
        inside[at[at >= 0]] = False
    # A document of one byte has no second last byte of its own: that one may end the document before, which is outside too.
    return bucket, inside


def _word_buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(48)).astype(np.int64)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, features, weights): shares of a document's trigrams and of its words."""
    for rows in batches:
        data, offsets = buffers(rows.column(1))
        names, weights = [], []
        for d in range(rows.num_rows):
            own = offsets[d : d + 2]
            bucket, inside = _trigrams(data, own)
            words = _word_buckets(find_words(data, own, NOT_ALNUM).hashes)
            ids, values = [], []
            for base, found in ((0, bucket[inside]), (BUCKETS, words)):
                at, n = np.unique(found, return_counts=True)
                ids.append(at + base)
                values.append(n / max(1, len(found)))
            names.append(np.concatenate(ids).astype(np.int32))
            weights.append(np.concatenate(values).astype(np.float32))
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(names, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float32()))], ["lang", "features", "weights"])


class Sparse:
    """Rows of a matrix: values of columns[first[r]:first[r + 1]] in row r."""

    def __init__(self, first: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.first, self.columns, self.values, self.width = first, columns, values, width

    def times(self, w: np.ndarray) -> np.ndarray:
        return by_document(self.values * w[self.columns], self.first, np.add, 0)


def linear_svm(x: Sparse, rows: np.ndarray, y: np.ndarray, c: float = 1.0, epochs: int = 12, seed: int = 7) -> np.ndarray:
    """Weights of an L2-loss linear SVM on some rows of x by dual coordinate descent; y is -1 or 1, classes weigh the same."""
    n = len(y)
    share = {s: n / (2.0 * max(1, int((y == s).sum()))) for s in (-1, 1)}
    shift = np.array([1 / (2 * c * share[int(s)]) for s in y])
    norms = by_document(x.values**2, x.first, np.add, 0)[rows] + shift
    w, alpha, rng = np.zeros(x.width), np.zeros(n), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(n):
            own = slice(x.first[rows[i]], x.first[rows[i] + 1])
            columns, values = x.columns[own], x.values[own]
            g = y[i] * float(values @ w[columns]) - 1 + shift[i] * alpha[i]
            new = max(0.0, alpha[i] - g / norms[i])
            if new != alpha[i]:
                w[columns] += ((new - alpha[i]) * y[i]) * values
                alpha[i] = new
    return w


def _sharpness(margins: np.ndarray, y: np.ndarray) -> float:
    """The slope a of 1 / (1 + exp(-a * margin)) that fits these margins best."""
    a = 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * y * margins, -30, 30)))
        g = ((1 - p) * y * margins).sum() - 0.01 * a
        h = (p * (1 - p) * margins**2).sum() + 0.01
        a = min(max(a + g / h, 0.1), 20.0)
    return float(a)


class Model:
    """Tables of weights by bucket, one column for each pair of families, then of languages of a family."""

    def __init__(self, langs: list[str]):
        self.langs = langs
        self.families = sorted({family_of(x) for x in langs})
        self.members = {f: [x for x in langs if family_of(x) == f] for f in self.families}
        self.pairs = [("", a, b) for a, b in combinations(self.families, 2)]
        for f in self.families:
            self.pairs += [(f, a, b) for a, b in combinations(self.members[f], 2)]
        #: The row of weights of each bucket; the first row, of zeros, is that of buckets not used.
        self.row_of = np.zeros(2 * BUCKETS, np.int32)
        self.weights = np.zeros((1, len(self.pairs)), np.float32)
        self.bias = np.zeros(len(self.pairs))
        self.slope = np.ones(len(self.pairs))

    def fit(self, labels: list[str], used: np.ndarray, places: list[np.ndarray], shares: list[np.ndarray]) -> Model:
        """used: buckets that are features; places and shares: for each row, which of them it has and how much of it they are."""
        n = len(used)
        sizes = np.array([len(p) for p in places])
        first = np.concatenate([[0], np.cumsum(sizes + 1)])
        # Each row's last value is 1, for the constant.
        columns, values = np.full(int(first[-1]), n), np.ones(int(first[-1]))
        inside = np.ones(len(columns), bool)
        inside[first[1:] - 1] = False
        columns[inside], values[inside] = np.concatenate(places), np.concatenate(shares)
        scale = np.sqrt(np.bincount(columns, weights=values**2, minlength=n + 1) / max(1, len(labels))) + 1e-4
        values /= scale[columns] * np.sqrt(n)
        values[~inside] = 1.0
        x = Sparse(first, columns, values, n + 1)
        self.row_of[used] = np.arange(1, n + 1)
        self.weights = np.zeros((n + 1, len(self.pairs)), np.float32)
        lang, family = np.array(labels), np.array([family_of(v) for v in labels])
        for k, (of, a, b) in enumerate(self.pairs):
            group = lang if of else family
            rows = np.flatnonzero((group == a) | (group == b))
            y = np.where(group[rows] == a, 1, -1)
            w = linear_svm(x, rows, y)
            self.slope[k] = _sharpness(x.times(w)[rows], y)
            self.weights[1:, k] = w[:-1] / (scale[:-1] * np.sqrt(n))
            self.bias[k] = w[-1]
        return self

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        bucket, inside = _trigrams(data, offsets)
        words = find_words(data, offsets, NOT_ALNUM)
        at, bucket = offsets - offsets[0], self.row_of[bucket]
        word_at = self.row_of[_word_buckets(words.hashes) + BUCKETS]
        n_tri = np.maximum(1, by_document(inside.astype(np.int64), at, np.add, 0))
        n_word = np.maximum(1, np.diff(words.first))
        out = np.empty((len(offsets) - 1, len(self.pairs)))
        for k in range(len(self.pairs)):
            w = np.ascontiguousarray(self.weights[:, k])
            tri = by_document(np.where(inside, w[bucket], 0).astype(np.float64), at, np.add, 0)
            word = by_document(w[word_at].astype(np.float64), words.first, np.add, 0)
            out[:, k] = tri / n_tri + word / n_word + self.bias[k]
        return out

    def _vote(self, margins: np.ndarray, of: str, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(index of the winner among names, the least probability it has against another)."""
        rows = len(margins)
        votes, total, least = np.zeros((rows, len(names))), np.zeros((rows, len(names))), np.ones((rows, len(names)))
        for k, (f, a, b) in enumerate(self.pairs):
            if f == of and a in names and b in names:
                p = 1 / (1 + np.exp(-np.clip(self.slope[k] * margins[:, k], -30, 30)))
                for name, q in ((a, p), (b, 1 - p)):
                    i = names.index(name)
                    votes[:, i] += q >= 0.5
                    total[:, i] += q
                    least[:, i] = np.minimum(least[:, i], q)
        won = (votes * 1000 + total).argmax(1)
        return won, least[np.arange(rows), won]

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], list[str], np.ndarray]:
        m = self.margins(data, offsets)
        won, score = self._vote(m, "", self.families)
        lang = np.empty(len(won), object)
        for i, f in enumerate(self.families):
            rows = np.flatnonzero(won == i)
            inner, p = self._vote(m[rows], f, self.members[f])
            lang[rows] = np.array(self.members[f], object)[inner]
            score[rows] *= p
        return [self.families[i] for i in won], lang.tolist(), score


def _predict(shared, text: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for rows in batches:
            names = rows.schema.names
            data, offsets = buffers(rows.column(names.index(text)))
            letters = rows.column(names.index("letters_")).to_numpy(zero_copy_only=False)
            kept = [i for i, name in enumerate(names) if name not in ("text_", "letters_")]
            for lo, hi in slices(offsets):
                if model.langs:
                    family, lang, score = model.predict(data, offsets[lo : hi + 1])
                else:
                    family, lang, score = ["und"] * (hi - lo), ["und"] * (hi - lo), np.zeros(hi - lo)
                for i in np.flatnonzero(~letters[lo:hi]):
                    family[i], lang[i], score[i] = "und", "und", 0.0
                columns = [rows.column(i).slice(lo, hi - lo) for i in kept] + [pa.array(family), pa.array(lang), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, [names[i] for i in kept] + ADDED)

    return run


def _select(shared) -> Callable:
    """(lang, features, weights) with the places of the chosen features only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(2 * BUCKETS, -1, np.int32)
        place[shared.value] = np.arange(len(shared.value), dtype=np.int32)
        for rows in batches:
            features, weights = [], []
            for f, w in zip(rows.column(1), rows.column(2)):
                own = place[np.asarray(f.values)]
                features.append(own[own >= 0])
                weights.append(np.asarray(w.values)[own >= 0])
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(features, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float32()))], rows.schema.names)

    return run


def train(labelled: DataFrame, per_language: int = 1000) -> Model:
    """Fit on a bounded sample of (id, text, lang): about ``per_language`` rows of each language.

    The sample is drawn by a hash of id and text, at the rate that each language's
    count asks for, so it is the same at every run and needs no sorting. Rows without
    a language or text are not used. Spark counts in how many sampled rows each bucket
    occurs; the driver gets the FEATURES most frequent ones and the rows' shares of them.
    """
    spark = labelled.sparkSession
    rows = labelled.where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = Model(sorted(counts))
    if len(counts) > 1:
        rate = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, per_language / n))])
        drawn = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000)) < rate[F.col("lang")] * 1_000_000
        kind = "lang string, features array<int>, weights array<float>"
        drawn = saved(rows.where(drawn).select("lang", "text").mapInArrow(_featurise, kind), "language-features")
        often = drawn.select(F.explode("features").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        used = np.sort(often.orderBy(F.col("n").desc(), "bucket").limit(FEATURES).toArrow()["bucket"].to_numpy())
        shared = spark.sparkContext.broadcast(used)
        sample = drawn.mapInArrow(_select(shared), kind).toArrow()
        shared.unpersist()
        features, weights = ([np.asarray(v.values) for v in sample[c].combine_chunks()] for c in ("features", "weights"))
        labels = sample["lang"].to_pylist()
        order = sorted(range(len(features)), key=lambda i: (labels[i], zlib.crc32(weights[i].tobytes(), zlib.crc32(features[i].tobytes()))))
        present = sorted(set(labels))
        model = Model(present)
        if len(present) > 1:
            model.fit([labels[i] for i in order], used, [features[i] for i in order], [weights[i] for i in order])
    return model


ADDED = ["family_pred", "lang_pred", "score"]


def identify(docs: DataFrame, train_on: Column, keep: list[str] | None = None, per_language: int = 1000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` with the columns ``keep`` (default: all) and family_pred, lang_pred and score (0 to 1).

    Models are fitted on rows where ``train_on`` holds; predictions use the text
    alone, all of it. A null text or one without a letter is ``und`` with score 0.
    With one language in the training rows it is predicted throughout, with score 1;
    with none, ``und``. Ties between languages go to the first by name. Repeated rows
    are predicted each; an empty table gives no rows. Columns of the input that are
    named like an added one are replaced.
    """
    labelled = docs.where(train_on).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(train(labelled, per_language))
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters_")
    keep = [c for c in (keep or docs.columns) if c not in ADDED]
    own = [] if text_col in keep else [F.col(text_col).alias("text_")]
    rows = docs.select(*keep, *own, letters)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name not in ("text_", "letters_"))
    return rows.mapInArrow(_predict(model, "text_" if own else text_col), schema + "family_pred string, lang_pred string, score double")
