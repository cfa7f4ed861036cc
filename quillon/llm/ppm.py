"""Language-model scores by prediction by partial matching over byte contexts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm._store import saved
from quillon.llm._words import LOWER, SPACE, Words, buffers, by_document, find_words, slices

_U = np.uint64
BOUNDARY = 256
BITS = _U(9)
ORDER = 5
#: What goes to every executor has so many contexts with a symbol at most: all of them, or the
#: most frequent ones, and then what is left to look up joins tables. Scores are the same.
MODEL_GRAMS = 6_000_000
#: Words whose counts are looked up while scoring: the most frequent ones, so that no frequent
#: word is left to be a hot key of the join with all other counts.
HEAD_WORDS = 1 << 16
#: A counting task merges its counts when so many new keys wait, and passes them on when it holds
#: so many: a worker then needs some 100 MB for them, whatever the size of its part.
MERGE_KEYS = 1_000_000
HELD_KEYS = 2_000_000
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


class Stream(NamedTuple):
    """Symbols of some documents, each after ``order`` boundaries; ``at`` are the positions that are coded."""

    symbols: np.ndarray
    at: np.ndarray
    first: np.ndarray


def stream(data: np.ndarray, offsets: np.ndarray, words: Words, order: int) -> Stream:
    """Lower-cased words with single spaces between and a boundary at the end."""
    base, docs = int(offsets[0]), len(offsets) - 1
    text = LOWER[data[base : int(offsets[-1])]]
    keep = ~SPACE[text]
    counts = np.diff(words.first)
    last = np.zeros(len(words.hashes), bool)
    last[words.first[1:][counts > 0] - 1] = True
    gaps = words.ends[~last] - base
    keep[gaps], text[gaps] = True, 0x20
    width = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    sizes = np.diff(width[words.first]) + np.maximum(counts - 1, 0)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    symbols = np.full(int(starts[-1]) + order * (docs + 1), BOUNDARY, np.uint16)
    where = np.ones(len(symbols), bool)
    # Document d begins after its own order boundaries; where is False on all of them.
    begin = starts[:-1] + order * np.arange(1, docs + 1)
    for j in range(1, order + 1):
        where[begin - j] = False
    where[len(symbols) - order :] = False
    symbols[where] = text[keep]
    where[begin + sizes] = True
    return Stream(symbols, np.flatnonzero(where), starts + np.arange(docs + 1))


def grams(symbols: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The symbol at each position and the ``order`` ones before it, the latest in the lowest bits."""
    wide = symbols.astype(np.uint64)
    keys = wide.copy()
    for j in range(1, order + 1):
        keys[j:] |= wide[:-j] << (BITS * _U(j))
    return keys[at]


class Counter:
    """Counts of 64-bit keys, merged when many have come in; ``full`` asks to take the total and begin anew."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0
        self.full = False

    def add(self, keys: np.ndarray) -> None:
        found = np.unique(keys, return_counts=True)
        self.parts.append(found)
        self.waiting += len(found[0])
        if self.waiting > MERGE_KEYS and len(self.parts) > 1:
            self.parts = [self.total()]
            self.waiting = 0
            self.full = len(self.parts[0][0]) > HELD_KEYS

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """All counts so far; the counter is empty afterwards."""
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.waiting, self.full = [], 0, False
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        counts = counts[order]
        del order
        return summed(keys, counts)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a sorted array and the sums of their counts."""
    if not len(keys):
        return keys, counts
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


_WORD, _GRAM, _DOC = 0, 1, 2


def _count(order: int) -> Callable:
    """(text) of training rows to (kind, key, n): words, contexts with a symbol, and documents; a key may come more than once."""

    def out(kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(keys), 100_000):
            part = keys[lo : lo + 100_000].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(part), pa.array(counts[lo : lo + 100_000].astype(np.int64))], ["kind", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, docs = {_WORD: Counter(), _GRAM: Counter()}, 0
        for rows in batches:
            data, offsets = buffers(rows.column(0))
            docs += rows.num_rows
            for lo, hi in slices(offsets):
                own = offsets[lo : hi + 1]
                found = find_words(data, own)
                text = stream(data, own, found, order)
                counters[_WORD].add(found.hashes)
                counters[_GRAM].add(grams(text.symbols, text.at, order))
                for kind, counter in counters.items():
                    if counter.full:
                        yield from out(kind, *counter.total())
        for kind, counter in counters.items():
            yield from out(kind, *counter.total())
        yield from out(_DOC, np.zeros(1, np.uint64), np.array([docs]))

    return run


class Table:
    """Rows of values by distinct 64-bit keys, probed for whole arrays.

    Keys are sorted by the highest bits of their hashes, about one key for each value of
    these bits, and ``first`` has where each value begins: no slot is left empty.
    """

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        bits = max(4, len(keys).bit_length())
        self.shift = _U(64 - bits)
        home = self._home(keys)
        order = np.argsort(home).astype(np.int32)
        self.first = np.zeros((1 << bits) + 1, np.int32)
        np.cumsum(np.bincount(home, minlength=1 << bits), out=self.first[1:])
        del home
        # One row more: a last empty bucket begins there, and row -1 is there to be read.
        self.keys = np.full(len(keys) + 1, _EMPTY, np.uint64)
        self.keys[:-1] = keys[order]
        self.values = []
        for v in values:
            column = np.zeros(len(keys) + 1, v.dtype)
            column[:-1] = v[order]
            self.values.append(column)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (((keys ^ (keys >> _U(29))) * _U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 if it isn't there."""
        home = self._home(keys)
        out = self.first[home].astype(np.int64)
        pending = np.flatnonzero(self.keys[out] != keys)
        at, end = out[pending] + 1, self.first[home[pending] + 1]
        out[pending] = -1
        while len(pending):
            more = at < end
            pending, at, end = pending[more], at[more], end[more]
            wrong = self.keys[at] != keys[pending]
            out[pending[~wrong]] = at[~wrong]
            pending, at, end = pending[wrong], at[wrong] + 1, end[wrong]
        return out


def _low(symbols: int) -> int:
    """A mask of the last ``symbols`` symbols of a key."""
    return (1 << int(BITS) * symbols) - 1


class Level(NamedTuple):
    """Sorted grams of an order and their counts; the contexts, where each begins, its count and its number of symbols."""

    keys: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    first: np.ndarray
    total: np.ndarray
    kinds: np.ndarray


def _level(keys: np.ndarray, counts: np.ndarray) -> Level:
    contexts = keys >> BITS
    first = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]])) if len(keys) else np.zeros(0, np.int64)
    total = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
    return Level(keys, counts, contexts[first], first, total, np.diff(np.append(first, len(keys))))


def _lower(keys: np.ndarray, k: int) -> Level:
    """The grams of order k - 1, each counted once for every one of order k that ends in it."""
    shorter = keys & _U(_low(k))
    shorter.sort()
    return _level(*summed(shorter, np.ones(len(shorter), np.int64)))


def _escapes(level: Level, low: Level | None, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each context of order k: log escape, log denominator one order below, log escape there."""
    escape = (np.log10(level.kinds) - np.log10(2.0 * level.total)).astype(np.float32)
    if low is None:
        return escape, np.log10(np.maximum(257.0 - level.kinds, 1.0)).astype(np.float32), np.zeros(len(level.kinds), np.float32)
    same = low.counts[np.searchsorted(low.keys, level.keys & _U(_low(k)))]
    same = np.add.reduceat(same, level.first) if len(level.first) else 0
    below = np.searchsorted(low.contexts, level.contexts & _U(_low(k - 1)))
    there = np.log10(2.0 * np.maximum(low.total[below] - same, 1))
    new = low.kinds[below] - level.kinds
    on = np.where(new > 0, np.log10(np.maximum(new, 1)) - there, 0.0)
    return escape, there.astype(np.float32), on.astype(np.float32)


class Model:
    """Escape estimation by method D with update exclusion and symbol exclusion.

    In each context a symbol that was seen c times among n, with t different ones, has
    (2c - 1) / 2n, and the escape t / 2n. Shorter contexts count a symbol once for each
    longer context in which it is new. After an escape, symbols of the longer context
    are excluded: n and t are taken over the others. Below order 0 all symbols that
    are left have equal shares.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int):
        self.order = order
        self.grams: list[Table] = []  # by order: (log probability with nothing excluded, log of 2c - 1)
        self.nodes: list[Table] = []  # by order: (log escape, log denominator one order below, log escape there)
        level = _level(keys, counts)
        # From the longest order down: arrays of two orders at a time, and no more of them than are still needed.
        for k in range(order, -1, -1):
            low = _lower(level.keys, k) if k else None
            self.nodes.append(Table(level.contexts, *_escapes(level, low, k)))
            full = np.log10(np.maximum(1, 2 * level.counts - 1))
            alone = (full - np.repeat(np.log10(2.0 * level.total), level.kinds)).astype(np.float32)
            # Nothing is escaped from before the longest order, so its grams need no second value.
            values = (alone, full.astype(np.float32)) if k < order else (alone,)
            keys, level = level.keys, low
            del full
            self.grams.append(Table(keys, *values))
        self.grams.reverse()
        self.nodes.reverse()

    def log_probability(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's last symbol after its context."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        above = np.full(len(keys), -1)  # slot of the context escaped from, one order higher
        for k in range(self.order, -1, -1):
            mask = (_U(1) << (BITS * _U(k + 1))) - _U(1)
            own = keys[left] & mask
            at = self.grams[k].find(own)
            alone = self.grams[k].values[0]
            escaped = above >= 0
            hit = at >= 0
            begin, after = hit & ~escaped, hit & escaped
            out[left[begin]] += alone[at[begin]]
            if k < self.order:
                _, there, on = self.nodes[k + 1].values
                out[left[after]] += self.grams[k].values[1][at[after]] - there[above[after]]
                out[left[~hit & escaped]] += on[above[~hit & escaped]]
            left, own, escaped = left[~hit], own[~hit], escaped[~hit]
            if not len(left):
                return out
            above = self.nodes[k].find(own >> BITS)
            known = above >= 0
            fresh = known & ~escaped
            out[left[fresh]] += self.nodes[k].values[0][above[fresh]]
        deep = above >= 0
        out[left[deep]] -= self.nodes[0].values[1][above[deep]]
        out[left[~deep]] -= np.log10(257.0)
        return out


class Head:
    """Log probabilities of the most frequent grams of the longest order; others are not a number."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray):
        self.grams = Table(keys, logs)

    def log_probability(self, keys: np.ndarray) -> np.ndarray:
        slot = self.grams.find(keys)
        return np.where(slot >= 0, self.grams.values[0][slot], np.nan)


def _model(shared) -> Model | Head:
    """The model of a broadcast, built once in each worker: it replaces its counts there and goes with the broadcast."""
    held = shared.value
    if "parts" in held:
        kind, *parts = held["parts"]
        held["model"] = kind(*parts)
        del held["parts"]
    return held["model"]


def _tables(grams: DataFrame, order: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """By order, (key, n) of all grams and (context, total, kinds, escape, there, on) of all contexts: Model as tables.

    A shorter gram has 257 longer ones at most, and a context 257 symbols, so no key of these joins and sums is hot.
    """
    levels = [grams]
    for k in range(order, 0, -1):
        shorter = levels[0].groupBy(F.col("key").bitwiseAND(_low(k)).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        levels.insert(0, saved(shorter, f"grams{k - 1}"))
    contexts: list[DataFrame] = []
    for k, level in enumerate(levels):
        sums = [F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")]
        own = F.shiftright("key", int(BITS)).alias("context")
        escape = F.log10("kinds") - F.log10(2.0 * F.col("total"))
        if k:
            lower = levels[k - 1].select(F.col("key").alias("low"), F.col("n").alias("low_n"))
            nodes = level.join(lower, F.col("key").bitwiseAND(_low(k)) == F.col("low")).groupBy(own).agg(*sums, F.sum("low_n").alias("same"))
            below = contexts[k - 1].select(F.col("context").alias("low"), F.col("total").alias("low_total"), F.col("kinds").alias("low_kinds"))
            nodes = nodes.join(F.broadcast(below) if k <= 2 else below, F.col("context").bitwiseAND(_low(k - 1)) == F.col("low"))
            new = F.col("low_kinds") - F.col("kinds")
            there = F.log10(2.0 * F.greatest(F.col("low_total") - F.col("same"), F.lit(1)))
            on = F.when(new > 0, F.log10(F.greatest(new, F.lit(1))) - there).otherwise(0.0)
        else:
            nodes = level.groupBy(own).agg(*sums)
            there, on = F.log10(F.greatest(257.0 - F.col("kinds"), F.lit(1.0))), F.lit(0.0)
        nodes = nodes.select("context", "total", "kinds", escape.alias("escape"), there.alias("there"), on.alias("on"))
        contexts.append(saved(nodes, f"contexts{k}"))
    return levels, contexts


def _alone(grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """(key, n, alone): log10 of the probability of each gram with nothing excluded."""
    total = contexts.select("context", "total")
    return grams.join(total, F.shiftright("key", int(BITS)) == F.col("context")).select("key", "n", (F.log10(2.0 * F.col("n") - 1) - F.log10(2.0 * F.col("total"))).alias("alone"))


def _joined(keys: DataFrame, alone: DataFrame, levels: list[DataFrame], contexts: list[DataFrame]) -> DataFrame:
    """(key, log) of distinct keys of the longest order: Model.log_probability by joins."""
    order = len(levels) - 1
    first = saved(keys.join(alone.select("key", "alone"), "key", "left"), "looked")
    rows = first.where("alone IS NULL").select("key", F.lit(None).cast("double").alias("log"), F.lit(0.0).alias("sofar"), F.lit(None).cast("double").alias("there"), F.lit(None).cast("double").alias("on"))
    for k in range(order, -1, -1):
        small = F.broadcast if k <= 1 else (lambda t: t)  # 257 * 257 rows at most; longer ones are shuffled
        nodes = contexts[k].select("context", F.col("total").alias("own_total"), F.col("escape").alias("own_escape"), F.col("there").alias("own_there"), F.col("on").alias("own_on"))
        rows = rows.join(small(nodes), F.shiftright(F.col("key").bitwiseAND(_low(k + 1)), int(BITS)) == F.col("context"), "left")
        if k < order:
            rows = rows.join(small(levels[k].select(F.col("key").alias("gram"), "n")), F.col("key").bitwiseAND(_low(k + 1)) == F.col("gram"), "left")
            full = F.log10(2.0 * F.col("n") - 1)
            hit = F.col("sofar") + full - F.coalesce("there", F.log10(2.0 * F.col("own_total")))
            rows = rows.withColumn("log", F.coalesce("log", hit))
        past = F.col("sofar") + F.coalesce("on", "own_escape", F.lit(0.0))
        rows = rows.select("key", "log", past.alias("sofar"), F.col("own_there").alias("there"), F.col("own_on").alias("on"))
    rest = rows.select("key", F.coalesce("log", F.col("sofar") - F.coalesce("there", F.lit(float(np.log10(257.0))))).alias("log"))
    return first.where("alone IS NOT NULL").select("key", F.col("alone").alias("log")).unionByName(rest)


def _most_frequent(grams: DataFrame, most: int) -> DataFrame:
    """The grams of the highest counts, ``most`` at most; equal counts go together."""
    band = F.floor(F.log2("n") * 16)
    sizes = sorted(((r["band"], r["rows"]) for r in grams.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("rows")).collect()), reverse=True)
    least, taken = sizes[0][0] + 1 if sizes else 0, 0
    for at, rows in sizes:
        if (taken := taken + rows) > most:
            break
        least = at
    return grams.where(band >= least)


def _score(shared, head, order: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (head_keys, head_logs) = _model(shared), head.value
        known = Table(head_keys, head_logs)
        for rows in batches:
            data, offsets = buffers(rows.column(1))
            for lo, hi in slices(offsets):
                own, n = offsets[lo : hi + 1], hi - lo
                words = find_words(data, own)
                text = stream(data, own, words, order)
                coded = grams(text.symbols, text.at, order)
                logs = model.log_probability(coded)
                absent = np.flatnonzero(np.isnan(logs))
                logs[absent] = 0.0
                score = by_document(logs, text.first, np.add, 0)
                deep = pa.array(np.searchsorted(absent, text.first).astype(np.int32))
                deep_keys = pa.ListArray.from_arrays(deep, pa.array(coded[absent].view(np.int64)))
                del coded, logs, absent
                slot = known.find(words.hashes)
                found = slot >= 0
                base = by_document(np.where(found, known.values[0][slot], 0.0), words.first, np.add, 0)
                n_found = by_document(found.astype(np.int64), words.first, np.add, 0)
                tail = np.concatenate([[0], np.cumsum(~found)])[words.first]
                tail_keys = pa.ListArray.from_arrays(pa.array(tail.astype(np.int32)), pa.array(words.hashes[~found].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(i).slice(lo, n) for i in (0, 2)), pa.array(np.diff(words.first) + 1), pa.array(n_found), pa.array(base), pa.array(score), tail_keys, deep_keys],
                    ["id", "held_out", "n_tokens", "head_known", "head_base", "score", "tail", "deep"],
                )

    return run


def score(docs: DataFrame, held_out: Column, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score): one row per input row.

    A text is its words, runs of anything but ASCII white space with A-Z lower-cased,
    and one end. ``score`` is the log10 probability of their bytes, one space between
    words, and of the end, by prediction by partial matching with contexts of up to
    ``order`` bytes, pretrained on all rows where ``held_out`` is false. ``base_score``
    is that of the words by their counts c in those rows: the sum over a document of
    log10((c + 0.5) / (N + 0.5 * (V + 1))), with N words, ends included, V of them different.

    Counts cover every training row. Those of the HEAD_WORDS most frequent words are
    looked up while scoring; other words of each document join all counts by a shuffle.
    So do contexts if they are more than MODEL_GRAMS; ``order`` holds for any number of them.

    Null or empty text: the end alone. A null ``held_out`` counts as false. Without
    training rows the model is uniform and base_score is the end's, log10(0.5 / 0.5).
    Repeated rows are counted and scored each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    held = F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held.alias("held_out"))
    counts = rows.where(~F.col("held_out")).select("text").mapInArrow(_count(order), "kind int, key long, n long")
    counts = saved(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    words = counts.where(F.col("kind") == _WORD).select("key", "n")
    totals = {r["kind"]: (r["rows"], r["n"]) for r in counts.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).collect()}
    train_docs = totals.get(_DOC, (0, 0))[1]
    n = totals.get(_WORD, (0, 0))[1] + train_docs
    v = totals.get(_WORD, (0, 0))[0] + (train_docs > 0)
    denominator = n + 0.5 * (v + 1)

    contexts = counts.where(F.col("kind") == _GRAM).select("key", "n")
    joins = totals.get(_GRAM, (0, 0))[0] > MODEL_GRAMS
    if joins:
        levels, nodes = _tables(contexts, order)
        alone = saved(_alone(contexts, nodes[order]), "alone")
        found = _most_frequent(alone, MODEL_GRAMS).toArrow()
        parts = Head, found["key"].to_numpy().view(np.uint64), found["alone"].to_numpy()
    else:
        found = contexts.toArrow()
        keys, amounts = found["key"].to_numpy().view(np.uint64), found["n"].to_numpy()
        by_key = np.argsort(keys)
        parts = Model, keys[by_key], amounts[by_key], order
    model = spark.sparkContext.broadcast({"parts": parts})
    top = words.orderBy(F.col("n").desc(), "key").limit(HEAD_WORDS).toArrow()
    head = spark.sparkContext.broadcast((top["key"].to_numpy().view(np.uint64), np.log10((top["n"].to_numpy() + 0.5) / denominator)))

    schema = "id " + rows.schema["id"].dataType.simpleString() + ", held_out boolean, n_tokens long, head_known long, head_base double, score double, tail array<long>, deep array<long>"
    scored = rows.mapInArrow(_score(model, head, order), schema)
    scored = saved(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = scored.select("row", F.explode("tail").alias("key")).join(words, "key", "left")
    c = F.coalesce("n", F.lit(0))
    tail = tail.groupBy("row").agg(F.sum(F.log10((c + 0.5) / F.lit(float(denominator)))).alias("tail_base"), F.sum((c > 0).cast("long")).alias("tail_known"))
    end = float(np.log10((train_docs + 0.5) / denominator))
    out = scored.drop("tail", "deep").join(tail, "row", "left")
    log = F.col("score")
    if joins:
        deep = scored.select("row", F.explode("deep").alias("key"))
        logs = _joined(deep.select("key").distinct(), alone, levels, nodes)
        out = out.join(deep.join(logs, "key").groupBy("row").agg(F.sum("log").alias("deep_score")), "row", "left")
        log += F.coalesce("deep_score", F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + F.lit(int(train_docs > 0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", F.lit(0.0)) + F.lit(end)).alias("base_score"),
        log.alias("score"),
    )
