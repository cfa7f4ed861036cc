"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm._shingles import windows
from quillon.llm._store import BROADCAST_IDS, saved
from quillon.llm._words import NOT_ALNUM, buffers, find_words, powers, slices

_U = np.uint64
#: Up to so many pairs of an item and a seed of it (32 bytes each) go to every executor, where
#: documents are compared with items; with more, the documents' windows are joined by a shuffle.
BROADCAST_SEEDS = 4_000_000
#: Pairs of a document's seed and an item that are counted at a time; a document of more stands alone.
_PAIRS = 4_000_000


def _item_seeds(length: int) -> Callable:
    """(item_id, text) to (item_id, seed, times, words): each item's distinct seeds, how often it has them, and its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            data, offsets = buffers(rows.column(1))
            for lo, hi in slices(offsets):
                words = find_words(data, offsets[lo : hi + 1], NOT_ALNUM)
                hashes, owner = windows(words, length)
                pair, times = np.unique(np.rec.fromarrays([owner, hashes.view(np.int64)]), return_counts=True)
                counts = np.diff(words.first)[pair.f0]
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(lo + pair.f0)), pa.array(np.ascontiguousarray(pair.f1)), pa.array(times.astype(np.int64)), pa.array(counts.astype(np.int64))], ["item_id", "seed", "times", "words"])

    return run


def _seeds(length: int) -> Callable:
    """(id, text) to (id, seed): each row's distinct seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            data, offsets = buffers(rows.column(1))
            for lo, hi in slices(offsets):
                hashes, owner = windows(find_words(data, offsets[lo : hi + 1], NOT_ALNUM), length)
                pair = np.unique(np.rec.fromarrays([owner, hashes.view(np.int64)]))
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(lo + pair.f0)), pa.array(np.ascontiguousarray(pair.f1))], ["id", "seed"])

    return run


class Seeds:
    """Items by seed: those of seed k are item[first[k]:first[k + 1]], with how often they have it, and their words."""

    def __init__(self, table: pa.Table):
        order = np.argsort(table["seed"].to_numpy().view(np.uint64), kind="stable")
        seed = table["seed"].to_numpy().view(np.uint64)[order]
        begins = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]])) if len(seed) else np.zeros(0, np.int64)
        self.seeds, self.first = seed[begins], np.append(begins, len(seed))
        self.ids, self.item = np.unique(table["item_id"].to_numpy()[order], return_inverse=True)
        self.times, self.words = table["times"].to_numpy()[order], table["words"].to_numpy()[order]

    def candidates(self, hashes: np.ndarray, owner: np.ndarray, length: int, coverage: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(document, item) index arrays: pairs whose shared seeds could cover enough of the item's words."""
        if not len(self.seeds) or not len(hashes):
            return
        spot = np.searchsorted(self.seeds, hashes)
        spot[spot == len(self.seeds)] = 0
        hit = self.seeds[spot] == hashes
        both = np.unique(owner[hit] * len(self.seeds) + spot[hit])
        document, seed = both // len(self.seeds), both % len(self.seeds)
        sizes = self.first[seed + 1] - self.first[seed]
        ends = np.append(np.flatnonzero(document[1:] != document[:-1]) + 1, len(document))
        total, lo = np.concatenate([[0], np.cumsum(sizes)]), 0
        while lo < len(document):
            hi = int(ends[max(np.searchsorted(ends, lo, "right"), np.searchsorted(total[ends], total[lo] + _PAIRS, "right") - 1)])
            own = sizes[lo:hi]
            at = np.repeat(self.first[seed[lo:hi]] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            pair, which = np.unique(np.repeat(document[lo:hi], own) * len(self.ids) + self.item[at], return_inverse=True)
            covered = np.bincount(which, weights=self.times[at]) * length
            words = np.full(len(pair), np.inf)
            np.minimum.at(words, which, self.words[at])
            pair = pair[covered >= coverage * words]
            yield pair // len(self.ids), pair % len(self.ids)
            lo = hi


def _candidates(shared, length: int, coverage: float) -> Callable:
    """(id, text) to (id, item_id): candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for rows in batches:
            data, offsets = buffers(rows.column(1))
            for lo, hi in slices(offsets):
                hashes, owner = windows(find_words(data, offsets[lo : hi + 1], NOT_ALNUM), length)
                for document, item in known.candidates(hashes, owner, length, coverage):
                    if len(document):
                        yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(lo + document)), pa.array(known.ids[item])], ["id", "item_id"])

    return run


def _rolling(tokens: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``length`` tokens, from one prefix sum."""
    up, down = powers(len(tokens) + 1)
    total = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(tokens * up[: len(tokens)], out=total[1:])
    n = len(tokens) - length + 1
    return (total[length:] - total[:n]) * down[:n]


def tiles(pattern: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in pattern, start in text, length) of disjoint matches.

    Longest matches of unmarked tokens are marked first, each token once, none shorter
    than ``least``. Matches are found with Karp-Rabin windows of a length that starts
    at the longest match seen and is halved down to ``least``.
    """
    found: list[tuple[int, int, int]] = []
    free_p, free_t = np.ones(len(pattern), bool), np.ones(len(text), bool)
    size = max(least, min(len(pattern), len(text)))
    while size >= least:
        if len(pattern) >= size and len(text) >= size:
            _mark(pattern, text, free_p, free_t, size, found)
        if size == least:
            break
        size = max(least, size // 2)
    return found


def _mark(pattern, text, free_p, free_t, size, found) -> None:
    """Mark every match of at least ``size`` unmarked tokens, the longest first, until none is left."""
    hashes_p, hashes_t = _rolling(pattern, size), _rolling(text, size)
    while True:
        open_p = np.flatnonzero(np.convolve(free_p, np.ones(size, np.int64), "valid") == size)
        if not len(open_p):
            return
        free = np.concatenate([[0], np.cumsum(free_t)])
        spots = np.flatnonzero((free[size:] - free[:-size] == size) & np.isin(hashes_t, hashes_p[open_p]))
        if not len(spots):
            return
        at = defaultdict(list)
        for i in open_p.tolist():
            at[int(hashes_p[i])].append(i)
        matches = []
        reached: dict[int, int] = {}  # diagonal -> end of the last match on it
        for j in spots.tolist():
            for i in at[int(hashes_t[j])]:
                if reached.get(j - i, -1) > j or not np.array_equal(pattern[i : i + size], text[j : j + size]):
                    continue
                n = size
                while i + n < len(pattern) and j + n < len(text) and free_p[i + n] and free_t[j + n] and pattern[i + n] == text[j + n]:
                    n += 1
                reached[j - i] = j + n
                matches.append((-n, i, j))
        if not matches:
            return
        for n, i, j in sorted(matches):
            if free_p[i : i - n].all() and free_t[j : j - n].all():
                free_p[i : i - n] = free_t[j : j - n] = False
                found.append((i, j, -n))


def _tile(least: int) -> Callable:
    """From (id, text, items) to (id, item_id, item_words, covered_words, tiles, longest), a row per item of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            data, offsets = buffers(rows.column(1))
            out: list[list[int]] = [[], [], [], [], [], []]
            for r in range(rows.num_rows):
                text = find_words(data, offsets[r : r + 2], NOT_ALNUM).hashes
                items = rows.column(2)[r].values
                texts, at = buffers(items.field("item"))
                for k, item_id in enumerate(items.field("item_id").to_pylist()):
                    item = find_words(texts, at[k : k + 2], NOT_ALNUM).hashes
                    # An item of fewer words than a tile has is a candidate of texts that are nothing else.
                    got = tiles(item, text, min(least, max(1, len(item))))
                    for column, value in zip(out, (r, item_id, len(item), sum(n for _, _, n in got), len(got), max((n for _, _, n in got), default=0)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(out[0], pa.int64())), *(pa.array(x, pa.int64()) for x in out[1:])], ["id", "item_id", "item_words", "covered_words", "tiles", "longest"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, tiles, longest, coverage): the pairs found.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
    Documents and items that share seeds, windows of ``least`` words, are tiled if those
    seeds could cover enough of the item, each as many words as it has; a pair is returned
    if its tiles cover at least ``coverage`` of the item's words, in whatever order the
    document has them. Seeds of the benchmark go to the documents, so a phrase that very
    many of both share is counted within each document and makes no rows of its own. Each
    text is tiled with all of its items, as one row.

    An item with fewer than ``least`` words is found in documents that are that sequence of
    words and no other. Null texts count as empty; rows with a null id, on either side, are
    not reported. Repeated rows give one pair, that of the best covered text; of equal ones
    that of the longest tile. Empty tables give no rows; other columns are ignored, whatever
    their names.
    """
    spark = docs.sparkSession
    source = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    items = benchmark.where(F.col(item_id_col).isNotNull()).select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("item"))
    item_seeds = items.mapInArrow(_item_seeds(least), "item_id long, seed long, times long, words long")
    item_seeds = saved(item_seeds.groupBy("item_id", "seed").agg(F.sum("times").alias("times"), F.min("words").alias("words")), "item-seeds")
    if item_seeds.count() <= BROADCAST_SEEDS:
        known = spark.sparkContext.broadcast(Seeds(item_seeds.toArrow()))
        pairs = source.mapInArrow(_candidates(known, least, coverage), "id long, item_id long").distinct()
    else:
        shared = source.mapInArrow(_seeds(least), "id long, seed long").join(item_seeds, "seed")
        bound = shared.groupBy("id", "item_id").agg(F.sum("times").alias("times"), F.min("words").alias("words"))
        pairs = bound.where(F.col("times") * least >= F.col("words") * coverage).select("id", "item_id")
    pairs = saved(pairs, "seeded")
    ids = pairs.select("id").distinct()
    few = ids.count() <= BROADCAST_IDS
    texts = saved(source.join(F.broadcast(ids) if few else ids, "id", "left_semi"), "candidates")
    own = pairs.join(items, "item_id").groupBy("id").agg(F.collect_list(F.struct("item_id", "item")).alias("items"))
    rows = texts.join(own, "id").select("id", "text", "items")
    scored = rows.mapInArrow(_tile(least), "id long, item_id long, item_words long, covered_words long, tiles long, longest long")
    scored = scored.withColumn("coverage", F.col("covered_words") / F.col("item_words")).where(F.col("coverage") >= coverage)
    best = F.max(F.struct("coverage", "longest", "item_words", "covered_words", "tiles")).alias("b")
    out = scored.groupBy("id", "item_id").agg(best).select(F.col("id").alias(id_col), F.col("item_id").alias(item_id_col), "b.item_words", "b.covered_words", "b.tiles", "b.longest", "b.coverage")
    return out
