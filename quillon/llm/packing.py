"""Tokenise documents and pack the pieces into sequences by best fit."""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm._store import saved

#: Pieces that one task places at a time.
PER_TASK = 60_000
_SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def _exact(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Ids of texts by the byte-level BPE in this tokenizers file.

    The file's vocabulary is read into a faster implementation of the same
    algorithm; texts that hold a special token go through tokenizers itself,
    which is loaded with the first of them.
    """
    import json

    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(visible))}
    ranks = {bytes(to_byte[c] for c in token): i for token, i in vocabulary.items() if token != _SPECIAL}
    fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        return [_exact(path).encode(t, add_special_tokens=False).ids if _SPECIAL in t else fast.encode_ordinary(t) for t in texts]

    return encode


def _cut(path: str | None, size: int, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from public_tokenizers import path as file_of

        encode = encoder(path or file_of("byte_bpe_50k.json"))
        for rows in batches:
            for lo in range(0, rows.num_rows, 256):
                part = rows.slice(lo, 256)
                out: list[list] = [[], [], [], [], []]
                for row, text in enumerate(part.column(1).to_pylist()):
                    ids = np.array([*encode([text or ""])[0], end_id], "<u4")
                    start = 0
                    # Only the first piece may be shorter, so the cuts count from the end.
                    for piece, stop in enumerate(range((len(ids) - 1) % size + 1, len(ids) + 1, size)):
                        for column, value in zip(out, (row, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())), strict=True):
                            column.append(value)
                        start = stop
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int32()), *(pa.array(x, pa.int64()) for x in out[2:])], ["id", "piece", "start", "length", "ids_crc32"])

    return run


@dataclass(frozen=True)
class Plan:
    """Where best fit puts items, the largest first. Steps name the first item, in that order, the first bin, items a bin and where they begin."""

    sizes: np.ndarray  # ascending
    firsts: np.ndarray  # places in the order of their first items
    item: np.ndarray
    bin: np.ndarray
    each: np.ndarray
    offset: np.ndarray

    def places(self, sizes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bin, offset) of the items of these sizes and ranks among the items of their size, from 0."""
        items = self.firsts[np.searchsorted(self.sizes, sizes)] + ranks
        k = np.searchsorted(self.item, items, "right") - 1
        after = items - self.item[k]
        return self.bin[k] + after // self.each[k], self.offset[k] + after % self.each[k] * sizes


def fit_plan(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> Plan:
    """Best fit of any number of items, from the sizes, ascending, and the count of each.

    Items of one size are alike, and so are bins of equal room. The bin with the least
    room that holds an item stays that bin until no further item of the size fits, so a
    run of like bins takes its items in one step. A size splits at most two runs, so
    steps grow with the number of sizes, not of items.
    """
    steps: list[tuple[int, int, int, int]] = []
    rooms: list[int] = []  # sizes of room that some open bin has, sorted
    by_room: dict[int, list[tuple[int, int]]] = {}  # (first bin, bins) of its runs
    bins = item = 0

    def put(room: int, first: int, number: int) -> None:
        if room and number:
            if room not in by_room:
                by_room[room] = []
                bisect.insort(rooms, room)
            by_room[room].append((first, number))

    for size, left in zip(sizes[::-1].tolist(), counts[::-1].tolist(), strict=True):
        while left:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                room, first, number = capacity, bins, -(-left // (capacity // size))
                bins += number
            else:
                room = rooms[at]
                first, number = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            # Some bins take as many as they hold, the next one what is left, the others nothing.
            each = room // size
            full = min(number, left // each)
            rest = left - full * each if full < number else 0
            for start, taken, n in ((first, full, each), (first + full, min(rest, 1), rest)):
                if taken:
                    steps.append((item, start, n, capacity - room))
                    put(room - n * size, start, taken)
                    item, left = item + taken * n, left - taken * n
            used = full + min(rest, 1)
            put(room, first + used, number - used)
    return Plan(sizes, np.cumsum(counts[::-1])[::-1] - counts, *np.array(steps, np.int64).reshape(-1, 4).T.copy())


def _ranks(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for as many as each count says, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, fill): best fit of the items, largest first; ties in the order given."""
    known, inverse, counts = np.unique(sizes, return_inverse=True, return_counts=True)
    ranks = np.zeros(len(sizes), np.int64)
    ranks[np.argsort(inverse, kind="stable")] = _ranks(counts)
    place, offset = fit_plan(known, counts, capacity).places(sizes, ranks)
    fill = np.zeros(place.max(initial=-1) + 1, np.int64)
    np.add.at(fill, place, sizes)
    return place, offset, fill


def _place(plan: Plan) -> Callable:
    """Sequence and offset of the pieces of one group, of which ``earlier`` counts those of each length in the groups before it."""

    def run(group: pa.Table, earlier: pa.Table) -> pa.Table:
        earlier, group = earlier.sort_by("length"), group.sort_by([("length", "ascending"), ("number", "ascending")])
        n = earlier["n"].to_numpy()
        place, offset = plan.places(group["length"].to_numpy(), _ranks(n) + np.repeat(earlier["earlier"].to_numpy(), n))
        return group.select(["id", "piece", "start", "length", "ids_crc32"]).append_column("sequence_id", pa.array(place)).append_column("offset", pa.array(offset))

    return run


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece.

    A document is its ids by the tokenizer, then ``end_id``. Documents of more than
    ``capacity`` ids are cut into pieces of that length, the first may be shorter.
    All pieces are best-fitted together, the largest first. The driver plans this from
    the count of each length, at most ``capacity`` numbers. Pieces are numbered within
    their length by groups of bounded size, of which each learns how many pieces of a
    length the groups before it have, and look their places up in the plan.

    Null text counts as empty: the end id alone. Repeated rows are packed each; null
    ids stay null. An empty table gives no rows. sequence_id is any number that the
    pieces of one sequence share; their offsets and lengths leave no gap.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    cut = source.mapInArrow(_cut(tokenizer, capacity, end_id), "id long, piece int, start long, length long, ids_crc32 long")
    pieces = saved(cut.withColumn("number", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-pieces.count() // PER_TASK))
    pieces = pieces.withColumn("grp", F.pmod(F.xxhash64("number"), F.lit(groups)))
    counts = saved(pieces.groupBy("length", "grp").agg(F.count("*").alias("n")), "lengths")
    totals = sorted((r.length, r.n) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect())
    plan = fit_plan(*np.array(totals, np.int64).reshape(-1, 2).T, capacity)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("earlier", F.coalesce(before, F.lit(0)))
    out = pieces.groupBy("grp").cogroup(counts.groupBy("grp")).applyInArrow(_place(plan), _SCHEMA)
    return out.withColumnRenamed("id", id_col)


_SCHEMA = "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
