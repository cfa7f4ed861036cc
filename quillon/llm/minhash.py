"""Near-duplicate components: banded MinHash, Bayesian pruning, exact verification."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm._shingles import BITS, shingle_sets
from quillon.llm._store import BROADCAST_IDS, saved
from quillon.llm._words import buffers, by_document, find_words, mix, slices
from quillon.llm.components import connected_components

_U = np.uint64
#: Rows, and bytes of their sets, of one side of a block of bucket members that are compared in memory.
BLOCK = 256
BLOCK_BYTES = 16 << 20


class Plan(NamedTuple):
    """Parameters of a run. A pair links when share_den * |A n B| >= share_num * |A u B|."""

    words: int
    share_num: int
    share_den: int
    rows: int
    bands: int
    batch: int
    miss: float

    @property
    def hashes(self) -> int:
        return self.rows * self.bands


def plan_for(share_num: int, share_den: int, words: int = 5, rows: int = 4, batch: int = 16, miss: float = 1e-6) -> Plan:
    """As many bands as a pair at the threshold needs to share no band with probability ``miss`` at most."""
    t = share_num / share_den
    bands = math.ceil(math.log(miss) / math.log(1 - t**rows))
    return Plan(words, share_num, share_den, rows, bands, batch, miss)


def needed_matches(n: int, threshold: float, miss: float) -> int:
    """Fewest equal hashes of ``n`` that leave the posterior P(similarity >= threshold) at ``miss`` or more.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1),
    whose upper tail is P(Binomial(n + 1, threshold) <= m).
    """
    tail = 0.0
    for m in range(n + 1):
        tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


def signatures(values: np.ndarray, first: np.ndarray, hashes: int) -> np.ndarray:
    """MinHash signatures, 32 bits a hash, of the sets values[first[d]:first[d + 1]]; zeros for empty sets."""
    seeds = mix(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * _U(0xA0761D6478BD642F))
    out = np.zeros((len(first) - 1, hashes), np.uint32)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        at, work = first[:-1][full], np.empty_like(values)
        for i in range(hashes):
            np.bitwise_xor(values, seeds[2 * i], out=work)
            np.multiply(work, seeds[2 * i + 1] | _U(1), out=work)
            out[full, i] = np.minimum.reduceat(work, at) >> _U(32)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a two-dimensional array as bytes."""
    n, width = rows.shape[0], rows.strides[0] if rows.size else 0
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(width)), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _batches(rows: pa.RecordBatch, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = buffers(rows.column(1))
    for lo, hi in slices(offsets):
        yield lo, hi, *shingle_sets(find_words(data, offsets[lo : hi + 1]), words)


def _sign(plan: Plan) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for lo, hi, first, values in _batches(rows, plan.words):
                sums = [by_document(mix(values ^ _U(salt)), first, np.add, 0).view(np.int64) for salt in (0x243F6A8885A308D3, 0x13198A2E03707344)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).slice(lo, hi - lo), rows.column(2).slice(lo, hi - lo), pa.array(np.diff(first)), pa.array(sums[0]), pa.array(sums[1]), _binary(signatures(values, first, plan.hashes))],
                    ["id", "name", "n", "f1", "f2", "sig"],
                )

    return run


def _collect_sets(plan: Plan) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for lo, hi, first, values in _batches(rows, plan.words):
                packed = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(first.astype(np.int64) * 8), pa.py_buffer(np.ascontiguousarray(values).tobytes())])
                yield pa.RecordBatch.from_arrays([rows.column(0).slice(lo, hi - lo), packed.cast(pa.binary())], ["id", "shingles"])

    return run


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, width)


def surviving(a: np.ndarray, b: np.ndarray, plan: Plan) -> np.ndarray:
    """Indices of the row pairs that no batch of hashes rules out."""
    left, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    t = plan.share_num / plan.share_den
    for lo in range(0, plan.hashes, plan.batch):
        hi = min(lo + plan.batch, plan.hashes)
        matches += (a[left, lo:hi] == b[left, lo:hi]).sum(1)
        keep = matches >= needed_matches(hi, t, plan.miss)
        left, matches = left[keep], matches[keep]
    return left


def _prune(plan: Plan) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keep = surviving(_matrix(rows.column(2), plan.hashes), _matrix(rows.column(3), plan.hashes), plan)
            yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(keep)), rows.column(1).take(pa.array(keep))], ["a", "b"])

    return run


def common(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sizes of the intersections of packed sets, pair by pair; 4,096 pairs at most."""

    def keys(sets: list[bytes]) -> np.ndarray:
        sizes = np.fromiter(map(len, sets), np.int64, len(sets)) // 8
        return np.frombuffer(b"".join(sets), np.uint64) | (np.repeat(np.arange(len(sets), dtype=np.uint64), sizes) << BITS)

    both = np.concatenate([keys(a), keys(b)])
    both.sort()
    twice = both[1:][both[1:] == both[:-1]]
    return np.bincount((twice >> BITS).astype(np.int64), minlength=len(a))


def _verify(plan: Plan) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for lo in range(0, rows.num_rows, 512):
                part = rows.slice(lo, 512)
                a, b = part.column(2).to_pylist(), part.column(3).to_pylist()
                both = common(a, b)
                union = (np.fromiter(map(len, a), np.int64) + np.fromiter(map(len, b), np.int64)) // 8 - both
                keep = pa.array(np.flatnonzero((both > 0) & (plan.share_den * both >= plan.share_num * union)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(keep), part.column(1).take(keep)], ["a", "b"])

    return run


def _compare_blocks(plan: Plan) -> Callable:
    """Pairs of components that links within one block pair of a bucket join; each link is confirmed on full sets.

    A pair that shares several bands is taken up in the first of them only. Pairs of a
    component, also of one that the block's links have made, need no comparison, so a
    block gives fewer links than it has rows.
    """

    def run(block: pa.Table) -> pa.Table:
        ids, sides = block["rep"].to_numpy(), block["side"].to_numpy()
        names, bands = block["comp"].to_numpy(), block["band"].to_numpy()
        comps = np.unique(names, return_inverse=True)[1]
        sigs = _matrix(block["sig"].combine_chunks(), plan.hashes)
        sets = [np.frombuffer(x, np.uint64) for x in block["shingles"].to_pylist()]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        same = not len(right)
        if same:
            right = left
        out_a, out_b = [], []
        keys = sigs.reshape(len(sigs), plan.bands, plan.rows)
        for i in left:
            others = right[comps[right] != comps[i]]
            if same:
                others = others[ids[others] > ids[i]]
            others = others[plan.share_den * np.minimum(sizes[others], sizes[i]) >= plan.share_num * np.maximum(sizes[others], sizes[i])]
            if not len(others):
                continue
            others = others[surviving(np.broadcast_to(sigs[i], (len(others), plan.hashes)), sigs[others], plan)]
            others = others[(keys[others] == keys[i]).all(2).argmax(1) == bands[i]]
            for j in others:
                if comps[i] == comps[j]:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if plan.share_den * both >= plan.share_num * (sizes[i] + sizes[j] - both):
                    out_a.append(min(names[i], names[j]))
                    out_b.append(max(names[i], names[j]))
                    comps[comps == comps[j]] = comps[i]
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return run


def near_duplicates(docs: DataFrame, share_num: int = 4, share_den: int = 5, words: int = 5, rows: int = 4, miss: float = 1e-6, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per input row.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a document's
    set is its distinct shingles of ``words`` words (fewer words: the whole sequence),
    held as 52-bit hashes of them, on which links are confirmed.
    Documents link when share_den * |A n B| >= share_num * |A u B|, confirmed on full
    sets; component_id is the smallest id reachable, kept is doc_id = component_id.

    Equal sets are one class. Classes that share a band are compared to the bucket's
    most connected class first; then, where a bucket still holds several components,
    across these, block by block, and only the components that links join leave a
    block. Only ``miss`` of the pairs at the threshold may go unseen.

    Null or empty text: an empty set, linked with nothing. Rows with a null id keep
    their n_shingles, have a null component_id unless an equal set has an id, and
    are kept unless it has. Rows that share an id count as one document. With
    ``row_col``, a number that differs by row, rows are told apart by it instead: one
    row of each component is kept, that of the smallest id (null ids last), then of the
    smallest number, and the number is returned too. Ties: the smallest id. An empty
    table gives no rows; other columns are ignored.
    """
    plan = plan_for(share_num, share_den, words, rows, miss=miss)
    source = docs.select(F.col(row_col or id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("name"))
    signed = saved(source.mapInArrow(_sign(plan), "id long, name long, n long, f1 long, f2 long, sig binary"), "signatures")
    source = source.drop("name")
    key = ["n", "f1", "f2"]
    classes = saved(signed.where("n > 0").groupBy(*key).agg(F.min("id").alias("rep"), F.max("sig").alias("sig")).where("rep is not null"), "classes")

    comps = _components(source, classes, plan)
    labelled = classes.select(*key, "rep").join(comps, F.col("rep") == F.col("node"), "left").select(*key, F.coalesce("component", "rep").alias("comp"))
    out = signed.select("id", "name", *key).join(labelled, key, "left")
    component = F.when(F.col("n") > 0, F.col("comp")).otherwise(F.col("id")).alias("component")
    out = out.select("id", "name", F.col("n").alias("n_shingles"), component)
    if not row_col:
        return out.select(F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))
    out = saved(out, "members")
    first = F.min(F.struct(F.col("name").isNull().alias("no_name"), "name", "id")).alias("first")
    firsts = saved(out.groupBy("component").agg(first).select("component", F.col("first.name").alias("component_id"), F.col("first.id").alias("keep")), "firsts")
    out = out.join(firsts, "component")
    return out.select(F.col("name").alias(id_col), F.col("id").alias(row_col), "n_shingles", "component_id", (F.col("id") == F.col("keep")).alias("kept"))


def _components(source: DataFrame, classes: DataFrame, plan: Plan) -> DataFrame:
    """(node, component) of the class representatives that are linked with others."""
    comps, links = _links(source, classes, plan)
    if links.isEmpty():
        return comps
    # What blocks have found joins components: those are merged among themselves.
    merged = saved(connected_components(links).select(F.col("node").alias("old"), F.col("component").alias("new")), "merged")
    out = comps.join(merged, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))
    return out.unionByName(merged.select(F.col("old").alias("node"), F.col("new").alias("component")).join(comps, "node", "left_anti"))


def _links(source: DataFrame, classes: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """Components (node, component) of links to the buckets' pivots, and pairs (a, b) of components that other links join."""
    bands = F.transform(F.sequence(F.lit(0), F.lit(plan.bands - 1)), lambda i: F.struct(i.cast("int").alias("band"), F.xxhash64(i, F.substring(F.col("sig"), i * (4 * plan.rows) + 1, 4 * plan.rows)).alias("bucket")))
    members = classes.select("rep", F.explode(bands).alias("at")).select("rep", "at.*")
    # Sums by bucket are written before members join them: a very large bucket's members are then a
    # side of the join by themselves, and can be split over tasks.
    sizes = saved(members.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    members = saved(members.join(sizes, ["band", "bucket"]), "members")

    central = members.groupBy("rep").agg(F.sum("size").alias("weight"))
    members = saved(members.join(central, "rep"), "weighted")
    pivots = saved(members.groupBy("band", "bucket").agg(F.min(F.struct((-F.col("weight")).alias("w"), "rep")).getField("rep").alias("pivot")), "pivots")
    with_pivot = members.join(pivots, ["band", "bucket"])
    stars = with_pivot.where("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
    signs = classes.select("rep", "sig")
    edges = _confirm(_pruned(stars, signs, plan), source, plan)

    comps = saved(connected_components(edges), "components")
    rest = with_pivot.where("rep <> pivot and size > 2").select("band", "bucket", "rep")
    rest = rest.join(comps, F.col("rep") == F.col("node"), "left").select("band", "bucket", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = rest.groupBy("band", "bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("band", "bucket")
    mixed = saved(mixed, "mixed")
    rest = saved(rest.join(mixed, ["band", "bucket"]), "rest")
    sets = _sets(rest.select(F.col("rep").alias("id")).distinct(), source, plan).withColumnRenamed("id", "rep")
    length = sets.select("rep", F.octet_length("shingles").alias("bytes"))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")
    blocks = saved(rest.join(length, "rep").groupBy("band", "bucket").agg(blocks), "blocks")
    rest = rest.join(blocks, ["band", "bucket"]).join(signs, "rep").join(sets, "rep")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(j, own).alias("i"), F.greatest(j, own).alias("j"), F.when(own <= j, 0).otherwise(1).alias("side")))
    rest = rest.select("band", "bucket", "rep", "comp", "sig", "shingles", F.explode(tiles).alias("t")).select("band", "bucket", "rep", "comp", "sig", "shingles", "t.*")
    more = rest.groupBy("band", "bucket", "i", "j").applyInArrow(_compare_blocks(plan), "a long, b long").distinct()
    return comps, saved(more, "links")


def _pruned(pairs: DataFrame, signs: DataFrame, plan: Plan) -> DataFrame:
    both = pairs.join(signs.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a").join(signs.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b")
    return saved(both.select("a", "b", "sa", "sb").mapInArrow(_prune(plan), "a long, b long"), "pairs")


def _sets(ids: DataFrame, source: DataFrame, plan: Plan) -> DataFrame:
    """(id, shingles) of the documents with these ids, a written table."""
    ids = saved(ids, "ids")
    wanted = source.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")
    return saved(wanted.mapInArrow(_collect_sets(plan), "id long, shingles binary"), "sets")


def _confirm(pairs: DataFrame, source: DataFrame, plan: Plan) -> DataFrame:
    """The pairs whose full sets meet the threshold."""
    sets = _sets(pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct(), source, plan)
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    return saved(both.select("a", "b", "x", "y").mapInArrow(_verify(plan), "a long, b long").distinct(), "links")
