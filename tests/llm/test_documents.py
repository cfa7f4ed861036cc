"""Deduplication, packing, decontamination and language ID against brute force."""

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from quillon.llm import exact_dedup
from quillon.llm._store import numbered
from quillon.llm._words import NOT_ALNUM, SPACE, buffers, find_words, slices, word_hash
from quillon.llm.decontamination import contaminated, tiles
from quillon.llm.exact_dedup import exact_duplicates
from quillon.llm.language_id import Model, family_of, identify
from quillon.llm.minhash import near_duplicates, needed_matches, plan_for
from quillon.llm.packing import best_fit, encoder, fit_plan, pack
from quillon.shipping import BATCH_BYTES, ship

DOC = "doc_id long, text string, n int, kept string, id string"


def frame(spark, rows):
    """Documents with extra columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], DOC)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n\t!", max_size=30), max_size=8))
def test_words_are_those_of_bytes_split(texts):
    data, offsets = buffers(pa.array(texts, pa.string()))
    for lo, hi in slices(offsets, 10):
        words = find_words(data, offsets[lo : hi + 1], SPACE)
        expected = [w for t in texts[lo:hi] for w in t.encode().lower().split()]
        assert np.diff(words.first).tolist() == [len(t.encode().split()) for t in texts[lo:hi]]
        assert words.hashes.tolist() == [word_hash(w) for w in expected]


def test_words_of_many_texts_take_little_memory_at_a_time():
    data, offsets = buffers(pa.array(["lorem ipsum dolor sit amet " * 100] * 3000))
    tracemalloc.start()
    for lo, hi in slices(offsets):
        find_words(data, offsets[lo : hi + 1], SPACE)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(data) > 8e6 and peak < 25e6


def test_python_workers_get_rows_in_small_batches(spark):
    def sizes(batches):
        for rows in batches:
            yield pa.RecordBatch.from_arrays([pa.array([rows.num_rows]), pa.array([rows.nbytes])], ["n", "size"])

    texts = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    before = spark.conf.get(BATCH_BYTES, None)
    try:
        spark.conf.unset(BATCH_BYTES)
        ship(spark)
        got = texts.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 2000 and max(r.size for r in got) < 8e6
        spark.conf.set(BATCH_BYTES, "32m")
        ship(spark)
        assert spark.conf.get(BATCH_BYTES) == "32m"
    finally:
        spark.conf.unset(BATCH_BYTES) if before is None else spark.conf.set(BATCH_BYTES, before)


def test_row_numbers_need_no_python_worker(spark, sf):
    rows = numbered(spark.read.parquet(f"{sf}/documents.parquet"), "row")
    assert "RDD" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.select("row").distinct().count() == rows.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def brute_exact(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    out = []
    for i, t in rows:
        group = [(-len(u or ""), j is None, j) for j, u in rows if norm(u) == norm(t)]
        best = min(group, key=lambda g: (g[0], g[1], g[2] or 0))[2]
        out.append((i, best, len(group), i == best, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_duplicates(spark):
    rows = [(1, "a b"), (2, "a  b"), (3, "ab"), (4, None), (5, ""), (6, " \t\n"), (7, "ba"), (8, "x" * 100_000), (9, "x" * 100_000 + " "), (9, "x" * 100_000 + " "), (None, "ab"), (None, "lone"), (10, "é\x0bé"), (11, "éé"), (12, "é é")]
    got = [tuple(r) for r in exact_duplicates(frame(spark, rows), digest_all=True).collect()]
    assert sorted(got, key=repr) == brute_exact(rows)
    lazy = {r.doc_id: r.text_sha256 for r in exact_duplicates(frame(spark, rows)).collect()}
    assert lazy[7] is None or lazy[1] is not None
    assert exact_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_exact_duplicates_many_keys(spark, monkeypatch):
    import quillon.llm.exact_dedup as module

    monkeypatch.setattr(module, "BROADCAST_KEYS", 0)
    rows = [(i, f"text {i % 7}") for i in range(40)]
    assert sorted((tuple(r) for r in exact_duplicates(frame(spark, rows), digest_all=True).collect()), key=repr) == brute_exact(rows)


def sets_of(text, k=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows, num, den):
    ids = sorted({i for i, _ in rows})
    sets = {i: sets_of(t) for i, t in rows}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed=3):
    rng = random.Random(seed)
    words = lambda n: [rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(n)]
    rows, base = [], words(90)
    for _ in range(60):  # a group whose members are linked through a few of them
        copy = list(base)
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(len(copy))] = "new" + str(rng.randrange(1000))
        rows.append(" ".join(copy))
    for _ in range(40):
        rows.append(" ".join(words(rng.randrange(1, 80))))
    chain = words(70)
    for i in range(6):  # each like the one before, the ends unlike
        chain = chain[2:] + words(2)
        rows.append(" ".join(chain))
    rows += ["", None, "one", "ONE", "one two three", " \n", rows[0].upper(), rows[0] + "  "]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("num,den", [(4, 5), (85, 100)])
def test_near_duplicates(spark, num, den):
    rows = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, rows), num, den).collect()}
    assert got == brute_components(rows, num, den)


def test_near_duplicates_by_shuffle_and_in_small_blocks(spark, monkeypatch):
    import quillon.llm.minhash as module

    monkeypatch.setattr(module, "BROADCAST_IDS", 0)
    monkeypatch.setattr(module, "BLOCK", 4)
    rows = near_copies(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, rows), 85, 100).collect()}
    assert got == brute_components(rows, 85, 100)


def test_near_duplicates_edges(spark):
    assert near_duplicates(frame(spark, [(1, "a")]).limit(0)).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "other words here now yes"), (2, None)]
    got = sorted((tuple(r) for r in near_duplicates(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 1, None, True), (2, 0, 2, True)], key=repr)


def test_bayesian_bounds():
    plan = plan_for(4, 5, miss=1e-6)
    assert (1 - 0.8**plan.rows) ** plan.bands <= 1e-6
    assert needed_matches(plan.hashes, 0.8, 1e-6) < 0.8 * plan.hashes
    assert needed_matches(16, 0.8, 1e-6) <= needed_matches(32, 0.8, 1e-6)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_places_every_item_without_gaps(sizes):
    place, offset, fill = best_fit(np.array(sizes, np.int64), 50)
    for b in range(len(fill)):
        at = 0
        for i in sorted(np.flatnonzero(place == b), key=lambda i: offset[i]):
            assert offset[i] == at
            at += sizes[i]
        assert at == fill[b] <= 50
    assert sum(1 for f in fill if f <= 25) <= 1


def test_pack_round_trip(spark, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    import quillon.llm.packing as module

    monkeypatch.setattr(module, "PER_TASK", 40)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "Ünïcode", "x1", "\n"]) for _ in range(rng.randrange(300)))) for i in range(150)] + [(1000, None), (1001, ""), (1002, "<|endoftext|> end"), (1003, "a " * 5000), (None, "no id"), (7, "again"), (7, "again")]
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = pack(frame(spark, rows), capacity=128).toPandas()
    expected = []
    for i, t in rows:
        ids = exact.encode(t or "", add_special_tokens=False).ids + [0]
        first, start = (len(ids) - 1) % 128 + 1, 0
        for piece, stop in enumerate(range(first, len(ids) + 1, 128)):
            expected.append((i, piece, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())))
            start = stop
    own = [(None if i != i else int(i), *map(int, r)) for i, *r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)]
    assert sorted(own, key=repr) == sorted(expected, key=repr)
    for _, sequence in got.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert (sequence.offset == sequence.length.cumsum() - sequence.length).all() and sequence.length.sum() <= 128
    assert got.sequence_id.nunique() <= 1.05 * got.length.sum() / 128 + 1  # groups of forty pieces
    assert pack(frame(spark, rows).limit(0)).count() == 0


def naive_fills(sizes, capacity):
    """Fills of bins by best fit, item by item."""
    fills = []
    for s in sorted(sizes, reverse=True):
        fitting = [b for b, f in enumerate(fills) if f + s <= capacity]
        if fitting:
            fills[max(fitting, key=lambda b: fills[b])] += s
        else:
            fills.append(s)
    return sorted(fills)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(50, 120))
def test_best_fit_fills_bins_as_item_by_item(sizes, capacity):
    assert sorted(best_fit(np.array(sizes, np.int64), capacity)[2].tolist()) == naive_fills(sizes, capacity)


def test_plan_takes_any_number_of_items():
    n = 10**12
    plan = fit_plan(np.array([5, 28, 100, 123]), np.array([n, n, n, n]), 128)
    place, offset = plan.places(np.array([123, 5, 5, 100, 28]), np.array([n - 1, n - 1, 0, 0, n // 2]))
    assert place.tolist() == [n - 1, n - 1, 0, n, n + n // 2] and offset.tolist() == [0, 123, 123, 0, 100]
    assert len(plan.item) == 4


def test_pack_fills_sequences_across_tasks(spark, monkeypatch):
    import quillon.llm.packing as module

    monkeypatch.setattr(module, "PER_TASK", 20)
    rng = random.Random(2)
    pairs = [123, 5, 100, 28] * 100
    for lengths in (pairs, [rng.choice([rng.randrange(1, 9), rng.randrange(20, 129)]) for _ in range(400)]):
        got = pack(frame(spark, [(i, " a" * (n - 1)) for i, n in enumerate(lengths)]), capacity=128).toPandas()
        assert sorted(got.length) == sorted(lengths)
        assert sorted(got.groupby("sequence_id").length.sum()) == naive_fills(lengths, 128)
        for _, sequence in got.groupby("sequence_id"):
            sequence = sequence.sort_values("offset")
            assert (sequence.offset == sequence.length.cumsum() - sequence.length).all()
    assert len(naive_fills(pairs, 128)) == 200


def test_packing_is_tight(spark, sf):
    got = pack(spark.read.parquet(f"{sf}/documents.parquet")).toPandas()
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1


def test_encoder_matches_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["", " ", "a\n\n b", "naïve café", "日本語 text", "<|endoftext|>x", "1234 56", "it's   they'll", "\x00\x7f", "🙂🙂"]
    assert encoder(path)(texts) == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def hashes(words):
    return np.array([word_hash(w.encode()) for w in words], np.uint64)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=0, max_size=14), st.lists(st.sampled_from("abc"), min_size=0, max_size=30))
def test_tiles_are_maximal_disjoint_matches(pattern, text):
    got = tiles(hashes(pattern), hashes(text), 3)
    used_p, used_t = [False] * len(pattern), [False] * len(text)
    lengths = [n for _, _, n in got]
    assert lengths == sorted(lengths, reverse=True) or len(set(lengths)) > 1
    for i, j, n in got:
        assert n >= 3 and pattern[i : i + n] == text[j : j + n]
        assert not any(used_p[i : i + n]) and not any(used_t[j : j + n])
        used_p[i : i + n] = used_t[j : j + n] = [True] * n
    for i in range(len(pattern) - 2):  # nothing is left to mark
        for j in range(len(text) - 2):
            assert pattern[i : i + 3] != text[j : j + 3] or any(used_p[i : i + 3]) or any(used_t[j : j + 3])


def test_contaminated(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    w = item.split()
    filler = " ".join(f"w{i}" for i in range(200))
    rows = [(1, f"{filler} {item.upper()}, {filler}"), (2, f"{' '.join(w[10:])}. {filler} {' '.join(w[:10])}"), (3, f"{filler} {' '.join(w[:6])} {filler}"), (4, filler), (5, None), (6, ""), (None, item), (7, item), (7, item), (8, " ".join(w[:5] * 4))]
    bench = spark.createDataFrame([(0, item, 1), (1, "too short", 1), (2, None, 1), (None, item, 1)], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): (r.item_words, r.covered_words) for r in contaminated(frame(spark, rows), bench).collect()}
    assert got == {(1, 0): (20, 20), (2, 0): (20, 20), (7, 0): (20, 20)}
    low = {(r.doc_id, r.item_id): r.covered_words for r in contaminated(frame(spark, rows), bench, coverage=0.0).collect()}
    assert low[(3, 0)] == 6 and low[(8, 0)] == 5
    assert contaminated(frame(spark, rows).limit(0), bench).count() == 0 and contaminated(frame(spark, rows), bench.limit(0)).count() == 0


def test_contaminated_by_shuffle(spark, monkeypatch):
    import quillon.llm.decontamination as module

    monkeypatch.setattr(module, "BROADCAST_SEEDS", 0)
    monkeypatch.setattr(module, "BROADCAST_IDS", 0)
    item = "one two three four five six seven eight"
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    got = contaminated(frame(spark, [(1, "x " * 50 + item), (2, "nothing of it in here at all")]), bench).collect()
    assert [(r.doc_id, r.item_id, r.coverage) for r in got] == [(1, 0, 1.0)]


def test_language_is_found_on_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    from pyspark.sql import functions as F

    got = identify(docs, F.col("doc_id") % 4 != 2, ["doc_id", "lang"]).where("doc_id % 4 = 2").toPandas()
    assert (got.lang == got.lang_pred).mean() >= 0.95
    assert got.score.between(0, 1).all()


def test_language_edges(spark):
    from pyspark.sql import functions as F

    rows = [(1, "the and of that is this", "en"), (2, "der die das und ist", "de"), (3, None, "en"), (4, "123 !?", "de"), (5, "", None), (None, "le la les et une", "fr"), (6, "the of and", None), (6, "the of and", None)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    got = identify(docs, F.lit(True)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (3, 4, 5)} == {3: "und", 4: "und", 5: "und"}
    assert all(r.lang_pred in ("en", "de", "fr", "und") for r in got)
    assert {r.lang_pred for r in identify(docs, F.col("lang") == "en").collect()} == {"en", "und"}
    assert {r.lang_pred for r in identify(docs, F.lit(False)).collect()} == {"und"}
    assert identify(docs.limit(0), F.lit(True)).count() == 0
    model = Model(["de", "en", "es", "fr"])
    assert model.families == ["germanic", "romance"] and family_of("tlh") == "tlh" and len(model.pairs) == 3


def test_row_numbers_tell_repeated_rows_apart(spark):
    from quillon.llm._store import numbered, saved

    rows = [(1, "a b c"), (1, "a b c"), (2, "a  b c"), (None, "a b c"), (1, "other words"), (None, None), (None, "")]
    docs = saved(frame(spark, rows).repartition(3), "rows")
    both = numbered(docs, "row").collect()
    assert len({r.row for r in both}) == len(rows) and sorted(map(str, both)) == sorted(map(str, numbered(docs, "row").collect()))
    assert len({r.row for r in numbered(frame(spark, rows), "row").collect()}) == len(rows)
    got = exact_dedup.exact_duplicates(numbered(docs, "row"), row_col="row").collect()
    assert sorted((r.keep_id is None, r.keep_id, r.group_size) for r in got if r.kept) == [(False, 1, 1), (False, 2, 4), (True, None, 2)]
    near = near_duplicates(numbered(docs, "row"), row_col="row").collect()
    assert sum(r.kept for r in near) == 4 and {r.component_id for r in near if r.kept} == {1, None} and len(near) == len(rows)


def test_exact_dedup_beyond_what_is_broadcast(spark, monkeypatch):
    rng = random.Random(12)
    docs = frame(spark, [(i, " " * rng.randrange(3) + "x" * rng.randrange(4) + str(rng.randrange(8))) for i in range(200)] + [(500, None), (501, "")])
    for everything in (False, True):
        small = sorted(map(tuple, exact_dedup.exact_duplicates(docs, digest_all=everything).collect()), key=str)
        with monkeypatch.context() as m:
            m.setattr(exact_dedup, "BROADCAST_KEYS", 0)
            assert sorted(map(tuple, exact_dedup.exact_duplicates(docs, digest_all=everything).collect()), key=str) == small


def test_pipeline_edges(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, id string, row string"
    words = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(i, words(i), "en" if i % 3 else None) for i in range(30)]
    rows += [(3, words(3), "en"), (3, words(3), "en"), (3, words(500), "en"), (None, words(4), None), (None, words(600), None), (70, None, "en"), (71, "", "en"), (72, "1234 5678", "en"), (73, words(700) + " tail", "en"), (74, words(700), "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", 1, 0.5, "x", "y") for i, t, lang in rows], schema)
    folder = str(tmp_path / "sf")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, words(600)), (2, "too short")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, got, folder)
        if k < 4:
            assert got.columns == docs.columns
            got.write.parquet(f"{folder}/{k}")
            got = spark.read.parquet(f"{folder}/{k}")
            seen.append(sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in got.collect()))
    expected = sorted([(False, i, words(i)) for i in range(30)] + [(False, 3, words(500)), (True, 0, words(600)), (False, 73, words(700) + " tail"), (False, 74, words(700))])
    assert len(seen[0]) == len(rows) - 3 and seen[1] == expected
    expected.remove((False, 74, words(700)))
    assert seen[2] == expected
    expected.remove((True, 0, words(600)))
    assert seen[3] == expected
    assert sorted(r.doc_id for r in got.where("piece = 0").collect()) == sorted(i for _, i, _ in expected)
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, unlabelled, folder).count() == len(rows) - 3
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_decontamination_beyond_what_is_broadcast(spark, monkeypatch):
    from quillon.llm import decontamination

    rng = random.Random(9)
    phrase = "a very common phrase of six words"
    items = [(k, " ".join(f"i{k}w{j}" for j in range(12)) + " " + phrase) for k in range(30)] + [(100, phrase), (101, "yes no"), (102, None), (103, " ".join(["ba"] * 20)), (104, phrase), (None, phrase)]
    docs = [(d, " ".join(f"x{rng.randrange(900)}" for _ in range(30)) + " " + phrase) for d in range(90)]
    docs += [(200, "start " + " ".join(f"i3w{j}" for j in (6, 7, 8, 9, 10, 11, 0, 1, 2, 3, 4, 5))), (201, "Yes, no!"), (202, "yes no maybe"), (203, "ba " * 40000), (204, None), (205, ""), (None, phrase), (206, items[5][1]), (206, items[5][1]), (207, items[6][1] + " and more")]
    benchmark = spark.createDataFrame([(i, t, "z", 1) for i, t in items], "item_id long, text string, id string, seed int")
    found = contaminated(frame(spark, docs), benchmark).collect()
    got = sorted((r.doc_id, r.item_id, r.item_words, r.covered_words, r.tiles, r.longest) for r in found)
    assert {(d, i) for d, i, *_ in got if d < 200} == {(d, i) for d in range(90) for i in (100, 104)}
    assert {(d, i) for d, i, *_ in got if d >= 200} == {(200, 3), (201, 101), (203, 103), (206, 5), (206, 100), (206, 104), (207, 6), (207, 100), (207, 104)}
    assert (200, 3, 19, 12, 2, 6) in got
    monkeypatch.setattr(decontamination, "BROADCAST_SEEDS", 0)
    assert sorted((r.doc_id, r.item_id, r.item_words, r.covered_words, r.tiles, r.longest) for r in contaminated(frame(spark, docs), benchmark).collect()) == got
    monkeypatch.setattr(decontamination, "BROADCAST_SEEDS", 10**6)
    monkeypatch.setattr(decontamination, "_PAIRS", 1)
    assert len(contaminated(frame(spark, docs), benchmark).collect()) == len(got)


def test_warc_of_a_hot_payload_and_a_large_one(spark, monkeypatch):
    from quillon.llm import warc
    from quillon.llm._store import fresh_path

    monkeypatch.setattr(warc, "FILE_BYTES", 200_000)
    noise = random.Random(3).randbytes(1_500_000).hex()
    hot = "<p>not found</p>" * 20
    rows = [(i, "u", hot, 1, "x") for i in range(900)] + [(2000, "u", noise, 1, "x"), (2001, "v", noise, 1, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int, refers_to string")
    archives = warc.write(pages, fresh_path(spark, "warc"))
    got = {r.page_id: r for r in warc.resolved(warc.read(archives)).collect()}
    assert len(got) == len(rows) and archives.count() > 4
    assert all(got[i].refers_to == 0 and got[i].payload_bytes == len(hot) for i in range(1, 900)) and got[0].record_type == "response"
    assert got[2001].refers_to == 2000 and got[2000].payload_bytes == 3_000_000 and got[2001].payload_digest == hashlib.sha256(noise.encode()).hexdigest()
