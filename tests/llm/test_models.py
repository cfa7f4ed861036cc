"""Language-model scores, toxicity, WARC, licences, personal data and the pipeline."""

import hashlib
import math
import random
import re
import tracemalloc
import types
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillon.llm import licenses, pii, ppm, toxicity, warc
from quillon.llm._store import fresh_path, shared_dir
from quillon.llm._words import buffers, find_words

DOC = "doc_id long, text string, n int, score string, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], DOC)


def trained(texts, order):
    data, offsets = buffers(pa.array(texts))
    words = find_words(data, offsets)
    text = ppm.stream(data, offsets, words, order)
    counter = ppm.Counter()
    counter.add(ppm.grams(text.symbols, text.at, order))
    keys, counts = counter.total()
    return ppm.Model(keys, counts, order), text


def test_stream_is_the_canonical_text():
    texts = ["  A b\n\nc ", "", "x", " \t "]
    _, text = trained(texts, 3)
    coded = [bytes(s for s in text.symbols[text.at[a:b]].tolist() if s != ppm.BOUNDARY) for a, b in zip(text.first, text.first[1:])]
    assert coded == [b"a b c", b"", b"x", b""]
    assert (text.symbols[text.at[text.first[1:] - 1]] == ppm.BOUNDARY).all()


@pytest.mark.parametrize("order", [1, 3, 5])
def test_probabilities_sum_to_one(order):
    rng = random.Random(order)
    texts = ["".join(rng.choice("aab bc d") for _ in range(60)) for _ in range(20)]
    model, _ = trained(texts, order)
    for _ in range(60):
        context = [rng.choice([ppm.BOUNDARY, *b"abcdz "]) for _ in range(order)]
        key = 0
        for s in context:
            key = (key << 9) | s
        keys = np.array([(key << 9) | s for s in range(257)], np.uint64)
        assert abs((10 ** model.log_probability(keys)).sum() - 1) < 1e-5


def brute_base(rows, held):
    from collections import Counter

    counts, tokens = Counter(), lambda t: [*(t or "").encode().lower().split(), None]
    for (_, t), h in zip(rows, held):
        if not h:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    return n, [(len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))) for _, t in rows]


def test_lm_scores(spark, monkeypatch):
    monkeypatch.setattr(ppm, "HEAD_WORDS", 5)
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "of", "Tion", "é", f"w{rng.randrange(40)}"]) for _ in range(rng.randrange(60)))) for i in range(80)] + [(100, None), (101, ""), (102, "the " * 20000), (None, "the of"), (3, "unseen words")]
    held = [i is not None and i % 5 == 1 for i, _ in rows]
    docs = frame(spark, rows)
    got = ppm.score(docs, F.col("doc_id") % 5 == 1).collect()
    n, expected = brute_base(rows, held)
    mine = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got)
    assert mine == sorted((-1 if i is None else i, a, b, round(c, 6)) for (i, _), (a, b, c) in zip(rows, expected))
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    again = ppm.score(docs, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in again)
    assert ppm.score(docs.limit(0), F.lit(False)).count() == 0


def test_lm_score_beats_words_on_held_out_text(spark):
    from quillon.llm.queries import op1_lm_score

    got = op1_lm_score(spark, "/root/testdata/sf0.1").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_lm_score_beside_words_on_a_small_corpus(spark):
    """With few training texts the model is worse than word counts (by 17 % at sf0.001, as the README says)."""
    from quillon.llm.queries import op1_lm_score

    got = op1_lm_score(spark, "/root/testdata/sf0.001").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert 1.2 * got[1] < got[0] < got[1]


def test_model_falls_back_to_shorter_contexts(spark, monkeypatch):
    monkeypatch.setattr(ppm, "MODEL_GRAMS", 20)
    got = ppm.score(frame(spark, [(1, "some words to learn from"), (2, "other ones")]), F.lit(False)).collect()
    assert all(math.isfinite(r.score) for r in got)


@pytest.mark.parametrize("most", [0, 20, 150])
def test_scores_do_not_depend_on_what_fits_in_memory(spark, monkeypatch, most):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("aab bcé d") for _ in range(rng.randrange(60)))) for i in range(60)] + [(100, None), (101, "XYZ zzz"), (102, "ab " * 500), (None, "abc")]
    docs = frame(spark, rows).withColumn("row", F.monotonically_increasing_id())
    held = F.col("row") % 3 == 1
    whole = {r.row: r for r in ppm.score(docs, held, id_col="row").collect()}
    monkeypatch.setattr(ppm, "MODEL_GRAMS", most)
    part = {r.row: r for r in ppm.score(docs, held, id_col="row").collect()}
    assert whole.keys() == part.keys() and len(part) == len(rows)
    assert all(abs(whole[i].score - part[i].score) < 1e-4 * (1 - whole[i].score) for i in whole)
    assert all(whole[i][:6] == part[i][:6] for i in whole)


def peak_mb(run):
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def counted(batches, order=5):
    """(kind, key) to count, and the number of rows of a counting task."""
    found, rows = Counter(), 0
    for b in ppm._count(order)(iter(batches)):
        rows += b.num_rows
        for kind, key, n in zip(*(b.column(i).to_pylist() for i in range(3))):
            found[kind, key] += n
    return found, rows


def test_counting_task_takes_little_memory():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(1000)) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    (found, _), peak = peak_mb(lambda: counted([batch]))
    assert sum(map(len, texts)) > 4e6 and peak < 100
    assert sum(n for (kind, _), n in found.items() if kind == ppm._WORD) == 600_000 and found[ppm._DOC, 0] == 600
    assert sum(n for (kind, _), n in found.items() if kind == ppm._GRAM) == sum(len(t) + 1 for t in texts)


def test_counting_task_passes_on_what_it_holds(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdef ") for _ in range(50)) for _ in range(200)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 10])], ["text"]) for i in range(0, 200, 10)]
    whole, rows = counted(batches)
    assert rows == len(whole)
    monkeypatch.setattr(ppm, "MERGE_KEYS", 50)
    monkeypatch.setattr(ppm, "HELD_KEYS", 200)
    parts, more = counted(batches)
    assert parts == whole and more > rows


def test_model_takes_little_memory():
    rng = np.random.default_rng(7)
    keys = np.unique(ppm.grams(rng.integers(97, 123, 300_000).astype(np.uint16), np.arange(5, 300_000), 5))
    _, peak = peak_mb(lambda: ppm.Model(keys, np.ones(len(keys), np.int64), 5))
    assert peak * 1e6 < 200 * len(keys)


def test_model_replaces_its_counts_in_a_worker():
    keys = np.array([97, (97 << 9) | 98], np.uint64)
    shared = types.SimpleNamespace(value={"parts": (ppm.Head, keys, np.array([-1.0, -2.0]))})
    model = ppm._model(shared)
    assert model.log_probability(keys).tolist() == [-1.0, -2.0]
    assert ppm._model(shared) is model and list(shared.value) == ["model"]


@pytest.mark.parametrize("n", [0, 1, 15, 16, 5000])
def test_table_finds_its_keys_only(n):
    rng = np.random.default_rng(n)
    keys = rng.permutation(np.unique(rng.integers(0, 1 << 54, 2 * n + 9).astype(np.uint64)))
    table = ppm.Table(keys[:n], np.arange(n), np.arange(n) * 0.5)
    slot = table.find(keys)
    assert (slot[:n] >= 0).all() and (slot[n:] == -1).all()
    assert (table.values[0][slot[:n]] == np.arange(n)).all() and (table.values[1][slot[:n]] == np.arange(n) * 0.5).all()
    assert len(table.find(keys[:0])) == 0 and table.values[0][-1] == 0


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.classify(docs, labels.where("doc_id % 3 <> 0"), toxicity.default_categories(), "toxic")
    held = labels.where("doc_id % 3 = 0").select("doc_id", F.col("toxic").alias("truth")).join(got, "doc_id").toPandas()
    assert got.count() == docs.count()
    assert held[held.truth == 0].toxic.mean() < 0.03 and held[held.truth == 1].toxic.mean() > 0.6


def test_toxicity_edges(spark):
    rows = [(i, "you idiot trash" if i % 2 else "kind words only") for i in range(40)] + [(100, None), (101, ""), (None, "idiot"), (0, "kind words only")]
    labels = spark.createDataFrame([(i, i % 2, "z") for i in range(40)] + [(None, 1, "z"), (5, None, "z")], "doc_id long, toxic int, text string")
    got = toxicity.classify(frame(spark, rows), labels, toxicity.default_categories(), "toxic")
    by = {r.doc_id: r.toxic for r in got.collect()}
    assert got.count() == len(rows) and by[1] and not by[0] and not by[100] and by[None]
    assert not any(r.toxic for r in toxicity.classify(frame(spark, rows), labels.limit(0), toxicity.default_categories(), "toxic").collect())
    assert toxicity.classify(frame(spark, rows).limit(0), labels, toxicity.default_categories(), "toxic").count() == 0


def test_chain_uses_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    words = [np.unique(rng.integers(0, 30, 8)).astype(np.int32) for _ in range(200)]
    y = np.array([[float(3 in w), float(3 in w and 4 in w)] for w in words])
    chain = toxicity.Chain(["a", "b"]).fit(np.arange(30), sparse(words, 30), y, np.arange(200) % 5)
    assert [len(w) for w in chain.weights] == [len(chain.features) + 1, len(chain.features) + 2]


def sparse(words, columns):
    """Rows in which each of these words stands once in eight."""
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return toxicity.Rows(owner, np.concatenate(words).astype(np.int64), toxicity.strength(np.ones(len(owner)), np.full(len(owner), 8)), len(words), columns)


def brute_logistic(x, y, penalty):
    """Newton's method on a dense matrix whose last column is the constant."""
    w, keep = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    keep[-1] = 1e-3
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(keep), x.T @ (p - y) + keep * w)
    return w


def test_chain_against_brute_force(monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_ASSOCIATION", -1.0)
    rng = np.random.default_rng(5)
    words = [np.unique(rng.integers(0, 12, 6)).astype(np.int32) for _ in range(150)]
    y = np.array([[float(3 in w) if rng.random() < 0.9 else 1.0, float(3 in w or 4 in w)] for w in words])
    folds = np.arange(150) % 5
    x, value = np.zeros((150, 13)), float(toxicity.strength(np.ones(1), np.full(1, 8))[0])
    for r, w in enumerate(words):
        x[r, w] = value
    x[:, -1] = 1.0
    unseen = np.zeros(150)
    for f in range(5):
        unseen[folds == f] = 1 / (1 + np.exp(-x[folds == f] @ brute_logistic(x[folds != f], y[folds != f, 0], 0.05)))
    both = np.hstack([x[:, :-1], unseen[:, None], x[:, -1:]])
    expected = brute_logistic(x, y[:, 0], 0.05), brute_logistic(both, y[:, 1], 0.05)
    exact = toxicity.logistic
    monkeypatch.setattr(toxicity, "logistic", lambda r, z: exact(r, z, steps=60000, tolerance=1e-13))
    chain = toxicity.Chain(["a", "b"]).fit(np.arange(12), sparse(words, 12), y, folds)
    for mine, brute in zip(chain.weights, expected):
        assert np.abs(mine - brute).max() < 1e-3
    feature = np.concatenate(words).astype(np.int64)
    got = chain.predict(np.repeat(np.arange(150), [len(w) for w in words]), feature, np.full(len(feature), value), 150)
    first = 1 / (1 + np.exp(-x @ expected[0]))
    second = 1 / (1 + np.exp(-np.hstack([x[:, :-1], first[:, None], x[:, -1:]]) @ expected[1]))
    assert np.abs(got - np.stack([first, second], 1)).max() < 1e-3


def test_toxicity_learns_every_language(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.classify(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels.where("doc_id % 3 <> 0"), toxicity.default_categories(), "toxic")
    held = labels.where("doc_id % 3 = 0").select("doc_id", F.col("toxic").alias("truth")).join(got, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (held[held.truth == 1].groupby("lang").toxic.mean() > 0.85).all() and held[held.truth == 0].toxic.mean() < 0.005


def test_toxicity_writes_files_by_its_sample_not_by_the_parts_of_the_documents(spark, monkeypatch):
    rows = [(i % 1300, f"{'vile' if i % 4 == 0 else 'kind'} word{i % 7} and word{i % 11}") for i in range(1400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(1300)], "doc_id long, toxic int")
    parts, kept = [], toxicity.saved

    def saved(df, name):
        parts.append(df.rdd.getNumPartitions())
        return kept(df, name)

    monkeypatch.setattr(toxicity, "saved", saved)
    found = [sorted(map(repr, toxicity.classify(frame(spark, rows).repartition(n), labels, toxicity.default_categories(), "toxic").collect())) for n in (1, 60)]
    assert parts == [3, 3] and found[0] == found[1] and len(found[0]) == 1400


def test_toxicity_finds_altered_words_and_counts_repeated_labels_once(spark):
    rng = random.Random(3)
    plain = ["river", "mountain", "forest", "window", "garden", "letter", "summer", "winter"]
    rows = [(i, " ".join(rng.choice(plain) for _ in range(12)) + (" zurkelblat" if i % 4 == 0 else "")) for i in range(400)]
    rows += [(1000, "river xzurkelblaten forest"), (1001, "river forest " * 30000 + "zurkelblat " * 400), (1002, "river forest garden")]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(1, 0)] * 50 + [(4, 0)] * 20, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(frame(spark, rows), labels, toxicity.default_categories(), "toxic").collect()}
    assert got[1000].toxic and got[1001].toxic and not got[1002].toxic and got[4].toxic
    assert len(got) == len(rows) and all(0 <= r.p_dense <= 1 and 0 <= r.p_varied <= 1 for r in got.values())


def brute_pages(rows):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        first = min(j for j, _, g in rows if j is not None and (g or "").encode() == data) if i is not None else None
        again = i is not None and len(data) >= 100 and i != first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(set(out), key=repr)


@pytest.mark.parametrize("size", [97, 5000])
def test_warc_round_trip(spark, monkeypatch, size):
    monkeypatch.setattr(warc, "RANGE_BYTES", size)
    rng = random.Random(4)
    noise = "".join(chr(rng.randrange(32, 1000)) for _ in range(3000))
    rows = [(i, f"http://x/{i}", f"<p>{i % 9}</p>" * 30) for i in range(40)] + [(50, None, None), (51, "u\r\nX: y", "short"), (52, "u", "short"), (53, "u", noise), (54, "u", noise), (None, "u", noise), (55, "u", "\x1f\x8b\x08" * 50), (56, "u", "é" * 60), (56, "u", "é" * 60)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, size int")
    archives = warc.write(pages, fresh_path(spark, "warc"))
    got = [tuple(r) for r in warc.resolved(warc.read(archives)).collect()]
    assert len(got) == len(rows)
    assert sorted(set(got), key=repr) == brute_pages(rows)
    payloads = {r.page_id: r.payload for r in warc.read(archives, with_payload=True).where("record_type = 'response'").collect()}
    assert payloads[53] == noise.encode() and payloads[50] == b""
    assert warc.read(warc.write(pages.limit(0), fresh_path(spark, "warc"))).count() == 0


def test_warc_reader_passes_over_what_is_no_record():
    import io

    good = [warc.member(warc.record(i, "u", f"payload {i}".encode() * 50, "d", None, "1970-01-01T00:00:00Z")) for i in range(5)]
    data = b"junk\x1f\x8b\x08 no member" + good[0] + warc.member(b"no warc") + good[1] + b"\x1f\x8b\x08" + good[2] + good[3][:40] + good[4]
    everything = [f["warc-record-id"] for _, f, _ in warc.records_in(io.BytesIO(data), len(data), 0, len(data))]
    assert everything == [f"<urn:quillon:page:{i}>" for i in (0, 1, 2, 4)]
    for cut in range(1, len(data), 37):
        halves = [f["warc-record-id"] for a, b in ((0, cut), (cut, len(data))) for _, f, _ in warc.records_in(io.BytesIO(data), len(data), a, b)]
        assert halves == everything


def brute_licenses(rows, least=0.8):
    found = {}
    grams = [(n, i, set(licenses.bigrams(t))) for i, (n, t) in enumerate(licenses.NOTICES)]
    for d, text in rows:
        for kind, parts in enumerate(([text or ""], re.split(r"\n[ \t\r]*\n", text or ""), (text or "").split("\n"))):
            for at, part in enumerate(parts, 1):
                own = set(licenses.bigrams(part))
                for name, i, b in grams:
                    dice = 2 * len(own & b) / (len(own) + len(b))
                    if dice >= least:
                        best = (dice, kind, -at, -i)
                        found[d, name] = max(found.get((d, name), best), best)
    return {k: (-v[3], licenses.KINDS[v[1]], -v[2], round(v[0], 9)) for k, v in found.items()}


def test_licenses(spark):
    notice = licenses.NOTICES
    rows = [(1, "x\nReleased under the MIT License.\ny"), (2, notice[3][1]), (3, f"intro\n\n{notice[11][1].replace(', ', chr(10))}\n\nend"), (4, "nothing here"), (5, None), (6, ""), (7, "license"), (8, "LICENSED   under cc-by-nc 4.0!"), (9, notice[4][1] + "\n" + notice[0][1]), (9, notice[4][1] + "\n" + notice[0][1]), (10, " ".join(notice[3][1].split()[:60])), (11, "software " * 5000)]
    got = {(r.doc_id, r.license): (r.template, r.unit, r.number, round(r.dice, 9)) for r in licenses.scan(frame(spark, rows)).collect()}
    assert got == brute_licenses(rows) and (1, "MIT") in got and (3, "BSD-3-Clause") in got
    assert licenses.scan(frame(spark, rows).limit(0)).count() == 0 and licenses.scan(frame(spark, rows), notices=[]).count() == 0
    plan = licenses.scan(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("ExistingRDD", ""))


def test_every_notice_is_found_as_its_licence(spark):
    """On a line of its own and wrapped into lines of a comment beside other words."""
    rows = []
    for i, (_, text) in enumerate(licenses.NOTICES):
        words = text.split()
        wrapped = "\n".join(" * " + " ".join(words[k : k + 7]) for k in range(0, len(words), 7))
        rows += [(2 * i, f"one\n{text}\ntwo"), (2 * i + 1, f"/* The work of some of us\n{wrapped}\n * and so it goes */")]
    got = {(r.doc_id, r.license) for r in licenses.scan(frame(spark, rows)).collect()}
    wanted = {(2 * i + k, name) for i, (name, _) in enumerate(licenses.NOTICES) for k in (0, 1)}
    assert wanted <= got, sorted(wanted - got)


def test_licenses_beside_other_words(spark):
    notice = [t for _, t in licenses.NOTICES]
    block = "/*\n * Copyright 2020 Jane Doe\n *\n" + "".join(f" * {' '.join(notice[3].split()[k : k + 9])}\n" for k in range(0, 70, 9)) + " *\n" + " * The above notice shall be included in all copies or large parts of these files, and no one will be held to account.\n" * 3 + " * It comes as it is, with no warranty of any kind, and its authors answer for no claim that might arise out of it in any way.\n */\nint main;"
    hashes = "#!/bin/sh\n# A tool by Jane\n#\n" + "".join(f"# {' '.join(notice[8].split()[k : k + 8])}\n" for k in range(0, 50, 8)) + "#\n" + "# some words on how to call this tool and what it writes to the screen\n" * 3
    rows = [
        (1, "Copyright 2020 Jane Doe. Licensed under the MIT License."),
        (2, "word " * 3000 + "and so this page is " + notice[13] + " more words " * 500),
        (3, block),
        (4, hashes),
        (5, "we heard that our little library is licensed under the GNU Lesser General Public License, version 3, for all who want it"),
        (6, "a long story says that this work is licensed under the GNU General Public License, version 2, and nothing else at all"),
        (7, "some say that this work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License and go on to tell of it"),
        (8, "the licence of this is under the terms of nobody, licensed by the version of the software"),
        (9, "long before that this was set Licensed under\nCC BY-SA 4.0. and more words came after it"),
        (10, notice[0] + "\nand here it was Licensed under the MIT License. too"),
        (11, "some words\nof text\n" + notice[6]),
    ]
    got = {(r.doc_id, r.license): (r.template, r.unit, r.number, r.dice) for r in licenses.scan(frame(spark, rows)).collect()}
    assert got[1, "MIT"] == (1, "run", 5, 1.0) and got[2, "CC-BY-4.0"] == (13, "run", 3006, 1.0)
    assert got[3, "MIT"][:2] == (3, "run") and got[4, "GPL-2.0"][:2] == (8, "run") and got[5, "LGPL-3.0"][:2] == (9, "run")
    assert got[9, "CC-BY-SA-4.0"][1] == "run" and got[10, "MIT"][:3] == (0, "line", 1)
    assert len(got) == 8 and got[11, "GPL-3.0"][1] == "line"


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute_spans(text):
    out = []
    for k, (kind, rx) in enumerate(BASE.items()):
        for m in rx.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            bad = kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)) or kind == "phone" and not 10 <= len(digits) <= 15
            if not bad:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return sorted(out)


def test_personal_data_base_spans(spark):
    rng = random.Random(6)
    bits = ["a.b@c.de", "@", "x@y", "x@y.z@w.v", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4539578763621486", "4539 5787 6362 1486", "4539-5787-6362-1487", "+1 (974) 555-3436", "+49 30 1234567", "+1", "😀é", " ", ", ", "v1.2.3.4", "12345", "..", "0000000000.1.2.3"]
    rows = [(i, "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(12)))) for i in range(300)] + [(900, None), (901, ""), (902, "a" * 50000 + "@b"), (903, "9" * 30000), (None, "x@y.zz"), (1, "x@y.zz")]
    got = pii.digest(pii.personal_data(frame(spark, rows))).collect()
    mine = sorted((-1 if r.doc_id is None else r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got)
    expected = []
    for i, t in rows:
        spans = brute_spans(t)
        expected.append((-1 if i is None else i, *(sum(s[1] == k for s in spans) for k in range(4)), hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest()))
    assert mine == sorted(expected)
    by = {r.doc_id: r.spans for r in got}
    assert all(s[2] in by[i].split(",") for i, t in rows if i is not None and i > 1 for s in brute_spans(t))
    assert pii.personal_data(frame(spark, rows).limit(0)).count() == 0


def test_em_finds_who_is_right():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    right = np.array([0.95, 0.9, 0.55])
    votes = np.where(rng.random((4000, 3)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    p, table = pii.reliabilities(patterns, counts.astype(float))
    assert table[1, 0, 2] > table[1, 2, 2] + 0.2 and table[0, 0, 0] > table[0, 2, 0] + 0.2
    assert p[(patterns == [1, 1, -1]).all(1)][0] > 0.8 and p[(patterns == [-1, -1, 1]).all(1)][0] < 0.2


def test_queries_cover_all_rows(spark, sf):
    from quillon.llm.queries import QUERIES

    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 11))
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op2_toxicity", "op8_pii"):
        assert QUERIES[name](spark, sf).count() == n


def test_shared_folder_is_read_from_the_session(spark):
    assert shared_dir(spark) and fresh_path(spark, "a") != fresh_path(spark, "a")


def test_pipeline_against_brute_force(spark, sf):
    import corpus_pipeline
    from test_documents import brute_components, brute_exact

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows = [(i, t) for i, t in rows if t and re.search(r"[^\W\d_]", t)]
    kept = {i for i, _, _, k, _ in brute_exact(rows) if k}
    rows = [r for r in rows if r[0] in kept]
    comps = brute_components(rows, 4, 5)
    rows = [r for r in rows if comps[r[0]][1] == r[0]]
    words = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.translate({c: c + 32 for c in range(65, 91)}))
    grams = [(w, {tuple(w[i : i + 5]) for i in range(len(w) - 4)}) for w in (words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect())]

    def clean(text):
        w = words(text)
        own = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        for item, g in grams:
            covered = {k for i in range(len(item) - 4) if tuple(item[i : i + 5]) in own and tuple(item[i : i + 5]) in g for k in range(i, i + 5)}
            if len(covered) >= len(item) / 2:
                return False
        return True

    expected = {i for i, t in rows if clean(t)}
    got = corpus_pipeline.run(spark, sf).toPandas()
    assert set(got.doc_id) == expected
    for _, sequence in got.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert (sequence.offset == sequence.length.cumsum() - sequence.length).all() and sequence.length.sum() <= 2048
    assert len(corpus_pipeline.STAGES) == 5 and zlib.crc32(b"") == 0
