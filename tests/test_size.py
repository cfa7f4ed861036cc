"""Steps that work on many rows at once, held against the plain ones."""

import random

import numpy as np
from pyspark.sql import functions as F

from quillon.config import load
from quillon.operators import rules, tables


def test_bands_are_aligned_together_as_alone():
    rnd = np.random.default_rng(3)
    for n in (1, 6, 13):
        left = np.round(rnd.integers(0, 6, (200, n)) * 40 + rnd.random((200, n)) * 30, 2)
        right, row = left + rnd.integers(5, 60, (200, n)), rnd.integers(0, 4, (200, n))
        column, several = tables.align_many(left, right, row, 0.4)
        for b in range(200):
            one, more = tables.align(left[b], right[b], row[b], 0.4)
            assert one.tolist() == column[b].tolist() and more == several[b]


def test_pages_are_searched_together_as_alone(spark, monkeypatch):
    """Words are shuffled once, by document, and batches may end anywhere."""
    rnd, words = random.Random(5), []
    for d in range(60):
        for p in range(rnd.choice([1, 3])):
            drift, y = rnd.choice([0, 0, 45]), 0.0
            for r in range(rnd.randint(1, 6)):
                y += rnd.choice([20.0, 20.0, 90.0])
                for c in range(rnd.randint(2, 4)):
                    x, s = 100.0 * c + drift * r + rnd.choice([0, 3.0005]), rnd.choice([None, rnd.randint(-2, 90)])
                    words += [(f"d{d}", p, "w", x + 24 * k, y, x + 24 * k + 20, y + 10, s, None if s is None else s + 4) for k in range(rnd.choice([1, 2]))]
    words = spark.createDataFrame(words, "doc_id string, page int, text string, x0 double, y0 double, x1 double, y1 double, char_start int, char_end int")
    docs = spark.range(50).select(F.concat(F.lit("d"), "id").alias("doc_id"), F.repeat(F.lit("ab\ncd "), 20).alias("full"))
    found = []
    for together, gathered in ((256, 1 << 16), (0, 1 << 16), (256, 40)):
        from pyspark import cloudpickle

        monkeypatch.setattr(tables, "TOGETHER", together)
        monkeypatch.setattr(tables, "GATHERED", gathered)
        cloudpickle.register_pickle_by_value(tables)
        try:
            found.append(sorted(map(repr, tables.geometry(words, docs).collect())))
        finally:
            cloudpickle.unregister_pickle_by_value(tables)
    assert len(found[0]) > 100 and found[0] == found[1] == found[2]
    plan = tables.geometry(words, docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_markers_hold_alike_on_texts_that_are_ascii_and_not(spark):
    """What is looked for before a pattern is in every match; a letter that is not ASCII takes the pattern as it is written."""
    assert rules.needles(r"\baccount\s+(?:opening|closure)\s?form\b(?!x)") == ["account", [["opening"], ["closure"]], "form"]
    assert rules.needles(r"a*(?:b|c?)[de]") == [] and rules.needles(r"\p{L}x") == []
    texts = ["TAX  Invoice no. 7", "p.o. No 5", "Know your CLIENT", "kyc form: re-kyc", "W.P.(C) No. 12", "repayment schedule", "its repayment schedule", "xinvoice", "invoice_", "tax\ninvoice", "", None]
    texts += [t + "\u00e9" for t in texts if t] + ["tax \u0131nvoice", "account\u2003statement", "ta\u017fx", "pay\u017flip"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, full string").repartition(2)
    patterns = sorted({m["pattern"] for markers in load().classes.values() for m in markers if m.get("pattern")})
    made = {f"a{k}": rules.fires({"pattern": p}, rules.scopes(F.col("full"), F.array("full"))) for k, p in enumerate(patterns)}
    plain = {f"b{k}": (F.char_length("full") > 0) & F.col("full").rlike("(?iU)" + p) for k, p in enumerate(patterns)}
    for r in rows.select("full", F.struct(*[c.alias(n) for n, c in made.items()]).alias("a"), F.struct(*[c.alias(n) for n, c in plain.items()]).alias("b")).collect():
        assert list(r.a) == list(r.b), r.full
    one = rows.where("i = 0").select(rules.class_scores(F.col("full"), F.array("full"))).first()[0]
    assert one == {"invoice": 0.95}
    # Lowered twice for the text and for a page that differs, not for each of a hundred terms.
    plan = rows.select(rules.class_scores(F.col("full"), F.array("full")).alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") <= 3


def test_tables_and_their_headers_are_found_in_one_pass(spark):
    """Bands of one shape are searched once, and a table's header and size come from the same pass over its cells."""
    page = "Item     Qty\n{}        1\n{}        2\n\nName     Sum\nx        3\ny        4"
    pages = spark.createDataFrame([(f"d{k}", 0, page.format(chr(97 + k), chr(98 + k)), 0) for k in range(3)], "doc_id string, page int, text string, page_start int").coalesce(1)
    cells = tables.text_grid(pages)
    got = {(r.doc_id, r.tbl): r for r in tables.assemble(cells).collect()}
    assert len(got) == 6 and got["d2", 0].header == ["Item", "Qty"] and got["d1", 1].header == ["Name", "Sum"] and {r.n_rows for r in got.values()} == {3}
    assert {(r.row, r.col): r.text for r in cells.where("doc_id = 'd1' and tbl = 0").collect()}[2, 0] == "c"
    assert [tuple(r) for r in tables.sizes(cells).where("doc_id = 'd0'").orderBy("tbl").collect()] == [("d0", 0, 3, 2, 6, True), ("d0", 1, 3, 2, 6, True)]
    for found in (tables.assemble(cells), tables.sizes(cells)):
        assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_texts_are_scored_once_and_tags_won(spark):
    from quillon.functions import quality

    rows = spark.createDataFrame([("the lnvo1ce t0tal is due",), ("café lnvo1ce t0tal MiXed",), ("",), (None,)], "t string").repartition(1)
    got = [tuple(r.q) for r in rows.select(quality.score_text(F.col("t")).alias("q")).collect()]
    assert got == [(0.6, 0.2, 0.4, 0.0, 0.0, 5), (1.333333, 0.333333, 0.666667, 0.333333, 0.25, 4), (0.0,) * 5 + (0,), (0.0,) * 5 + (0,)]
    plan = rows.select(quality.score_text(F.col("t"))["score"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") <= 2  # six times where each rate is an expression of its own
    empty, late = F.create_map().cast("map<string,double>"), F.create_map(F.lit("signed"), F.lit(0.4), F.lit("multi_page"), F.lit(0.3))
    (tags,) = rows.limit(1).select(rules.apply_tags(late, F.create_map(F.lit("signed"), F.lit(0.4)))).first()
    assert [tuple(t) for t in tags] == [("signed", 0.4, "derived")] and rows.limit(1).select(rules.apply_tags(empty, empty)).first()[0] == []
