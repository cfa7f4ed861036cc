"""Rules, fields, graph, tables, evaluation and review on small inputs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.config import load
from quillon.operators import evaluate, fields, graph, profile, review, rules, tables
from quillon.schema import offset_violations, range_violations
from quillon.sources import documents as sources

INVOICE = "TAX INVOICE\nInvoice No: INV-2024-0042\nInvoice Date: 14/03/2024\nSold By: Acme Trading\nGSTIN: 27AAPFU0939F1ZV\nIFSC: HDFC0001234\nAccount Number: 123456789012\n" + "x " * 60 + "\nBill To: Beta Stores\nGrand Total: Rs. 1,234.50"


def docs(spark, *texts, label="unknown"):
    return spark.createDataFrame([(f"d{i}", t, [t or ""], label) for i, t in enumerate(texts)], "doc_id string, full string, pages array<string>, label string")


def test_config_names_everything():
    config = load()
    assert len(config.classes) == 17 and sum(map(len, config.classes.values())) == 77
    assert len(config.fields["fields"]) == 15 and len(config.tags["tags"]) == 11


def test_markers(spark):
    texts = rules.scopes(F.col("full"), F.col("pages"))
    one = lambda m, t: docs(spark, t).select(rules.fires(m, texts).alias("x")).first().x
    assert one({"any": ["net pay"]}, "the NET PAY is") and not one({"any": ["net pay"]}, "internet payment")
    assert not one({"all": [], "any": []}, "x") and not one({"pattern": ".*"}, "") and not one({}, "x")
    assert one({"all": ["a"], "any": ["b", "c"]}, "a c") and not one({"all": ["a"], "any": ["b"]}, "a c")


@pytest.mark.parametrize("text,label", [(INVOICE, "invoice"), ("PURCHASE ORDER\nVendor: x", "purchase_order"), ("Purchase Order No. 5 only", "unknown"), ("CASH RECEIPT", "receipt"), ("bank statement of things", "bank_statement"), ("hello", "unknown"), ("", "unknown"), ("payable upon receipt, amount paid", "unknown")])
def test_cascade_of_rules(spark, text, label):
    scores = rules.class_scores(F.col("full"), F.col("pages"))
    assert docs(spark, text).withColumn("r", scores).select(rules.cascade(F.col("r")).alias("c")).first().c.label == label


def test_cascade_with_a_model(spark):
    none = F.create_map().cast("map<string,double>")
    made = lambda r, m: spark.range(1).select(rules.cascade(r, m).alias("c")).first().c
    rule = lambda x: F.create_map(F.lit("invoice"), F.lit(x))
    model = lambda x: F.create_map(F.lit("contract"), F.lit(x), F.lit("a"), F.lit(0.1))
    assert made(rule(0.95), model(0.99))[0] == "invoice"
    assert made(rule(0.8), model(0.5))[0] == "contract"
    assert made(rule(0.8), model(0.2))[0] == "invoice"
    assert tuple(made(rule(0.5), model(0.2)))[:2] == ("unknown", 0.2) and made(none, F.lit(None).cast("map<string,double>")).confidence == 0.0


def extracted(spark, *texts, label="unknown"):
    return [{m.field: m for m in r.metadata} for r in fields.extract(docs(spark, *texts, label=label)).orderBy("doc_id").collect()]


def test_fields_of_an_invoice(spark):
    (got,) = extracted(spark, INVOICE, label="invoice")
    assert got["gstin"].validated and got["gstin"].method == "regex_checksum" and got["pan"].validated is not None if "pan" in got else True
    assert got["invoice_number"].value == "INV-2024-0042" and got["invoice_number"].method == "anchor"
    assert got["invoice_date"].normalized_value == "2024-03-14" and got["total_amount"].normalized_value == "1234.50" and got["total_amount"].currency == "INR"
    assert got["vendor_name"].value == "Acme Trading" and got["buyer_name"].value == "Beta Stores" and got["account_number"].value == "123456789012"
    assert all(INVOICE[m.char_start : m.char_end] == m.value for m in got.values())


def test_fields_of_other_classes_and_empty_texts(spark):
    a, b, c = extracted(spark, INVOICE, "", None, label="contract")
    assert "invoice_number" not in a and "gstin" in a and b == {} and c == {}


def test_offsets_shift_with_the_text(spark):
    (a,), (b,) = extracted(spark, "card 4539 5787 6362 1486 end"), extracted(spark, "😀é\n" * 9 + "card 4539 5787 6362 1486 end")
    assert b["card_number"].char_start == a["card_number"].char_start + 27 and b["card_number"].normalized_value == "4539578763621486"


def test_multiple_values_are_distinct_and_validated_first(spark):
    text = "AAPFU0939F ABCDE1234F AAPFU0939F AABCU9603R"
    got = fields.extract(docs(spark, text), only=["pan"]).first().metadata
    assert [(m.value, m.validated) for m in got] == [("AAPFU0939F", True), ("ABCDE1234F", False), ("AABCU9603R", True)]


def test_anchor_before(spark):
    spec = {"value": "([0-9]{3})", "labels": {"units": 1.0}, "direction": "before", "window": 20}
    got = docs(spark, "111 then 222 units").select(fields.anchor_candidates(F.col("full"), spec).alias("c")).first().c
    assert [(c.value, c.start) for c in got] == [("222", 9)]


def test_positions(spark):
    template = [{"match": {"regex": "FORM"}, "fields": {"total_amount": {"page": 0, "region": [0.5, 0.5, 1.0, 1.0]}}}]
    words = spark.createDataFrame([("d0", 0, "5", 60.0, 60.0, 65.0, 65.0, 0.9, 5, 6), ("d0", 0, "FORM", 1.0, 1.0, 9.0, 9.0, 0.9, 0, 4)], "doc_id string, page int, text string, x0 double, y0 double, x1 double, y1 double, conf double, char_start int, char_end int")
    sizes = spark.createDataFrame([("d0", 0, 100.0, 100.0)], "doc_id string, page int, w double, h double")
    got = fields.positional_candidates(words, sizes, docs(spark, "FORM 5"), template).collect()
    assert [(r.field, r.value, r.start) for r in got] == [("total_amount", "5", 5)]


def records(spark, rows):
    """rows: (doc_id, label, [(field, value, start, validated)])"""
    made = [(d, f"{d}.txt", (c, 0.9), [(f, v, v, 0, s, s + len(v), 1.0, "anchor", ok, "1", None) for f, v, s, ok in fs], ("native",), (1,)) for d, c, fs in rows]
    return spark.createDataFrame(made, "doc_id string, filename string, classification struct<label:string,confidence:double>, metadata array<struct<field:string,value:string,normalized_value:string,page:int,char_start:int,char_end:int,confidence:double,method:string,validated:boolean,normalizer_version:string,currency:string>>, text struct<method:string>, diagnostics struct<page_count:int>")


G1, G2 = "27AAPFU0939F1ZV", "29AAGCB7383J1Z4"


def test_graph(spark):
    r = records(spark, [
        ("a", "invoice", [("gstin", G1, 100, True), ("pan", G1[2:12], 90, True), ("vendor_name", "Acme", 80, False), ("buyer_name", "Beta", 300, False), ("invoice_number", "N1", 5, False), ("total_amount", "10", 9, False), ("ifsc", "HDFC0001234", 1, True), ("account_number", "123456789", 2, False)]),
        ("b", "invoice", [("invoice_number", "N1", 5, False), ("total_amount", "10", 9, False), ("gstin", G2, 4, False)]),
        ("c", "receipt", [("invoice_number", "N1", 5, False), ("invoice_number", "N9", 7, False), ("account_number", "55", 1, False)]),
    ])
    f = graph.fields_of(r)
    assert [tuple(x) for x in graph.mentions(f).collect()] == [("a", "AAPFU0939F")]
    assert graph.unverified(f).first()[0] == 1
    assert sorted(tuple(x) for x in graph.references(f).collect()) == [("c", "a", "N1"), ("c", "b", "N1")]
    assert [tuple(x) for x in graph.duplicate_edges(r).collect()] == [("a", "b", "invoice | N1 | 10")]
    assert [tuple(x) for x in graph.orphans(f).collect()] == [("c.txt", "receipt", "N9")]
    assert [tuple(x) for x in graph.accounts(f).collect()] == [("a", "HDFC0001234", "123456789")]
    assert [(x.role, x.name) for x in graph.match_roles(graph.role_pairs(f)).collect()] == [("issued_by", "Acme")]
    kinds = {x.type: x.n for x in graph.stats(graph.edges(r)).collect()}
    assert kinds == {"mentions_org": 1, "issued_by": 1, "pays_to": 1, "held_by": 1, "references": 2, "duplicate_of": 1}
    assert {x.kind for x in graph.nodes(r).collect()} == {"document", "organization", "account"}
    assert graph.exposure(r).first().documents == 1 and graph.chains(r).count() == 2 and graph.neighbours(graph.edges(r), "doc:a").count() >= 4
    assert graph.duplicates(r).first().documents == ["a", "b"]


def test_roles_too_close_to_call_are_refused(spark):
    r = records(spark, [("a", "invoice", [("gstin", G1, 100, True), ("vendor_name", "A", 80, False), ("buyer_name", "B", 130, False)])])
    assert graph.match_roles(graph.role_pairs(graph.fields_of(r))).count() == 0


GRID = "Report\n\nItem        Qty     Price\nPen           2     10.00\nBook          1    250.00\nInk           3     75.50\n\nThank you"


def test_text_grid(spark):
    pages = sources.pages_of(docs(spark, GRID, "Just a paragraph of prose\nwith two lines."))
    found = tables.text_grid(pages).where("refused is null")
    cells = {(r.row, r.col): r.text for r in found.collect()}
    assert cells[0, 0] == "Item" and cells[3, 2] == "75.50" and len(cells) == 12 and {r.doc_id for r in found.collect()} == {"d0"}
    assert all(GRID[r.char_start : r.char_end] == r.text for r in found.collect())
    (table,) = tables.assemble(found).collect()
    assert (table.n_rows, table.n_cols, table.header, table.confidence) == (4, 3, ["Item", "Qty", "Price"], 1.0)


def test_blank_runs(spark):
    got = spark.createDataFrame([(["ab  cd", "a   c"],)], "l array<string>").select(tables.blank_runs(F.col("l")).alias("r")).first().r
    assert [(r.start, r.end) for r in got] == [(2, 4)]


def boxes(spark, rows):
    return spark.createDataFrame([("d0", 0, t, x0, y0, x1, y0 + 10.0, 0.9, None, None) for t, x0, x1, y0 in rows], "doc_id string, page int, text string, x0 double, y0 double, x1 double, y1 double, conf double, char_start int, char_end int")


def test_geometry_finds_and_refuses(spark):
    grid = [(f"w{r}{c}{k}", 100.0 * c + 24 * k, 100.0 * c + 24 * k + 20, 20.0 * r) for r in range(3) for c in range(3) for k in range(2)]
    got = tables.geometry(boxes(spark, grid), docs(spark, "")).collect()
    assert {(r.row, r.col): r.text for r in got}[1, 2] == "w120 w121" and {r.n_cols for r in got} == {3}
    drift = [(f"w{r}{c}{k}", 100.0 * c + 45 * r + 24 * k, 100.0 * c + 45 * r + 24 * k + 20, 20.0 * r) for r in range(3) for c in range(3) for k in range(2)]
    assert all(r.refused for r in tables.geometry(boxes(spark, drift), docs(spark, "")).collect())


def test_space_and_segments():
    words = [{"text": f"w{i}", "x0": x, "y0": 0.0, "x1": x + 10, "y1": 5.0} for i, x in enumerate([0.0, 14.0, 60.0, 74.0])]
    page = tables.Page(words, load().settings["tables"])
    assert page.space == 4.0
    assert [" ".join(w["text"] for w in part) for part in (page.words[:2], page.words[2:])] == ["w0 w1", "w2 w3"] and page.first.tolist() == [0, 2]


def test_attach_boxes_across_buckets(spark):
    cells = spark.createDataFrame([("d", 0, 0, 0, 250, 262, None, None, None, None)], "doc_id string, tbl int, row int, col int, char_start int, char_end int, x0 double, y0 double, x1 double, y1 double")
    words = spark.createDataFrame([("d", 250, 254, 1.0, 1.0, 2.0, 2.0), ("d", 257, 262, 5.0, 0.0, 9.0, 3.0), ("d", 260, 264, 50.0, 0.0, 90.0, 3.0)], "doc_id string, char_start int, char_end int, x0 double, y0 double, x1 double, y1 double")
    r = tables.attach_boxes(cells, words).first()
    assert (r.x0, r.y0, r.x1, r.y1) == (1.0, 0.0, 9.0, 3.0)


def test_matching_prefers_ids_then_paths(spark):
    gold = spark.createDataFrame([(1, None, "x/a.pdf"), (2, "k", None), (3, None, "none.pdf")], "gold_n int, doc_id string, path string")
    pred = spark.createDataFrame([(7, "k", "a.pdf"), (8, None, "y/a.pdf")], "pred_n int, doc_id string, source_path string")
    assert {(r.gold_n, r.pred_n) for r in evaluate.match(gold, pred).collect()} == {(1, 7), (2, 7)}


def test_extraction_errors(spark):
    pairs = spark.createDataFrame([("a b c", "a  x c"), ("same", "same"), (None, "x")], "ref string, hyp string")
    assert tuple(evaluate.extraction(pairs).first()) == (2, 0.1, 0.1667)


def test_correct_abstention_counts_for_its_label_only(spark):
    pairs = spark.createDataFrame([(1, "unknown", "unknown", 0.1), (2, "a", "a", 0.9), (3, "a", "b", 0.8)], "ord int, truth string, got string, confidence double")
    r = evaluate.classification(pairs).first()
    assert (r.answered, r.accuracy_overall, r.accuracy_when_answered) == (2, 0.3333, 0.5)
    assert {x.label: x.tp for x in evaluate.per_label(pairs).collect()} == {"unknown": 1, "a": 1, "b": 0}


def test_adjacency_is_not_content(spark):
    cells = lambda t: spark.createDataFrame([("d", 0, r, c, v) for r, row in enumerate(t) for c, v in enumerate(row)], "doc string, tbl int, row int, col int, text string")
    a, b = cells([["a", "b"], ["c", ""]]), cells([["b", "a"], ["c", ""]])
    assert evaluate.bag_scores(a, b, ["text"]).first().f1 == 1.0
    assert evaluate.bag_scores(evaluate.adjacency(a), evaluate.adjacency(b), ["a", "b", "way"]).first().f1 < 0.5
    assert tuple(evaluate.table_detection(a, b).first()) == (1, 1, 1.0)


def test_threshold_ties_go_low(spark):
    rows = spark.createDataFrame([("t", 1, 0.9), ("t", 1, 0.8), ("t", 0, 0.1), ("n", 0, 0.4)], "tag string, truth int, prob double")
    assert {r.tag: (r.threshold, r.f1) for r in evaluate.fit_threshold(rows).collect()} == {"t": (0.5, 1.0), "n": (0.5, 0.0)}


def test_distribution_is_by_rank(spark):
    r = profile.distribution(spark.createDataFrame([(float(v),) for v in [5, 1, 4, 2, 3, 3, 10]], "v double"), "v").first()
    assert (r.n, r.min, r.p50, r.p90, r.max, r["mean"]) == (7, 1.0, 3.0, 10.0, 10.0, 4.0)
    assert profile.distribution(spark.createDataFrame([], "v double"), "v").count() == 0


def test_review_round_trip(spark):
    schema = "DOC_ID string, PREDICTED string, VERDICT string, CORRECTED string"
    old = spark.createDataFrame([("1", "invoice", "ok", ""), ("2", "invoice", "wrong", "receipt"), ("3", "invoice", "", ""), ("4", "invoice", "wrong", "contract")], schema)
    new = spark.createDataFrame([("1", "invoice", "", ""), ("2", "receipt", "", ""), ("3", "invoice", "", ""), ("4", "invoice", "", "")], schema)
    got = {r.DOC_ID: (r.VERDICT, r.CORRECTED) for r in review.carry_documents(new, old).collect()}
    assert got == {"1": ("ok", ""), "2": ("ok", ""), "3": ("", ""), "4": ("wrong", "contract")}
    gold = {r.doc_id: r.label for r in review.gold_documents(review.carry_documents(new, old)).collect()}
    assert gold == {"1": "invoice", "2": "receipt", "4": "contract"}


def test_review_of_fields(spark):
    schema = "DOC_ID string, FIELD string, VALUE string, CHAR_START string, CHAR_END string, VERDICT string, CORRECTED string"
    tab = spark.createDataFrame([("1", "pan", "aapfu0939f", "3", "13", "ok", ""), ("1", "email", "x", "1", "2", "wrong", "A@b.co"), ("1", "ifsc", "y", "1", "2", "spurious", "")], schema)
    got = {r.field: (r.normalized_value, r.char_start) for r in review.gold_fields(tab).collect()}
    assert got == {"pan": ("AAPFU0939F", 3), "email": ("a@b.co", None)}
    new = spark.createDataFrame([("1", "email", "z", "", "", "", "")], schema)
    assert {(r.FIELD, r.VERDICT, r.CORRECTED) for r in review.carry_fields(new, tab).collect()} == {("email", "wrong", "A@b.co")}
    assert {(r.FIELD, r.CORRECTED) for r in review.rescued_fields(new, tab).collect()} == {("pan", "aapfu0939f")}


def test_scan_and_extract(spark, tmp_path):
    import zipfile

    for name, text in {"a.txt": INVOICE, "._b.txt": "x", "c.zip": "x", "d.xlsx": "x", "e.weird": "x", "sub/f.md": "# hi\r\nthere", "g.pdf": "%PDF broken"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    with zipfile.ZipFile(tmp_path / "h.docx", "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>Hello</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>')
    listed = sources.list_files(spark, str(tmp_path))
    assert listed.count() == 8 and sources.kept_files(spark, str(tmp_path)).count() == 4
    assert {r.reason for r in listed.where("reason is not null").collect()} == {"macos_resource_fork", "archive", "evaluation_set", "unsupported_extension"}
    got = {r.path.rsplit("/", 1)[-1]: r for r in sources.extract(sources.read_files(spark, str(tmp_path))).collect()}
    assert got["h.docx"].pages == ["Hello\na\tb"] and got["f.md"].pages == ["# hi\nthere"]
    assert got["g.pdf"].errors and got["g.pdf"].pages == [""] and got["a.txt"].page_methods == ["native"]
    with pytest.raises(FileNotFoundError):
        sources.list_files(spark, str(tmp_path / "absent"))
    with pytest.raises(KeyError):
        sources.engine("none such")


def test_records_hold_together(spark):
    from quillon.plans.process import records as made
    from quillon.plans.process import resumed

    files = spark.createDataFrame([("d0", "x/a.txt", [INVOICE, "page two"], ["native", "native"], [0.98, 0.98], []), ("d1", "x/b.txt", [""], ["none"], [0.0], ["txt: failed"])], sources.EXTRACTED)
    out = made(files).persist()
    a, b = out.orderBy("doc_id").collect()
    assert a.classification.label == "invoice" and "multi_page" in [t.tag for t in a.tags] and a.text.full == INVOICE + "\n\f\n" + "page two"
    assert b.classification.label == "unknown" and b.diagnostics.errors == ["txt: failed"] and b.metadata == []
    assert offset_violations(out).count() == 0 and range_violations(out).count() == 0
    assert resumed(files, out.where("doc_id = 'd0'")).count() == 1


def test_words_and_offsets(spark):
    tokens = spark.createDataFrame([("d", 0, 1, 1, line, n, t, 0.9, 0.0, 0.0, 1.0, 1.0) for line, n, t in [(1, 1, "Hello"), (1, 2, "big"), (2, 1, "world")]], "doc_id string, page int, block int, par int, line int, word_num int, text string, conf double, x0 double, y0 double, x1 double, y1 double")
    r = sources.assemble_words(tokens).first()
    assert r.text == "Hello big\nworld" and all(r.text[w.char_start : w.char_end] == w.text for w in r.words)
    got = spark.range(1).select(sources.map_words(F.lit("a b a c"), F.array(*map(F.lit, ["a", "a", "b", "z"]))).alias("m")).first().m
    assert [(w.start, w.end) for w in got] == [(0, 1), (4, 5), (2, 3), (None, None)]


def test_running_shares_and_percentiles_on_millions_of_rows(spark):
    """The same exact answer each time, though ranges are sampled."""
    n = 3_000_000
    rows = spark.range(n).select(F.col("id").alias("ord"), F.lit("a").alias("truth"), F.when(F.pmod(F.xxhash64("id"), F.lit(1000)) < F.col("id") / n * 200, "b").otherwise("a").alias("got"), (1 - F.col("id") / n).alias("confidence"))
    right = rows.select((F.col("got") == "a").cast("int").alias("k"), "ord").toPandas().sort_values("ord").k.to_numpy().cumsum()
    error = 1 - right / np.arange(1, n + 1)
    for _ in range(2):
        got = {r.target: r.coverage for r in evaluate.coverage_at_error(rows, (0.02, 0.05, 0.5)).collect()}
        assert got == {t: round((np.flatnonzero(error <= t).max() + 1) / n, 4) for t in (0.02, 0.05, 0.5)} and 0 < got[0.02] < got[0.05] < 1 == got[0.5]
        half = profile.distribution(spark.range(n).select((F.col("id") * 7919 % n).alias("v")), "v").first()
        assert (half.n, half.min, half.p50, half.p90, half.max) == (n, 0, n // 2, int(0.9 * n), n - 1)


def brute_tables(lines, first, least_rows=2, least_cols=2, least_cells=6, gap=2, share=0.75):
    """Every run of lines is split at columns of blanks; the best run, then both sides of it."""

    def grid(part):
        width = max(map(len, part))
        blank = "".join("b" if all(x.ljust(width)[j] == " " for x in part) else "f" for j in range(width))
        spans = [m.span() for m in re.finditer(rf"f(?:b{{0,{gap - 1}}}f)*", blank)]
        cells = [[x[a:b] for a, b in spans if x[a:b].strip()] for x in part]
        good = len(spans) >= least_cols and sum(map(len, cells)) >= least_cells and sum(len(c) > 1 for c in cells) / len(part) >= share
        return (len(spans), [[c.strip() for c in row] for row in cells]) if good else None

    runs = [(-g[0], i - j, i, j, g[1]) for i in range(len(lines)) for j in range(i + least_rows, len(lines) + 1) if (g := grid(lines[i:j]))]
    if not runs:
        return []
    _, _, i, j, cells = min(runs)
    return [*brute_tables(lines[:i], first), (first + i, first + j, cells), *brute_tables(lines[j:], first + j)]


def test_grids_against_brute_force():
    rng = random.Random(11)
    options = load().settings["tables"]
    for _ in range(150):
        lines = []
        for _ in range(rng.randrange(2, 9)):
            columns = rng.choice([(0, 9, 18), (0, 12), (0, 9, 18, 26), (0,)])
            line = ""
            for c in columns:
                line = line.ljust(c) + rng.choice(["ab", "a b", "abcdef", "12345678", "x", "wide words here"])
            lines.append(line + rng.choice(["", "  "]))
        band = tables.Band(lines, options)
        got = []
        for lo, hi, columns, refused in band.tables():
            if not refused:
                rows = [[] for _ in range(lo, hi)]
                for k, _, s, e in band.cells(lo, hi, columns):
                    rows[k - lo].append(lines[k][s:e])
                got.append((lo, hi, rows))
        assert got == brute_tables(lines, 0), lines


def test_roles_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(f"d{d}", f"r{rng.randrange(3)}", f"n{k}", rng.randrange(400), f"o{rng.randrange(3)}", rng.randrange(0, 300, 7)) for d in range(200) for k in range(rng.randrange(1, 8))]

    def brute(pairs):
        pairs, out = sorted(pairs), {}
        while pairs:  # the nearest pair takes its turn; what it rules out goes
            distance, role, _, org, name = pairs[0]
            others = [p[0] for p in pairs_all if p > pairs[0] and p[3] == org and p[1] != role]
            won = not others or min(others) - distance >= 60
            if won:
                out[role] = (org, name, distance)
            pairs = [p for p in pairs if p[3] != org and not (won and p[1] == role)]
        return out

    expected = set()
    for doc in {r[0] for r in rows}:
        pairs_all = [(r[5], r[1], r[3], r[4], r[2]) for r in rows if r[0] == doc]
        expected |= {(doc, role, *v) for role, v in brute(pairs_all).items()}
    got = graph.match_roles(spark.createDataFrame(rows, "doc_id string, role string, name string, role_start int, org string, distance int"))
    assert {(r.doc_id, r.role, r.org, r.name, r.distance) for r in got.collect()} == expected
