"""The driver's contract, and that nothing but the entry depends on the corpus operators."""

import re
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_only_the_entry_knows_the_corpus_operators():
    for p in (ROOT / "quillon").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert not re.search(r"quillon\.llm|from \.+llm", p.read_text()), p


def test_some_queries_match_their_sql(spark, sf):
    import duckdb

    import __spark_entry__ as e

    con = duckdb.connect()
    for t in ("orders", "lineitem", "documents", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name in ("fld_pattern_card", "val_gstin", "ev_per_label", "pro_distribution", "src_map_words"):
        df = e.queries()[name](spark, sf)
        names = sorted(df.columns)
        mine = sorted(repr(tuple(r[c] for c in names)) for r in df.collect())
        found = con.execute(e.oracle_sql()[name])
        at = [[d[0] for d in found.description].index(c) for c in names]
        assert mine == sorted(repr(tuple(r[i] for i in at)) for r in found.fetchall()), name


def test_arriving_files_become_records_once(spark, tmp_path):
    from quillon.streaming.incremental import run

    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("TAX INVOICE")
    run(spark, folder, out, state).awaitTermination()
    (tmp_path / "in/b.txt").write_text("CASH RECEIPT")
    (tmp_path / "in/c.txt").write_text("TAX INVOICE")  # the same content again
    run(spark, folder, out, state).awaitTermination()
    got = [r.label for r in spark.read.parquet(out).select("classification.label").collect()]
    assert sorted(got) == ["invoice", "receipt"]


def test_reports_of_the_command_line(spark, tmp_path):
    """eval tells of tags, spans and texts, and reports are written as Markdown."""
    import json

    from quillon import cli

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("TAX INVOICE\nInvoice No: INV-2024-0042")
    folder = str(tmp_path)
    assert cli.main(["run", "--input", f"{folder}/in", "--output", f"{folder}/out"]) == 0
    row = spark.read.json(f"{folder}/out").first()
    (tmp_path / "gold.jsonl").write_text(json.dumps({"doc_id": row.doc_id, "label": "invoice", "tags": ["no_such_tag"], "text": row.text.full, "metadata": []}) + "\n")
    assert cli.main(["eval", "--gold", f"{folder}/gold.jsonl", "--pred", f"{folder}/out", "--markdown", "--output", f"{folder}/eval.md"]) == 0
    report = (tmp_path / "eval.md").read_text()
    assert "| invoice | 1 | 0 | 0 |" in report and "| no_such_tag | 0 | 0 | 1 |" in report and "| 1 | 0.0 | 0.0 |" in report
    assert cli.main(["tables", "--input", f"{folder}/out", "--output", f"{folder}/tables", "--report", f"{folder}/tables.md"]) == 0
    assert cli.main(["graph", "--input", f"{folder}/out", "--output", f"{folder}/graph", "--report", f"{folder}/graph.md"]) == 0
    assert "| document | 1 |" in (tmp_path / "graph.md").read_text() and "# Tables" in (tmp_path / "tables.md").read_text()


def test_models_are_trained_saved_and_tuned(spark, tmp_path, monkeypatch):
    """train writes models that run takes up, and tune-thresholds rewrites the cutoffs of a configuration."""
    import json
    import shutil

    from quillon import cli
    from quillon.config import base_of, load, write_thresholds
    from quillon.operators import ml
    from quillon.operators.ml import load_model

    monkeypatch.setattr(ml, "TERMS", 256)
    folder, config = str(tmp_path), str(tmp_path / "config")
    shutil.copytree(base_of(None), config, ignore=shutil.ignore_patterns("*.py", "__pycache__"))
    rows = [{"doc_id": str(i), "text": f"{word} page {i}", "label": label, "tags": tags} for i in range(6) for word, label, tags in (("harvest of wheat and barley", "crop", ["payment_made"]), ("engine with piston and valve", "motor", ["contains_pii"]))]
    rows.append({"doc_id": "none", "label": "crop"})
    (tmp_path / "gold.jsonl").write_text("".join(json.dumps({**r, "doc_id": f"{k}"}) + "\n" for k, r in enumerate(rows)))
    assert cli.main(["train", "--annotations", f"{folder}/gold.jsonl", "--output-model", f"{folder}/models", "--iterations", "3"]) == 0
    again = load_model(spark, f"{folder}/models/classifier").scores(spark.createDataFrame([("barley harvest",), ("piston engine",), (None,)], "text string")).collect()
    assert [max(r.scores, key=r.scores.get) for r in again[:2]] == ["crop", "motor"] and set(again[2].scores) == {"crop", "motor"}
    assert json.loads(spark.read.text(f"{folder}/models/classifier/meta").first().value)["trained_on"] == {"crop": 6, "motor": 6}
    tune = ["--config", config, "tune-thresholds", "--annotations", f"{folder}/gold.jsonl", "--model-dir", f"{folder}/models/tagger", "--output", f"{folder}/tuned.json"]
    write_thresholds(config, {"payment_made": 0.99})
    before = load(config).tags["tags"]["payment_made"]["threshold"]
    assert cli.main([*tune, "--dry-run"]) == 0 and load(config).tags["tags"]["payment_made"]["threshold"] == before
    assert cli.main(tune) == 0
    tuned = {r["tag"]: r for r in json.loads((tmp_path / "tuned.json").read_text())}
    assert set(tuned) == {"contains_pii", "payment_made"} and tuned["payment_made"]["f1"] == 1.0 and tuned["payment_made"]["positives"] == 6
    assert load(config).tags["tags"]["payment_made"]["threshold"] == tuned["payment_made"]["threshold"] != before
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("barley and wheat harvest")
    assert cli.main(["--config", config, "run", "--input", f"{folder}/in", "--output", f"{folder}/out", "--models", f"{folder}/models"]) == 0
    row = spark.read.json(f"{folder}/out").first()
    assert row.classification.label == "crop" and row.classification.method == "tfidf_svm" and [t.tag for t in row.tags if t.method == "tfidf_svm"] == ["payment_made"]
    assert cli.main(["train", "--annotations", f"{folder}/gold.jsonl", "--output-model", f"{folder}/none", "--kind", "neither"]) == 1
    assert cli.main(["tune-thresholds", "--annotations", f"{folder}/gold.jsonl", "--model-dir", f"{folder}/none"]) == 1
