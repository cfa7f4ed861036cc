"""Command line: python -m quillon.cli VERB ..."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.config import load, write_thresholds
from quillon.operators import evaluate, graph, ml, profile, review, tables
from quillon.plans.process import records, resumed
from quillon.schema import canonical_text, record_schema
from quillon.shipping import ship
from quillon.sources import documents as sources
from quillon.store import exists


def _done(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.schema(record_schema()).json(path) if exists(spark, path) else None


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    """With --models, texts are scored by the classifier and the tagger that are there."""
    files = sources.read_files(spark, a.input)
    docs = sources.extract(resumed(files, None if a.no_resume else _done(spark, a.output)))
    scores = {"classifier": None, "tagger": None}
    for kind in scores if a.models else ():
        model = ml.load_model(spark, f"{a.models}/{kind}")
        if model:
            docs = model.scores(docs.withColumn("model_text_", canonical_text(F.col("pages"))), "model_text_", f"{kind}_", exclusive=kind == "classifier").drop("model_text_")
            scores[kind] = F.col(f"{kind}_")
    sources.write_records(records(docs, *scores.values(), config=load(a.config)), a.output)
    return 0


ANNOTATIONS = "doc_id string, path string, text string, label string, tags array<string>"


def _annotated(spark: SparkSession, a: argparse.Namespace, first: str) -> DataFrame:
    """Annotations with their texts: those of records (--predictions) of their doc_id or path, their own; ``first`` names those taken first.

    Rows without either are left out. Of several records with one key, the largest text counts.
    """
    rows = spark.read.schema(ANNOTATIONS).json(a.annotations).withColumn("key", F.coalesce(F.nullif("doc_id", F.lit("")), "path"))
    if a.predictions:
        told = sources.read_jsonl(spark, a.predictions)
        keys = F.explode(F.array_distinct(F.array("doc_id", "source_path")))
        told = told.select(keys.alias("key"), F.nullif("text.full", F.lit("")).alias("told")).groupBy("key").agg(F.max("told").alias("told"))
        rows = rows.join(told, "key", "left")
    else:
        rows = rows.withColumn("told", F.lit(None).cast("string"))
    own = F.nullif("text", F.lit(""))
    text = F.coalesce("told", own) if first == "told" else F.coalesce(own, "told")
    return rows.withColumn("text", text).where("text is not null").drop("told")


def train(spark: SparkSession, a: argparse.Namespace) -> int:
    """1 if nothing was trained."""
    rows, fitted = _annotated(spark, a, "own").persist(), 0
    for kind, column, fit in (("classifier", "label", ml.train_classifier), ("tagger", "tags", ml.train_tagger)):
        own = rows.where(F.length("label") > 0 if column == "label" else F.size("tags") > 0)
        if a.kind in (kind, "both") and not own.isEmpty():
            model, told = fit(own, iterations=int(a.iterations))
            model.save(spark, f"{a.output_model}/{kind}", told)
            fitted += 1
    rows.unpersist()
    return int(not fitted)


def tune_thresholds(spark: SparkSession, a: argparse.Namespace) -> int:
    """1 if there is no tagger or no tagged text. Of repeated annotations, the one with the largest tags counts."""
    model = ml.load_model(spark, a.model_dir)
    rows = _annotated(spark, a, "told").where("key is not null and tags is not null").groupBy("key").agg(F.max(F.struct("tags", "text")).alias("x")).select("x.*")
    if model is None or rows.isEmpty():
        return 1
    scored = model.scores(rows, exclusive=False).select("tags", F.explode("scores").alias("tag", "prob"))
    fitted = evaluate.fit_threshold(scored.select("tag", F.array_contains("tags", F.col("tag")).cast("int").alias("truth"), "prob")).orderBy("tag").collect()
    if not a.dry_run:
        write_thresholds(a.config, {r["tag"]: r["threshold"] for r in fitted})
    return _print([json.dumps([r.asDict() for r in fitted], indent=2)], a.output)


def profile_(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = sources.read_jsonl(spark, a.input).select("doc_id", F.col("classification.label").alias("label"), F.col("text.method").alias("method"), F.col("text.char_count").alias("chars"), F.col("text.extraction_confidence").alias("confidence"))
    lines = ["# Profile", "", "| what | value | documents |", "|-|-|-|"]
    lines += [f"| {r.what} | {r.value} | {r.n} |" for r in profile.counts(rows, ["label", "method"]).orderBy("what", F.desc("n"), "value").collect()]
    for name in ("chars", "confidence"):
        lines += ["", f"{name}: " + ", ".join(f"{k} {v}" for r in profile.distribution(rows, name).collect() for k, v in r.asDict().items())]
    low = profile.low_confidence(rows).first()
    lines += ["", f"{low.low} of {low.documents} documents below 0.6 confidence ({low.share})"]
    return _print(lines, a.output)


def _print(lines: list[str], path: str | None) -> int:
    text = "\n".join(lines) + "\n"
    if path:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
    else:
        sys.stdout.write(text)
    return 0


def _markdown(title: str, parts: dict[str, DataFrame]) -> list[str]:
    """A report of small tables: one row for each class, field, tag or kind."""
    lines = [f"# {title}"]
    for name, df in parts.items():
        rows = [tuple(r) for r in df.collect()]
        lines += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
        lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in sorted(rows, key=lambda r: tuple(map(str, r)))]
    return lines


def graph_(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = sources.read_jsonl(spark, a.input)
    nodes, edges = graph.nodes(rows), graph.edges(rows)
    nodes.write.mode("errorifexists").json(f"{a.output}/nodes")
    edges.write.mode("errorifexists").json(f"{a.output}/edges")
    if a.dot:
        graph.to_dot(nodes, edges).orderBy("ord", "line").select("line").coalesce(1).write.text(f"{a.output}/dot")
    if a.report:
        return _print(_markdown("Graph", {"nodes": nodes.groupBy("kind").count(), "edges": graph.stats(edges), "unverified numbers": graph.unverified(graph.fields_of(rows))}), a.report)
    return 0


def tables_(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = sources.read_jsonl(spark, a.input).select("doc_id", F.col("text.pages").alias("pages"), F.col("text.full").alias("full"))
    words = spark.read.parquet(a.words) if a.words else spark.createDataFrame([], "doc_id string, page int, text string, x0 double, y0 double, x1 double, y1 double, conf double, char_start int, char_end int")
    tables.detect(rows, words, load(a.config)).write.mode("errorifexists").json(a.output)
    if a.report:
        found = spark.read.schema(tables.CELLS).json(a.output)
        return _print(_markdown("Tables", {"found": tables.statistics(found), "refused": found.where("refused is not null").groupBy("method").count()}), a.report)
    return 0


def _fields(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("doc_id").alias("doc"), F.explode_outer("metadata").alias("m")).where("m is not null").select("doc", "m.*")


def _scores(gold: DataFrame, pred: DataFrame) -> dict[str, DataFrame]:
    pairs = gold.select("doc_id", F.col("label").alias("truth")).join(pred.select("doc_id", F.col("classification.label").alias("got"), F.col("classification.confidence").alias("confidence")), "doc_id").withColumn("ord", F.col("doc_id"))
    tags = lambda df, tag: df.select(F.col("doc_id").alias("doc"), F.explode(tag).alias("tag"))
    known = gold.where("tags is not null").select("doc_id")
    by_tag = evaluate.set_scores(tags(gold, F.col("tags")), tags(pred.join(known, "doc_id", "left_semi"), F.transform("tags", lambda t: t["tag"])), "tag", [])
    texts = gold.select("doc_id", F.col("text").alias("ref")).join(pred.select("doc_id", F.col("text.full").alias("hyp")), "doc_id")
    fields = evaluate.metadata_values(_fields(gold), _fields(pred))
    return {
        "classification": evaluate.classification(pairs), "labels": evaluate.per_label(pairs), "confusion": evaluate.confusion(pairs), "coverage": evaluate.coverage_at_error(pairs),
        "fields": fields, "fields together": evaluate.micro(fields), "spans": evaluate.metadata_spans(_fields(gold), _fields(pred)), "proven fields": evaluate.validated_precision(_fields(gold), _fields(pred)),
        "tags": by_tag, "tags together": evaluate.micro(by_tag), "text": evaluate.extraction(texts),
    }


GOLD = "doc_id string, label string, tags array<string>, text string, metadata array<struct<field:string,value:string,normalized_value:string,char_start:int,char_end:int>>"


def eval_(spark: SparkSession, a: argparse.Namespace) -> int:
    found = _scores(spark.read.schema(GOLD).json(a.gold), sources.read_jsonl(spark, a.pred))
    if a.markdown:
        return _print(_markdown("Evaluation", found), a.output)
    return _print([json.dumps({name: [r.asDict() for r in df.collect()] for name, df in found.items()}, indent=2)], a.output)


def compare(spark: SparkSession, a: argparse.Namespace) -> int:
    """2 if asked to fail on regressions and there is one."""
    gold = spark.read.schema(GOLD).json(a.gold)
    x, y = (_scores(gold, sources.read_jsonl(spark, p)) for p in (a.a, a.b))
    rows = [r.asDict() for k, by in (("labels", "label"), ("fields", "field"), ("tags", "tag")) for r in evaluate.compare(x[k], y[k], by).orderBy("delta", by).collect()]
    _print([json.dumps(rows, indent=2)], a.output)
    return 2 if a.fail_on_regression and any(r["regressed"] for r in rows) else 0


def import_labels(spark: SparkSession, a: argparse.Namespace) -> int:
    """1 if a label or file is not known."""
    found = review.import_labels(sources.read_label_csv(spark, a.csv, a.name_column, a.label_column), sources.list_files(spark, a.root)).persist()
    found.where("problem is null").write.mode("errorifexists").json(a.output)
    return int(not found.where("problem in ('unknown label', 'missing file', 'ambiguous file')").isEmpty())


def export_review(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = sources.read_jsonl(spark, a.input)
    tabs = {"Documents": review.document_rows(rows), "Metadata": review.metadata_rows(rows), "Tags": review.tag_rows(rows), "Taxonomy": review.taxonomy_rows(spark, load(a.config))}
    if a.merge_from:
        old = {n: spark.read.option("header", True).csv(f"{a.merge_from}/{n}") for n in ("Documents", "Metadata", "Tags")}
        tabs["Documents"] = review.carry_documents(tabs["Documents"], old["Documents"])
        tabs["Metadata"] = review.carry_fields(tabs["Metadata"], old["Metadata"]).unionByName(review.rescued_fields(tabs["Metadata"], old["Metadata"]), allowMissingColumns=True)
        tabs["Tags"] = review.carry_tags(tabs["Tags"], old["Tags"]).unionByName(review.rescued_tags(tabs["Tags"], old["Tags"]), allowMissingColumns=True)
    sources.write_tabs(tabs, a.output, a.overwrite)
    return 0


def import_review(spark: SparkSession, a: argparse.Namespace) -> int:
    """1 if a correction names no declared class; then nothing is written."""
    tab = lambda n: spark.read.option("header", True).csv(f"{a.input}/{n}")
    docs = review.gold_documents(tab("Documents"), load(a.config)).persist()
    if not docs.where("problem is not null").isEmpty():
        return 1
    found = review.gold_fields(tab("Metadata"), load(a.config)).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("field", "value", "normalized_value", "char_start", "char_end"))).alias("metadata"))
    tags = review.gold_tags(tab("Tags")).groupBy("doc_id").agg(F.sort_array(F.collect_set("tag")).alias("tags"))
    docs.where("label is not null").select("doc_id", "label").join(found, "doc_id", "left").join(tags, "doc_id", "left").write.mode("errorifexists").json(a.output)
    return 0


VERBS = {
    "run": (run, ["--input", "--output"], ["--no-resume", "--models="]),
    "train": (train, ["--annotations", "--output-model"], ["--kind=both", "--predictions=", "--iterations=30"]),
    "tune-thresholds": (tune_thresholds, ["--annotations", "--model-dir"], ["--predictions=", "--dry-run", "--output="]),
    "profile": (profile_, ["--input"], ["--output="]),
    "graph": (graph_, ["--input", "--output"], ["--dot", "--report="]),
    "tables": (tables_, ["--input", "--output"], ["--words=", "--report="]),
    "eval": (eval_, ["--gold", "--pred"], ["--output=", "--markdown"]),
    "compare": (compare, ["--gold", "--a", "--b"], ["--output=", "--fail-on-regression"]),
    "import-labels": (import_labels, ["--csv", "--root", "--output"], ["--name-column=File_Name", "--label-column=Document_Type"]),
    "export-review": (export_review, ["--input", "--output"], ["--merge-from=", "--overwrite"]),
    "import-review": (import_review, ["--input", "--output"], []),
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quillon", description=__doc__)
    parser.add_argument("--config")
    verbs = parser.add_subparsers(dest="verb", required=True)
    for name, (_, needed, free) in VERBS.items():
        own = verbs.add_parser(name)
        for flag in needed:
            own.add_argument(flag, required=True)
        for flag in free:
            key, equals, default = flag.partition("=")
            own.add_argument(key, default=default or None) if equals else own.add_argument(key, action="store_true")
    a = parser.parse_args(argv)
    return VERBS[a.verb][0](ship(SparkSession.builder.appName(f"quillon {a.verb}").getOrCreate()), a)


if __name__ == "__main__":
    sys.exit(main())
