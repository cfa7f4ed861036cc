"""Labels from outside and the human review of predictions, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.config import Config, load
from quillon.functions.normalizers import normalize
from quillon.schema import preview, runner_up

#: Words of reviewers (fixed values).
VERDICTS = {"ok": "ok", "correct": "ok", "wrong": "wrong", "incorrect": "wrong", "spurious": "spurious", "missing": "missing"}
TRUTHY = ("true", "yes", "y", "1")


def text_of(value: Column) -> Column:
    return F.trim(F.coalesce(value.cast("string"), F.lit("")))


def verdict(value: Column) -> Column:
    """ok, wrong, spurious, missing, or empty."""
    low = F.lower(text_of(value))
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in VERDICTS.items() for x in kv]), low), F.lit(""))


def is_gold(value: Column) -> Column:
    return F.lower(text_of(value)).isin(*TRUTHY)


def fill_down(tab: DataFrame, order: str = "row", column: str = "DOC_ID", sheet: str = "sheet") -> DataFrame:
    """A tab whose blank identifiers take the last one above, sheet by sheet; wholly blank rows are dropped."""
    named = tab.select(*[F.col(c).alias(c if c in (order, sheet) else c.upper()) for c in tab.columns])
    cells = [c for c in named.columns if c not in (order, sheet)]
    some = F.lit(False)
    for c in cells:
        some |= text_of(F.col(c)) != ""
    value = F.when(text_of(F.col(column)) != "", text_of(F.col(column)))
    up = W.partitionBy(sheet).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return named.where(some).withColumn(column, F.last(value, ignorenulls=True).over(up))


def import_labels(labels: DataFrame, files: DataFrame, config: Config | None = None) -> DataFrame:
    """(name, label, class, lossy, path, problem) from labels (name, label) and files (path).

    A name is a path, or else the only file of that base name. Problems: unknown label,
    unscored label (mapped to nothing), missing file, ambiguous file.
    """
    rows = [(m["label"], m.get("class"), bool(m.get("lossy"))) for m in (config or load()).settings["taxonomy"]]
    known = F.broadcast(labels.sparkSession.createDataFrame(rows, "label string, class string, lossy boolean").withColumn("known", F.lit(True)))  # configuration
    exact = files.select(F.col("path").alias("name"), F.col("path").alias("exact")).distinct()
    base = files.groupBy(F.element_at(F.split("path", "/"), -1).alias("name")).agg(F.min("path").alias("only"), F.countDistinct("path").alias("n"))
    out = labels.select(F.trim("name").alias("name"), F.trim("label").alias("label")).join(known, "label", "left").join(exact, "name", "left").join(base, "name", "left")
    path = F.coalesce("exact", F.when(F.col("n") == 1, F.col("only")))
    problem = F.when(F.col("known").isNull(), "unknown label").when(F.col("class").isNull(), "unscored label").when(path.isNotNull(), F.lit(None)).when(F.col("n") > 1, "ambiguous file").otherwise("missing file")
    return out.select("name", "label", "class", "lossy", path.alias("path"), problem.alias("problem"))


def collapsed(config: Config | None = None) -> dict[str, list[str]]:
    """Classes that several outside labels map to."""
    by: dict[str, list[str]] = {}
    for m in (config or load()).settings["taxonomy"]:
        if m.get("class"):
            by.setdefault(m["class"], []).append(m["label"])
    return {c: sorted(v) for c, v in by.items() if len(v) > 1}


def repeated_names(labels: DataFrame) -> DataFrame:
    return labels.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("label")).alias("labels")).where("n > 1")


def document_rows(records: DataFrame) -> DataFrame:
    """The Documents tab: a row per record to be reviewed."""
    second = runner_up(F.col("classification.all_scores"), F.col("classification.label"))
    return records.select(
        F.col("doc_id").alias("DOC_ID"), F.col("filename").alias("FILENAME"), F.col("source_path").alias("PATH"), F.col("classification.label").alias("PREDICTED"), F.round("classification.confidence", 4).alias("CONFIDENCE"),
        F.col("classification.method").alias("METHOD"), second["label"].alias("RUNNER_UP"), second["score"].alias("RUNNER_UP_SCORE"), F.col("text.method").alias("TEXT_METHOD"), F.col("text.char_count").alias("CHAR_COUNT"),
        F.sha2(F.col("text.full").cast("binary"), 256).alias("TEXT_SHA256"), preview(F.col("text.full")).alias("PREVIEW"), F.lit("").alias("VERDICT"), F.lit("").alias("CORRECTED"), F.lit("").alias("NOTES"),
    )


def metadata_rows(records: DataFrame) -> DataFrame:
    return records.select(F.col("doc_id").alias("DOC_ID"), F.explode_outer("metadata").alias("m")).where("m is not null").select("DOC_ID", F.col("m.field").alias("FIELD"), F.col("m.value").alias("VALUE"), F.col("m.normalized_value").alias("NORMALIZED"), F.col("m.char_start").alias("CHAR_START"), F.col("m.char_end").alias("CHAR_END"), F.col("m.confidence").alias("CONFIDENCE"), F.col("m.validated").alias("VALIDATED"), F.lit("").alias("VERDICT"), F.lit("").alias("CORRECTED"))


def tag_rows(records: DataFrame) -> DataFrame:
    return records.select(F.col("doc_id").alias("DOC_ID"), F.explode_outer("tags").alias("t")).where("t is not null").select("DOC_ID", F.col("t.tag").alias("TAG"), F.col("t.confidence").alias("CONFIDENCE"), F.col("t.method").alias("METHOD"), F.lit("").alias("VERDICT"))


def taxonomy_rows(spark, config: Config | None = None) -> DataFrame:
    """(KIND, NAME): all classes, fields and tags."""
    config = config or load()
    rows = [("class", n) for n in config.classes] + [("field", n) for n in config.fields["fields"]] + [("tag", n) for n in config.tags["tags"]]
    return spark.createDataFrame(rows, "KIND string, NAME string")


def line_item_rows(tables: DataFrame) -> DataFrame:
    """(DOC_ID, TABLE_ID, ROW, COL, TEXT, IS_HEADER) of all tables' cells."""
    each = tables.select("doc_id", F.explode("tables").alias("t")).select("doc_id", "t.table_id", F.explode("t.cells").alias("c"))
    return each.select(F.col("doc_id").alias("DOC_ID"), F.col("table_id").alias("TABLE_ID"), F.col("c.row").alias("ROW"), F.col("c.col").alias("COL"), F.col("c.text").alias("TEXT"), F.col("c.is_header").alias("IS_HEADER"))


def gold_documents(tab: DataFrame, config: Config | None = None) -> DataFrame:
    """(doc_id, label, confirmed_unknown, problem): ok takes the prediction, wrong and missing the correction.

    A confirmed ``unknown`` is no gold label. An undeclared correction is a problem.
    """
    config = config or load()
    unknown = config.settings["classification"]["unknown"]
    v = verdict(F.col("VERDICT"))
    label = F.when(v == "ok", text_of(F.col("PREDICTED"))).when(v.isin("wrong", "missing"), text_of(F.col("CORRECTED")))
    rows = tab.select(F.col("DOC_ID").alias("doc_id"), label.alias("label")).where("label is not null and label <> ''")
    declared = F.col("label").isin(*config.classes, unknown)
    problem = F.when(~declared, F.concat(F.lit("undeclared class: "), "label"))
    return rows.select("doc_id", F.when(declared & (F.col("label") != unknown), F.col("label")).alias("label"), (F.col("label") == unknown).alias("confirmed_unknown"), problem.alias("problem"))


def gold_fields(tab: DataFrame, config: Config | None = None) -> DataFrame:
    """(doc_id, field, value, normalized_value, char_start, char_end): reviewed fields; corrections lose their place."""
    config = config or load()
    v = verdict(F.col("VERDICT"))
    corrected = v.isin("wrong", "missing")
    value = F.when(v == "ok", text_of(F.col("VALUE"))).when(corrected, text_of(F.col("CORRECTED")))
    both = F.col("CHAR_START").try_cast("int").isNotNull() & F.col("CHAR_END").try_cast("int").isNotNull() & (v == "ok")
    place = lambda c: F.when(both, F.col(c).try_cast("int"))
    rows = tab.select(F.col("DOC_ID").alias("doc_id"), F.col("FIELD").alias("field"), value.alias("value"), place("CHAR_START").alias("char_start"), place("CHAR_END").alias("char_end")).where("value is not null and value <> ''")
    form = F.col("value")
    for name, spec in config.fields["fields"].items():
        form = F.when(F.col("field") == name, F.coalesce(normalize(spec.get("normalizer"), F.col("value")), F.col("value"))).otherwise(form)
    return rows.select("doc_id", "field", "value", form.alias("normalized_value"), "char_start", "char_end")


def gold_tags(tab: DataFrame) -> DataFrame:
    """(doc_id, tag): distinct tags found ok or missing."""
    return tab.where(verdict(F.col("VERDICT")).isin("ok", "missing")).select(F.col("DOC_ID").alias("doc_id"), text_of(F.col("TAG")).alias("tag")).where("tag <> ''").distinct()


def reviewed(tab: DataFrame) -> DataFrame:
    """The rows that a person has judged."""
    return tab.where(verdict(F.col("VERDICT")) != "")


def carry_documents(new: DataFrame, old: DataFrame) -> DataFrame:
    """``new`` with the verdicts of an earlier review: corrections stay, agreed ones become ok, confirmations only for the same label."""
    o = reviewed(old).select("DOC_ID", verdict(F.col("VERDICT")).alias("v_"), text_of(F.col("CORRECTED")).alias("c_"), text_of(F.col("PREDICTED")).alias("p_"))
    both = new.join(o, "DOC_ID", "left")
    fixed = F.col("v_").isin("wrong", "missing") & (F.col("c_") != "")
    agreed = fixed & (F.col("c_") == F.col("PREDICTED"))
    same = (F.col("v_") == "ok") & (F.col("p_") == F.col("PREDICTED"))
    return both.withColumns({"VERDICT": F.when(agreed | same, "ok").when(fixed, F.col("v_")).otherwise(""), "CORRECTED": F.when(fixed & ~agreed, F.col("c_")).otherwise("")}).drop("v_", "c_", "p_")


def carry_fields(new: DataFrame, old: DataFrame) -> DataFrame:
    """``new`` fields with earlier verdicts: those of the same document, field and value, else one unused correction of the field each."""
    o = reviewed(old).select("DOC_ID", "FIELD", "VALUE", verdict(F.col("VERDICT")).alias("v_"), text_of(F.col("CORRECTED")).alias("c_"))
    exact = o.groupBy("DOC_ID", "FIELD", "VALUE").agg(F.min(F.struct("v_", "c_")).alias("x")).select("DOC_ID", "FIELD", "VALUE", "x.*")
    first = new.join(exact, ["DOC_ID", "FIELD", "VALUE"], "left")
    rest = o.where("v_ in ('wrong', 'missing') and c_ <> ''").join(new.select("DOC_ID", "FIELD", "VALUE"), ["DOC_ID", "FIELD", "VALUE"], "left_anti")
    rank = W.partitionBy("DOC_ID", "FIELD").orderBy("VALUE")
    rest = rest.withColumn("k_", F.row_number().over(rank)).select("DOC_ID", "FIELD", "k_", F.col("v_").alias("v2_"), F.col("c_").alias("c2_"))
    free = first.withColumn("k_", F.when(F.col("v_").isNull(), F.row_number().over(W.partitionBy("DOC_ID", "FIELD", F.col("v_").isNull()).orderBy("VALUE"))))
    both = free.join(rest, ["DOC_ID", "FIELD", "k_"], "left")
    return both.withColumns({"VERDICT": F.coalesce("v_", "v2_", F.lit("")), "CORRECTED": F.coalesce("c_", "c2_", F.lit(""))}).drop("v_", "c_", "v2_", "c2_", "k_")


def carry_tags(new: DataFrame, old: DataFrame) -> DataFrame:
    o = reviewed(old).groupBy("DOC_ID", "TAG").agg(F.min(verdict(F.col("VERDICT"))).alias("v_"))
    return new.join(o, ["DOC_ID", "TAG"], "left").withColumn("VERDICT", F.coalesce("v_", F.lit(""))).drop("v_")


def rescued_fields(new: DataFrame, old: DataFrame) -> DataFrame:
    """Earlier reviewed fields that the new predictions lack, as missing ones; spurious ones go."""
    o = reviewed(old).withColumn("v_", verdict(F.col("VERDICT"))).where("v_ <> 'spurious'")
    value = F.when(F.col("v_") == "ok", text_of(F.col("VALUE"))).otherwise(text_of(F.col("CORRECTED")))
    lost = o.join(new.select("DOC_ID", "FIELD", "VALUE"), ["DOC_ID", "FIELD", "VALUE"], "left_anti").join(new.select("DOC_ID", "FIELD").distinct().withColumn("has_", F.lit(True)), ["DOC_ID", "FIELD"], "left")
    # A correction whose field is predicted again has been carried already.
    return lost.where("v_ = 'ok' or has_ is null").select("DOC_ID", "FIELD", F.lit("").alias("VALUE"), F.lit("missing").alias("VERDICT"), value.alias("CORRECTED")).where("CORRECTED <> ''").distinct()


def rescued_tags(new: DataFrame, old: DataFrame) -> DataFrame:
    o = reviewed(old).where(verdict(F.col("VERDICT")).isin("ok", "missing"))
    return o.join(new.select("DOC_ID", "TAG"), ["DOC_ID", "TAG"], "left_anti").select("DOC_ID", "TAG", F.lit("missing").alias("VERDICT")).distinct()
