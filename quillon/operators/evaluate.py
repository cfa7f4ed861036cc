"""Predictions held against gold: joins, scores and comparisons, blind to how predictions were made."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.store import ranged

KEYS = ("doc_id", "source_path", "path")


def prf(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """precision, recall and f1, 0 where they have no denominator, to four places."""
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    p, r = share(tp, tp + fp), share(tp, tp + fn)
    f1 = F.coalesce(2 * p * r / F.nullif(p + r, F.lit(0.0)), F.lit(0.0))
    return [F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(f1, 4).alias("f1")]


def _keyed(rows: DataFrame, order: str) -> DataFrame:
    """A row per name a record goes by, in order of preference: each key and its last path part."""
    names = []
    for k in KEYS:
        c = F.col(k) if k in rows.columns else F.lit(None).cast("string")
        names += [c, F.element_at(F.split(c, "/"), -1)]
    keys = F.filter(F.array(*names), lambda x: F.coalesce(x, F.lit("")) != "")
    return rows.select(F.col(order).alias("n"), F.posexplode(keys).alias("rank", "key"))


def match(gold: DataFrame, pred: DataFrame, gold_order: str = "gold_n", pred_order: str = "pred_n") -> DataFrame:
    """(gold_n, pred_n): each gold row with the first prediction that goes by the first of its names that any does.

    The order columns number the rows; missing and extra rows are anti joins on them.
    """
    p = _keyed(pred, pred_order).groupBy("key").agg(F.min("n").alias("pred_n"))
    hits = _keyed(gold, gold_order).join(p, "key")
    return hits.groupBy(F.col("n").alias("gold_n")).agg(F.min_by("pred_n", "rank").alias("pred_n"))


def word_errors(ref: Column, hyp: Column) -> Column:
    """Edit distance of two arrays of words: each distinct word becomes one character of its own."""
    words = F.array_distinct(F.concat(ref, hyp))
    letter = lambda w: F.decode(F.unhex(F.lpad(F.hex(F.array_position(words, w) + 0x10000), 8, "0")), "UTF-32")
    coded = lambda a: F.array_join(F.transform(a, letter), "")
    return F.levenshtein(coded(ref), coded(hyp))


def extraction(pairs: DataFrame) -> DataFrame:
    """(scored, cer, wer) over pairs (ref, hyp) whose reference is not empty; white space collapsed."""
    flat = lambda c: F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"(?U)\s+", " "))
    rows = pairs.where(F.coalesce(F.col("ref"), F.lit("")) != "").select(flat("ref").alias("ref"), flat("hyp").alias("hyp"))
    words = lambda c: F.filter(F.split(F.col(c), " "), lambda w: w != "")
    cer = F.levenshtein("ref", "hyp") / F.greatest(F.char_length("ref"), F.lit(1))
    wer = word_errors(words("ref"), words("hyp")) / F.greatest(F.size(words("ref")), F.lit(1))
    return rows.agg(F.count(F.lit(1)).alias("scored"), F.round(F.avg(cer), 4).alias("cer"), F.round(F.avg(wer), 4).alias("wer"))


def judged(pairs: DataFrame, unknown: str = "unknown") -> DataFrame:
    """(ord, truth, got, confidence, ok, abstained) from pairs (ord, truth, got, confidence)."""
    name = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    rows = pairs.select("ord", name("truth").alias("truth"), name("got").alias("got"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
    return rows.withColumns({"ok": F.col("got") == F.col("truth"), "abstained": F.col("got").isin(unknown, "")})


def classification(pairs: DataFrame, unknown: str = "unknown") -> DataFrame:
    """One row: n, answered, abstained, coverage, accuracy_overall, accuracy_when_answered, macro_f1."""
    rows = judged(pairs, unknown)
    right = F.count_if(~F.col("abstained") & F.col("ok"))
    answered = F.count_if(~F.col("abstained"))
    n = F.count(F.lit(1))
    share = lambda a, b: F.round(F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0)), 4)
    total = rows.agg(n.alias("n"), answered.alias("answered"), (n - answered).alias("abstained"), share(answered, n).alias("coverage"), share(right, n).alias("accuracy_overall"), share(right, answered).alias("accuracy_when_answered"))
    macro = per_label(pairs, unknown).agg(F.coalesce(F.round(F.avg("f1"), 4), F.lit(0.0)).alias("macro_f1"))
    return total.crossJoin(F.broadcast(macro))  # one row each


def per_label(pairs: DataFrame, unknown: str = "unknown") -> DataFrame:
    """(label, tp, fp, fn, precision, recall, f1); a right abstention counts for its label."""
    rows = judged(pairs, unknown)
    truth = rows.select(F.col("truth").alias("label"), F.col("ok").cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"), (~F.col("ok")).cast("long").alias("fn"))
    wrong = rows.where("not ok and not abstained").select(F.col("got").alias("label"), F.lit(0).cast("long").alias("tp"), F.lit(1).cast("long").alias("fp"), F.lit(0).cast("long").alias("fn"))
    return _rolled(truth.unionAll(wrong), ["label"])


def _rolled(rows: DataFrame, by: list[str]) -> DataFrame:
    sums = rows.groupBy(*by).agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    return sums.select(*by, "tp", "fp", "fn", *prf(F.col("tp"), F.col("fp"), F.col("fn")))


def confusion(pairs: DataFrame, unknown: str = "unknown", top: int = 10) -> DataFrame:
    """(truth, got, n): the most frequent mistakes."""
    wrong = judged(pairs, unknown).where("not ok").select("truth", F.when(F.col("got") == "", unknown).otherwise(F.col("got")).alias("got"))
    return wrong.groupBy("truth", "got").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "truth", "got").limit(top)


def coverage_at_error(pairs: DataFrame, targets: tuple[float, ...] = (0.01, 0.05, 0.10), unknown: str = "unknown") -> DataFrame:
    """(target, coverage, threshold): the largest share of documents answered with at most that error.

    Answers are taken by falling confidence, then by ord. Running counts are made in
    ranges of confidence: each range is counted, the counts before it are added, and
    only the rows of one range are sorted in a task.
    """
    rows = judged(pairs, unknown)
    total = rows.count()
    spark = pairs.sparkSession
    if not total:
        return spark.createDataFrame([], "target double, coverage double, threshold double")
    answers = ranged(rows.where("not abstained").select("confidence", "ord", "ok"), F.col("confidence").desc(), F.col("ord"))
    before = {r["range"]: (r["n"], r["right"]) for r in answers.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("right")).collect()}
    offsets, n, right = [], 0, 0
    for k in sorted(before):
        offsets.append((k, n, right))
        n, right = n + before[k][0], right + before[k][1]
    if not offsets:
        return spark.createDataFrame([(t, 0.0, 1.0) for t in targets], "target double, coverage double, threshold double")
    base = F.broadcast(spark.createDataFrame(offsets, "range int, n0 long, right0 long"))  # a row per partition
    own = W.partitionBy("range").orderBy(F.col("confidence").desc(), "ord").rowsBetween(W.unboundedPreceding, 0)
    run = answers.withColumns({"n": F.count(F.lit(1)).over(own), "right": F.count_if("ok").over(own)}).join(base, "range")
    run = run.select("confidence", (F.col("n") + F.col("n0")).alias("i"), (F.col("right") + F.col("right0")).alias("tp"))
    each = run.select("confidence", "i", F.explode(F.array(*map(F.lit, targets))).alias("target"), (1 - F.col("tp") / F.col("i")).alias("error"))
    best = each.groupBy("target").agg(F.max(F.when(F.col("error") <= F.col("target"), F.struct("i", "confidence"))).alias("b"))
    return best.select("target", F.round(F.coalesce(F.col("b.i") / total, F.lit(0.0)), 4).alias("coverage"), F.round(F.coalesce("b.confidence", F.lit(1.0)), 4).alias("threshold"))


def set_scores(gold: DataFrame, pred: DataFrame, by: str, item: list[str]) -> DataFrame:
    """(by, tp, fp, fn, precision, recall, f1) of distinct items (doc, by, item...) in gold and predictions."""
    keys = ["doc", by, *item]
    g = gold.select(*keys).distinct().withColumn("g", F.lit(1))
    p = pred.select(*keys).distinct().withColumn("p", F.lit(1))
    both = g.join(p, keys, "full_outer")
    has = lambda c: F.col(c).isNotNull()
    return _rolled(both.select(by, (has("g") & has("p")).cast("long").alias("tp"), (has("p") & ~has("g")).cast("long").alias("fp"), (has("g") & ~has("p")).cast("long").alias("fn")), [by])


def micro(scores: DataFrame) -> DataFrame:
    """One row over a per-label table: tp, fp, fn, precision, recall, f1, macro_f1."""
    t = scores.agg(F.coalesce(F.sum("tp"), F.lit(0)).alias("tp"), F.coalesce(F.sum("fp"), F.lit(0)).alias("fp"), F.coalesce(F.sum("fn"), F.lit(0)).alias("fn"), F.coalesce(F.round(F.avg("f1"), 4), F.lit(0.0)).alias("macro_f1"))
    return t.select("tp", "fp", "fn", *prf(F.col("tp"), F.col("fp"), F.col("fn")), "macro_f1")


def value_of(value: Column, normalized: Column) -> Column:
    return F.trim(F.coalesce(normalized, value, F.lit("")))


def metadata_values(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Per-field scores of (doc, field, value, normalized_value) rows by value."""
    form = lambda df: df.select("doc", "field", value_of(F.col("value"), F.col("normalized_value")).alias("v"))
    return set_scores(form(gold), form(pred), "field", ["v"])


def metadata_spans(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Per-field scores by (char_start, char_end), over documents whose gold has spans."""
    spanned = gold.where("char_start is not null and char_end is not null")
    own = pred.join(spanned.select("doc").distinct(), "doc", "left_semi")
    return set_scores(spanned, own, "field", ["char_start", "char_end"])


def validated_precision(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """(right, wrong, precision) of proven predictions of fields that the document's gold has."""
    form = lambda df: df.withColumn("v", value_of(F.col("value"), F.col("normalized_value")))
    g = form(gold).select("doc", "field", "v").distinct().withColumn("hit", F.lit(True))
    p = form(pred).where("validated").join(gold.select("doc", "field").distinct(), ["doc", "field"], "left_semi").join(g, ["doc", "field", "v"], "left")
    right, n = F.count("hit"), F.count(F.lit(1))
    return p.agg(right.alias("right"), (n - right).alias("wrong"), F.round(right / F.nullif(n, F.lit(0)), 4).alias("precision"))


def cell_norm(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " ")))


def adjacency(cells: DataFrame) -> DataFrame:
    """(doc, a, b, way) from (doc, tbl, row, col, text): each cell's next filled neighbour right (h) and below (v)."""
    filled = cells.select("doc", "tbl", "row", "col", cell_norm(F.col("text")).alias("a")).where("a <> ''")
    right = filled.withColumn("b", F.lead("a").over(W.partitionBy("doc", "tbl", "row").orderBy("col"))).withColumn("way", F.lit("h"))
    below = filled.withColumn("b", F.lead("a").over(W.partitionBy("doc", "tbl", "col").orderBy("row"))).withColumn("way", F.lit("v"))
    return right.unionByName(below).where("b is not null").select("doc", "a", "b", "way")


def bag_scores(gold: DataFrame, pred: DataFrame, item: list[str]) -> DataFrame:
    """One row: multiset scores of the items of two tables."""
    g = gold.groupBy(*item).agg(F.count(F.lit(1)).alias("g"))
    p = pred.groupBy(*item).agg(F.count(F.lit(1)).alias("p"))
    g0, p0 = F.coalesce("g", F.lit(0)), F.coalesce("p", F.lit(0))
    both = g.join(p, item, "full_outer").agg(F.coalesce(F.sum(F.least(g0, p0)), F.lit(0)).alias("tp"), F.coalesce(F.sum(p0), F.lit(0)).alias("np"), F.coalesce(F.sum(g0), F.lit(0)).alias("ng"))
    tp, fp, fn = F.col("tp"), F.col("np") - F.col("tp"), F.col("ng") - F.col("tp")
    return both.select("tp", fp.alias("fp"), fn.alias("fn"), *prf(tp, fp, fn))


def table_detection(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """(gold_tables, detected, recall): gold tables of which some prediction of the document holds over half the cells."""
    bag = lambda df: df.select("doc", "tbl", cell_norm(F.col("text")).alias("v")).where("v <> ''").groupBy("doc", "tbl", "v").agg(F.count(F.lit(1)).alias("n"))
    g, p = bag(gold), bag(pred).withColumnsRenamed({"tbl": "other", "n": "m"})
    size = g.groupBy("doc", "tbl").agg(F.sum("n").alias("size"))
    shared = g.join(p, ["doc", "v"]).groupBy("doc", "tbl", "other").agg(F.sum(F.least("n", "m")).alias("both"))
    found = shared.join(size, ["doc", "tbl"]).where("both > size * 0.5").select("doc", "tbl").distinct().withColumn("hit", F.lit(True))
    every = gold.select("doc", "tbl").distinct().join(found, ["doc", "tbl"], "left")
    n, hit = F.count(F.lit(1)), F.count("hit")
    return every.agg(n.alias("gold_tables"), hit.alias("detected"), F.round(F.coalesce(hit / F.nullif(n, F.lit(0)), F.lit(0.0)), 4).alias("recall"))


def compare(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
    """(by, f1_a, f1_b, delta, regressed) of two per-label tables; what one lacks counts as 0."""
    x, y = a.select(by, F.col("f1").alias("f1_a")), b.select(by, F.col("f1").alias("f1_b"))
    both = x.join(y, by, "full_outer").fillna(0.0, ["f1_a", "f1_b"])
    delta = F.round(F.col("f1_b") - F.col("f1_a"), 4)
    return both.select(by, "f1_a", "f1_b", delta.alias("delta"), (delta < 0).alias("regressed"))


def fit_threshold(rows: DataFrame, by: str = "tag") -> DataFrame:
    """(by, threshold, f1, positives) from (by, truth 0/1, prob): the cutoff with the best F1, the lowest of equals.

    Cutoffs are the distinct rounded probabilities and 0.05, 0.5, 0.95. Rows are first
    counted by distinct probability, so what each group's running sums go over is
    bounded by the distinct rounded values, at most 10,001 for probabilities.
    """
    exact = rows.select(by, F.col("truth").cast("long").alias("truth"), F.col("prob"), F.round("prob", 4).alias("t"))
    # A row counts as found by a cutoff if prob >= t; with t rounded up its own row may fall below it.
    up = F.when(F.col("prob") >= F.col("t"), F.col("t")).otherwise(F.round(F.col("t") - 0.0001, 4))
    counts = exact.groupBy(by, up.alias("t")).agg(F.sum("truth").alias("pos"), F.count(F.lit(1)).alias("n"))
    cuts = exact.select(by, "t").distinct().unionAll(rows.select(by).distinct().select(by, F.explode(F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95))).alias("t"))).distinct()
    both = counts.unionAll(cuts.select(by, "t", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("n"))).groupBy(by, "t").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    above, every = W.partitionBy(by).orderBy(F.col("t").desc()).rowsBetween(W.unboundedPreceding, 0), W.partitionBy(by)
    run = both.select(by, "t", F.sum("pos").over(above).alias("tp"), F.sum("n").over(above).alias("found"), F.sum("pos").over(every).alias("positives"))
    run = run.join(cuts, [by, "t"], "left_semi")
    f1 = F.coalesce(2 * F.col("tp") / F.nullif(F.col("found") + F.col("positives"), F.lit(0)), F.lit(0.0))
    best = run.groupBy(by).agg(F.max(F.struct(f1.alias("f1"), (-F.col("t")).alias("low"), "positives")).alias("b"))
    none = F.col("b.positives") == 0
    return best.select(by, F.when(none, 0.5).otherwise(F.round(-F.col("b.low"), 4)).alias("threshold"), F.when(none, 0.0).otherwise(F.round(F.col("b.f1"), 4)).alias("f1"), F.col("b.positives").alias("positives"))
