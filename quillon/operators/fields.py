"""Typed fields with exact offsets, found by patterns, labels or places on a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.config import Config, load
from quillon.functions.normalizers import currency_code, normalize
from quillon.functions.validators import PROOFS, validate
from quillon.schema import page_of, page_spans

CANDIDATE = "array<struct<unproven:boolean,doubt:double,start:int,end:int,value:string,method:string>>"


def _candidate(value: Column, start: Column, valid: Column, confidence: Column, method: Column) -> Column:
    """Ordered as candidates rank: proven first, then surer, then earlier."""
    start = start.cast("int")
    return F.struct((~valid).alias("unproven"), (-confidence).alias("doubt"), start.alias("start"), (start + F.char_length(value)).alias("end"), value.alias("value"), method.alias("method"))


def matches(text: Column, regex: str, limit: int = 25) -> Column:
    """array<struct<value, start>> of the first matches; the value is group 1, which must end the match, or the match."""
    group = 1 if _groups(regex) else 0
    values = F.slice(F.regexp_extract_all(text, F.lit(regex), F.lit(group)), 1, limit)
    whole = values if _is_group(regex) or not group else F.slice(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), 1, limit)
    gaps = F.slice(F.split(text, regex, -1), 1, limit)
    rows = F.arrays_zip(whole.alias("w"), values.alias("v"), gaps.alias("g"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<value:string,start:int>>").alias("out"))

    def step(state: Column, row: Column) -> Column:
        end = state["at"] + F.char_length(row["g"]) + F.char_length(row["w"])
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(row["v"].alias("value"), (end - F.char_length(row["v"])).alias("start")))).alias("out"))

    found = F.aggregate(F.filter(rows, lambda r: r["w"].isNotNull()), empty, step)["out"]
    # Most texts have none: they are searched once, not three times.
    return F.when(text.rlike(regex), found).when(text.isNotNull(), F.array().cast("array<struct<value:string,start:int>>"))


def _groups(regex: str) -> bool:
    import re

    return re.compile(regex).groups > 0


def _is_group(regex: str) -> bool:
    """Whether the whole match is group 1, with nothing of any width around it."""
    import re._parser as parser

    wide = [(str(kind), value) for kind, value in parser.parse(regex) if str(kind) not in ("AT", "ASSERT", "ASSERT_NOT")]
    return len(wide) == 1 and wide[0][0] == "SUBPATTERN" and wide[0][1][0] == 1


def pattern_candidates(text: Column, spec: dict, limit: int = 25) -> Column:
    check = spec.get("check")

    def made(m: Column) -> Column:
        confidence = F.when(m["valid"], float(spec.get("sure", 1.0))).otherwise(float(spec.get("unsure", 0.5)))
        method = F.when(m["valid"], "regex_checksum" if check in PROOFS else "regex_format").otherwise("regex_format")
        return _candidate(m["value"], m["start"], m["valid"], confidence, method)

    judged = F.transform(matches(text, spec["regex"], limit), lambda m: F.struct(m["value"].alias("value"), m["start"].alias("start"), validate(check, m["value"]).alias("valid")))
    return F.transform(judged, made)


def _occurrences(low: Column, label: str) -> Column:
    """array<int> of the places where a label begins."""
    parts = F.split(low, rf"\Q{label}\E", -1)
    sums = F.aggregate(
        F.slice(parts, 1, F.size(parts) - 1),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda s, p: F.struct((s["at"] + F.char_length(p) + len(label)).alias("at"), F.concat(s["out"], F.array(s["at"] + F.char_length(p))).alias("out")),
    )
    return sums["out"]


def anchor_candidates(text: Column, spec: dict, default_window: int = 120, limit: int = 25, low: Column | None = None) -> Column:
    """Values near a label: the label's weight falls by up to 0.4 with the distance, a valid value adds 0.05."""
    window, direction, regex, check = int(spec.get("window", default_window)), spec.get("direction", "after"), spec["value"], spec.get("check")
    group, low, found = (1 if _groups(regex) else 0), F.lower(text) if low is None else low, []

    def ways(label: str, weight: float) -> dict:
        # What a step finds is a field of its rows: computed once, however often the next one reads it.
        def judged(hits: Column) -> Column:
            known = F.transform(hits, lambda h: F.struct(*[h[n].alias(n) for n in ("value", "start", "distance")], (validate(check, h["value"]) if check else F.lit(False)).alias("valid")))

            def made(h: Column) -> Column:
                sure = F.least(F.lit(0.95), weight * (1 - 0.4 * F.least(F.lit(1.0), h["distance"] / max(1, window))))
                sure = F.round(F.when(h["valid"], F.least(F.lit(1.0), sure + 0.05)).otherwise(sure), 4)
                return _candidate(h["value"], h["start"], h["valid"], sure, F.lit("anchor"))

            return F.transform(known, made)

        def after(places: Column) -> Column:
            parts = F.transform(places, lambda at: F.struct((at + len(label)).alias("begin"), F.substr(text, at + len(label) + 1, F.lit(window)).alias("part")))
            whole = F.transform(parts, lambda x: F.struct(x["begin"].alias("begin"), x["part"].alias("part"), F.regexp_extract(x["part"], regex, 0).alias("whole")))
            some = F.filter(whole, lambda x: F.char_length(x["whole"]) > 0)
            hits = F.transform(some, lambda x: F.struct(x["begin"].alias("begin"), F.regexp_extract(x["part"], regex, group).alias("value"), (F.regexp_instr(x["part"], F.lit(regex)) - 1 + F.char_length(x["whole"])).alias("end")))
            return judged(F.transform(hits, lambda h: F.struct(h["value"].alias("value"), (h["begin"] + h["end"] - F.char_length(h["value"])).alias("start"), (h["end"] - F.char_length(h["value"])).alias("distance"))))

        def before(places: Column) -> Column:
            begin = lambda at: F.greatest(at - window, F.lit(0))
            hits = F.transform(places, lambda at: F.struct(at.alias("at"), F.try_element_at(matches(F.substr(text, begin(at) + 1, at - begin(at)), regex, 1000), F.lit(-1)).alias("hit")))
            placed = F.transform(F.filter(hits, lambda h: h["hit"].isNotNull()), lambda h: F.struct(h["hit"]["value"].alias("value"), (begin(h["at"]) + h["hit"]["start"]).alias("start"), h["at"].alias("at")))
            return judged(F.transform(placed, lambda h: F.struct(h["value"].alias("value"), h["start"].alias("start"), (h["at"] - h["start"] - F.char_length(h["value"])).alias("distance"))))

        return {"after": after, "before": before}

    for label, weight in sorted(spec["labels"].items(), key=lambda x: -x[1]):
        for way, hits in ways(label, weight).items():
            if direction in (way, "both"):
                near = hits(_occurrences(low, label.lower()))
                found.append(F.when(low.contains(label.lower()), near).otherwise(F.array().cast(CANDIDATE)))
    return F.slice(F.concat(*found), 1, limit)


def positional_candidates(words: DataFrame, sizes: DataFrame, docs: DataFrame, templates: list[dict]) -> DataFrame:
    """(doc_id, field, value, start, end, confidence): fields read from regions of registered templates.

    A word counts if its top left corner, as a share of the page, lies in the region;
    the value is the canonical text from the first to the last of them. Words join
    their page's size and document by key; templates are configuration, not data.
    """
    out = None
    placed = words.where("char_start is not null and char_end is not null").join(sizes.where("w > 0 and h > 0"), ["doc_id", "page"])
    for rank, template in enumerate(templates):
        own = docs.select("doc_id", "full", "label")
        if template.get("class"):
            own = own.where(F.col("label") == template["class"])
        if (template.get("match") or {}).get("regex"):
            own = own.where(F.col("full").rlike(template["match"]["regex"]))
        for field, region in (template.get("fields") or {}).items():
            x0, y0, x1, y1 = map(float, region["region"])
            inside = placed.where((F.col("page") == int(region.get("page", 0))) & (F.col("x0") / F.col("w")).between(x0, x1) & (F.col("y0") / F.col("h")).between(y0, y1))
            span = inside.groupBy("doc_id").agg(F.min("char_start").alias("start"), F.max("char_end").alias("end"))
            hit = own.join(span, "doc_id").where("start < end and end <= char_length(full)")
            hit = hit.select("doc_id", F.lit(field).alias("field"), F.expr("substring(full, start + 1, end - start)").alias("value"), "start", "end", F.lit(float(template.get("confidence", 0.85))).alias("confidence"), F.lit(rank).alias("rank"))
            out = hit if out is None else out.unionByName(hit)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id string, field string, value string, start int, end int, confidence double")
    return out.groupBy("doc_id", "field").agg(F.min_by(F.struct("value", "start", "end", "confidence"), "rank").alias("x")).select("doc_id", "field", "x.*")


def candidates(docs: DataFrame, names: list[str], config: Config) -> DataFrame:
    """``docs`` with f_<name>: the ranked candidates of the first of each field's strategies that finds any.

    Each strategy's candidates are a column of their own, so that they are computed once.
    """
    options, text, found = config.settings["fields"], F.coalesce(F.col("full"), F.lit("")), {}
    for name in names:
        spec = config.fields["fields"][name]
        for strategy in spec["find"]:
            if strategy == "pattern":
                found[f"{strategy}_{name}"] = pattern_candidates(text, spec["pattern"], options["candidates"])
            elif strategy == "anchor":
                found[f"{strategy}_{name}"] = anchor_candidates(text, spec["anchor"], options["window"], options["candidates"], F.col("low_"))
    docs = docs.withColumn("low_", F.lower(text)).withColumns(found).drop("low_")
    chosen = {}
    for name in names:
        first = F.array().cast(CANDIDATE)
        for strategy in reversed([x for x in config.fields["fields"][name]["find"] if f"{x}_{name}" in found]):
            own = F.col(f"{strategy}_{name}")
            first = F.when(F.size(own) > 0, own).otherwise(first)
        chosen[f"f_{name}"] = F.array_sort(first)
    return docs.withColumns(chosen).drop(*found)


def _forms(name: str, normalizer: str | None) -> Column:
    return F.transform(F.col(f"f_{name}"), lambda c: normalize(normalizer, c["value"]))


def _finished(name: str, spec: dict, config: Config) -> Column:
    """A field's ranked candidates (f_<name>) and their normal forms (n_<name>) as records; char_start and field come first to sort by."""
    values, forms = F.col(f"f_{name}"), F.col(f"n_{name}")
    both = F.arrays_zip(values, forms)

    def record(x: Column) -> Column:
        c = x[f"f_{name}"]
        money = currency_code(F.col("full"), c["start"], config.fields["currency"]) if spec.get("normalizer") == "currency" else F.lit(None).cast("string")
        return F.struct(
            c["start"].alias("char_start"), F.lit(name).alias("field"), c["value"].alias("value"), x[f"n_{name}"].alias("normalized_value"),
            page_of(F.col("spans_"), c["start"]).alias("page"), c["end"].alias("char_end"), F.round(-c["doubt"], 4).alias("confidence"), c["method"].alias("method"),
            (~c["unproven"]).alias("validated"), F.lit(config.fields["version"]).alias("normalizer_version"), money.alias("currency"),
        )

    kept = F.transform(both, record)
    if spec.get("multi"):
        keys = F.transform(both, lambda x: F.coalesce(x[f"n_{name}"], x[f"f_{name}"]["value"]))
        kept = F.filter(kept, lambda m, i: F.array_position(keys, F.coalesce(m["normalized_value"], m["value"])) == i + 1)
    return kept


def extract(docs: DataFrame, config: Config | None = None, only: list[str] | None = None) -> DataFrame:
    """``docs`` (full, pages, label, ...) with ``metadata``: every field's values, by place, then name.

    A field of some classes is looked for in those, and where the class is unknown.
    Of a field's candidates the best is kept, or for a multiple field the best of each
    normal form. Null text has no fields.
    """
    config = config or load()
    options, unknown = config.settings["fields"], config.settings["classification"]["unknown"]
    wanted = [n for n in config.fields["fields"] if only is None or n in only]
    docs = candidates(docs.withColumn("spans_", page_spans(F.col("pages"))), wanted, config)
    kept, forms = {}, {}
    for name in wanted:
        spec, found = config.fields["fields"][name], F.col(f"f_{name}")
        if spec.get("classes"):
            searched = spec["classes"] + (["", unknown] if options["scoped_when_unknown"] else [])
            found = F.when(F.coalesce(F.col("label"), F.lit("")).isin(searched), found).otherwise(F.array().cast(CANDIDATE))
        found = found if spec.get("multi") else F.slice(found, 1, 1)
        if options["drop_mismatch"]:
            found = F.filter(found, lambda c: F.substr(F.col("full"), c["start"] + 1, c["end"] - c["start"]) == c["value"])
        kept[f"f_{name}"] = found
        forms[f"n_{name}"] = _forms(name, spec.get("normalizer"))
    docs = docs.withColumns(kept).withColumns(forms)
    parts = [_finished(name, config.fields["fields"][name], config) for name in wanted]
    names = ("field", "value", "normalized_value", "page", "char_start", "char_end", "confidence", "method", "validated", "normalizer_version", "currency")
    ordered = F.array_sort(F.concat(*parts))
    metadata = F.transform(ordered, lambda m: F.struct(*[m[n].alias(n) for n in names]))
    return docs.withColumn("metadata", metadata).drop("spans_", *kept, *forms)
