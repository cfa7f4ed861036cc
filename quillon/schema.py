"""Record schemas, canonical text, and the checks that hold records to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Between pages in the canonical text (fixed value).
PAGE_SEP = "\n\f\n"
RECORD_VERSION, TABLES_VERSION = "1.1.0", "1.0.0"
#: What method columns may say (fixed values).
TEXT_METHODS = ("native", "ocr", "hybrid", "none", "ocr_rescued")
CLASS_METHODS = ("tfidf_svm", "rule", "fallback")
FIELD_METHODS = ("regex_checksum", "regex_format", "anchor", "positional")
TAG_METHODS = ("keyword", "tfidf_svm", "derived")
TABLE_METHODS = ("geometry", "text_grid")



def record_schema() -> T.StructType:
    """One document: text, class, fields, tags and diagnostics."""
    return T.StructType.fromDDL(
        "doc_id string, source_path string, filename string, schema_version string, "
        "text struct<full:string,pages:array<string>,method:string,char_count:int,extraction_confidence:double,page_methods:array<string>>, "
        "classification struct<label:string,confidence:double,all_scores:map<string,double>,method:string>, "
        "metadata array<struct<field:string,value:string,normalized_value:string,page:int,char_start:int,char_end:int,confidence:double,method:string,validated:boolean,normalizer_version:string,currency:string>>, "
        "tags array<struct<tag:string,confidence:double,method:string>>, "
        "diagnostics struct<page_count:int,is_scanned:boolean,has_native_text:boolean,timings_ms:map<string,double>,errors:array<string>>"
    )


CELL_DDL = "row:int,col:int,row_span:int,col_span:int,text:string,page:int,char_start:int,char_end:int,x0:double,y0:double,x1:double,y1:double,is_header:boolean"
TABLE_DDL = f"table_id:string,page:int,n_rows:int,n_cols:int,method:string,confidence:double,header:array<string>,cells:array<struct<{CELL_DDL}>>,char_start:int,char_end:int"
WORD_DDL = "doc_id string, page int, text string, x0 double, y0 double, x1 double, y1 double, conf double, char_start int, char_end int"


def canonical_text(pages: Column) -> Column:
    """The pages with PAGE_SEP between; a null page counts as empty."""
    return F.array_join(F.transform(pages, lambda p: F.coalesce(p, F.lit(""))), PAGE_SEP)


def sanitize(text: Column) -> Column:
    """Carriage returns and form feeds as line feeds, a pair as one."""
    return F.regexp_replace(text, "\r\n|\r|\f", "\n")


def sanitize_fixed_width(text: Column) -> Column:
    """Carriage returns and form feeds as line feeds, each by itself."""
    return F.translate(text, "\r\f", "\n\n")


def page_spans(pages: Column) -> Column:
    """array<struct<start, end>> of the pages in the canonical text."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def add(spans: Column, page: Column) -> Column:
        start = F.when(F.size(spans) == 0, 0).otherwise(F.element_at(spans, -1)["end"] + len(PAGE_SEP))
        return F.concat(spans, F.array(F.struct(start.alias("start"), (start + F.char_length(F.coalesce(page, F.lit("")))).alias("end"))))

    return F.aggregate(pages, empty, add)


def page_of(spans: Column, offset: Column) -> Column:
    """Number of the first page that holds the offset, ends included, else of the last page."""
    hit = F.array_position(F.transform(spans, lambda s: (s["start"] <= offset) & (offset <= s["end"])), True)
    return F.when(hit > 0, hit - 1).otherwise(F.greatest(F.size(spans) - 1, F.lit(0))).cast("int")


def doc_id(content: Column) -> Column:
    """The first 16 hexadecimal digits of the content's SHA-256."""
    return F.substring(F.sha2(content, 256), 1, 16)


def preview(text: Column, length: int = 200) -> Column:
    return F.substring(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), 1, length)


def runner_up(scores: Column, label: Column) -> Column:
    """struct<label, score> of the best class but the label's; ties go to the first by name."""
    others = F.map_entries(F.map_filter(scores, lambda k, v: k != label))
    ranked = F.array_sort(F.transform(others, lambda e: F.struct((-e["value"]).alias("s"), e["key"].alias("label"))))
    best = F.get(ranked, 0)
    return F.struct(best["label"].alias("label"), (-best["s"]).alias("score"))


def offset_violations(records: DataFrame) -> DataFrame:
    """(doc_id, field, char_start, char_end, value, found): fields whose span does not slice back to the value."""
    each = records.select("doc_id", F.col("text.full").alias("full"), F.explode_outer("metadata").alias("m")).where("m is not null")
    found = F.substring(F.col("full"), F.col("m.char_start") + 1, F.col("m.char_end") - F.col("m.char_start"))
    return each.select("doc_id", F.col("m.field").alias("field"), F.col("m.char_start").alias("char_start"), F.col("m.char_end").alias("char_end"), F.col("m.value").alias("value"), found.alias("found")).where("not (found <=> value)")


def unexpected_keys(lines: DataFrame, column: str = "value", schema: T.StructType | None = None) -> DataFrame:
    """(key, n): top-level JSON keys that the schema does not have, which readers drop silently."""
    known = (schema or record_schema()).fieldNames()
    keys = lines.select(F.explode(F.json_object_keys(column)).alias("key")).where(~F.col("key").isin(known))
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def range_violations(records: DataFrame) -> DataFrame:
    """(doc_id, what): confidences outside [0, 1] and spans that end before they start."""
    unit = lambda c: (c < 0) | (c > 1)
    tests = {
        "extraction_confidence": unit(F.col("text.extraction_confidence")),
        "classification.confidence": unit(F.col("classification.confidence")),
        "metadata.confidence": F.exists("metadata", lambda m: unit(m["confidence"])),
        "metadata.span": F.exists("metadata", lambda m: m["char_end"] < m["char_start"]),
        "tags.confidence": F.exists("tags", lambda t: unit(t["confidence"])),
    }
    failed = F.filter(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()]), lambda x: x.isNotNull())
    return records.select("doc_id", F.explode(failed).alias("what"))
