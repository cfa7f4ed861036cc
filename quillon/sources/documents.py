"""Files and records as DataFrames, and DataFrames as files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.schema import PAGE_SEP, doc_id, record_schema

#: Extensions by the way they are read (fixed values).
TEXT, WORD, PDF = ("txt", "md"), ("docx",), ("pdf",)
IMAGE = ("png", "jpg", "jpeg", "tif", "tiff", "bmp")
SPREADSHEET, ARCHIVE = ("xlsx", "xls"), ("zip",)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def exclusion(path: Column) -> Column:
    """Why a path is no document, null if it is one; the first reason counts."""
    name, ext = F.element_at(F.split(path, "/"), -1), extension(path)
    return (
        F.when(name.startswith("._") | F.array_contains(F.split(path, "/"), "__MACOSX"), "macos_resource_fork")
        .when(ext.isin(*ARCHIVE), "archive")
        .when(ext.isin(*SPREADSHEET), "evaluation_set")
        .when(~ext.isin(*TEXT, *WORD, *PDF, *IMAGE), "unsupported_extension")
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, reason) of all files below a folder, hidden ones too, or of the one file; a missing root is an error.

    Names only are listed, on the driver, through Hadoop's file systems.
    """
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(base):
        raise FileNotFoundError(root)
    single = files.getFileStatus(base).isFile()
    found, rows = files.listFiles(base, True), []
    while found.hasNext():
        status = found.next()
        rows.append((status.getPath().toString(), status.getLen()))
    out = spark.createDataFrame(rows, "path string, length long")
    return out.withColumn("reason", F.lit(None).cast("string") if single else exclusion(F.col("path")))


def kept_files(spark: SparkSession, root: str) -> DataFrame:
    return list_files(spark, root).where("reason is null").orderBy(F.lower("path"))


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, content, doc_id) of the documents below a folder, content-addressed."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return raw.where(exclusion(F.col("path")).isNull()).select("path", "content", doc_id(F.col("content")).alias("doc_id"))


def text_pages(content: Column) -> Column:
    """One page of UTF-8, malformed bytes replaced, line ends and form feeds as line feeds."""
    from quillon.schema import sanitize

    return F.array(sanitize(F.decode(content, "UTF-8")))


class NullEngine:
    """The OCR engine of a machine without one."""

    name = "null"

    def available(self) -> bool:
        return False

    def words(self, image: bytes) -> list[dict]:
        raise RuntimeError("no OCR engine is available")


_engines: dict[str, Callable[[], NullEngine]] = {"null": NullEngine}


def register_engine(name: str, make: Callable) -> None:
    _engines[name] = make


def engine(name: str):
    """The engine of a name; an unknown one is a KeyError."""
    return _engines[name]()


def docx_text(content: bytes) -> str:
    """Paragraphs, then table rows with tabs between cells."""
    import io
    import zipfile
    from xml.etree import ElementTree

    space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(f"{space}body")
    said = lambda e: "".join(t.text or "" for t in e.iter(f"{space}t"))
    lines = [said(p) for p in body.findall(f"{space}p")]
    lines += ["\t".join(said(c) for c in row.findall(f"{space}tc")) for table in body.iter(f"{space}tbl") for row in table.findall(f"{space}tr")]
    return "\n".join(lines)


EXTRACTED = "doc_id string, path string, pages array<string>, page_methods array<string>, page_confidences array<double>, errors array<string>"


def extract(files: DataFrame, native_confidence: float = 0.98) -> DataFrame:
    """EXTRACTED of (path, content, doc_id): at least one page each; what cannot be read has an error and an empty page.

    Text files are decoded by expressions; only other formats pass through Python.
    """
    ext = extension(F.col("path"))
    text = files.where(ext.isin(*TEXT)).withColumn("pages", text_pages(F.col("content")))
    has = F.col("pages")[0].rlike(r"(?U)\S")
    text = text.select("doc_id", "path", "pages", F.array(F.when(has, "native").otherwise("none")).alias("page_methods"), F.array(F.when(has, native_confidence).otherwise(0.0)).alias("page_confidences"), F.array().cast("array<string>").alias("errors"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for path, content, key in rows[["path", "content", "doc_id"]].itertuples(index=False):
                kind = path.rsplit(".", 1)[-1].lower()
                try:
                    if kind not in WORD:
                        raise RuntimeError("no reader for this format is installed")
                    page = docx_text(content).replace("\r\n", "\n").replace("\r", "\n").replace("\f", "\n")
                    method, errors = ("native" if page.strip() else "none"), []
                except Exception as e:  # a bad file is a row with an error
                    page, method, errors = "", "none", [f"{kind}: {type(e).__name__}: {e}"]
                out.append((key, path, [page], [method], [native_confidence if method == "native" else 0.0], errors))
            yield pd.DataFrame(out, columns=["doc_id", "path", "pages", "page_methods", "page_confidences", "errors"])

    return text.unionByName(files.where(~ext.isin(*TEXT)).select("path", "content", "doc_id").mapInPandas(run, EXTRACTED))


def rescue_pages(pages: DataFrame, readings: DataFrame, threshold: float = 0.02, min_tokens: int = 40) -> DataFrame:
    """(doc_id, page, text, method): suspect native pages take another reading (doc_id, page, ocr) that looks cleaner."""
    from quillon.functions.quality import is_suspect, prefer_ocr, score_text

    both = pages.join(readings, ["doc_id", "page"], "left")
    better = is_suspect(score_text(F.col("text")), threshold, min_tokens) & F.col("ocr").isNotNull() & prefer_ocr(F.col("text"), F.col("ocr"))
    return both.select("doc_id", "page", F.when(better, F.col("ocr")).otherwise(F.col("text")).alias("text"), F.when(better, "ocr_rescued").otherwise(F.col("method")).alias("method"))


def upscale(width: Column, height: Column, least: int = 1000) -> Column:
    """How much larger an image is made before OCR, so that its short side has enough pixels."""
    return F.greatest(F.lit(1.0), least / F.least(width, height))


def assemble_words(tokens: DataFrame) -> DataFrame:
    """(doc_id, page, text, words): page text and word offsets of OCR tokens (doc_id, page, block, par, line, word_num, text, conf, x0..y1).

    Words of a line are joined by blanks, lines by line feeds.
    """
    order = ["block", "par", "line", "word_num"]
    page = W.partitionBy("doc_id", "page").orderBy(*order, "text")
    rows = tokens.where(F.col("text").rlike(r"(?U)\S")).withColumn("first", F.coalesce(F.struct("block", "par", "line") != F.lag(F.struct("block", "par", "line")).over(page), F.lit(False)))
    rows = rows.withColumn("char_end", F.sum(F.char_length("text") + 1).over(page.rowsBetween(W.unboundedPreceding, 0)) - 1).withColumn("char_start", F.col("char_end") - F.char_length("text"))
    word = F.struct(*order, *[F.col(c).alias(c) for c in ("text", "conf", "x0", "y0", "x1", "y1")], F.col("first").alias("first"), F.col("char_start").cast("int").alias("char_start"), F.col("char_end").cast("int").alias("char_end"))
    out = rows.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(word)).alias("w"))
    text = F.aggregate("w", F.lit(""), lambda a, w: F.concat(a, F.when(w["char_start"] == 0, "").when(w["first"], "\n").otherwise(" "), w["text"]))
    keep = ("text", "conf", "x0", "y0", "x1", "y1", "char_start", "char_end")
    return out.select("doc_id", "page", text.alias("text"), F.transform("w", lambda w: F.struct(*[w[k].alias(k) for k in keep])).alias("words"))


def map_words(text: Column, words: Column) -> Column:
    """array<struct<word, start, end>>: each word where it next occurs, else where it first does, else nulls."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<word:string,start:int,end:int>>").alias("out"))

    def step(s: Column, w: Column) -> Column:
        later = F.position(w, text, s["at"] + 1)
        place = F.when(later > 0, later).otherwise(F.position(w, text, F.lit(1))) - 1
        found = (place >= 0) & (F.char_length(w) > 0)
        end = place + F.char_length(w)
        entry = F.struct(w.alias("word"), F.when(found, place).alias("start"), F.when(found, end).alias("end"))
        return F.struct(F.when(found, end).otherwise(s["at"]).alias("at"), F.concat(s["out"], F.array(entry)).alias("out"))

    return F.aggregate(words, empty, step)["out"]


def canonical_offsets(words: DataFrame, spans: DataFrame) -> DataFrame:
    """``words`` with offsets in the canonical text, from (doc_id, page, start) of the pages."""
    both = words.join(spans.select("doc_id", "page", F.col("start").alias("base_")), ["doc_id", "page"], "left")
    return both.withColumns({c: F.col(c) + F.col("base_") for c in ("char_start", "char_end")}).drop("base_")


def rescale(words: DataFrame, scale: Column) -> DataFrame:
    """Boxes in page units from boxes of an image that is ``scale`` times as large."""
    return words.withColumns({c: F.col(c) / scale for c in ("x0", "y0", "x1", "y1")})


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Records of JSON lines; a line that is no JSON of the schema stops the read. Only line feeds end lines."""
    return spark.read.schema(schema or record_schema()).option("mode", "FAILFAST").option("lineSep", "\n").json(path)


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line): those that are no JSON."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line")).where("trim(line) <> ''")
    return lines.where(F.try_parse_json("line").isNull())


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, path, label, tags, text) in the order of their names."""
    rows = spark.read.schema("doc_id string, path string, label string, tags array<string>, text string").option("mode", "FAILFAST").json(path)
    return rows.orderBy(F.substring(F.coalesce("doc_id", "path", "text"), 1, 200))


def read_label_csv(spark: SparkSession, path: str, name: str = "File_Name", label: str = "Document_Type") -> DataFrame:
    """(name, label) of a CSV with a header, with or without a byte order mark."""
    rows = spark.read.option("header", True).csv(path)
    rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns])
    return rows.select(F.col(name).alias("name"), F.col(label).alias("label"))


def read_words(words: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, words): an array for each document, empty where nothing was recorded."""
    own = words.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "char_start", "text", "x0", "y0", "x1", "y1"))).alias("words"))
    return docs.select("doc_id").join(own, "doc_id", "left").withColumn("words", F.coalesce("words", F.array()))


def write_records(records: DataFrame, path: str, append: bool = True) -> None:
    records.write.mode("append" if append else "errorifexists").json(path)


def write_words(words: DataFrame, path: str) -> None:
    words.write.mode("append").parquet(path)


def write_tabs(tabs: dict[str, DataFrame], path: str, overwrite: bool = False) -> None:
    """A folder per tab; nothing is overwritten unless asked for."""
    for name, tab in tabs.items():
        tab.write.mode("overwrite" if overwrite else "errorifexists").option("header", True).option("quoteAll", True).csv(f"{path}/{name}")


def pages_of(docs: DataFrame) -> DataFrame:
    """(doc_id, page, text, page_start): a row per page of documents (doc_id, pages)."""
    from quillon.schema import page_spans

    each = docs.select("doc_id", F.posexplode(F.arrays_zip(F.col("pages").alias("text"), page_spans(F.col("pages")).alias("span"))).alias("page", "p"))
    return each.select("doc_id", "page", F.col("p.text").alias("text"), F.col("p.span.start").alias("page_start"))


def split_canonical(full: Column) -> Column:
    return F.split(full, PAGE_SEP.replace("\f", r"\f"), -1)
