"""Queries over the driver's tables, one or more for each family of operators, and SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import normalizers, quality, validators
from quillon.operators import evaluate, fields, graph, profile, review, rules, tables
from quillon.plans import business
from quillon.schema import canonical_text, doc_id, page_of, page_spans, preview, runner_up, sanitize, sanitize_fixed_width
from quillon.sources import documents as sources
from quillon.store import saved, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with(body: str) -> str:
    return f"WITH {business.sql()}\n{body}"


# Patterns and text ---------------------------------------------------------------


def _pattern_sql(regex: str) -> str:
    return f"""
WITH m AS (SELECT doc_id, regexp_extract_all(text, '{regex}') AS v, regexp_split_to_array(text, '{regex}') AS g FROM documents),
e AS (SELECT doc_id, v, g, unnest(range(1, len(v) + 1)) AS i FROM m WHERE len(v) > 0)
SELECT doc_id, v[i] AS value,
       CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(v[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS char_start
FROM e WHERE i <= 25"""


def _pattern(spark: SparkSession, sf_dir: str, regex: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    return docs.select("doc_id", F.explode(fields.matches(F.col("text"), regex)).alias("m")).select("doc_id", F.col("m.value").alias("value"), F.col("m.start").cast("long").alias("char_start"))


_CARD = "[0-9]{4}(?:[ -]?[0-9]{4}){3}"
_MAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"


@query(_pattern_sql(_CARD))
def fld_pattern_card(spark, sf_dir):
    return _pattern(spark, sf_dir, _CARD)


@query(_pattern_sql(_MAIL))
def fld_pattern_email(spark, sf_dir):
    return _pattern(spark, sf_dir, _MAIL)


@query()
def fld_extract_documents(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("full"), F.array("text").alias("pages"), F.lit("unknown").alias("label"))
    out = fields.extract(docs, only=["card_number", "email", "phone", "pan", "gstin", "ifsc", "aadhaar"])
    return out.select("doc_id", F.explode_outer("metadata").alias("m")).where("m is not null").select("doc_id", "m.*")


@query("SELECT page_id, regexp_replace(coalesce(html, ''), '\\r\\n|\\r|\\f', chr(10), 'g') AS clean, translate(coalesce(html, ''), chr(13) || chr(12), chr(10) || chr(10)) AS same_width FROM pages")
def prj_sanitize(spark, sf_dir):
    html = F.coalesce("html", F.lit(""))
    return _t(spark, sf_dir, "pages").select("page_id", sanitize(html).alias("clean"), sanitize_fixed_width(html).alias("same_width"))


_PAGES = "list_transform(string_split(text, chr(10)), lambda x: x)"


@query(f"""
WITH p AS (SELECT doc_id, {_PAGES} AS pages FROM documents),
e AS (SELECT doc_id, pages, unnest(range(1, len(pages) + 1)) AS i FROM p)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS page, CAST(coalesce(list_sum(list_transform(pages[1:i-1], lambda x: length(x) + 3)), 0) AS INTEGER) AS "start",
       CAST(coalesce(list_sum(list_transform(pages[1:i-1], lambda x: length(x) + 3)), 0) + length(pages[i]) AS INTEGER) AS "end" FROM e""")
def prj_page_spans(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("pages"))
    return docs.select("doc_id", F.posexplode(page_spans(F.col("pages"))).alias("page", "s")).select("doc_id", "page", "s.start", "s.end")


@query("""
WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS pages, n_chars // 2 AS off FROM documents),
s AS (SELECT doc_id, off, pages, list_transform(range(1, len(pages) + 1), lambda i: coalesce(list_sum(list_transform(pages[1:i-1], lambda x: length(x) + 3)), 0)) AS st FROM p),
h AS (SELECT doc_id, off, list_filter(range(1, len(pages) + 1), lambda i: st[i] <= off AND off <= st[i] + length(pages[i])) AS hit, len(pages) AS n, array_to_string(pages, chr(10) || chr(12) || chr(10)) AS full_text FROM s)
SELECT doc_id, CAST(CASE WHEN len(hit) > 0 THEN hit[1] - 1 ELSE n - 1 END AS INTEGER) AS page, length(full_text) AS chars FROM h""")
def prj_page_for_offset(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("pages"), F.floor(F.col("n_chars") / 2).cast("int").alias("off"))
    docs = docs.withColumn("spans", page_spans(F.col("pages")))
    return docs.select("doc_id", page_of(F.col("spans"), F.col("off")).alias("page"), F.char_length(canonical_text(F.col("pages"))).cast("long").alias("chars"))


@query("SELECT doc_id, substr(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 200) AS preview, substr(sha256(text), 1, 16) AS content_id FROM documents")
def prj_preview(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", preview(F.col("text")).alias("preview"), doc_id(F.col("text").cast("binary")).alias("content_id"))


# Sources -------------------------------------------------------------------------


@query("""
WITH p AS (SELECT page_id, CASE page_id % 8 WHEN 0 THEN 'a/._x.txt' WHEN 1 THEN '__MACOSX/b.pdf' WHEN 2 THEN 'c.zip' WHEN 3 THEN 'd/e.XLSX' WHEN 4 THEN 'f.exe' WHEN 5 THEN 'g.PDF' WHEN 6 THEN 'h.md' ELSE 'noext' END AS path FROM pages)
SELECT page_id, path, CASE WHEN page_id % 8 IN (0, 1) THEN 'macos_resource_fork' WHEN page_id % 8 = 2 THEN 'archive' WHEN page_id % 8 = 3 THEN 'evaluation_set' WHEN page_id % 8 IN (4, 7) THEN 'unsupported_extension' END AS reason FROM p""")
def src_exclusion(spark, sf_dir):
    names = F.array(*map(F.lit, ["a/._x.txt", "__MACOSX/b.pdf", "c.zip", "d/e.XLSX", "f.exe", "g.PDF", "h.md", "noext"]))
    rows = _t(spark, sf_dir, "pages").select("page_id", F.element_at(names, (F.col("page_id") % 8 + 1).cast("int")).alias("path"))
    return rows.select("page_id", "path", sources.exclusion(F.col("path")).alias("reason"))


@query("""
WITH t AS (SELECT l_orderkey AS doc, l_partkey % 3 AS line, l_linenumber AS w, 'w' || l_suppkey AS txt FROM lineitem),
o AS (SELECT doc, line, w, txt, sum(length(txt) + 1) OVER (PARTITION BY doc ORDER BY line, w, txt ROWS UNBOUNDED PRECEDING) - 1 AS e FROM t)
SELECT lpad(hex(doc), 16, '0') AS doc_id, txt AS text, CAST(e - length(txt) AS INTEGER) AS char_start, CAST(e AS INTEGER) AS char_end FROM o""")
def src_assemble_words(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem")
    tokens = rows.select(F.lpad(F.hex("l_orderkey"), 16, "0").alias("doc_id"), F.lit(0).alias("page"), F.lit(1).alias("block"), F.lit(1).alias("par"), (F.col("l_partkey") % 3).alias("line"), F.col("l_linenumber").alias("word_num"), F.concat(F.lit("w"), "l_suppkey").alias("text"), F.lit(0.9).alias("conf"), *[F.lit(0.0).alias(c) for c in ("x0", "y0", "x1", "y1")])
    return sources.assemble_words(tokens).select("doc_id", F.explode("words").alias("w")).select("doc_id", "w.text", "w.char_start", "w.char_end")


@query("SELECT o_orderkey, strpos('PO ' || o_orderpriority || ' / ' || o_orderpriority, o_orderpriority) - 1 AS a, strpos('PO ' || o_orderpriority || ' / ' || o_orderpriority, o_orderpriority) - 1 + length(o_orderpriority) + 3 AS b FROM orders")
def src_map_words(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    p = F.col("o_orderpriority")
    found = sources.map_words(F.concat(F.lit("PO "), p, F.lit(" / "), p), F.array(p, p))
    return orders.select("o_orderkey", found[0]["start"].cast("long").alias("a"), found[1]["start"].cast("long").alias("b"))


@query("SELECT o.o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linenumber = 3)")
def src_resume(spark, sf_dir):
    from quillon.plans.process import resumed

    done = _t(spark, sf_dir, "lineitem").where("l_linenumber = 3").select(F.col("l_orderkey").alias("doc_id"))
    return resumed(_t(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "doc_id"), done).select(F.col("doc_id").alias("o_orderkey"))


# Validators and normal forms -------------------------------------------------------

_DIGITS = "lpad(cast(o_orderkey * 7919 + o_custkey * 104729 as {0}), 16, '4')"
_LUHN = "list_sum(list_transform(range(1, 17), lambda i: CASE WHEN i % 2 = 0 THEN CAST(substr(v, 17 - i, 1) AS INT) * 2 - CASE WHEN CAST(substr(v, 17 - i, 1) AS INT) > 4 THEN 9 ELSE 0 END ELSE CAST(substr(v, 17 - i, 1) AS INT) END)) % 10 = 0"


@query(f"SELECT o_orderkey, {_LUHN} AS ok FROM (SELECT o_orderkey, {_DIGITS.format('varchar')} AS v FROM orders)")
def val_luhn(spark, sf_dir):
    return _t(spark, sf_dir, "orders").selectExpr("o_orderkey", _DIGITS.format("string") + " AS v").select("o_orderkey", validators.validate("luhn", F.col("v")).alias("ok"))


@query(_with("SELECT doc_id, gstin, good_gstin AS ok, true AS pan_ok, ifsc, true AS ifsc_ok FROM b"))
def val_gstin(spark, sf_dir):
    b = business.rendered(spark, sf_dir)
    check = validators.validate
    return b.select("doc_id", "gstin", check("gstin", F.col("gstin")).alias("ok"), check("pan", F.substring("gstin", 3, 10)).alias("pan_ok"), "ifsc", check("ifsc", F.col("ifsc")).alias("ifsc_ok"))


@query("""
WITH t AS (SELECT c_custkey, lpad(cast(c_custkey * 7 as varchar), 11, '2') AS p FROM customer),
m AS (SELECT *, [[0,1,2,3,4,5,6,7,8,9],[1,2,3,4,0,6,7,8,9,5],[2,3,4,0,1,7,8,9,5,6],[3,4,0,1,2,8,9,5,6,7],[4,0,1,2,3,9,5,6,7,8],[5,9,8,7,6,0,4,3,2,1],[6,5,9,8,7,1,0,4,3,2],[7,6,5,9,8,2,1,0,4,3],[8,7,6,5,9,3,2,1,0,4],[9,8,7,6,5,4,3,2,1,0]] AS d,
      [[0,1,2,3,4,5,6,7,8,9],[1,5,7,6,2,8,3,0,9,4],[5,8,0,3,7,9,6,1,4,2],[8,9,1,6,0,4,3,5,2,7],[9,4,5,3,1,2,6,8,7,0],[4,2,8,6,5,7,3,9,0,1],[2,7,9,3,8,0,6,4,1,5],[7,0,4,6,9,1,3,2,5,8]] AS q FROM t)
SELECT c_custkey, CAST([0,4,3,2,1,5,6,7,8,9][1 + list_reduce(list_prepend(0, list_transform(range(1, 12), lambda i: q[i % 8 + 1][CAST(substr(p, 12 - i, 1) AS INT) + 1])), lambda a, x: d[a + 1][x + 1])] AS VARCHAR) AS digit, true AS ok FROM m""")
def val_verhoeff(spark, sf_dir):
    rows = _t(spark, sf_dir, "customer").selectExpr("c_custkey", "lpad(cast(c_custkey * 7 as string), 11, '2') AS p")
    rows = rows.withColumn("digit", validators.verhoeff_digit(F.col("p")))
    return rows.select("c_custkey", "digit", validators.validate("aadhaar", F.concat("p", "digit")).alias("ok"))


@query("""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS c, length(ph) = 10 AND substr(ph, 1, 1) IN ('6','7','8','9') AS phone_ok, true AS mail_ok, false AS bad_mail, length(inv) BETWEEN 3 AND 30 AS invoice_ok, o_totalprice BETWEEN 0 AND 1000000000000 AS amount_ok
FROM (SELECT *, cast(o_orderkey * 1234577 % 10000000000 as varchar) AS ph, 'INV' || o_orderkey AS inv FROM orders)""")
def val_formats(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("c", F.col("o_custkey").cast("string"))
    check = validators.validate
    phone = F.expr("cast(o_orderkey * 1234577 % 10000000000 as string)")
    return o.select("o_orderkey", "c", check("phone_in", phone).alias("phone_ok"), check("email", F.concat(F.lit("a"), "c", F.lit("@x.org"))).alias("mail_ok"), check("email", F.concat(F.lit("a..b@"), "c")).alias("bad_mail"), check("invoice_number", F.concat(F.lit("INV"), F.col("o_orderkey"))).alias("invoice_ok"), check("amount_sane", F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("amount_ok"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS dmy, strftime(o_orderdate, '%Y-%m-%d') AS named, strftime(o_orderdate, '%Y-%m-%d') AS american, strftime(o_orderdate, '%Y-%m-%d') AS short, CAST(NULL AS VARCHAR) AS none, year(o_orderdate) BETWEEN 1990 AND 2035 AS sane FROM orders""")
def nrm_date_iso(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    form = lambda pattern: normalizers.date_iso(F.date_format("o_orderdate", pattern))
    return o.select("o_orderkey", form("dd/MM/yyyy").alias("dmy"), form("d MMMM, yyyy").alias("named"), form("MMM d yyyy").alias("american"), form("dd-MM-yy").alias("short"), normalizers.date_iso(F.lit("30 February 2024")).alias("none"), validators.validate("date_sane", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("sane"))


@query("""
SELECT l_orderkey, l_linenumber, printf('%.2f', l_extendedprice) AS amount, CASE l_linenumber % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'INR' ELSE 'EUR' END AS code, 'AB' || l_orderkey AS id_form, CAST(l_orderkey AS VARCHAR) AS digits, 'a b' AS words FROM lineitem""")
def nrm_currency(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem")
    symbol = F.when(F.col("l_linenumber") % 3 == 0, "$ ").when(F.col("l_linenumber") % 3 == 1, "Rs. ").otherwise("€ ")
    amount = F.format_number("l_extendedprice", 2)
    form = normalizers.normalize
    return rows.select("l_orderkey", "l_linenumber", form("currency", amount).alias("amount"), normalizers.currency_code(F.concat(F.lit("Total: "), symbol, amount), F.char_length(F.concat(F.lit("Total: "), symbol))).alias("code"), form("id_upper", F.concat(F.lit("a b-"), F.col("l_orderkey"))).alias("id_form"), form("digits_only", F.concat(F.lit("no. "), F.col("l_orderkey"))).alias("digits"), F.lower(form("upper_strip", F.lit("  a \t b "))).alias("words"))


# Classification and tags -------------------------------------------------------------


@query(_with("""
SELECT doc_id, CASE kind WHEN 'receipt' THEN 'receipt' WHEN 'purchase_order' THEN 'purchase_order' ELSE 'invoice' END AS label,
       CASE kind WHEN 'receipt' THEN 0.94 ELSE 0.95 END::DOUBLE AS confidence, 'rule' AS method FROM b"""))
def cls_cascade_documents(spark, sf_dir):
    from quillon.plans.process import classified

    return classified(business.rendered(spark, sf_dir).select("doc_id", "pages")).select("doc_id", "classification.label", "classification.confidence", "classification.method")


_SCORES = """
SELECT l_orderkey, l_linenumber, l_discount * 10 AS r1, l_tax * 12 AS r2, CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_quantity / 50 END AS m1, CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE 0.3 END AS m2 FROM lineitem"""


@query(f"""
WITH s AS ({_SCORES}), t AS (
SELECT *, greatest(r1, r2) AS rs, CASE WHEN r1 >= r2 THEN 'invoice' ELSE 'receipt' END AS rl, greatest(m1, m2) AS ms, CASE WHEN m1 >= m2 THEN 'contract' ELSE 'tax_form' END AS ml FROM s)
SELECT l_orderkey, l_linenumber, CASE WHEN rs >= 0.9 THEN rl WHEN ms >= 0.45 THEN ml WHEN rs >= 0.7 THEN rl ELSE 'unknown' END AS label,
       CASE WHEN rs >= 0.9 THEN 'rule' WHEN ms >= 0.45 THEN 'tfidf_svm' WHEN rs >= 0.7 THEN 'rule' ELSE 'fallback' END AS method,
       round(CASE WHEN rs >= 0.9 THEN rs WHEN ms >= 0.45 THEN ms WHEN rs >= 0.7 THEN rs WHEN ms IS NOT NULL THEN ms ELSE rs END, 4) AS confidence,
       CASE WHEN rl = 'invoice' THEN 'receipt' ELSE 'invoice' END AS second FROM t""")
def cls_cascade(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_discount * 10 AS r1", "l_tax * 12 AS r2", "CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_quantity / 50 END AS m1")
    rows = rows.withColumns({"rules": F.create_map(F.lit("invoice"), "r1", F.lit("receipt"), "r2"), "model": F.when(F.col("m1").isNotNull(), F.create_map(F.lit("contract"), "m1", F.lit("tax_form"), F.lit(0.3)))})
    rows = rows.withColumn("c", rules.cascade(F.col("rules"), F.col("model")))
    return rows.select("l_orderkey", "l_linenumber", "c.label", "c.method", "c.confidence", runner_up(F.col("rules"), rules.top(F.col("rules"))["label"])["label"].alias("second"))


@query("""
WITH t AS (SELECT doc_id, text, lower(text) AS low FROM documents)
SELECT doc_id, regexp_matches(low, 'licensed\\s+under') AS pattern_hit, regexp_matches(low, '(^|[^\\p{L}\\p{N}_])license([^\\p{L}\\p{N}_]|$)') AND (regexp_matches(low, '(^|[^\\p{L}\\p{N}_])apache([^\\p{L}\\p{N}_]|$)') OR regexp_matches(low, '(^|[^\\p{L}\\p{N}_])mit([^\\p{L}\\p{N}_]|$)')) AS words_hit, false AS empty_hit,
       greatest(CASE WHEN regexp_matches(low, 'licensed\\s+under') THEN 0.9 ELSE 0 END, CASE WHEN regexp_matches(low, '(^|[^\\p{L}\\p{N}_])mit([^\\p{L}\\p{N}_]|$)') THEN 0.5 ELSE 0 END)::DOUBLE AS score FROM t""")
def flt_markers(spark, sf_dir):
    texts = rules.scopes(F.col("text"), F.array("text"))
    a, b = {"pattern": r"licensed\s+under", "weight": 0.9}, {"all": ["license"], "any": ["apache", "mit"]}
    return _t(spark, sf_dir, "documents").select("doc_id", rules.fires(a, texts).alias("pattern_hit"), rules.fires(b, texts).alias("words_hit"), rules.fires({"all": [], "any": []}, texts).alias("empty_hit"), rules.best_score([a, {"any": ["mit"]}], texts).alias("score"))


@query(_with("""
SELECT doc_id, kind AS label, CASE kind WHEN 'receipt' THEN 0.94 ELSE 0.95 END::DOUBLE AS score FROM b
UNION ALL SELECT doc_id, 'invoice', CASE kind WHEN 'receipt' THEN 0.88 ELSE 0.85 END::DOUBLE FROM b WHERE kind <> 'invoice'"""))
def cls_rule_scores(spark, sf_dir):
    b = business.rendered(spark, sf_dir)
    scores = b.select("doc_id", rules.class_scores(F.col("full"), F.col("pages")).alias("s"))
    return scores.select("doc_id", F.explode_outer("s").alias("label", "score"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'contains_pii' AS tag, CASE WHEN l_quantity > 40 THEN 0.99 ELSE round(l_tax * 10, 4) END::DOUBLE AS confidence, CASE WHEN l_quantity > 40 THEN 'derived' ELSE 'keyword' END AS method FROM lineitem WHERE l_quantity > 40 OR round(l_tax * 10, 4) >= 0.5
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'multi_page', 1.0::DOUBLE, 'derived' FROM lineitem WHERE l_linenumber > 1""")
def tag_apply(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem")
    fact = {"page_count": F.col("l_linenumber"), "extraction_confidence": F.lit(0.9), "char_count": F.lit(10)}
    hit = F.struct(F.lit("pan").alias("field"), F.lit("x").alias("value"), F.lit("x").alias("normalized_value"), F.lit(1.0).alias("confidence"), (F.col("l_quantity") > 40).alias("validated"))
    rows = rows.withColumn("keyword", F.map_filter(F.create_map(F.lit("contains_pii"), F.round(F.col("l_tax") * 10, 4)), lambda k, v: v > 0)).withColumn("derived", rules.derived_scores(F.array(hit), fact))
    tags = rules.apply_tags(F.col("keyword"), F.col("derived"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.explode_outer(tags).alias("t")).where("t is not null").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "t.tag", "t.confidence", "t.method")


_FIT = "SELECT 'quality' AS tag, quality AS truth, round(least(n_chars / 5000.0, 1.0), 3) AS prob FROM labels JOIN documents USING (doc_id) UNION ALL SELECT 'toxic', toxic, round(least(n_chars / 5000.0, 1.0), 3) FROM labels JOIN documents USING (doc_id)"


@query(f"""
WITH r AS ({_FIT}), c AS (SELECT DISTINCT tag, round(prob, 4) AS t FROM r UNION SELECT DISTINCT tag, unnest([0.05, 0.5, 0.95]) FROM r),
s AS (SELECT c.tag, t, sum(CASE WHEN truth = 1 AND prob >= t THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN prob >= t THEN 1 ELSE 0 END) AS found, sum(truth) AS pos FROM c JOIN r USING (tag) GROUP BY ALL)
SELECT tag, t::DOUBLE AS threshold, round(coalesce(2.0 * tp / nullif(found + pos, 0), 0), 4)::DOUBLE AS f1, pos::BIGINT AS positives FROM s
QUALIFY row_number() OVER (PARTITION BY tag ORDER BY coalesce(2.0 * tp / nullif(found + pos, 0), 0) DESC, t) = 1""")
def tag_threshold_fit(spark, sf_dir):
    rows = _t(spark, sf_dir, "labels").join(_t(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    prob = F.round(F.least(F.col("n_chars") / 5000.0, F.lit(1.0)), 3)
    each = F.explode(F.array(F.struct(F.lit("quality").alias("tag"), F.col("quality").alias("truth")), F.struct(F.lit("toxic").alias("tag"), F.col("toxic").alias("truth"))))
    return evaluate.fit_threshold(rows.select(each.alias("x"), prob.alias("prob")).select("x.*", "prob"))


# Quality and profile -------------------------------------------------------------------


@query(r"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: regexp_matches(x, '\p{L}')) AS k FROM documents),
l AS (SELECT doc_id, len(k) AS n, list_filter(k, lambda x: regexp_full_match(x, '[\x00-\x7F]+')) AS a FROM t),
s AS (SELECT doc_id, n, greatest(len(a), 1) AS d, len(a) AS la, len(list_filter(a, lambda x: regexp_matches(x, '[a-z][0-9]|[0-9][a-z]'))) AS dl,
  len(list_filter(a, lambda x: NOT regexp_matches(x, '[./]') AND length(regexp_replace(x, '[^A-Za-z]', '', 'g')) >= 3 AND NOT regexp_full_match(regexp_replace(x, '[^A-Za-z]', '', 'g'), '[a-z]+|[A-Z]+|[A-Z][a-z]+'))) AS cs,
  len(regexp_extract_all(array_to_string(a, ' '), '\bl[bcdfgjklmnpqrstvwxz]')) AS ll FROM l)
SELECT doc_id, round((ll + dl + cs) / d, 6) AS score, round(ll / d, 6) AS l_for_i, round(dl / d, 6) AS digit_letter, round(cs / d, 6) AS case_shape, CASE WHEN n > 0 THEN round((n - la) / n, 6) ELSE 0 END AS non_latin_rate, CAST(n AS INTEGER) AS tokens FROM s""")
def dq_score_text(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", quality.score_text(F.col("text")).alias("q")).select("doc_id", "q.*")


@query("""
SELECT l_orderkey, round(sum(l_extendedprice / 100003 * length(l_returnflag || l_linestatus || l_linenumber)) / sum(length(l_returnflag || l_linestatus || l_linenumber)), 4) AS confidence,
       CASE WHEN bool_or(l_linenumber % 3 = 0) AND bool_or(l_linenumber % 3 <> 0) THEN 'hybrid' WHEN bool_or(l_linenumber % 3 = 0) THEN 'ocr' ELSE 'native' END AS method FROM lineitem GROUP BY 1""")
def dq_document_confidence(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", F.concat("l_returnflag", "l_linestatus", "l_linenumber").alias("p"), (F.col("l_extendedprice") / 100003).alias("c"), F.when(F.col("l_linenumber") % 3 == 0, "ocr_rescued").otherwise("native").alias("m")).alias("x"))
    docs = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("x")).alias("x"))
    part = lambda n: F.transform("x", lambda e: e[n])
    return docs.select("l_orderkey", quality.document_confidence(part("p"), part("c")).alias("confidence"), quality.document_method(part("m")).alias("method"))


@query("""
WITH s AS (SELECT list_sort(list(n_chars)) AS v FROM documents)
SELECT len(v) AS n, v[1]::DOUBLE AS min, v[len(v) // 2 + 1]::DOUBLE AS p50, v[least(len(v) - 1, CAST(floor(0.9 * len(v)) AS BIGINT)) + 1]::DOUBLE AS p90, v[len(v)]::DOUBLE AS max, list_sum(v)::DOUBLE / len(v) AS mean FROM s""")
def pro_distribution(spark, sf_dir):
    return profile.distribution(_t(spark, sf_dir, "documents"), "n_chars")


@query("SELECT 'lang' AS what, lang AS value, count(*) AS n FROM documents GROUP BY ALL UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY ALL")
def pro_counts(spark, sf_dir):
    return profile.counts(_t(spark, sf_dir, "documents"), ["lang", "source"])


@query("SELECT user_id::VARCHAR AS doc_id, round(avg(CASE WHEN event_type = 'click' THEN value END) - avg(CASE WHEN event_type = 'error' THEN value END), 4) AS delta FROM events GROUP BY 1 HAVING avg(CASE WHEN event_type = 'click' THEN value END) - avg(CASE WHEN event_type = 'error' THEN value END) IS NOT NULL")
def pro_hybrid_delta(spark, sf_dir):
    method = F.when(F.col("event_type") == "click", "native").when(F.col("event_type") == "error", "ocr").otherwise("ocr_rescued")
    return profile.hybrid_delta(_t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("doc_id"), method.alias("method"), F.col("value").alias("confidence")))


@query("SELECT count(*) AS documents, count(*) FILTER (WHERE l_discount < 0.06) AS low, round(count(*) FILTER (WHERE l_discount < 0.06) / count(*), 4) AS share FROM lineitem")
def pro_low_confidence(spark, sf_dir):
    return profile.low_confidence(_t(spark, sf_dir, "lineitem").select(F.col("l_discount").alias("confidence")), 0.06)


# Graph -------------------------------------------------------------------------------------

_GRAPH_FIELDS = ["gstin", "ifsc", "invoice_number", "total_amount", "account_number", "vendor_name", "buyer_name"]


def _records(spark: SparkSession, sf_dir: str, only: list[str]) -> DataFrame:
    """Records of the rendered documents; their class is what they were rendered as."""
    docs = business.rendered(spark, sf_dir).select("doc_id", F.col("path").alias("filename"), "full", "pages", F.col("kind").alias("label"))
    out = fields.extract(docs, only=only)
    return out.select("doc_id", "filename", F.struct("label", F.lit(0.95).alias("confidence")).alias("classification"), "metadata", F.struct(F.lit("native").alias("method")).alias("text"), F.struct(F.lit(1).alias("page_count")).alias("diagnostics"))


def _found_once(spark: SparkSession, sf_dir: str, only: list[str]) -> DataFrame:
    """``_records``, written: for results that read them more than once."""
    return saved(_records(spark, sf_dir, only), "records")


def _facts(spark: SparkSession, sf_dir: str, only: list[str]) -> DataFrame:
    return graph.fields_of(_records(spark, sf_dir, only))


_NUMBER = "CASE kind WHEN 'purchase_order' THEN 'PO-' ELSE 'INV-' END || number"
_OWNERS = "kind IN ('invoice', 'purchase_order')"


@query(_with("SELECT doc_id, filename, gstin AS value, substr(gstin, 3, 10) AS org, good_gstin AS validated FROM (SELECT *, path AS filename FROM b)"))
def gr_fields(spark, sf_dir):
    rows = _facts(spark, sf_dir, ["gstin"])
    return rows.select("doc_id", "filename", "value", graph.org_key(F.col("value")).alias("org"), "validated")


@query(_with("SELECT DISTINCT doc_id, substr(gstin, 3, 10) AS org FROM b WHERE good_gstin"))
def gr_mentions(spark, sf_dir):
    return graph.mentions(_facts(spark, sf_dir, ["gstin"]))


@query(_with("SELECT doc_id, ifsc, account AS number FROM b WHERE has_bank"))
def gr_accounts(spark, sf_dir):
    return graph.accounts(graph.fields_of(_found_once(spark, sf_dir, ["ifsc", "account_number"])))


@query(_with(f"""
, n AS (SELECT doc_id, kind, {_NUMBER} AS key FROM b)
SELECT a.doc_id AS src, c.doc_id AS dst, min(a.key) AS key FROM n a JOIN n c USING (key) WHERE a.kind = 'receipt' AND c.{_OWNERS} AND a.doc_id <> c.doc_id GROUP BY ALL""".replace(f"\n, n AS", ", n AS", 1).lstrip()))
def gr_references(spark, sf_dir):
    return graph.references(graph.fields_of(_found_once(spark, sf_dir, ["invoice_number"])))


@query(_with(f"""SELECT b.path AS filename, b.kind AS label, {_NUMBER} AS key FROM b WHERE NOT {_OWNERS} AND {_NUMBER} NOT IN (SELECT {_NUMBER} FROM b WHERE {_OWNERS})"""))
def gr_orphans(spark, sf_dir):
    return graph.orphans(graph.fields_of(_found_once(spark, sf_dir, ["invoice_number"])))


@query(_with(f"""SELECT * FROM (SELECT min(doc_id) OVER (PARTITION BY kind, number, amount) AS src, doc_id AS dst, kind || ' | ' || {_NUMBER} || ' | ' || amount AS key FROM b) x WHERE src <> dst"""))
def gr_duplicates(spark, sf_dir):
    return graph.duplicate_edges(_found_once(spark, sf_dir, ["invoice_number", "total_amount"]))


@query(_with("SELECT substr(gstin, 3, 10) AS org, count(DISTINCT doc_id) AS documents, list_sort(list(DISTINCT path)) AS files FROM b WHERE good_gstin GROUP BY 1"))
def gr_exposure(spark, sf_dir):
    return graph.exposure(_records(spark, sf_dir, ["gstin"]))


@query(_with("SELECT count(*) FILTER (WHERE NOT good_gstin) AS unverified FROM b"))
def gr_unverified(spark, sf_dir):
    return graph.unverified(_facts(spark, sf_dir, ["gstin"]))


# Evaluation ------------------------------------------------------------------------------------

_PAIRS_SQL = "SELECT l_orderkey * 10 + l_linenumber AS ord, l_returnflag AS truth, CASE WHEN l_tax > 0.06 THEN 'unknown' WHEN l_discount > 0.07 THEN 'R' ELSE l_returnflag END AS got, l_discount AS confidence FROM lineitem"


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS ord", "l_returnflag AS truth", "CASE WHEN l_tax > 0.06 THEN 'unknown' WHEN l_discount > 0.07 THEN 'R' ELSE l_returnflag END AS got", "l_discount AS confidence")


_LABEL_SQL = f"""
p AS ({_PAIRS_SQL}), e AS (
  SELECT truth AS label, CASE WHEN got = truth THEN 1 ELSE 0 END AS tp, 0 AS fp, CASE WHEN got <> truth THEN 1 ELSE 0 END AS fn FROM p
  UNION ALL SELECT got, 0, 1, 0 FROM p WHERE got <> truth AND got <> 'unknown'),
s AS (SELECT label, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn FROM e GROUP BY 1),
l AS (SELECT *, round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1 FROM s)"""


@query(f"WITH {_LABEL_SQL} SELECT * FROM l")
def ev_per_label(spark, sf_dir):
    return evaluate.per_label(_pairs(spark, sf_dir))


@query(f"""WITH {_LABEL_SQL}, t AS (SELECT count(*) AS n, count(*) FILTER (WHERE got <> 'unknown') AS a, count(*) FILTER (WHERE got = truth AND got <> 'unknown') AS r FROM p)
SELECT n, a AS answered, n - a AS abstained, round(a / n, 4) AS coverage, round(r / n, 4) AS accuracy_overall, round(r / a, 4) AS accuracy_when_answered, (SELECT round(avg(f1), 4) FROM l) AS macro_f1 FROM t""")
def ev_classification(spark, sf_dir):
    return evaluate.classification(_pairs(spark, sf_dir))


@query(f"WITH p AS ({_PAIRS_SQL}) SELECT truth, got, count(*) AS n FROM p WHERE truth <> got GROUP BY ALL ORDER BY n DESC, truth, got LIMIT 10")
def ev_confusion(spark, sf_dir):
    return evaluate.confusion(_pairs(spark, sf_dir))


@query(f"""
WITH p AS ({_PAIRS_SQL}), a AS (SELECT confidence, got = truth AS ok, row_number() OVER (ORDER BY confidence DESC, ord) AS i, sum(CASE WHEN got = truth THEN 1 ELSE 0 END) OVER (ORDER BY confidence DESC, ord) AS tp FROM p WHERE got <> 'unknown'),
t AS (SELECT unnest([0.01, 0.05, 0.10])::DOUBLE AS target)
SELECT target, round(coalesce(max(i) FILTER (WHERE 1 - tp / i <= target) / (SELECT count(*) FROM p), 0), 4) AS coverage, round(coalesce(max_by(confidence, i) FILTER (WHERE 1 - tp / i <= target), 1.0), 4) AS threshold FROM a, t GROUP BY 1""")
def ev_coverage_at_error(spark, sf_dir):
    return evaluate.coverage_at_error(_pairs(spark, sf_dir))


_ITEMS_G = "SELECT l_orderkey AS doc, l_returnflag AS field, cast(l_suppkey % 5 as {0}) AS value, cast(null as {0}) AS normalized_value, l_linenumber AS char_start, l_linenumber + 3 AS char_end FROM lineitem WHERE l_linenumber <= 4"
_ITEMS_P = "SELECT l_orderkey AS doc, l_returnflag AS field, cast(l_partkey % 5 as {0}) AS value, cast(l_suppkey % 5 as {0}) AS normalized_value, l_linenumber AS char_start, l_linenumber + 3 AS char_end, l_tax > 0.04 AS validated FROM lineitem WHERE l_linenumber >= 3"


def _items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    _t(spark, sf_dir, "lineitem").createOrReplaceTempView("quillon_lineitem")
    a, b = (x.format("string").replace("FROM lineitem", "FROM quillon_lineitem") for x in (_ITEMS_G, _ITEMS_P))
    return spark.sql(a), spark.sql(b)


def _set_sql(keys: str) -> str:
    return f"""
WITH g AS (SELECT DISTINCT doc, field, {keys}, 1 AS g FROM ({_ITEMS_G.format('varchar').replace('value,', 'value AS v,', 0)}) x), p AS (SELECT DISTINCT doc, field, {keys}, 1 AS p FROM ({_ITEMS_P.format('varchar')}) x {{where}}),
s AS (SELECT field, count(*) FILTER (WHERE g = 1 AND p = 1) AS tp, count(*) FILTER (WHERE g IS NULL) AS fp, count(*) FILTER (WHERE p IS NULL) AS fn FROM g FULL JOIN p USING (doc, field, {{using}}) GROUP BY 1)
SELECT *, round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1 FROM s"""


@query(_set_sql("coalesce(normalized_value, value) AS v").format(where="", using="v"))
def ev_metadata_values(spark, sf_dir):
    return evaluate.metadata_values(*_items(spark, sf_dir))


@query(_set_sql("char_start, char_end").format(where=f"WHERE doc IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber <= 4)", using="char_start, char_end"))
def ev_metadata_spans(spark, sf_dir):
    return evaluate.metadata_spans(*_items(spark, sf_dir))


@query(f"""
WITH g AS (SELECT DISTINCT doc, field, value AS v FROM ({_ITEMS_G.format('varchar')}) x), p AS (SELECT doc, field, normalized_value AS v FROM ({_ITEMS_P.format('varchar')}) x WHERE validated AND (doc, field) IN (SELECT doc, field FROM g))
SELECT count(*) FILTER (WHERE (doc, field, v) IN (SELECT doc, field, v FROM g)) AS "right", count(*) FILTER (WHERE (doc, field, v) NOT IN (SELECT doc, field, v FROM g)) AS wrong, round(count(*) FILTER (WHERE (doc, field, v) IN (SELECT doc, field, v FROM g)) / nullif(count(*), 0), 4) AS precision FROM p""")
def ev_validated_precision(spark, sf_dir):
    return evaluate.validated_precision(*_items(spark, sf_dir))


@query("""
WITH p AS (SELECT lower(c_mktsegment) AS ref, lower(substr(c_mktsegment, 2)) || c_nationkey % 3 AS hyp FROM customer)
SELECT count(*) AS scored, round(avg(levenshtein(ref, hyp) / greatest(length(ref), 1)), 4) AS cer, round(avg(CASE WHEN ref = hyp THEN 0 ELSE 1 END), 4)::DOUBLE AS wer FROM p""")
def ev_extraction(spark, sf_dir):
    return evaluate.extraction(_t(spark, sf_dir, "customer").selectExpr("lower(c_mktsegment) AS ref", "concat(lower(substring(c_mktsegment, 2)), c_nationkey % 3) AS hyp"))


_CELLS = "SELECT l_orderkey AS doc, 0 AS tbl, l_linenumber AS row, cast(l_suppkey % 3 as int) AS col, CASE WHEN l_tax = 0 THEN '' ELSE l_returnflag || l_linestatus END AS text FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_returnflag, l_linestatus, l_tax) AS k FROM {0}) z WHERE k = 1"


@query(f"""
WITH f AS (SELECT doc, tbl, row, col, lower(text) AS a FROM ({_CELLS.format('lineitem')}) c WHERE text <> ''),
n AS (SELECT doc, a, lead(a) OVER (PARTITION BY doc, tbl, row ORDER BY col) AS b, 'h' AS way FROM f UNION ALL SELECT doc, a, lead(a) OVER (PARTITION BY doc, tbl, col ORDER BY row), 'v' FROM f)
SELECT doc, a, b, way FROM n WHERE b IS NOT NULL""")
def ev_adjacency(spark, sf_dir):
    _t(spark, sf_dir, "lineitem").createOrReplaceTempView("quillon_lineitem")
    return evaluate.adjacency(spark.sql(_CELLS.format("quillon_lineitem")))


@query(f"""
WITH a AS (SELECT lower(text) AS v, count(*) AS g FROM ({_CELLS.format('lineitem')}) c GROUP BY 1), b AS (SELECT lower(text) AS v, count(*) AS p FROM ({_CELLS.format('lineitem')}) c WHERE doc % 3 <> 0 GROUP BY 1),
s AS (SELECT sum(least(coalesce(g, 0), coalesce(p, 0)))::BIGINT AS tp, sum(coalesce(p, 0))::BIGINT AS np, sum(coalesce(g, 0))::BIGINT AS ng FROM a FULL JOIN b USING (v))
SELECT tp, np - tp AS fp, ng - tp AS fn, round(tp / np, 4) AS precision, round(tp / ng, 4) AS recall, round(2 * tp / (np + ng), 4) AS f1 FROM s""")
def ev_bag_scores(spark, sf_dir):
    _t(spark, sf_dir, "lineitem").createOrReplaceTempView("quillon_lineitem")
    cells = spark.sql(_CELLS.format("quillon_lineitem")).withColumn("v", evaluate.cell_norm(F.col("text")))
    return evaluate.bag_scores(cells, cells.where("doc % 3 <> 0"), ["v"])


@query(f"""
WITH {_LABEL_SQL}, m AS (SELECT label, f1, CASE WHEN label = 'N' THEN f1 / 2 ELSE f1 END AS f2 FROM l WHERE label <> 'A')
SELECT l.label, l.f1 AS f1_a, coalesce(m.f2, 0) AS f1_b, round(coalesce(m.f2, 0) - l.f1, 4) AS delta, round(coalesce(m.f2, 0) - l.f1, 4) < 0 AS regressed FROM l LEFT JOIN m ON l.label = m.label""")
def ev_compare(spark, sf_dir):
    a = evaluate.per_label(_pairs(spark, sf_dir))
    b = a.where("label <> 'A'").withColumn("f1", F.when(F.col("label") == "N", F.col("f1") / 2).otherwise(F.col("f1")))
    return evaluate.compare(a, b, "label")


@query("""
WITH p AS (SELECT p_partkey AS n, 'x/part' || p_partkey % 50 || '.pdf' AS path FROM part), g AS (SELECT s_suppkey AS n, 'part' || s_suppkey % 60 || '.pdf' AS path FROM supplier)
SELECT g.n AS gold_n, min(p.n) AS pred_n FROM g JOIN p ON g.path = split_part(p.path, '/', 2) GROUP BY 1""")
def ev_match(spark, sf_dir):
    pred = _t(spark, sf_dir, "part").selectExpr("p_partkey AS pred_n", "concat('x/part', p_partkey % 50, '.pdf') AS path")
    gold = _t(spark, sf_dir, "supplier").selectExpr("s_suppkey AS gold_n", "concat('part', s_suppkey % 60, '.pdf') AS path")
    return evaluate.match(gold, pred)


# Tables --------------------------------------------------------------------------------------


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page, text, page_start): a fixed-width listing of each order's lines."""
    row = F.concat(F.rpad(F.concat(F.lit("Item "), F.chr(F.col("l_linenumber") + 64)), 12, " "), F.lpad(F.col("l_quantity").cast("int").cast("string"), 4, " "), F.lit("   "), F.lpad(F.format_string("%.2f", "l_extendedprice"), 12, " "))
    lines = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", row.alias("t")))).alias("x"))
    head = F.concat(F.rpad(F.lit("Description"), 12, " "), F.lit(" Qty"), F.lit("   "), F.lpad(F.lit("Amount"), 12, " "))
    text = F.array_join(F.concat(F.array(F.lit("Statement"), F.lit(""), head), F.transform("x", lambda e: e["t"])), "\n")
    return lines.select(F.lpad(F.hex("l_orderkey"), 16, "0").alias("doc_id"), F.lit(0).alias("page"), text.alias("text"), F.lit(0).alias("page_start"))


@query("SELECT lpad(hex(l_orderkey), 16, '0') AS doc_id, CAST(count(*) + 1 AS INTEGER) AS n_rows, 3 AS n_cols, CAST((count(*) + 1) * 3 AS BIGINT) AS cells, true AS has_header FROM lineitem GROUP BY 1")
def tbl_text_grid(spark, sf_dir):
    from pyspark.sql import Window as W

    # A row per table, so that the cells are found once; then what is largest of a document's.
    found, own = tables.sizes(tables.text_grid(_grid(spark, sf_dir))), W.partitionBy("doc_id")
    of = {"n_rows": F.max("n_rows").over(own), "n_cols": F.max("n_cols").over(own), "cells": F.sum("cells").over(own)}
    return found.withColumns(of).where("has_header is not null").select("doc_id", "n_rows", "n_cols", "cells", "has_header")


@query("""
WITH p AS (SELECT p_partkey, rpad(p_brand, 12, ' ') || lpad(cast(p_size as varchar), 4, ' ') AS a FROM part)
SELECT p_partkey, len(list_filter(range(1, 17), lambda i: substr(a, i, 1) = ' ')) AS blanks FROM p""")
def tbl_blank_runs(spark, sf_dir):
    rows = _t(spark, sf_dir, "part").selectExpr("p_partkey", "concat(rpad(p_brand, 12, ' '), lpad(cast(p_size as string), 4, ' ')) AS a")
    runs = tables.blank_runs(F.array("a", "a"), 1)
    return rows.select("p_partkey", F.aggregate(runs, F.lit(0), lambda s, r: s + r["end"] - r["start"]).cast("long").alias("blanks"))


@query("""
WITH w AS (SELECT l_orderkey AS doc, l_linenumber * 10 AS s, l_linenumber * 10 + 4 AS e, l_quantity AS x FROM lineitem), c AS (SELECT o_orderkey AS doc, 10 AS s, 35 AS e FROM orders)
SELECT lpad(hex(c.doc), 16, '0') AS doc_id, min(x) AS x0, max(x + 1) AS x1 FROM c LEFT JOIN w ON c.doc = w.doc AND w.s >= c.s AND w.e <= c.e GROUP BY 1""")
def tbl_attach_boxes(spark, sf_dir):
    key = lambda c: F.lpad(F.hex(c), 16, "0").alias("doc_id")
    words = _t(spark, sf_dir, "lineitem").select(key("l_orderkey"), (F.col("l_linenumber") * 10).alias("char_start"), (F.col("l_linenumber") * 10 + 4).alias("char_end"), F.col("l_quantity").alias("x0"), F.lit(0.0).alias("y0"), (F.col("l_quantity") + 1).alias("x1"), F.lit(1.0).alias("y1"))
    none = F.lit(None).cast("double")
    cells = _t(spark, sf_dir, "orders").select(key("o_orderkey"), F.lit(0).alias("tbl"), F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit(10).alias("char_start"), F.lit(35).alias("char_end"), *[none.alias(c) for c in ("x0", "y0", "x1", "y1")])
    return tables.attach_boxes(cells, words).select("doc_id", "x0", "x1")


@query("""
WITH l AS (SELECT doc_id, 0 AS page, unnest(range(1, len(x) + 1)) - 1 AS n, unnest(x) AS line FROM (SELECT doc_id, string_split(replace(text, '. ', '.' || chr(10) || chr(10)), chr(10)) AS x FROM documents)),
f AS (SELECT *, n - row_number() OVER (PARTITION BY doc_id ORDER BY n) AS g FROM l WHERE regexp_matches(line, '\\S'))
SELECT doc_id, page, CAST(min(n) AS INTEGER) AS first, count(*) AS n_lines FROM f GROUP BY doc_id, page, g HAVING count(*) >= 2""")
def tbl_text_bands(spark, sf_dir):
    pages = _t(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("page"), F.replace("text", F.lit(". "), F.lit(".\n\n")).alias("text"))
    return tables.text_bands(pages).select("doc_id", "page", "first", F.size("lines").cast("long").alias("n_lines"))


# Labels and review ------------------------------------------------------------------------------


@query("""
WITH l AS (SELECT s_suppkey, 'f' || s_suppkey % 40 || '.pdf' AS name, ['Invoice', 'Legal Opinions', 'Nothing known', 'tax document'][CAST(s_suppkey % 4 AS INT) + 1] AS label FROM supplier),
f AS (SELECT 'd' || n_regionkey || '/f' || n_nationkey || '.pdf' AS path, 'f' || n_nationkey || '.pdf' AS base FROM nation)
SELECT l.name, l.label, CASE l.label WHEN 'Invoice' THEN 'invoice' WHEN 'Legal Opinions' THEN 'court_document' WHEN 'tax document' THEN 'tax_form' END AS class, CASE l.label WHEN 'Invoice' THEN false WHEN 'Nothing known' THEN NULL ELSE true END AS lossy, f.path,
       CASE WHEN l.label = 'Nothing known' THEN 'unknown label' WHEN f.path IS NULL THEN 'missing file' END AS problem
FROM l LEFT JOIN f ON l.name = f.base""")
def lbl_import(spark, sf_dir):
    labels = _t(spark, sf_dir, "supplier").selectExpr("concat('f', s_suppkey % 40, '.pdf') AS name", "element_at(array('Invoice', 'Legal Opinions', 'Nothing known', 'tax document'), cast(s_suppkey % 4 as int) + 1) AS label")
    files = _t(spark, sf_dir, "nation").selectExpr("concat('d', n_regionkey, '/f', n_nationkey, '.pdf') AS path")
    return review.import_labels(labels, files)


_TAB = "SELECT cast(o_orderkey as {0}) AS DOC_ID, CASE WHEN o_orderkey % 3 = 0 THEN 'invoice' ELSE 'receipt' END AS PREDICTED, CASE o_orderkey % 5 WHEN 0 THEN ' OK ' WHEN 1 THEN 'Incorrect' WHEN 2 THEN 'missing' WHEN 3 THEN 'spurious' ELSE '' END AS VERDICT, CASE WHEN o_orderkey % 7 = 0 THEN 'nonsense' WHEN o_orderkey % 7 = 1 THEN 'unknown' ELSE 'contract' END AS CORRECTED FROM {1}"


def _tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    _t(spark, sf_dir, "orders").createOrReplaceTempView("quillon_orders")
    return spark.sql(_TAB.format("string", "quillon_orders"))


@query(f"""
WITH t AS ({_TAB.format('varchar', 'orders')}), v AS (SELECT DOC_ID, CASE lower(trim(VERDICT)) WHEN 'ok' THEN PREDICTED WHEN 'incorrect' THEN CORRECTED WHEN 'missing' THEN CORRECTED END AS l FROM t)
SELECT DOC_ID AS doc_id, CASE WHEN l NOT IN ('nonsense', 'unknown') THEN l END AS label, l = 'unknown' AS confirmed_unknown, CASE WHEN l = 'nonsense' THEN 'undeclared class: nonsense' END AS problem FROM v WHERE l IS NOT NULL""")
def wb_gold_documents(spark, sf_dir):
    return review.gold_documents(_tab(spark, sf_dir))


@query(f"""
WITH o AS ({_TAB.format('varchar', 'orders')}), n AS (SELECT DOC_ID, CASE WHEN CAST(DOC_ID AS BIGINT) % 4 = 0 THEN 'contract' ELSE 'invoice' END AS PREDICTED FROM o),
j AS (SELECT n.DOC_ID, n.PREDICTED, lower(trim(o.VERDICT)) AS v, o.CORRECTED AS c, o.PREDICTED AS p FROM n JOIN o USING (DOC_ID))
SELECT DOC_ID, PREDICTED, CASE WHEN v IN ('incorrect', 'missing') AND c = PREDICTED OR v = 'ok' AND p = PREDICTED THEN 'ok' WHEN v = 'incorrect' THEN 'wrong' WHEN v = 'missing' THEN 'missing' ELSE '' END AS VERDICT,
       CASE WHEN v IN ('incorrect', 'missing') AND c <> PREDICTED THEN c ELSE '' END AS CORRECTED FROM j""")
def wb_carry_documents(spark, sf_dir):
    old = _tab(spark, sf_dir)
    new = old.select("DOC_ID", F.when(F.col("DOC_ID").cast("long") % 4 == 0, "contract").otherwise("invoice").alias("PREDICTED"), F.lit("").alias("VERDICT"), F.lit("").alias("CORRECTED"))
    return review.carry_documents(new, old)


@query("""
WITH o AS (SELECT DISTINCT cast(l_orderkey as varchar) AS d, l_shipmode_ AS t FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode_ FROM lineitem) WHERE l_linenumber % 2 = 0 AND l_quantity > 10),
n AS (SELECT DISTINCT cast(l_orderkey as varchar) AS d, l_returnflag || l_linestatus AS t FROM lineitem WHERE l_linenumber % 2 = 1)
SELECT d AS "DOC_ID", t AS "TAG", 'missing' AS "VERDICT" FROM o WHERE (d, t) NOT IN (SELECT d, t FROM n)""")
def wb_rescue_tags(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("DOC_ID"), F.concat("l_returnflag", "l_linestatus").alias("TAG"), "l_linenumber", "l_quantity")
    old = rows.where("l_linenumber % 2 = 0").withColumn("VERDICT", F.when(F.col("l_quantity") > 10, "ok").otherwise("spurious"))
    return review.rescued_tags(rows.where("l_linenumber % 2 = 1"), old)


@query("""
WITH t AS (SELECT l_orderkey AS sheet, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS row, CASE WHEN l_linenumber = 1 THEN 'D' || l_orderkey ELSE '' END AS d, l_returnflag AS v FROM lineitem)
SELECT sheet, row, last_value(nullif(d, '') IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY row) AS "DOC_ID", v AS "VALUE" FROM t""")
def src_fill_down(spark, sf_dir):
    from pyspark.sql import Window as W

    rows = _t(spark, sf_dir, "lineitem").withColumn("row", F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")))
    tab = rows.select(F.col("l_orderkey").alias("sheet"), "row", F.when(F.col("l_linenumber") == 1, F.concat(F.lit("D"), "l_orderkey")).otherwise("").alias("doc_id"), F.col("l_returnflag").alias("value"))
    return review.fill_down(tab)


@query(_with("""
SELECT doc_id, o_orderkey || '.txt' AS filename, kind AS label, CASE kind WHEN 'receipt' THEN 0.94 ELSE 0.95 END::DOUBLE AS confidence, CASE WHEN has_bank THEN 8 ELSE 7 END AS n_fields,
       CASE WHEN good_gstin THEN 'gst_applicable,bank_details_present' ELSE 'bank_details_present,gst_applicable' END || CASE WHEN kind = 'receipt' THEN ',payment_made' ELSE '' END AS tags FROM b"""))
def run_records(spark, sf_dir):
    from quillon.plans.process import records

    b = business.rendered(spark, sf_dir)
    docs = b.select("doc_id", "path", "pages", F.array(F.lit("native")).alias("page_methods"), F.array(F.lit(0.98)).alias("page_confidences"), F.array().cast("array<string>").alias("errors"))
    return records(docs).select("doc_id", "filename", "classification.label", "classification.confidence", F.size("metadata").alias("n_fields"), F.array_join(F.transform("tags", lambda t: t["tag"]), ",").alias("tags"))
