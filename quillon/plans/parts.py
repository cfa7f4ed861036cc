"""Queries of the parts that the main catalogue only reaches through larger ones, and SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import quality
from quillon.operators import evaluate, fields, graph, profile, review, tables
from quillon.plans import business
from quillon.plans.queries import _CELLS, _NUMBER, _OWNERS, _PAIRS_SQL, _found_once, _grid, _pairs, _records, _t, _with, query
from quillon.sources import documents as sources
from quillon.store import fresh_path, spread

_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_KEYS = _KEY.split(", ")


# Quality of pages ------------------------------------------------------------------


@query(f"""
WITH t AS (SELECT {_KEY}, l_quantity * 2 >= 40 AND l_discount >= 0.02 AS suspect, l_linenumber % 3 <> 2 AS blank,
  l_suppkey % 5 = 0 AS no_ocr, l_suppkey % 7 = 0 AS no_native, l_linenumber % 2 = 0 AS bad_native, l_partkey % 3 = 0 AS bad_ocr FROM lineitem)
SELECT {_KEY}, suspect, blank, CASE WHEN no_ocr THEN false WHEN no_native THEN true ELSE bad_native AND NOT bad_ocr END AS prefer FROM t""")
def dq_page_choices(spark, sf_dir):
    good, bad = F.lit("the invoice total is due"), F.lit("the lnvo1ce t0tal is due")
    native = F.when(F.col("l_suppkey") % 7 == 0, " \t").when(F.col("l_linenumber") % 2 == 0, bad).otherwise(good)
    ocr = F.when(F.col("l_suppkey") % 5 == 0, "").when(F.col("l_partkey") % 3 == 0, bad).otherwise(good)
    found = F.struct((F.col("l_quantity") * 2).alias("tokens"), F.col("l_discount").alias("score"))
    text = F.when(F.col("l_linenumber") % 3 == 0, " \t\n").when(F.col("l_linenumber") % 3 == 1, F.lit(None)).otherwise(F.col("l_returnflag"))
    return spread(_t(spark, sf_dir, "lineitem").select(*_KEYS, "l_quantity", "l_discount", "l_returnflag"), "l_orderkey").select(*_KEYS, quality.is_suspect(found).alias("suspect"), quality.blank(text).alias("blank"), quality.prefer_ocr(native, ocr).alias("prefer"))


@query("SELECT l_orderkey, round(sum(CASE WHEN l_linenumber = 4 THEN 0 ELSE l_tax / 3 + 0.00071 END * l_linenumber) / sum(l_linenumber), 4) AS confidence FROM lineitem GROUP BY 1")
def dq_ocr_confidence(spark, sf_dir):
    word = F.struct(F.expr("repeat('x', l_linenumber)").alias("text"), F.when(F.col("l_linenumber") != 4, F.col("l_tax") / 3 + 0.00071).alias("conf"))
    return _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(word).alias("w")).select("l_orderkey", quality.ocr_confidence(F.col("w")).alias("confidence"))


@query(_with("SELECT 'gstin' AS field, count(*) AS documents, count(*) FILTER (WHERE good_gstin) AS validated FROM b"))
def pro_field_hits(spark, sf_dir):
    return profile.field_hits(_records(spark, sf_dir, ["gstin"]))


# Sources and sinks -----------------------------------------------------------------------


@query("""
SELECT lpad(hex(l_orderkey), 16, '0') AS doc_id, l_linenumber AS page, CAST(l_partkey % 50 + 100 * l_linenumber AS BIGINT) AS char_start, CAST(l_partkey % 50 + 3 + 100 * l_linenumber AS BIGINT) AS char_end, l_quantity / 2.5 AS x0, (l_quantity + 4) / 2.5 AS x1 FROM lineitem""")
def src_canonical_offsets(spark, sf_dir):
    key = F.lpad(F.hex("l_orderkey"), 16, "0").alias("doc_id")
    rows = _t(spark, sf_dir, "lineitem")
    words = rows.select(key, F.col("l_linenumber").alias("page"), (F.col("l_partkey") % 50).alias("char_start"), (F.col("l_partkey") % 50 + 3).alias("char_end"), F.col("l_quantity").alias("x0"), F.lit(0.0).alias("y0"), (F.col("l_quantity") + 4).alias("x1"), F.lit(1.0).alias("y1"))
    spans = rows.select(key, F.col("l_linenumber").alias("page"), (F.col("l_linenumber") * 100).alias("start")).distinct()
    placed = sources.rescale(sources.canonical_offsets(words, spans), F.lit(2.5))
    return placed.select("doc_id", "page", F.col("char_start").cast("long").alias("char_start"), F.col("char_end").cast("long").alias("char_end"), "x0", "x1")


@query(_with("SELECT doc_id, path AS filename, kind AS label, 0.95::DOUBLE AS confidence, gstin AS value, good_gstin AS validated FROM b"))
def src_records_round_trip(spark, sf_dir):
    path = fresh_path(spark, "records")
    sources.write_records(_records(spark, sf_dir, ["gstin"]), path)
    rows = sources.read_jsonl(spark, path)
    return rows.select("doc_id", "filename", "classification.label", "classification.confidence", F.explode("metadata").alias("m")).select("doc_id", "filename", "label", "confidence", F.col("m.normalized_value").alias("value"), "m.validated")


@query("SELECT 's' || s_suppkey || '.pdf' AS name, s_name AS label FROM supplier")
def src_label_csv(spark, sf_dir):
    path = fresh_path(spark, "labels")
    _t(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey", F.lit(".pdf")).alias("File_Name"), F.col("s_name").alias("Document_Type")).write.option("header", True).csv(path)
    return sources.read_label_csv(spark, path)


@query("SELECT '{\"a\": ' || p_partkey AS line FROM part WHERE p_partkey % 5 = 0")
def src_bad_lines(spark, sf_dir):
    path = fresh_path(spark, "lines")
    text = F.when(F.col("p_partkey") % 7 == 0, " ").otherwise(F.concat(F.lit('{"a": '), "p_partkey", F.lit("}")))
    rows = _t(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit('{"a": '), "p_partkey")).otherwise(text).alias("value"))
    rows.write.text(path)
    return sources.bad_lines(spark, path)


@query("SELECT cast(s_suppkey as varchar) AS doc_id, 'p/' || s_suppkey AS path, s_name AS label, s_name || '|' || s_nationkey AS tags, 'text of ' || s_name AS text FROM supplier")
def src_annotations(spark, sf_dir):
    path = fresh_path(spark, "annotations")
    _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("doc_id"), F.concat(F.lit("p/"), "s_suppkey").alias("path"), F.col("s_name").alias("label"), F.array("s_name", F.col("s_nationkey").cast("string")).alias("tags"), F.concat(F.lit("text of "), "s_name").alias("text")).write.json(path)
    return sources.read_annotations(spark, path).withColumn("tags", F.array_join("tags", "|"))


@query("""
SELECT o_orderkey AS doc_id, count(l_orderkey) AS words, coalesce(string_agg(l_returnflag || l_linenumber, ' ' ORDER BY l_linenumber, l_partkey, l_returnflag || l_linenumber, l_quantity), '') AS texts
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber < 3 GROUP BY 1""")
def src_read_words(spark, sf_dir):
    words = _t(spark, sf_dir, "lineitem").where("l_linenumber < 3").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), F.col("l_partkey").alias("char_start"), F.concat("l_returnflag", "l_linenumber").alias("text"), F.col("l_quantity").alias("x0"), *[F.lit(0.0).alias(c) for c in ("y0", "x1", "y1")])
    docs = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))
    return sources.read_words(words, docs).select("doc_id", F.size("words").cast("long").alias("words"), F.array_join(F.transform("words", lambda w: w["text"]), " ").alias("texts"))


# Fields ------------------------------------------------------------------------------------


@query("""
WITH w AS (SELECT l_orderkey AS d, l_linenumber * 4 AS s, l_linenumber * 4 + 3 AS e FROM lineitem WHERE l_quantity / 50 BETWEEN 0.2 AND 0.6),
g AS (SELECT d, min(s) AS s, max(e) AS e FROM w GROUP BY 1)
SELECT o_orderkey AS doc_id, 'total' AS field, substr(repeat(o_orderpriority || o_orderkey, 9), s + 1, e - s) AS value, s AS "start", e AS "end", CASE WHEN o_orderkey % 2 = 0 THEN 0.9 ELSE 0.85 END::DOUBLE AS confidence FROM g JOIN orders ON d = o_orderkey""")
def fld_positional(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem")
    words = rows.select(F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("page"), (F.col("l_linenumber") * 4).alias("char_start"), (F.col("l_linenumber") * 4 + 3).alias("char_end"), F.col("l_quantity").alias("x0"), F.lit(1.0).alias("y0"))
    sizes = rows.select(F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("page"), F.lit(50.0).alias("w"), F.lit(10.0).alias("h")).distinct()
    docs = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.expr("repeat(concat(o_orderpriority, o_orderkey), 9)").alias("full"), F.when(F.col("o_orderkey") % 2 == 0, "even").otherwise("odd").alias("label"))
    region = {"total": {"region": [0.2, 0, 0.6, 1]}}
    return fields.positional_candidates(words, sizes, docs, [{"class": "even", "confidence": 0.9, "fields": region}, {"fields": region}])


# Graph -----------------------------------------------------------------------------------------

# Of a proven number 400 characters away or less, the nearest name wins if it is 60 nearer than the other.
_ROLES = """
d AS (SELECT *, strpos(full_text, 'GSTIN: ') + 6 - strpos(full_text, 'Acme Trading Company') + 1 AS dv, strpos(full_text, 'Bill To: ') + 9 - strpos(full_text, 'GSTIN: ') - 7 AS db FROM b WHERE good_gstin),
r AS (SELECT *, CASE WHEN dv <= db THEN 'issued_by' ELSE 'billed_to' END AS role, CASE WHEN dv <= db THEN 'Acme Trading Company' ELSE 'Customer' END AS name, least(dv, db) AS distance FROM d WHERE abs(dv - db) >= 60)"""


@query(_with(f", {_ROLES} SELECT doc_id, role, substr(gstin, 3, 10) AS org, name, CAST(distance AS INTEGER) AS distance FROM r").replace(")\n,", "),", 1))
def gr_match_roles(spark, sf_dir):
    return graph.match_roles(graph.role_pairs(graph.fields_of(_found_once(spark, sf_dir, ["gstin", "vendor_name", "buyer_name"]))))


@query("""
WITH p AS (SELECT l_orderkey AS d, l_linenumber AS role, l_suppkey % 3 AS org, min(l_partkey % 900) AS x FROM lineitem WHERE l_linenumber <= 2 GROUP BY ALL),
one AS (SELECT d, role, org, x, count(*) OVER (PARTITION BY d) AS n FROM p),
two AS (SELECT a.d, a.role, a.org, a.x, b.role AS role2, b.org AS org2, b.x AS x2 FROM one a JOIN one b ON a.d = b.d AND (a.x, a.role, a.org) < (b.x, b.role, b.org) WHERE a.n = 2)
SELECT d AS doc_id, 'r' || role AS role, 'o' || org AS org, CAST(x AS INTEGER) AS distance FROM one WHERE n = 1
UNION ALL SELECT d, 'r' || role, 'o' || org, CAST(x AS INTEGER) FROM two WHERE NOT (org = org2 AND role <> role2 AND x2 - x < 60)
UNION ALL SELECT d, 'r' || role2, 'o' || org2, CAST(x2 AS INTEGER) FROM two WHERE org <> org2 AND role <> role2""")
def gr_role_choices(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").where("l_linenumber <= 2").groupBy(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("r"), "l_linenumber").alias("role"), F.concat(F.lit("o"), F.col("l_suppkey") % 3).alias("org")).agg(F.min(F.col("l_partkey") % 900).alias("distance"))
    few = rows.join(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n <= 2").select("doc_id"), "doc_id")
    pairs = few.select("doc_id", "role", F.lit("x").alias("name"), F.lit(0).alias("role_start"), "org", "distance")
    return graph.match_roles(pairs).select("doc_id", "role", "org", "distance")


_REFERENCES = f"SELECT DISTINCT a.doc_id AS src, c.doc_id AS dst FROM n a JOIN n c USING (key) WHERE a.kind = 'receipt' AND c.{_OWNERS} AND a.doc_id <> c.doc_id"
#: Members of a group of duplicates are linked with its first.
_DUPLICATES = f"SELECT doc_id AS dst, min(doc_id) OVER (PARTITION BY kind, number, amount) AS src, kind || ' | ' || {_NUMBER} || ' | ' || amount AS key FROM b"


@query(_with(f""", n AS (SELECT doc_id, kind, {_NUMBER} AS key FROM b), {_ROLES},
e AS (SELECT 'mentions_org' AS type FROM b WHERE good_gstin UNION ALL SELECT role FROM r UNION ALL SELECT 'pays_to' FROM b WHERE has_bank
  UNION ALL SELECT 'held_by' FROM (SELECT DISTINCT ifsc, account, substr(gstin, 3, 10) FROM b WHERE has_bank AND good_gstin) x
  UNION ALL SELECT 'references' FROM ({_REFERENCES}) y UNION ALL SELECT 'duplicate_of' FROM ({_DUPLICATES}) z WHERE src <> dst)
SELECT type, count(*) AS n FROM e GROUP BY 1""").replace(")\n,", "),", 1))
def gr_edge_counts(spark, sf_dir):
    from quillon.plans.queries import _GRAPH_FIELDS

    # Every kind of edge reads the records: they are found once.
    return graph.stats(graph.edges(_found_once(spark, sf_dir, _GRAPH_FIELDS)))


@query(_with(f""", {_ROLES},
g AS (SELECT substr(gstin, 3, 10) AS org, string_agg(DISTINCT gstin, '; ' ORDER BY gstin) AS numbers FROM b WHERE good_gstin GROUP BY 1), w AS (SELECT substr(gstin, 3, 10) AS org, string_agg(DISTINCT name, '; ' ORDER BY name) AS names FROM r GROUP BY 1)
SELECT 'doc:' || doc_id AS id, 'document' AS kind, path AS a, kind AS b FROM b
UNION ALL SELECT 'org:' || org, 'organization', numbers, coalesce(names, '') FROM g LEFT JOIN w USING (org)
UNION ALL SELECT DISTINCT 'acct:' || ifsc || ':' || account, 'account', account, ifsc FROM b WHERE has_bank""").replace(")\n,", "),", 1))
def gr_nodes(spark, sf_dir):
    found = graph.nodes(_found_once(spark, sf_dir, ["gstin", "ifsc", "account_number", "vendor_name", "buyer_name"]))
    value = lambda *names: F.coalesce(*[F.try_element_at("attrs", F.lit(n)) for n in names])
    return found.select("id", "kind", value("filename", "gstins", "number").alias("a"), value("label", "names", "ifsc").alias("b"))


@query(_with(f""", n AS (SELECT doc_id, path, kind, {_NUMBER} AS key FROM b)
SELECT a.path AS "from", a.kind AS from_class, c.path AS "to", c.kind AS to_class, a.key FROM n a JOIN n c USING (key) WHERE a.kind = 'receipt' AND c.{_OWNERS}""").replace(")\n,", "),", 1))
def gr_chains(spark, sf_dir):
    return graph.chains(_found_once(spark, sf_dir, ["invoice_number"]))


@query("""
SELECT 0 AS ord, 'digraph documents {' AS line UNION ALL SELECT 3, '}' UNION ALL SELECT 1, '  "n:' || n_nationkey || '" [class=nation];' FROM nation
UNION ALL SELECT 1, '  "r:' || r_regionkey || '" [class=region];' FROM region UNION ALL SELECT 2, '  "n:' || n_nationkey || '" -> "r:' || n_regionkey || '" [label="lies_in"];' FROM nation""")
def gr_dot(spark, sf_dir):
    nations, regions = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")
    a = nations.select(F.concat(F.lit("n:"), "n_nationkey").alias("id"), F.lit("nation").alias("kind"))
    b = regions.select(F.concat(F.lit("r:"), "r_regionkey").alias("id"), F.lit("region").alias("kind"))
    arrows = nations.select(F.concat(F.lit("n:"), "n_nationkey").alias("src"), F.concat(F.lit("r:"), "n_regionkey").alias("dst"), F.lit("lies_in").alias("type"))
    return graph.to_dot(a.unionAll(b), arrows)


@query("SELECT 'n:' || n_nationkey AS src, 'r:' || n_regionkey AS dst FROM nation WHERE n_regionkey = 2")
def gr_neighbours(spark, sf_dir):
    arrows = _t(spark, sf_dir, "nation").select(F.concat(F.lit("n:"), "n_nationkey").alias("src"), F.concat(F.lit("r:"), "n_regionkey").alias("dst"))
    return graph.neighbours(arrows, "r:2")


# Evaluation -----------------------------------------------------------------------------------------


@query(f"""
WITH p AS (SELECT ord, truth, got, 1 - confidence AS confidence FROM ({_PAIRS_SQL}) x), a AS (SELECT confidence, got = truth AS ok, row_number() OVER (ORDER BY confidence DESC, ord) AS i, sum(CASE WHEN got = truth THEN 1 ELSE 0 END) OVER (ORDER BY confidence DESC, ord ROWS UNBOUNDED PRECEDING) AS tp FROM p WHERE got <> 'unknown'),
t AS (SELECT unnest([0.01, 0.05, 0.10, 0.2])::DOUBLE AS target)
SELECT target, round(coalesce(max(i) FILTER (WHERE 1 - tp / i <= target) / (SELECT count(*) FROM p), 0), 4) AS coverage, round(coalesce(max_by(confidence, i) FILTER (WHERE 1 - tp / i <= target), 1.0), 4) AS threshold FROM a, t GROUP BY 1""")
def ev_coverage_by_target(spark, sf_dir):
    return evaluate.coverage_at_error(_pairs(spark, sf_dir).withColumn("confidence", 1 - F.col("confidence")), (0.01, 0.05, 0.10, 0.2))


@query("""
WITH t AS (SELECT c_custkey, substr('abcdefgh', 1 + c_nationkey % 4, 4) || chr(CAST(97 + c_custkey % 3 AS INTEGER)) AS ref, substr('abcdefgh', 1 + c_custkey % 5, 3) || substr('hgfedcba', 1 + c_nationkey % 3, c_custkey % 4) AS hyp FROM customer)
SELECT count(*) AS scored, round(avg(levenshtein(ref, hyp) / length(ref)), 4) AS wer FROM t""")
def ev_word_errors(spark, sf_dir):
    word = {c: f"word{i}" for i, c in enumerate("abcdefgh")}
    rows = _t(spark, sf_dir, "customer").selectExpr("concat(substr('abcdefgh', 1 + c_nationkey % 4, 4), chr(97 + c_custkey % 3)) AS ref", "concat(substr('abcdefgh', 1 + c_custkey % 5, 3), substr('hgfedcba', 1 + c_nationkey % 3, cast(c_custkey % 4 as int))) AS hyp")
    names = F.create_map(*[F.lit(v) for pair in word.items() for v in pair])
    said = lambda c: F.array_join(F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: names[x]), "  ")
    return evaluate.extraction(rows.select(said("ref").alias("ref"), said("hyp").alias("hyp"))).select("scored", "wer")


_TAGS_G = "SELECT DISTINCT l_orderkey AS doc, l_returnflag || l_linestatus AS tag FROM {0} WHERE l_linenumber <= 3"
_TAGS_P = "SELECT DISTINCT l_orderkey AS doc, l_returnflag || l_linestatus AS tag FROM {0} WHERE l_linenumber >= 2"


@query(f"""
WITH g AS ({_TAGS_G.format('lineitem')}), p AS ({_TAGS_P.format('lineitem')}), s AS (SELECT coalesce(g.tag, p.tag) AS tag, count(*) FILTER (WHERE g.tag IS NOT NULL AND p.tag IS NOT NULL) AS tp, count(*) FILTER (WHERE g.tag IS NULL) AS fp, count(*) FILTER (WHERE p.tag IS NULL) AS fn FROM g FULL JOIN p ON g.doc = p.doc AND g.tag = p.tag GROUP BY 1),
f AS (SELECT *, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1 FROM s), m AS (SELECT sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, round(avg(f1), 4) AS macro_f1 FROM f)
SELECT tp, fp, fn, round(tp / (tp + fp), 4) AS precision, round(tp / (tp + fn), 4) AS recall, round(2 * tp / (2 * tp + fp + fn), 4) AS f1, macro_f1 FROM m""")
def ev_tag_scores(spark, sf_dir):
    _t(spark, sf_dir, "lineitem").createOrReplaceTempView("quillon_lineitem")
    gold, pred = (spark.sql(x.format("quillon_lineitem")) for x in (_TAGS_G, _TAGS_P))
    return evaluate.micro(evaluate.set_scores(gold, pred, "tag", []))


@query(f"""
WITH c AS ({_CELLS.format('lineitem')}), g AS (SELECT doc, row % 2 AS tbl, lower(text) AS v, count(*) AS n FROM c WHERE text <> '' GROUP BY ALL), p AS (SELECT doc, col AS other, lower(text) AS v, count(*) AS m FROM c WHERE text <> '' AND row > 1 GROUP BY ALL),
s AS (SELECT doc, tbl, sum(n) AS size FROM g GROUP BY ALL), h AS (SELECT DISTINCT doc, tbl FROM (SELECT g.doc, g.tbl, other, sum(least(n, m)) AS both_ FROM g JOIN p ON g.doc = p.doc AND g.v = p.v GROUP BY ALL) x JOIN s USING (doc, tbl) WHERE both_ > size * 0.5),
a AS (SELECT DISTINCT doc, row % 2 AS tbl FROM c)
SELECT count(*) AS gold_tables, count(h.doc) AS detected, round(count(h.doc) / count(*), 4) AS recall FROM a LEFT JOIN h ON a.doc = h.doc AND a.tbl = h.tbl""")
def ev_table_detection(spark, sf_dir):
    _t(spark, sf_dir, "lineitem").createOrReplaceTempView("quillon_lineitem")
    cells = spark.sql(_CELLS.format("quillon_lineitem"))
    return evaluate.table_detection(cells.withColumn("tbl", F.col("row") % 2), cells.where("row > 1").withColumn("tbl", F.col("col")))


# Tables ------------------------------------------------------------------------------------------------


@query("""
SELECT lpad(hex(l_orderkey), 16, '0') AS doc_id, lpad(hex(l_orderkey), 16, '0') || '-p0-t0' AS table_id, 0 AS tbl, 0 AS page, CAST(count(*) + 1 AS INTEGER) AS n_rows, 3 AS n_cols, 'text_grid' AS method, 1.0::DOUBLE AS confidence,
       'Description|Qty|Amount' AS header, 11 AS char_start, CAST(11 + (count(*) + 1) * 32 - 1 AS INTEGER) AS char_end FROM lineitem GROUP BY l_orderkey""")
def tbl_assemble(spark, sf_dir):
    return tables.assemble(tables.text_grid(_grid(spark, sf_dir))).withColumn("header", F.array_join("header", "|"))


@query("SELECT 'text_grid' AS method, count(DISTINCT l_orderkey) AS documents, count(DISTINCT l_orderkey) AS tables, (count(*) + count(DISTINCT l_orderkey)) * 3 AS cells FROM lineitem")
def tbl_statistics(spark, sf_dir):
    return tables.statistics(tables.text_grid(_grid(spark, sf_dir)))


@query("""
WITH k AS (SELECT o_orderkey, 3 + o_orderkey % 3 AS a, 3 + o_custkey % 4 AS b FROM orders)
SELECT o_orderkey AS doc_id, 0 AS tbl, CAST(a AS INTEGER) AS n_rows, 3 AS n_cols, a * 3 AS cells, 0::BIGINT AS first FROM k
UNION ALL SELECT o_orderkey, 1, CAST(b AS INTEGER), 2, b * 2, a * 23 + 31 FROM k""")
def tbl_two_in_a_band(spark, sf_dir):
    """Two tables of different columns in one run of lines, with a line of prose between: the wider is found first, then the rest."""
    rows = spread(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey").selectExpr("cast(o_orderkey as string) AS doc_id", "cast(3 + o_orderkey % 3 as int) AS a", "cast(3 + o_custkey % 4 as int) AS b")
    wide, narrow, prose = "abcdef   ghij   klmnop", "qrs          tuvwxyz", "so much for these and now those"[:30].ljust(30, "x")
    text = F.array_join(F.concat(F.array_repeat(F.lit(wide), F.col("a")), F.array(F.lit(prose)), F.array_repeat(F.lit(narrow), F.col("b"))), "\n")
    found = tables.text_grid(rows.select("doc_id", F.lit(0).alias("page"), text.alias("text"), F.lit(0).alias("page_start"))).where("refused is null")
    out = found.groupBy("doc_id", "tbl").agg(F.max("n_rows").alias("n_rows"), F.max("n_cols").alias("n_cols"), F.count(F.lit(1)).alias("cells"), F.min("char_start").cast("long").alias("first"))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


@query("""
WITH l AS (SELECT DISTINCT l_orderkey AS d, l_linenumber AS n FROM lineitem), i AS (SELECT d, n, n - row_number() OVER (PARTITION BY d ORDER BY n) AS g, max(n) OVER (PARTITION BY d) AS m FROM l),
t AS (SELECT d, count(*) AS rows FROM i GROUP BY d, g HAVING count(*) >= 2)
SELECT 'geometry' AS method, count(DISTINCT d) AS documents, count(*) AS tables, CAST(sum(rows * 3) AS BIGINT) AS cells FROM t""")
def tbl_geometry(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem")
    y = F.col("l_linenumber") * 40.0
    # Three cells a line, of two words each; a line that is missing leaves a gap that ends the table.
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("x0"), F.lit(x + 20.0).alias("x1")) for k in range(3) for x in (10.0 + 100 * k, 34.0 + 100 * k)]))
    words = rows.select("l_orderkey", "l_linenumber").distinct().select(F.lpad(F.hex("l_orderkey"), 16, "0").alias("doc_id"), F.lit(0).alias("page"), y.alias("y0"), (y + 20).alias("y1"), each.alias("c"), F.lit("w").alias("text"))
    words = words.select("doc_id", "page", "text", "c.x0", "y0", "c.x1", "y1", F.lit(None).cast("int").alias("char_start"), F.lit(None).cast("int").alias("char_end"))
    docs = words.select("doc_id").distinct().withColumn("full", F.lit(""))
    return tables.statistics(tables.geometry(words, docs))


@query("SELECT cast(o_orderkey as varchar) AS doc_id, CASE WHEN o_orderkey % 2 = 0 THEN CAST(3 + o_orderkey % 3 AS INTEGER) END AS n_rows, CASE WHEN o_orderkey % 2 = 0 THEN (3 + o_orderkey % 3) * 3 ELSE 0 END AS cells, o_orderkey % 2 = 1 AS refused FROM orders")
def tbl_geometry_refusals(spark, sf_dir):
    """Even documents have columns that line up; in odd ones each line is moved to the right, and no grid may be read into them."""
    rows = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("doc_id"), (F.col("o_orderkey") % 2 * 45).alias("drift"), F.explode(F.sequence(F.lit(0), (F.col("o_orderkey") % 3 + 2).cast("int"))).alias("r"))
    each = F.explode(F.array(*[F.lit(100.0 * c + 24 * k) for c in range(3) for k in range(2)]))
    words = rows.select("doc_id", F.lit(0).alias("page"), (F.col("r") * 20.0).alias("y0"), (F.col("r") * 20.0 + 10).alias("y1"), each.alias("x"), (F.col("drift") * F.col("r")).alias("by"), F.lit("w").alias("text"))
    none = F.lit(None).cast("int")
    words = words.select("doc_id", "page", "text", (F.col("x") + F.col("by")).alias("x0"), "y0", (F.col("x") + F.col("by") + 20).alias("x1"), "y1", none.alias("char_start"), none.alias("char_end"))
    found = tables.geometry(words, rows.select("doc_id", F.lit("").alias("full")).distinct())
    return found.groupBy("doc_id").agg(F.max("n_rows").alias("n_rows"), F.count("row").alias("cells"), F.bool_or(F.col("refused").isNotNull()).alias("refused"))


# Labels and review ----------------------------------------------------------------------------------------


@query("SELECT 'f' || s_suppkey % 40 AS name, count(*) AS n, string_agg(DISTINCT cast(s_nationkey as varchar), ',' ORDER BY cast(s_nationkey as varchar)) AS labels FROM supplier GROUP BY 1 HAVING count(*) > 1")
def lbl_repeated_names(spark, sf_dir):
    rows = _t(spark, sf_dir, "supplier").select(F.concat(F.lit("f"), F.col("s_suppkey") % 40).alias("name"), F.col("s_nationkey").cast("string").alias("label"))
    return review.repeated_names(rows).withColumn("labels", F.array_join("labels", ","))


_REVIEW = """SELECT cast(l_orderkey as {0}) AS DOC_ID, 'f' || l_linenumber AS FIELD, 'v' || min(l_partkey) AS VALUE, CASE min(l_suppkey) % 5 WHEN 0 THEN 'OK' WHEN 1 THEN ' wrong' WHEN 2 THEN 'Missing' WHEN 3 THEN 'spurious' ELSE '' END AS VERDICT,
CASE WHEN min(l_suppkey) % 3 = 0 THEN '' ELSE 'c' || min(l_suppkey) END AS CORRECTED, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE cast(l_linenumber * 10 as {0}) END AS CHAR_START, cast(l_linenumber * 10 + 4 as {0}) AS CHAR_END FROM {1} GROUP BY l_orderkey, l_linenumber"""


def _reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    _t(spark, sf_dir, "lineitem").createOrReplaceTempView("quillon_lineitem")
    return spark.sql(_REVIEW.format("string", "quillon_lineitem"))


@query(f"""
WITH t AS ({_REVIEW.format('varchar', 'lineitem')}), v AS (SELECT *, lower(trim(VERDICT)) AS v FROM t), g AS (SELECT *, CASE WHEN v = 'ok' THEN VALUE WHEN v IN ('wrong', 'missing') THEN CORRECTED END AS value_ FROM v)
SELECT DOC_ID AS doc_id, FIELD AS field, value_ AS value, value_ AS normalized_value, CASE WHEN v = 'ok' AND CHAR_START <> '' THEN CAST(CHAR_START AS INTEGER) END AS char_start, CASE WHEN v = 'ok' AND CHAR_START <> '' THEN CAST(CHAR_END AS INTEGER) END AS char_end FROM g WHERE value_ <> ''""")
def wb_gold_fields(spark, sf_dir):
    return review.gold_fields(_reviewed(spark, sf_dir))


@query(f"WITH t AS ({_REVIEW.format('varchar', 'lineitem')}) SELECT DISTINCT DOC_ID AS doc_id, FIELD AS tag FROM t WHERE lower(trim(VERDICT)) IN ('ok', 'missing')")
def wb_gold_tags(spark, sf_dir):
    return review.gold_tags(_reviewed(spark, sf_dir).withColumnRenamed("FIELD", "TAG"))


@query(f"""
WITH t AS ({_REVIEW.format('varchar', 'lineitem')}), n AS (SELECT DOC_ID, FIELD, VALUE || CASE WHEN length(VALUE) % 2 = 0 THEN 'x' ELSE '' END AS VALUE FROM t), o AS (SELECT *, lower(trim(VERDICT)) AS v FROM t WHERE VERDICT <> '')
SELECT n.DOC_ID, n.FIELD, n.VALUE, CASE WHEN n.VALUE = o.VALUE THEN o.v WHEN o.v IN ('wrong', 'missing') AND o.CORRECTED <> '' THEN o.v ELSE '' END AS VERDICT, CASE WHEN n.VALUE = o.VALUE THEN o.CORRECTED WHEN o.v IN ('wrong', 'missing') THEN o.CORRECTED ELSE '' END AS CORRECTED
FROM n LEFT JOIN o ON n.DOC_ID = o.DOC_ID AND n.FIELD = o.FIELD WHERE o.DOC_ID IS NOT NULL UNION ALL SELECT DOC_ID, FIELD, VALUE, '', '' FROM n WHERE (DOC_ID, FIELD) NOT IN (SELECT DOC_ID, FIELD FROM o)""")
def wb_carry_fields(spark, sf_dir):
    old = _reviewed(spark, sf_dir)
    new = old.select("DOC_ID", "FIELD", F.concat("VALUE", F.when(F.char_length("VALUE") % 2 == 0, "x").otherwise("")).alias("VALUE"))
    return review.carry_fields(new, old).select("DOC_ID", "FIELD", "VALUE", "VERDICT", "CORRECTED")


@query(f"""
WITH t AS ({_REVIEW.format('varchar', 'lineitem')}), n AS (SELECT DOC_ID, 'f' || (CAST(substr(FIELD, 2) AS INT) + 1) AS TAG FROM t)
SELECT n.DOC_ID, n.TAG, coalesce(lower(trim(t.VERDICT)), '') AS VERDICT FROM n LEFT JOIN t ON n.DOC_ID = t.DOC_ID AND n.TAG = t.FIELD""")
def wb_carry_tags(spark, sf_dir):
    old = _reviewed(spark, sf_dir)
    new = old.select("DOC_ID", F.concat(F.lit("f"), F.substring("FIELD", 2, 9).cast("int") + 1).alias("TAG"))
    return review.carry_tags(new, old.withColumnRenamed("FIELD", "TAG")).select("DOC_ID", "TAG", "VERDICT")


@query(f"""
WITH t AS ({_REVIEW.format('varchar', 'lineitem')}), o AS (SELECT *, lower(trim(VERDICT)) AS v FROM t WHERE VERDICT <> '' AND lower(trim(VERDICT)) <> 'spurious'), n AS (SELECT DOC_ID, FIELD FROM t WHERE FIELD < 'f4')
SELECT DISTINCT DOC_ID, FIELD, '' AS VALUE, 'missing' AS VERDICT, CASE v WHEN 'ok' THEN VALUE ELSE CORRECTED END AS CORRECTED FROM o WHERE (v = 'ok' OR (DOC_ID, FIELD) NOT IN (SELECT DOC_ID, FIELD FROM n)) AND CASE v WHEN 'ok' THEN VALUE ELSE CORRECTED END <> ''""")
def wb_rescue_fields(spark, sf_dir):
    old = _reviewed(spark, sf_dir)
    new = old.where("FIELD < 'f4'").select("DOC_ID", "FIELD", F.concat("VALUE", F.lit("!")).alias("VALUE"))
    return review.rescued_fields(new, old)


@query(_with("SELECT doc_id AS \"DOC_ID\", path AS \"FILENAME\", kind AS \"PREDICTED\", 0.95::DOUBLE AS \"CONFIDENCE\", sha256(full_text) AS \"TEXT_SHA256\", length(full_text)::BIGINT AS \"CHAR_COUNT\", '' AS \"VERDICT\" FROM b"))
def wb_document_rows(spark, sf_dir):
    rows = business.rendered(spark, sf_dir).select(
        "doc_id", F.col("path").alias("filename"), F.col("path").alias("source_path"), F.struct(F.col("kind").alias("label"), F.lit(0.95).alias("confidence"), F.create_map("kind", F.lit(0.95), F.lit("other"), F.lit(0.1)).alias("all_scores"), F.lit("rule").alias("method")).alias("classification"),
        F.struct("full", F.lit("native").alias("method"), F.char_length("full").alias("char_count")).alias("text"),
    )
    return review.document_rows(rows).select("DOC_ID", "FILENAME", "PREDICTED", "CONFIDENCE", "TEXT_SHA256", F.col("CHAR_COUNT").cast("long").alias("CHAR_COUNT"), "VERDICT")


@query(_with("SELECT doc_id AS \"DOC_ID\", 'gstin' AS \"FIELD\", gstin AS \"NORMALIZED\", CAST(strpos(full_text, gstin) - 1 AS INTEGER) AS \"CHAR_START\", good_gstin AS \"VALIDATED\" FROM b"))
def wb_metadata_rows(spark, sf_dir):
    return review.metadata_rows(_records(spark, sf_dir, ["gstin"])).select("DOC_ID", "FIELD", "NORMALIZED", "CHAR_START", "VALIDATED")


@query("SELECT cast(l_orderkey as varchar) AS \"DOC_ID\", 't0' AS \"TABLE_ID\", l_linenumber AS \"ROW\", cast(l_suppkey % 3 as int) AS \"COL\", l_returnflag AS \"TEXT\", l_linenumber = 1 AS \"IS_HEADER\" FROM lineitem")
def wb_line_items(spark, sf_dir):
    cell = F.struct(F.col("l_linenumber").alias("row"), (F.col("l_suppkey") % 3).cast("int").alias("col"), F.col("l_returnflag").alias("text"), (F.col("l_linenumber") == 1).alias("is_header"))
    found = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("doc_id")).agg(F.array(F.struct(F.lit("t0").alias("table_id"), F.collect_list(cell).alias("cells"))).alias("tables"))
    return review.line_item_rows(found)
