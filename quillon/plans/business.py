"""Business documents rendered from orders, for queries and tests; the same in Spark and in SQL.

One document per order: invoices, receipts that cite one, and purchase orders. Every
seventh GSTIN has a wrong check digit, every fifth document no bank code, and every
eleventh invoice repeats the number and total of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.validators import gstin_digit
from quillon.store import spread

#: Rendered in both dialects: everything but the dates, numbers and check digit.
_HEAD = "'27AB' || chr(cast({0} % 26 + 65 as int)) || 'C' || chr(cast({0} % 7 + 65 as int)) || lpad(cast({0} % 10000 as {1}), 4, '0') || chr(cast({0} % 25 + 65 as int)) || '1Z'"
_TEXT = """
CASE kind WHEN 'receipt' THEN 'PAYMENT RECEIPT' WHEN 'purchase_order' THEN 'PURCHASE ORDER' ELSE 'TAX INVOICE' END || chr(10)
|| CASE kind WHEN 'purchase_order' THEN 'PO Number: PO-' ELSE 'Invoice No: INV-' END || number || chr(10)
|| 'Invoice Date: ' || day || chr(10)
|| 'Sold By: Acme Trading Company' || chr(10)
|| 'GSTIN: ' || gstin || chr(10)
|| CASE WHEN has_bank THEN 'IFSC: ' || ifsc || chr(10) ELSE '' END
|| 'Account Number: ' || account || chr(10)
|| CASE WHEN o_orderkey % 2 = 0 THEN 'Terms: payment within thirty days of the date of this document, by bank transfer' || chr(10) ELSE '' END
|| 'Bill To: Customer' || chr(10)
|| CASE kind WHEN 'receipt' THEN 'Received with thanks, amount paid: INR ' ELSE 'Grand Total: INR ' END || amount || chr(10)
"""
_KIND = "CASE WHEN o_orderkey % 5 = 3 THEN 'receipt' WHEN o_orderkey % 5 = 4 THEN 'purchase_order' ELSE 'invoice' END"
_NUMBER = "CASE WHEN o_orderkey % 5 = 3 THEN o_orderkey - 2 WHEN o_orderkey % 11 = 0 AND o_orderkey > 0 THEN o_orderkey - 1 ELSE o_orderkey END"


def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, path, kind, number, day, gstin, good_gstin, ifsc, has_bank, account, amount, full, pages)."""
    orders = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"), "o_orderkey")
    rows = orders.selectExpr(
        "o_orderkey", f"{_KIND} AS kind", f"lpad(cast({_NUMBER} as string), 8, '0') AS number", "date_format(o_orderdate, 'dd/MM/yyyy') AS day", _HEAD.format("o_custkey", "string") + " AS head",
        "o_orderkey % 7 <> 0 AS good_gstin", "'HDFC0' || lpad(cast(o_custkey % 1000 as string), 6, '0') AS ifsc", "o_orderkey % 5 <> 1 AS has_bank", "lpad(cast(o_custkey as string), 11, '3') AS account",
        "cast(cast(round(CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 11 = 10 THEN 100 ELSE o_totalprice END, 2) as decimal(18,2)) as string) AS amount",
    )
    digit = gstin_digit(F.col("head"))
    wrong = F.when(digit == "0", "A").otherwise("0")
    rows = rows.withColumn("gstin", F.concat("head", F.when(F.col("good_gstin"), digit).otherwise(wrong)))
    text = rows.withColumn("full", F.expr(_TEXT)).withColumn("pages", F.array("full"))
    return text.withColumns({"doc_id": F.lpad(F.hex("o_orderkey"), 16, "0"), "path": F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string"), F.lit(".txt"))}).drop("head")


def sql() -> str:
    """CTE ``b`` of the same rows for DuckDB; follow it with a comma or a SELECT."""
    return f"""
b0 AS (
  SELECT o_orderkey, {_KIND} AS kind, lpad(cast({_NUMBER} as varchar), 8, '0') AS number, strftime(o_orderdate, '%d/%m/%Y') AS day, {_HEAD.format("o_custkey", "varchar")} AS head,
         o_orderkey % 7 <> 0 AS good_gstin, 'HDFC0' || lpad(cast(o_custkey % 1000 as varchar), 6, '0') AS ifsc, o_orderkey % 5 <> 1 AS has_bank, lpad(cast(o_custkey as varchar), 11, '3') AS account,
         cast(cast(round(CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 11 = 10 THEN 100 ELSE o_totalprice END, 2) as decimal(18,2)) as varchar) AS amount
  FROM orders
), b1 AS (
  SELECT *, list_sum(list_transform(range(1, 15), lambda i: (CASE WHEN i % 2 = 0 THEN 2 ELSE 1 END) * (strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substr(head, i, 1)) - 1) // 36 + (CASE WHEN i % 2 = 0 THEN 2 ELSE 1 END) * (strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substr(head, i, 1)) - 1) % 36)) AS total FROM b0
), b2 AS (
  SELECT *, substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', cast((36 - total % 36) % 36 + 1 as bigint), 1) AS digit FROM b1
), b3 AS (
  SELECT *, head || CASE WHEN good_gstin THEN digit WHEN digit = '0' THEN 'A' ELSE '0' END AS gstin FROM b2
), b AS (
  SELECT *, {_TEXT} AS full_text, lpad(hex(o_orderkey), 16, '0') AS doc_id, 'orders/' || o_orderkey || '.txt' AS path FROM b3
)"""
