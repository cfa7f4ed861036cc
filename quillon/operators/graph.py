"""The entity graph of documents, organisations and accounts, as a table of nodes and one of edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.config import Config, load


def org_key(value: Column) -> Column:
    """A GSTIN's PAN; any other value itself."""
    return F.when(F.char_length(value) == 15, F.substring(value, 3, 10)).otherwise(value)


def fields_of(records: DataFrame) -> DataFrame:
    """(doc_id, filename, label, field, value, char_start, validated): a row per field; rows without an id go.

    The class travels inside the exploded rows: later filters on it then apply to the
    rows, and are not pushed into the expressions that found it.
    """
    label = F.coalesce(F.col("classification.label"), F.lit("unknown"))
    each = F.transform("metadata", lambda m: F.struct(label.alias("label"), m["field"].alias("field"), m["normalized_value"].alias("value"), F.coalesce(m["char_start"], F.lit(0)).alias("char_start"), F.coalesce(m["validated"], F.lit(False)).alias("validated")))
    rows = records.where(F.coalesce(F.col("doc_id"), F.lit("")) != "").select("doc_id", "filename", F.explode_outer(each).alias("m"))
    return rows.where("m is not null").select("doc_id", "filename", "m.*")


def identities(fields: DataFrame) -> DataFrame:
    """(doc_id, org, value, char_start): per document and organisation its earliest proven number."""
    proven = fields.where("validated and field in ('gstin', 'pan') and value <> ''").withColumn("org", org_key(F.col("value")))
    first = F.min(F.struct("char_start", F.when(F.col("field") == "gstin", 0).otherwise(1).alias("o"), "value")).alias("x")
    return proven.groupBy("doc_id", "org").agg(first).select("doc_id", "org", "x.value", "x.char_start")


def unverified(fields: DataFrame) -> DataFrame:
    """(unverified): how many numbers were not proven and so not used."""
    return fields.agg(F.count_if(F.col("field").isin("gstin", "pan") & ~F.col("validated")).alias("unverified"))


def mentions(fields: DataFrame) -> DataFrame:
    """(doc_id, org) of proven organisations."""
    return identities(fields).select("doc_id", "org")


def role_pairs(fields: DataFrame, config: Config | None = None) -> DataFrame:
    """(doc_id, role, name, role_start, org, distance): labelled names near a proven number, joined by document."""
    options = (config or load()).settings["graph"]
    role = F.lit(None).cast("string")
    for edge, field in options["roles"].items():
        role = F.when(F.col("field") == field, edge).otherwise(role)
    named = fields.withColumn("role", role).where("role is not null").select("doc_id", "role", F.col("value").alias("name"), F.col("char_start").alias("role_start"))
    near = named.join(identities(fields).select("doc_id", "org", F.col("char_start").alias("id_start")), "doc_id")
    near = near.withColumn("distance", F.abs(F.col("id_start") - F.col("role_start")))
    return near.where(F.col("distance") <= options["role_distance"]).select("doc_id", "role", "name", "role_start", "org", "distance")


def match_roles(pairs: DataFrame, margin: int = 60) -> DataFrame:
    """(doc_id, role, org, name, distance): nearest pairs first, a role and an organisation once each.

    A pair is clear if no other role comes within ``margin`` further of its organisation
    after it. That is known before any choice: the next pair of another role is the first
    one after the pair's own streak of one role in the organisation's order. Choosing is
    then a fold over a document's pairs, whose few are one row: each pair of an organisation
    not met in a turn before, and of a role not given yet, takes the turn of its
    organisation, and the role too if it is clear.
    """
    order = ["distance", "role", "role_start", "org", "name"]
    own = W.partitionBy("doc_id", "org").orderBy(*order)
    streak = F.sum(F.when(F.col("role") == F.lag("role").over(own), 0).otherwise(1)).over(own.rowsBetween(W.unboundedPreceding, 0))
    rows = pairs.withColumn("streak", streak)
    # The distance at which the organisation's next streak begins.
    begins = F.min("distance").over(W.partitionBy("doc_id", "org").orderBy("streak").rangeBetween(1, 1))
    clear = F.coalesce(begins - F.col("distance") >= margin, F.lit(True)).alias("clear")
    packed = rows.select("doc_id", F.struct(*order, clear).alias("p")).groupBy("doc_id").agg(F.array_sort(F.collect_list("p")).alias("pairs"))
    kind = packed.schema["pairs"].dataType.simpleString()
    start = F.struct(F.array().cast("array<string>").alias("orgs"), F.array().cast("array<string>").alias("roles"), F.array().cast(kind).alias("given"))

    def turn(state: Column, p: Column) -> Column:
        passed = F.array_contains(state["orgs"], p["org"]) | F.array_contains(state["roles"], p["role"])
        won = F.when(p["clear"], F.array(p)).otherwise(F.array().cast(kind))
        after = F.struct(F.array_append(state["orgs"], p["org"]).alias("orgs"), F.concat(state["roles"], F.transform(won, lambda x: x["role"])).alias("roles"), F.concat(state["given"], won).alias("given"))
        return F.when(passed, state).otherwise(after)

    chosen = packed.select("doc_id", F.explode(F.aggregate("pairs", start, turn)["given"]).alias("g"))
    return chosen.select("doc_id", "g.role", "g.org", "g.name", F.col("g.distance").cast("int").alias("distance"))


def accounts(fields: DataFrame, qualifier: str = "ifsc") -> DataFrame:
    """(doc_id, ifsc, number): account numbers of documents that prove a bank, the smallest code's."""
    bank = fields.where((F.col("field") == qualifier) & F.col("validated") & (F.col("value") != "")).groupBy("doc_id").agg(F.min("value").alias("ifsc"))
    number = fields.where("field = 'account_number' and value <> ''").select("doc_id", F.col("value").alias("number")).distinct()
    return number.join(bank, "doc_id").select("doc_id", "ifsc", "number")


def references(fields: DataFrame, config: Config | None = None) -> DataFrame:
    """(src, dst, key): documents that cite a number another one owns."""
    options = (config or load()).settings["graph"]["reference"]
    cited = fields.where((F.col("field") == options["field"]) & (F.col("value") != ""))
    owner = F.col("label").isin(options["owners"])
    owners = cited.where(owner).select(F.col("doc_id").alias("dst"), F.col("value").alias("key")).distinct()
    citers = cited.where(~owner).select(F.col("doc_id").alias("src"), F.col("value").alias("key")).distinct()
    pairs = citers.join(owners, "key").where("src <> dst")
    # One edge of a kind between two documents: that of the first key.
    return pairs.groupBy("src", "dst").agg(F.min("key").alias("key"))


def duplicate_keys(records: DataFrame, config: Config | None = None) -> DataFrame:
    """(doc_id, key): class and smallest value of each compared field, of documents that have them all."""
    options = (config or load()).settings["graph"]["duplicates"]
    fields = fields_of(records).where(F.col("field").isin(options["fields"]) & (F.col("value") != ""))
    smallest = fields.groupBy("doc_id", "label").agg(*[F.min(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in options["fields"]]).dropna(subset=options["fields"])
    parts = (["label"] if options["same_class"] else []) + options["fields"]
    return smallest.select("doc_id", F.array(*parts).alias("key"))


def duplicates(records: DataFrame, config: Config | None = None) -> DataFrame:
    """(key, documents): groups of documents that agree on class and compared fields, two or more."""
    return duplicate_keys(records, config).groupBy("key").agg(F.sort_array(F.collect_set("doc_id")).alias("documents")).where(F.size("documents") > 1)


def duplicate_edges(records: DataFrame, config: Config | None = None) -> DataFrame:
    """(src, dst, key): each document of a group and the first one, by id; a group of n gives n - 1 rows, not all pairs."""
    keys = duplicate_keys(records, config).distinct()
    first = keys.groupBy("key").agg(F.min("doc_id").alias("src"))
    return keys.join(first, "key").where("src < doc_id").select("src", F.col("doc_id").alias("dst"), F.array_join("key", " | ").alias("key"))


def nodes(records: DataFrame, config: Config | None = None) -> DataFrame:
    """(id, kind, attrs): documents, organisations with their numbers and names, accounts."""
    fields = fields_of(records)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    docs = records.where(F.coalesce(F.col("doc_id"), F.lit("")) != "").dropDuplicates(["doc_id"]).select(
        F.concat(F.lit("doc:"), "doc_id").alias("id"), F.lit("document").alias("kind"),
        F.create_map(F.lit("filename"), text(F.col("filename")), F.lit("label"), F.coalesce("classification.label", F.lit("unknown")), F.lit("page_count"), text(F.col("diagnostics.page_count")), F.lit("method"), text(F.col("text.method"))).alias("attrs"),
    )
    proven = fields.where("validated and field in ('gstin', 'pan') and value <> ''").withColumn("org", org_key(F.col("value")))
    gstins = proven.groupBy("org").agg(F.sort_array(F.collect_set(F.when(F.char_length("value") == 15, F.col("value")))).alias("gstins"))
    names = match_roles(role_pairs(fields, config), (config or load()).settings["graph"]["role_margin"]).groupBy("org").agg(F.sort_array(F.collect_set("name")).alias("names"))
    joined = F.array_join(F.coalesce("names", F.array()), "; ")
    orgs = gstins.join(names, "org", "left").select(F.concat(F.lit("org:"), "org").alias("id"), F.lit("organization").alias("kind"), F.create_map(F.lit("pan"), F.col("org"), F.lit("gstins"), F.array_join("gstins", "; "), F.lit("names"), joined).alias("attrs"))
    held = accounts(fields).select("ifsc", "number").distinct().select(F.concat_ws(":", F.lit("acct"), "ifsc", "number").alias("id"), F.lit("account").alias("kind"), F.create_map(F.lit("number"), F.col("number"), F.lit("ifsc"), F.col("ifsc")).alias("attrs"))
    return docs.unionByName(orgs).unionByName(held)


def edges(records: DataFrame, config: Config | None = None) -> DataFrame:
    """(src, dst, type, attrs): one edge of a type between two nodes."""
    fields = fields_of(records)
    none = F.create_map().cast("map<string,string>")
    doc = lambda c: F.concat(F.lit("doc:"), F.col(c))
    org, acct = F.concat(F.lit("org:"), F.col("org")), F.concat_ws(":", F.lit("acct"), "ifsc", "number")
    named = mentions(fields)
    paid = accounts(fields)
    matched = match_roles(role_pairs(fields, config), (config or load()).settings["graph"]["role_margin"])
    parts = [
        named.select(doc("doc_id").alias("src"), org.alias("dst"), F.lit("mentions_org").alias("type"), none.alias("attrs")),
        matched.select(doc("doc_id").alias("src"), org.alias("dst"), F.col("role").alias("type"), F.create_map(F.lit("name"), F.col("name"), F.lit("distance"), F.col("distance").cast("string")).alias("attrs")),
        paid.select(doc("doc_id").alias("src"), acct.alias("dst"), F.lit("pays_to").alias("type"), none.alias("attrs")),
        paid.join(named, "doc_id").select(acct.alias("src"), org.alias("dst")).distinct().select("src", "dst", F.lit("held_by").alias("type"), none.alias("attrs")),
        references(fields, config).select(doc("src").alias("src"), doc("dst").alias("dst"), F.lit((config or load()).settings["graph"]["reference"]["edge"]).alias("type"), F.create_map(F.lit("key"), F.col("key")).alias("attrs")),
        duplicate_edges(records, config).select(doc("src").alias("src"), doc("dst").alias("dst"), F.lit("duplicate_of").alias("type"), F.create_map(F.lit("key"), F.col("key")).alias("attrs")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def chains(records: DataFrame, config: Config | None = None) -> DataFrame:
    """(from, from_class, to, to_class, key): citing and cited documents by file name."""
    found = references(fields_of(records), config)
    side = records.select("doc_id", "filename", F.coalesce(F.col("classification.label"), F.lit("unknown")).alias("label"))
    a = side.select(F.col("doc_id").alias("src"), F.col("filename").alias("from"), F.col("label").alias("from_class"))
    b = side.select(F.col("doc_id").alias("dst"), F.col("filename").alias("to"), F.col("label").alias("to_class"))
    return found.join(a, "src").join(b, "dst").select("from", "from_class", "to", "to_class", "key")


def exposure(records: DataFrame) -> DataFrame:
    """(org, documents, files): how many documents name each proven organisation."""
    named = mentions(fields_of(records)).join(records.select("doc_id", "filename"), "doc_id")
    return named.groupBy("org").agg(F.countDistinct("doc_id").alias("documents"), F.sort_array(F.collect_set("filename")).alias("files"))


def orphans(fields: DataFrame, config: Config | None = None) -> DataFrame:
    """(filename, label, key): each citation of a number that no document owns."""
    options = (config or load()).settings["graph"]["reference"]
    cited = fields.where((F.col("field") == options["field"]) & (F.col("value") != ""))
    owner = F.col("label").isin(options["owners"])
    return cited.where(~owner).join(cited.where(owner).select("value").distinct(), "value", "left_anti").select("filename", "label", F.col("value").alias("key"))


def neighbours(edge_table: DataFrame, node: str) -> DataFrame:
    return edge_table.where((F.col("src") == node) | (F.col("dst") == node))


def stats(edge_table: DataFrame) -> DataFrame:
    return edge_table.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def to_dot(node_table: DataFrame, edge_table: DataFrame) -> DataFrame:
    """(ord, line): Graphviz statements; write them in order for a file."""
    quote = lambda c: F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('\\"')), F.lit('"'))
    head = node_table.sparkSession.range(1).select(F.lit(0).alias("ord"), F.lit("digraph documents {").alias("line"))
    own = node_table.select(F.lit(1).alias("ord"), F.concat(F.lit("  "), quote("id"), F.lit(" [class="), F.col("kind"), F.lit("];")).alias("line"))
    arrows = edge_table.select(F.lit(2).alias("ord"), F.concat(F.lit("  "), quote("src"), F.lit(" -> "), quote("dst"), F.lit(' [label="'), F.col("type"), F.lit('"];')).alias("line"))
    return head.unionAll(own).unionAll(arrows).unionAll(head.select(F.lit(3), F.lit("}")))
