"""Queries of ingest, curation and flags."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.model import Field, Model
from ..functions.text import trimmed
from ..operators import curation, trees
from ..session import stored
from ..sources import readers
from .base import query, table


@query("explode_lines", """
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS item_id, line FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)""")
def explode_lines(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("doc_id", (F.col("pos") + 1).cast("long").alias("item_id"), "line")


@query("explode_tree", """
WITH o AS (SELECT c.c_custkey, n.n_nationkey, r.r_regionkey, r.r_name, n.n_name, c.c_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT r_regionkey AS doc, 'scaled' AS bucket, n_nationkey AS scale_id, n_name AS scale_name, 2::BIGINT AS scale_depth, r_name || '/' || n_name AS path, c_custkey AS item_id FROM o
UNION ALL SELECT r_regionkey, 'orphan', NULL, NULL, NULL, NULL, -1 FROM region
UNION ALL SELECT r_regionkey, 'scaled', 1000 + r_regionkey, r_name, 1, r_name, 0 FROM region
UNION ALL SELECT 99, NULL, NULL, NULL, NULL, NULL, NULL""")
def explode_tree(spark, sf):
    """Region trees built as nested JSON (an item of the region itself, nations as subscales, an orphan), then exploded."""
    c, n, r = table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "region")
    item = lambda key: F.struct(key.alias("item_id"))
    nations = c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_regionkey", "n_nationkey", "n_name").agg(F.sort_array(F.collect_list(item(F.col("c_custkey")))).alias("items"))
    subscales = nations.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("scale_name"), "items"))).alias("subs"))
    top = F.array(F.struct((F.col("r_regionkey") + 1000).alias("id"), F.col("r_name").alias("scale_name"), F.array(item(F.lit(0))).alias("items"), F.col("subs").alias("subscales")))
    docs = r.join(subscales, r.r_regionkey == subscales.n_regionkey).select(F.col("r_regionkey").cast("long").alias("doc"), F.to_json(F.struct(top.alias("scales"), F.array(item(F.lit(-1))).alias("orphan_items"))).alias("tree"))
    docs = docs.unionByName(spark.range(99, 100).select(F.col("id").alias("doc"), F.lit(None).cast("string").alias("tree")))
    rows = trees.explode_trees(docs, "doc", "tree", "item_id long")
    return rows.select("doc", "bucket", "scale_id", "scale_name", "scale_depth", F.array_join("scale_name_path", "/").alias("path"), F.col("item.item_id").alias("item_id"))


@query("rebuild_tree", """
WITH i AS (SELECT n.n_regionkey AS doc, n.n_nationkey AS id, n.n_name AS name, min(c.c_custkey) AS first, string_agg(c.c_custkey::VARCHAR, ',' ORDER BY c.c_custkey) AS items FROM nation n JOIN customer c ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2, 3)
SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY first) AS place, id, name, items FROM i""")
def rebuild_tree(spark, sf):
    """Trees of regions, nations and a level of customers' segments; a row a nation, with all its items in their order."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    rows = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("n_regionkey").alias("doc"), F.array("n_regionkey", "n_nationkey").alias("ids"), F.array(F.lit("r"), F.col("n_name")).alias("names"), F.col("c_custkey").alias("item"), F.col("c_custkey").alias("ord"))
    built = trees.rebuild(rows, "doc", "ids", "names", "item", "ord")
    nodes = built.select("doc", F.posexplode(F.flatten(F.transform("scales", lambda s: s["subscales"]))).alias("at", "s"))
    return nodes.select("doc", (F.col("at") + 1).cast("long").alias("place"), F.col("s.id").alias("id"), F.col("s.scale_name").alias("name"), F.array_join("s.items", ",").alias("items"))


@query("explode_deep", """
WITH RECURSIVE t AS (SELECT c_nationkey AS doc, c_custkey AS item, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer),
n AS (SELECT DISTINCT doc, 1 + (r - 1) % 511 AS node FROM t),
w AS (SELECT doc, node, [node] AS path FROM n WHERE node = 1 UNION ALL SELECT n.doc, n.node, list_append(w.path, n.node) FROM w JOIN n ON n.doc = w.doc AND n.node // 2 = w.node)
SELECT w.doc, row_number() OVER (PARTITION BY w.doc ORDER BY path, r) - 1 AS place, w.node AS scale_id, 's' || w.node AS scale_name, len(path)::BIGINT AS scale_depth, array_to_string(path, '/') AS path, item AS item_id,
  CASE WHEN item % 3 = 0 THEN 'choice' ELSE 'rating_scale' END AS item_type, item % 5 = 0 AS has_image
FROM w JOIN t ON t.doc = w.doc AND 1 + (t.r - 1) % 511 = w.node""")
def explode_deep(spark, sf):
    """Customers of a nation as the items of a tree of up to nine levels, nested, written as JSON, and exploded again."""
    c = table(spark, sf, "customer").withColumn("r", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")))
    node = (1 + (F.col("r") - 1) % 511).cast("long")
    steps = F.filter(F.transform(F.sequence(F.lit(8), F.lit(0), F.lit(-1)), lambda s: F.floor(node / F.pow(F.lit(2.0), s)).cast("long")), lambda x: x > 0)
    item = F.struct(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 == 0, F.lit("choice")).alias("type"), F.when(F.col("c_custkey") % 5 == 0, F.lit(True)).alias("img"))
    rows = c.select(F.col("c_nationkey").alias("doc"), steps.alias("ids"), F.transform(steps, lambda x: F.concat(F.lit("s"), x.cast("string"))).alias("names"), item.alias("item"), F.col("r").alias("ord"))
    docs = trees.rebuild(rows, "doc", "ids", "names", "item", "ord").select("doc", F.to_json(F.struct("scales")).alias("tree"))
    kinds = Model((Field("item_id", "bigint", "id"), Field("item_type", "string", "type", "rating_scale", blank=True), Field("has_image", "boolean", "img", False)))
    out = trees.explode_trees(stored(docs, "trees"), "doc", "tree", kinds)  # read twice: for the depth, then the rows
    return out.select("doc", F.col("ord").cast("long").alias("place"), "scale_id", "scale_name", "scale_depth", F.array_join(F.col("scale_id_path").cast("array<string>"), "/").alias("path"), "item.*")


@query("union_sources", """
SELECT 'documents' AS corpus_source, doc_id AS id, text AS body, lang, NULL::VARCHAR AS role FROM documents
UNION ALL SELECT 'conversations', conv_id, text, NULL, role FROM conversations""")
def union_sources(spark, sf):
    return readers.union_sources({
        "documents": table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body"), "lang"),
        "conversations": table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), F.col("text").alias("body"), "role"),
    })


_FILTERED = """
WITH d AS (SELECT d.doc_id, d.source, d.lang, l.quality, l.toxic, length(d.text) AS n FROM documents d LEFT JOIN labels l USING (doc_id)),
m AS (SELECT coalesce(toxic = 1, false) AS m0, quality IS NULL AS m1, lang <> 'en' AS m2, n > 5000 AS m3, coalesce(quality = 0, false) AS m4 FROM d),
f AS (SELECT *, CASE WHEN m0 THEN 0 WHEN m1 THEN 1 WHEN m2 THEN 2 WHEN m3 THEN 3 WHEN m4 THEN 4 END AS hit FROM m)"""


@query("filter_attrition", _FILTERED + """,
c AS (SELECT 0 AS step, 'toxic' AS name, count_if(m0) AS isolated, count_if(hit = 0) AS new FROM f UNION ALL SELECT 1, 'unlabelled', count_if(m1), count_if(hit = 1) FROM f
UNION ALL SELECT 2, 'foreign', count_if(m2), count_if(hit = 2) FROM f UNION ALL SELECT 3, 'long', count_if(m3), count_if(hit = 3) FROM f UNION ALL SELECT 4, 'poor', count_if(m4), count_if(hit = 4) FROM f)
SELECT step::BIGINT AS step, name, isolated::BIGINT AS isolated, new::BIGINT AS new, (sum(new) OVER (ORDER BY step))::BIGINT AS cumulative FROM c""")
def filter_attrition(spark, sf):
    d, filters = _with_filters(spark, sf)
    return curation.attrition(d, filters)


def _with_filters(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return d, {"toxic": F.col("toxic") == 1, "unlabelled": F.col("quality").isNull(), "foreign": F.col("lang") != "en", "long": F.length("text") > 5000, "poor": F.col("quality") == 0}


@query("filter_survivors", _FILTERED.replace("SELECT coalesce(toxic", "SELECT doc_id, coalesce(toxic") + " SELECT doc_id FROM f WHERE hit IS NULL")
def filter_survivors(spark, sf):
    d, filters = _with_filters(spark, sf)
    return curation.surviving(d, filters).select("doc_id")


@query("placement_filters", """
WITH p AS (SELECT l_orderkey AS k, CASE l_suppkey % 3 WHEN 0 THEN 'apa-psyctests' WHEN 1 THEN 'partial' END AS src, CASE l_partkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'unscaled' ELSE 'scaled' END AS bucket,
 CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'open' ELSE 'rating_scale' END AS type, CASE l_partkey % 7 WHEN 0 THEN true WHEN 1 THEN false END AS intake, repeat('x', (l_partkey % 252)::INT) AS txt FROM lineitem)
SELECT k, count(*) AS kept FROM p WHERE bucket IS NOT NULL AND (type IS NULL OR type = 'rating_scale') AND txt <> '' AND length(txt) <= 250 AND bucket <> 'unscaled'
 AND NOT coalesce(intake, coalesce(src = 'apa-psyctests', false)) GROUP BY k""")
def placement_filters(spark, sf):
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    p = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.when(supp % 3 == 0, "apa-psyctests").when(supp % 3 == 1, "partial").alias("corpus_source"), F.when(part % 9 == 1, "unscaled").when(part % 9 > 1, "scaled").alias("bucket"),
        F.when(part % 5 == 1, "open").when(part % 5 > 1, "rating_scale").alias("item_item_type"), F.when(part % 7 == 0, True).when(part % 7 == 1, False).alias("meta_intake_form"), F.repeat(F.lit("x"), (part % 252).cast("int")).alias("item_item_text"),
    )
    return curation.surviving(p, curation.source_filters(p.columns)).groupBy("k").agg(F.count("*").alias("kept"))


@query("observed_counts", """
SELECT DISTINCT l_orderkey AS doc, count(DISTINCT l_linenumber) OVER (PARTITION BY l_orderkey) AS n_items, count(DISTINCT l_suppkey) OVER (PARTITION BY l_orderkey) AS n_scales FROM lineitem""")
def observed_counts(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"), "l_linenumber", "l_suppkey")
    return curation.with_observed(rows, "doc", {"n_items": "l_linenumber", "n_scales": "l_suppkey"}).select("doc", "n_items", "n_scales").distinct()


@query("flags_count", """
WITH o AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 7 END AS ref FROM orders),
n AS (SELECT l_orderkey, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN n <> ref END AS items_deviate, CASE WHEN o_orderstatus = 'F' THEN n <> nullif(ref, 0) END AS scales_deviate FROM o LEFT JOIN n ON o_orderkey = l_orderkey""")
def flags_count(spark, sf):
    key = F.col("o_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.when(key % 4 == 0, None).when(key % 5 == 0, 0).otherwise(key % 7).alias("ref"))
    n = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.countDistinct("l_linenumber").alias("n"))
    main = F.col("o_orderstatus") == "F"
    return o.join(n, o.o_orderkey == n.l_orderkey, "left").select("o_orderkey", curation.deviates(F.col("n"), F.col("ref"), main).alias("items_deviate"), curation.deviates(F.col("n"), F.col("ref"), main, True).alias("scales_deviate"))


@query("flags_text", """
WITH d AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 0.05 WHEN 2 THEN 0.051 WHEN 3 THEN 0.9 END AS dist, CASE doc_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS ok, CASE doc_id % 5 WHEN 0 THEN 'EN ' WHEN 1 THEN 'de' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE lang END AS lang FROM documents)
SELECT doc_id, CASE WHEN coalesce(ok, true) THEN dist > 0.05 END AS deviates, nullif(lower(trim(lang, ' ')), '') <> 'en' AS translated FROM d""")
def flags_text(spark, sf):
    k = F.col("doc_id")
    dist = F.when(k % 5 == 4, float("nan")).when(k % 5 == 1, 0.05).when(k % 5 == 2, 0.051).when(k % 5 == 3, 0.9)
    lang = F.when(k % 5 == 0, "EN ").when(k % 5 == 1, "de").when(k % 5 == 2, "").when(k % 5 == 3, None).otherwise(F.col("lang"))
    ok = F.when(k % 3 == 0, True).when(k % 3 == 1, False)
    return table(spark, sf, "documents").select("doc_id", curation.text_deviates(dist, ok).alias("deviates"), curation.translated(lang).alias("translated"))


@query("text_checkable", """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE length(text) END AS chars, 1 + doc_id % 5 AS pages, doc_id % 11 AS images FROM documents)
SELECT doc_id, CASE WHEN chars IS NOT NULL THEN chars >= 200 AND NOT coalesce(pages > 1 AND images - pages >= pages - 1 AND chars::DOUBLE / nullif(pages - 1, 0) < 500, false) END AS checkable FROM d""")
def text_checkable(spark, sf):
    k = F.col("doc_id")
    return table(spark, sf, "documents").select("doc_id", curation.checkable(F.when(k % 6 != 0, F.length("text")), 1 + k % 5, k % 11).alias("checkable"))


@query("anomaly_census", """
SELECT count_if(d.text IS NULL) AS shells, count(*) - count(DISTINCT d.doc_id) AS repeated_ids, count(*) - count(DISTINCT d.text) AS repeated_texts, count_if(length(trim(d.text, ' ')) < 50) AS short_texts, count_if(l.quality IS NULL) AS unlabelled FROM documents d LEFT JOIN labels l USING (doc_id)""")
def anomaly_census(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    counts = d.agg(F.count_if(F.col("text").isNull()).alias("shells"), (F.count("*") - F.countDistinct("doc_id")).alias("repeated_ids"), (F.count("*") - F.countDistinct("text")).alias("repeated_texts"),
                   F.count_if(F.length(trimmed(F.col("text"))) < 50).alias("short_texts"), F.count_if(F.col("quality").isNull()).alias("unlabelled"))
    return counts


@query("map_distinct", "SELECT doc_id, source, upper(source) AS made FROM documents")
def map_distinct(spark, sf):
    from ..operators.distinct import map_distinct as run

    return run(table(spark, sf, "documents").select("doc_id", "source"), "source", lambda v: v.str.upper(), "string", out="made")


@query("resolve_mappings", """
WITH m AS (SELECT l_orderkey AS doc, l_linenumber::BIGINT AS item, l_suppkey AS scale, min(l_partkey) AS ord FROM lineitem GROUP BY ALL),
i AS (SELECT DISTINCT doc, item FROM m WHERE item <= 5)
SELECT m.doc, m.item, CASE WHEN s.s_suppkey IS NULL THEN NULL ELSE m.scale END AS scale, CASE WHEN s.s_suppkey IS NULL THEN 'orphan' ELSE 'scaled' END AS bucket
FROM m JOIN i USING (doc, item) LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 0) s ON m.scale = s.s_suppkey""")
def resolve_mappings(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").cast("long").alias("item"), F.col("l_suppkey").alias("scale"), F.col("l_partkey").alias("ord"))
    items = rows.where("item <= 5").select("doc", "item").distinct()
    scales = table(spark, sf, "supplier").where("s_suppkey % 10 <> 0").select(F.col("s_suppkey").alias("scale"))
    return trees.resolve_mappings(rows, items, scales, "doc", "item", "scale", "ord").select("doc", "item", "scale", "bucket")
