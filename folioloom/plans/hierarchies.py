"""Queries of vectors pooled over hierarchies."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hierarchy
from ..session import stored
from .base import query, table

COLUMNS = hierarchy.Placements("doc", "ord", "ids", "names", "item", "rev", "item_at", "name_at", "title_at", ("flag",), ("clerk",), ("status",))


def placements(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as placements: documents are priorities (the lowest is none), scales are regions, nations and groups of
    customers, items are customers. Some orders lie outside the scales, some have no item, some end at the nation.
    Vectors are ids of ``vectors``."""
    o, c, n = (table(spark, sf, x) for x in ("orders", "customer", "nation"))
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    ids = F.array(F.col("n_regionkey") + 1, F.col("n_nationkey") + 100, 1000 + F.col("n_nationkey") * 10 + F.col("c_custkey") % 3).cast("array<long>")
    ids = F.when(F.col("o_orderkey") % 11 > 0, F.when(F.col("o_orderkey") % 4 == 0, F.slice(ids, 1, 2)).otherwise(ids))
    last = F.try_element_at("ids", F.lit(-1))
    rows = rows.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("doc"), F.col("o_orderkey").alias("ord"), ids.alias("ids"),
        F.when(F.col("o_orderkey") % 13 > 0, F.col("c_custkey")).alias("item"), F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderkey") % 5 == 0).alias("rev"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus") == "F").alias("flag"), F.col("c_name").alias("clerk"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("status"),
        (F.col("c_custkey") % 700).alias("item_at"), F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderkey") % 50).alias("title_at"),
    )
    return rows.withColumn("names", F.transform("ids", lambda x: F.concat(F.lit("n"), x.cast("string")))).withColumn("name_at", F.when((last % 2 == 0) & (F.col("ord") % 3 > 0), last % 40))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "embedding")


def names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.concat(F.lit("n"), F.col("vec_id").cast("string")).alias("name"), F.col("embedding").alias("vector"))


#: The same placements; a document that is none is '' here. x: each placement at its nodes; f: the first of each item.
_SQL = """WITH p AS (SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE '' END AS doc, o_orderkey AS ord,
  CASE WHEN o_orderkey % 11 > 0 THEN CASE WHEN o_orderkey % 4 = 0 THEN [n_regionkey + 1, n_nationkey + 100] ELSE [n_regionkey + 1, n_nationkey + 100, 1000 + n_nationkey * 10 + c_custkey % 3] END ELSE [] END::BIGINT[] AS ids,
  CASE WHEN o_orderkey % 13 > 0 THEN 'i' || c_custkey ELSE 'r' || o_orderkey END AS tag, coalesce(o_orderkey % 7 > 0 AND o_orderkey % 5 = 0, false) AS rev, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus = 'F' END AS flag,
  c_name AS clerk, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status, c_custkey % 700 AS item_at, CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderkey % 50 END AS title_at
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
x AS (SELECT *, unnest(list_append(ids, -1)) AS node, unnest(range(1, len(ids) + 2)) AS lvl FROM p),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc, node, tag ORDER BY ord) AS rn FROM x) WHERE rn = 1),
e AS (SELECT vec_id, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
u AS (SELECT vec_id, pos, x / nullif(sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 0) AS x FROM e),
k AS (SELECT f.doc, f.node, f.ord, u.pos, CASE WHEN f.rev THEN -u.x ELSE u.x END AS x FROM f JOIN u ON u.vec_id = f.item_at),
s AS (SELECT doc, node, pos, sum(x) AS s, avg(x) AS m, count(*) AS n FROM k GROUP BY 1, 2, 3),
d AS (SELECT doc, node, count_if(d < 0 AND n > 1) AS away FROM (SELECT k.doc, k.node, k.ord, any_value(n) AS n, sum(x * s) - sum(x * x) AS d FROM k JOIN s USING (doc, node, pos) GROUP BY 1, 2, 3) GROUP BY 1, 2),
l AS (SELECT doc, node, arg_min('n' || node, ord) AS name, arg_min(lvl, ord) AS depth FROM x WHERE node >= 0 GROUP BY 1, 2),
c AS (SELECT DISTINCT doc, ids[lvl] AS node, unnest(ids[lvl:]) AS below FROM x WHERE node >= 0)"""


def _where(node: str = "node") -> str:
    return f"nullif(doc, '') AS doc, nullif({node}, -1) AS node"


@query("pooled_nodes", f"""{_SQL},
n AS (SELECT doc, node, count(*) AS n_items, bool_or(flag) AS flag FROM f GROUP BY 1, 2),
z AS (SELECT doc, node, count(*) AS n_scales FROM c GROUP BY 1, 2 UNION ALL SELECT doc, -1, count(DISTINCT node) FROM x WHERE node >= 0 GROUP BY 1),
r AS (SELECT doc, arg_min(clerk, ord) AS clerk, first(status ORDER BY ord) AS status FROM p GROUP BY 1),
w AS (SELECT doc, ids[-1] AS node, first(status ORDER BY ord) AS status FROM p WHERE len(ids) > 0 GROUP BY 1, 2)
SELECT {_where('n.node').replace("doc", "n.doc", 1)}, n.node = -1 AS is_instrument, l.name, l.depth::BIGINT AS depth, n_items, n_scales, n.flag, away AS keying_disagreements, r.clerk,
  CASE WHEN w.doc IS NULL THEN r.status ELSE w.status END AS status
FROM n LEFT JOIN l ON n.doc = l.doc AND n.node = l.node LEFT JOIN z ON n.doc = z.doc AND n.node = z.node LEFT JOIN d ON n.doc = d.doc AND n.node = d.node JOIN r ON n.doc = r.doc LEFT JOIN w ON n.doc = w.doc AND n.node = w.node""")
def pooled_nodes(spark, sf):
    """Every node and document with its counts, flags, carried columns and keying disagreements."""
    of_items = replace(COLUMNS, name_vector=None, title_vector=None)  # labels are not in the result
    out = hierarchy.pool(stored(placements(spark, sf), "placements"), of_items, vectors=vectors(spark, sf))
    return out.select("doc", "node", "is_instrument", "name", "depth", "n_items", "n_scales", "flag", "keying_disagreements", "clerk", "status")


def _long(df: DataFrame, vector: str) -> DataFrame:
    return df.select("doc", "node", F.posexplode(vector).alias("pos", "x")).select("doc", "node", (F.col("pos") + 1).cast("long").alias("pos"), F.round("x", 6).alias("x"))


@query("pooled_items", f"{_SQL} SELECT {_where()}, pos, round(m, 6) AS x FROM s")
def pooled_items(spark, sf):
    """The item vector of every node and document, one row a position."""
    return _long(hierarchy.item_pools(stored(placements(spark, sf), "placements"), COLUMNS, vectors(spark, sf)), "item_pooled")


@query("pooled_labels", f"""{_SQL},
own AS (SELECT doc, ids[-1] AS node, arg_min(CASE WHEN ids[-1] % 2 = 0 AND ord % 3 > 0 THEN ids[-1] % 40 ELSE -1 END, ord) AS v FROM p WHERE len(ids) > 0 GROUP BY 1, 2),
o AS (SELECT l.doc, l.node, coalesce(e.vec_id, g.vec_id) AS vec_id FROM l LEFT JOIN own ON l.doc = own.doc AND l.node = own.node LEFT JOIN embeddings e ON e.vec_id = own.v LEFT JOIN embeddings g ON g.vec_id = l.node),
t AS (SELECT doc, arg_min(coalesce(title_at, -1), ord) AS vec_id FROM p GROUP BY 1),
q AS (SELECT * FROM c UNION ALL SELECT DISTINCT doc, -1, ids[-1] FROM p WHERE len(ids) > 0),
v AS (SELECT q.doc, q.node, o.vec_id FROM q JOIN o ON q.doc = o.doc AND q.below = o.node UNION ALL SELECT l.doc, l.node, t.vec_id FROM l JOIN t ON l.doc = t.doc UNION ALL SELECT doc, -1, vec_id FROM t)
SELECT {_where()}, pos, round(avg(x), 6) AS x FROM v JOIN e ON e.vec_id = v.vec_id GROUP BY doc, node, pos""")
def pooled_labels(spark, sf):
    """The label vector of every node and document: names of the node and all below it, and the title."""
    out = hierarchy.pool(stored(placements(spark, sf), "placements"), COLUMNS, names(spark, sf), vectors(spark, sf), items=False)
    return _long(out.select("doc", "node", "scale_pooled"), "scale_pooled")
