"""Queries of pooling, search, matching, statistics and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.text import match_key
from ..functions.vectors import cosine, doubles, literal_vector
from ..operators import matching, pooling, records, report, search, statistics, verbatim
from .base import query, table

_UNIT = """u AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n FROM embeddings),
k AS (SELECT vec_id, label, list_transform(v, lambda x: CASE WHEN n > 0 THEN x / n ELSE x END * CASE WHEN vec_id % 5 = 0 THEN -1.0 ELSE 1.0 END) AS k FROM u),
e AS (SELECT vec_id, label, unnest(k) AS x, generate_subscripts(k, 1) AS pos FROM k)"""
def _reverse():
    return F.col("vec_id") % 5 == 0


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings")


@query("keyed_centroid", f"WITH {_UNIT} SELECT label::BIGINT AS label, (pos - 1)::BIGINT AS pos, round(avg(x), 6) AS x FROM e GROUP BY 1, 2")
def keyed_centroid(spark, sf):
    out = pooling.keyed_centroid(_embeddings(spark, sf), ["label"], "embedding", _reverse())
    return out.select(F.col("label").cast("long").alias("label"), F.posexplode("centroid").alias("pos", "x")).select("label", F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x"))


@query("renormalised_centroid", f"""WITH {_UNIT}, m AS (SELECT label::BIGINT AS label, (pos - 1)::BIGINT AS pos, avg(x) AS x FROM e GROUP BY 1, 2)
SELECT label, pos, round(x / sqrt(sum(x * x) OVER (PARTITION BY label)), 6) AS x FROM m""")
def renormalised_centroid(spark, sf):
    out = pooling.renormalised_centroid(_embeddings(spark, sf), ["label"], "embedding", _reverse())
    return out.select(F.col("label").cast("long").alias("label"), F.posexplode("centroid").alias("pos", "x")).select("label", F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x"))


@query("loo_disagreement", f"""WITH {_UNIT}, s AS (SELECT label, pos, sum(x) AS s FROM e GROUP BY 1, 2), d AS (SELECT e.label, e.vec_id, sum(x * s) - sum(x * x) AS d FROM e JOIN s USING (label, pos) GROUP BY 1, 2)
SELECT label::BIGINT AS label, count(*) AS n_items, CASE WHEN count(*) >= 2 THEN count_if(d < 0) ELSE 0 END::BIGINT AS n_disagree FROM d GROUP BY 1""")
def loo_disagreement(spark, sf):
    return pooling.keying_disagreement(_embeddings(spark, sf), ["label"], "embedding", _reverse()).withColumn("label", F.col("label").cast("long"))


def _placements(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    o = table(spark, sf, "orders")
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return rows.select(F.col("o_orderpriority").alias("doc"), F.array("n_regionkey", F.col("n_nationkey") + 100).alias("ids"), F.col("c_custkey").alias("item"), F.col("o_orderkey").alias("ord"), (F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus") == "F")).alias("flag"))


_PLACED = """p AS (SELECT o_orderpriority AS doc, [n_regionkey::BIGINT, n_nationkey::BIGINT + 100] AS ids, c_custkey AS item, o_orderkey AS ord, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus = 'F' END AS flag
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


@query("subtree_pool", f"""WITH {_PLACED}, x AS (SELECT *, unnest(ids) AS node, generate_subscripts(ids, 1) AS depth FROM p),
f AS (SELECT *, row_number() OVER (PARTITION BY doc, node, item ORDER BY ord) AS rn FROM x), g AS (SELECT *, row_number() OVER (PARTITION BY doc, item ORDER BY ord) AS rn FROM p)
SELECT f.doc, f.node, false AS is_instrument, min(depth)::BIGINT AS depth, count_if(rn = 1)::BIGINT AS n_items, CASE WHEN min(depth) = 1 THEN 1 + count(DISTINCT ids[2]) ELSE 1 END AS n_scales, bool_or(CASE WHEN rn = 1 THEN flag END) AS flag FROM f GROUP BY 1, 2
UNION ALL SELECT g.doc, NULL, true, NULL, count_if(rn = 1)::BIGINT, any_value(s.n), bool_or(CASE WHEN rn = 1 THEN flag END) FROM g JOIN (SELECT doc, count(DISTINCT node) AS n FROM x GROUP BY 1) s ON g.doc = s.doc GROUP BY 1""")
def subtree_pool(spark, sf):
    out = pooling.pooled(_placements(spark, sf), "doc", "ids", "item", ["ord"], ["flag"])
    return out.select("doc", "node", "is_instrument", "depth", "n_items", "n_scales", "flag")


@query("label_pool", """WITH c AS (SELECT DISTINCT n_regionkey AS node, n_nationkey AS below FROM nation UNION SELECT n_nationkey + 100, n_nationkey FROM nation),
v AS (SELECT c.node, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS pos FROM c JOIN embeddings ON vec_id = below)
SELECT node::BIGINT AS node, (pos - 1)::BIGINT AS pos, round(avg(x), 6) AS x FROM v GROUP BY 1, 2""")
def label_pool(spark, sf):
    n = table(spark, sf, "nation")
    below = n.select(F.col("n_regionkey").cast("long").alias("node"), F.col("n_nationkey").alias("below")).unionByName(n.select((F.col("n_nationkey") + 100).cast("long").alias("node"), F.col("n_nationkey").alias("below"))).distinct()
    v = _embeddings(spark, sf)
    means = pooling.elementwise_mean(below.join(v, below.below == v.vec_id), ["node"], "embedding", "v")
    return means.select("node", F.posexplode("v").alias("pos", "x")).select("node", F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x"))


@query("node_names", f"WITH {_PLACED}, x AS (SELECT *, unnest(ids) AS node, generate_subscripts(ids, 1) AS depth FROM p) SELECT doc, node, min(depth)::BIGINT AS depth FROM x GROUP BY 1, 2")
def node_names(spark, sf):
    return report.node_depths(_placements(spark, sf), "doc", "ids", "ord")


@query("carried_cols", """SELECT l_orderkey AS doc, first(CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END ORDER BY l_linenumber, l_partkey, l_suppkey) AS flag FROM lineitem GROUP BY 1""")
def carried_cols(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_returnflag")).alias("flag"), "l_linenumber", "l_partkey", "l_suppkey")
    return pooling.first_values(rows, ["doc"], ["flag"], ["l_linenumber", "l_partkey", "l_suppkey"])


def _query_vector(spark, sf):
    rows = _embeddings(spark, sf).where("vec_id in (0, 1)").orderBy("vec_id")
    pooled = pooling.keyed_centroid(rows, [], "embedding", _reverse()).first()
    return literal_vector(pooled["centroid"])


_SEARCH = f"""WITH {_UNIT}, q AS (SELECT list(m ORDER BY pos) AS q FROM (SELECT pos, avg(x) AS m FROM e WHERE vec_id IN (0, 1) GROUP BY pos)),
s AS (SELECT vec_id, label, list_cosine_similarity(v, q) AS sim FROM u, q)"""


@query("search_signed", _SEARCH + " SELECT vec_id, label::BIGINT AS label, round(sim, 6) AS similarity FROM s ORDER BY sim DESC, vec_id LIMIT 10")
def search_signed(spark, sf):
    out = search.top_k(_embeddings(spark, sf), "embedding", _query_vector(spark, sf), 10, tie=["vec_id"])
    return out.select("vec_id", F.col("label").cast("long").alias("label"), F.round("similarity", 6).alias("similarity"))


@query("search_abs", _SEARCH + " SELECT vec_id, label::BIGINT AS label, round(sim, 6) AS similarity FROM s ORDER BY abs(sim) DESC, vec_id LIMIT 10")
def search_abs(spark, sf):
    out = search.top_k(_embeddings(spark, sf), "embedding", _query_vector(spark, sf), 10, True, ["vec_id"])
    return out.select("vec_id", F.col("label").cast("long").alias("label"), F.round("similarity", 6).alias("similarity"))


def _centroids(spark, sf):
    return pooling.elementwise_mean(_embeddings(spark, sf).withColumn("label", F.col("label").cast("long")), ["label"], "embedding", "v")


_CENTROIDS = """WITH e AS (SELECT label::BIGINT AS label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings), m AS (SELECT label, pos, avg(x) AS x FROM e GROUP BY 1, 2), c AS (SELECT label, list(x ORDER BY pos) AS v FROM m GROUP BY 1)"""


@query("pairwise_cosine", _CENTROIDS + " SELECT a.label AS a, b.label AS b, round(list_cosine_similarity(a.v, b.v), 6) AS cosine FROM c a JOIN c b ON a.label < b.label")
def pairwise_cosine(spark, sf):
    return search.pairwise(_centroids(spark, sf), "label", "v").withColumn("cosine", F.round("cosine", 6))


_PAIRS = _CENTROIDS + ", p AS (SELECT a.label AS a, b.label AS b, list_cosine_similarity(a.v, b.v) AS x, list_cosine_similarity(a.v[1:32], b.v[1:32]) AS y FROM c a JOIN c b ON a.label < b.label)"


def _pairs(spark, sf):
    c = _centroids(spark, sf)
    half = search.pairwise(c.withColumn("v", F.slice("v", 1, 32)), "label", "v").withColumnRenamed("cosine", "y")
    return search.pairwise(c, "label", "v").withColumnRenamed("cosine", "x").join(half, ["a", "b"])


@query("pair_r_rmse", _PAIRS + " SELECT round(corr(x, y), 6) AS r, round(sqrt(avg((x - y) ** 2)), 6) AS rmse, round(avg(abs(x - y)), 6) AS mae, round(max(abs(x - y)), 6) AS largest FROM p")
def pair_r_rmse(spark, sf):
    out = _pairs(spark, sf).agg(*statistics.fit_of(F.col("x"), F.col("y")))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("bootstrap_ci", _PAIRS + """, n AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS place, count(*) OVER () AS n FROM c), d AS (SELECT rep, (('0x' || substr(md5(rep || '|' || place), 1, 8))::BIGINT % n)::BIGINT AS place FROM n, range(0, 40) t(rep)),
w AS (SELECT rep, n.label, count(*) AS w FROM d JOIN n ON d.place = n.place GROUP BY 1, 2), j AS (SELECT wa.rep, (wa.w * wb.w)::DOUBLE AS w, x, y FROM p JOIN w wa ON wa.label = a JOIN w wb ON wb.label = b AND wb.rep = wa.rep),
s AS (SELECT rep, (sum(w * x * y) - sum(w * x) * sum(w * y) / sum(w)) / sqrt((sum(w * x * x) - sum(w * x) ** 2 / sum(w)) * (sum(w * y * y) - sum(w * y) ** 2 / sum(w))) AS r FROM j GROUP BY 1)
SELECT round(quantile_cont(r, 0.025), 5) AS low, round(quantile_cont(r, 0.975), 5) AS high, count(*) AS reps FROM s""")
def bootstrap_ci(spark, sf):
    reps = statistics.bootstrap_correlation(_pairs(spark, sf), _centroids(spark, sf), "label", "a", "b", "x", "y", 40)
    return reps.agg(F.round(F.percentile("r", 0.025), 5).alias("low"), F.round(F.percentile("r", 0.975), 5).alias("high"), F.count("*").alias("reps"))


@query("encode_distinct")
def encode_distinct(spark, sf):
    """Vectors of the distinct item texts by the hash encoder, joined back to the rows."""
    from ..operators.encode import encode

    out = encode(table(spark, sf, "conversations").select("conv_id", "turn", "text"), "text", "vector", dim=16)
    return out.select("conv_id", "turn", F.size("vector").cast("long").alias("dim"))


@query("verbatim_exact", "SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def verbatim_exact(spark, sf):
    """Items that stand word for word in a document, wherever they begin."""
    return verbatim.contained(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "doc_id", "text", "item_id", "text")


@query("verbatim_status", """WITH i AS (SELECT b.item_id, b.item_id % 5 AS grp, max(contains(d.text, b.text)::INT) AS hit FROM benchmark b, documents d GROUP BY 1, 2)
SELECT grp, CASE WHEN avg(hit) >= 0.9 THEN 'ok' ELSE 'REVIEW' END AS status, count(*) AS n FROM i GROUP BY 1""")
def verbatim_status(spark, sf):
    found = verbatim_exact(spark, sf).select("item_id").distinct().withColumn("hit", F.lit(1))
    items = table(spark, sf, "benchmark").select("item_id", (F.col("item_id") % 5).alias("grp")).join(found, "item_id", "left")
    return items.groupBy("grp").agg(F.when(F.avg(F.coalesce("hit", F.lit(0))) >= 0.9, "ok").otherwise("REVIEW").alias("status"), F.count("*").alias("n"))


_NORM = "trim(regexp_replace(regexp_replace(lower(regexp_replace({x}, '<[^>]+>', ' ', 'g')), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"


@query("verbatim_check", f"""
WITH t AS (SELECT conv_id, turn, text, regexp_extract_all(text, '[^ ]+') AS w FROM conversations),
i AS (SELECT conv_id AS record, turn, CASE turn % 6 WHEN 0 THEN array_to_string(w[3:12], ' ') WHEN 1 THEN 'Item ' || turn || ' (A1): ' || array_to_string(w[2:9], ' ') || ' (2)' WHEN 2 THEN array_to_string(w[1:9], ' ') || ' qqq'
    WHEN 3 THEN 'qqq ' || array_to_string(w[1:9], ' ') WHEN 4 THEN 'short' ELSE '<b>' || array_to_string(w[4:10], ' , ') || '</b>' END AS text FROM t WHERE conv_id % 9 <> 5),
f AS (SELECT *, {_NORM.format(x="text")} AS p, {_NORM.format(x="regexp_replace(regexp_replace(regexp_replace(text, '\\s*\\(\\d+\\)\\s*$', ''), '^\\s*Item \\d+\\s*(\\([A-Z]\\d+\\))?[:.]\\s*', ''), '[:.]+$', '')")} AS b FROM i),
c AS (SELECT conv_id AS record, {_NORM.format(x="text")} AS plain FROM conversations WHERE conv_id % 7 <> 3),
m AS (SELECT f.record, f.turn, any_value(length(p)) AS n, max((contains(plain, p) OR contains(plain, b) OR (len(string_split(b, ' ')) >= 8 AND contains(plain, array_to_string(string_split(b, ' ')[1:8], ' '))))::INT) AS hit
  FROM f LEFT JOIN c ON f.record = c.record AND plain <> '' GROUP BY 1, 2),
g AS (SELECT record, count(*) AS n_items, count_if(n > 12) AS checkable, count_if(n > 12 AND hit = 1) AS matched FROM m GROUP BY 1)
SELECT r.record, coalesce(n_items, 0) AS n_items, CASE WHEN h.record IS NOT NULL THEN coalesce(checkable, 0) END AS checkable, CASE WHEN h.record IS NOT NULL THEN coalesce(matched, 0) END AS matched,
  CASE WHEN h.record IS NULL THEN 'no_source_text' WHEN coalesce(checkable, 0) = 0 THEN 'no_checkable_items' WHEN matched >= 0.9 * checkable THEN 'ok' ELSE 'REVIEW' END AS status
FROM (SELECT DISTINCT conv_id AS record FROM conversations) r LEFT JOIN g ON r.record = g.record LEFT JOIN (SELECT DISTINCT record FROM c WHERE plain <> '') h ON r.record = h.record""")
def verbatim_check(spark, sf):
    """Items cut from the turns of a conversation, some labelled, scored, changed or too short, against its turns."""
    t = table(spark, sf, "conversations").withColumn("w", F.regexp_extract_all("text", F.lit("[^ ]+"), F.lit(0)))
    cut = lambda a, b, by=" ": F.array_join(F.slice("w", a, b - a + 1), by)
    kind, lit = F.col("turn") % 6, F.lit
    text = F.when(kind == 0, cut(3, 12)).when(kind == 1, F.concat(lit("Item "), F.col("turn"), lit(" (A1): "), cut(2, 9), lit(" (2)"))).when(kind == 2, F.concat(cut(1, 9), lit(" qqq")))
    text = text.when(kind == 3, F.concat(lit("qqq "), cut(1, 9))).when(kind == 4, "short").otherwise(F.concat(lit("<b>"), cut(4, 10, " , "), lit("</b>")))
    items = t.where("conv_id % 9 <> 5").select(F.col("conv_id").alias("record"), text.alias("text"), F.lit(None).cast("array<string>").alias("options"), F.lit(None).cast("string").alias("note"))
    sources = t.where("conv_id % 7 <> 3").select(F.col("conv_id").alias("record"), F.col("text").alias("source_text"))
    return verbatim.check_extractions(t.select(F.col("conv_id").alias("record")), items, sources)


@query("lev_similarity", "SELECT a.p_partkey AS a, b.p_partkey AS b, round(levenshtein(lower(a.p_name), lower(b.p_name))::DOUBLE / greatest(length(a.p_name), length(b.p_name)), 6) AS distance FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey")
def lev_similarity(spark, sf):
    return matching.distances_within(table(spark, sf, "part"), ["p_brand", "p_size"], "p_partkey", "p_name").select("a", "b", F.round("distance", 6).alias("distance"))


@query("window_similarity", """WITH p AS (SELECT s_suppkey, lower(substr(s_name, 1, 6)) || 'xx' AS n, lower(s_name || ' and more') AS h FROM supplier)
SELECT s_suppkey, round(CASE WHEN contains(h, n) THEN 1.0 ELSE list_max(list_transform(range(1, length(h) - length(n) + 2), lambda i: 1 - levenshtein(n, substr(h, i, length(n)))::DOUBLE / length(n))) END, 6) AS similarity FROM p""")
def window_similarity(spark, sf):
    needle, hay = F.concat(F.substring("s_name", 1, 6), F.lit("xx")), F.concat("s_name", F.lit(" and more"))
    return table(spark, sf, "supplier").select("s_suppkey", F.round(matching.contained_similarity(needle, hay), 6).alias("similarity"))


@query("jaccard_dedupe", """WITH i AS (SELECT DISTINCT doc_id AS r, trim(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g'), ' ') AS i FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)), k AS (SELECT * FROM i WHERE length(i) >= 12),
n AS (SELECT r, count(*) AS n FROM k GROUP BY 1), s AS (SELECT a.r AS a, b.r AS b, count(*) AS shared FROM k a JOIN k b ON a.i = b.i AND a.r < b.r GROUP BY 1, 2)
SELECT a, b, shared, x.n AS n_a, y.n AS n_b FROM s JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE shared * 10 >= (x.n + y.n - shared) * 8""")
def jaccard_dedupe(spark, sf):
    return matching.shared_item_pairs(_lines(spark, sf), "doc_id", "item").select("a", "b", "shared", "n_a", "n_b")


def _lines(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).select("doc_id", match_key(F.col("line")).alias("item"))
    return lines.where(F.length("item") >= 12)


@query("greedy_keep")
def greedy_keep(spark, sf):
    """(dropped, keeper) after a greedy pass in order of document id."""
    pairs, members = matching.shared_item_classes(_lines(spark, sf), "doc_id", "item")
    return matching.greedy_keep_classes(pairs.select("a", "b"), members)


@query("partial_window")
def partial_window(spark, sf):
    rows = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.substring("s_name", 2, 9), F.lit("x")).alias("needle"), F.concat("s_name", F.lit(" and more")).alias("hay"))
    return matching.partial_distances(rows, "needle", "hay").select("s_suppkey", "edits", "normalised")


@query("text_clusters")
def text_clusters(spark, sf):
    rows = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), "role", "turn", "text")
    return matching.clustered(rows, ["doc", "role"], "text", "turn").select("doc", "role", "turn", "cluster")


@query("name_match_tiers", """WITH p AS (SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g'), ' ') AS k FROM part), q AS (SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN k WHEN 1 THEN k || ' scale' ELSE 'none ' || p_partkey END AS k FROM p),
f AS (SELECT k, min(p_partkey) AS m FROM p GROUP BY 1)
SELECT q.id, coalesce(a.m, b.m) AS matched, CASE WHEN a.m IS NOT NULL THEN 'exact' WHEN b.m IS NOT NULL THEN 'core' ELSE 'none' END AS tier FROM q LEFT JOIN f a ON a.k = q.k LEFT JOIN f b ON b.k = regexp_replace(q.k, ' scale$', '')""")
def name_match_tiers(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", match_key(F.col("p_name")).alias("k"))
    k = F.col("p_partkey") % 3
    asked = p.select(F.col("p_partkey").alias("id"), F.when(k == 0, F.col("k")).when(k == 1, F.concat("k", F.lit(" scale"))).otherwise(F.concat(F.lit("none "), F.col("p_partkey").cast("string"))).alias("k"))
    return records.name_tiers(asked, p, "id", "k", "p_partkey", ("scale",))


@query("best_match", "SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_size, p_partkey) AS n FROM part) WHERE n = 1")
def best_match(spark, sf):
    return matching.best_per_group(table(spark, sf, "part"), ["p_brand"], [F.desc("p_retailprice"), "p_size", "p_partkey"]).select("p_brand", "p_partkey", "p_retailprice")


def _runs(spark, sf):
    return table(spark, sf, "events").select((F.col("event_id") % 3).alias("run"), F.floor(F.col("event_id") / 3).alias("unit"), "event_type", "value")


_RUNS = "r AS (SELECT event_id % 3 AS run, event_id // 3 AS unit, event_type, value FROM events)"


@query("agreement", f"WITH {_RUNS} SELECT a.run AS run_a, b.run AS run_b, avg((a.event_type IS NOT DISTINCT FROM b.event_type)::INT)::DOUBLE AS agreement, count(*) AS n FROM r a JOIN r b ON a.unit = b.unit AND a.run < b.run GROUP BY 1, 2")
def agreement(spark, sf):
    return statistics.pair_agreement(_runs(spark, sf), "unit", "run", "event_type")


@query("alpha_nominal", f"""WITH {_RUNS}, c AS (SELECT unit, event_type AS v, count(*) AS c FROM r GROUP BY 1, 2), u AS (SELECT unit, sum(c) AS m, sum(c * c) AS s2 FROM c GROUP BY 1 HAVING sum(c) > 1), t AS (SELECT v, sum(c) AS t FROM c JOIN u USING (unit) GROUP BY 1)
SELECT round(CASE WHEN (SELECT count(*) FROM t) <= 1 THEN 1.0 ELSE 1 - (SELECT sum((m * m - s2)::DOUBLE / (m - 1)) FROM u) * ((SELECT sum(m) FROM u) - 1) / ((SELECT sum(m) FROM u) ** 2 - (SELECT sum(t * t) FROM t)) END, 6) AS alpha, (SELECT sum(m) FROM u)::BIGINT AS n_ratings""")
def alpha_nominal(spark, sf):
    out = statistics.alpha_nominal(_runs(spark, sf), "unit", "event_type")
    return out.withColumn("alpha", F.round("alpha", 6))


# DuckDB's levenshtein counts bytes: letters of two bytes become capitals, which no lower-cased text holds.
@query("alpha_text", """WITH r AS (SELECT conv_id, turn % 2 AS run, turn // 2 AS p, translate(lower(coalesce(text, '')), 'ßàáâäåçèéêëíîïñóôöùúûüœ', 'ABCDEFGHIJKLMNOPQRSTUVW') AS t FROM conversations),
k AS (SELECT conv_id, min(n) AS k, count(*) AS r FROM (SELECT conv_id, run, count(*) AS n FROM r GROUP BY 1, 2) GROUP BY 1),
c AS (SELECT conv_id, run, p, t FROM r JOIN k USING (conv_id) WHERE p < k),
d AS (SELECT a.conv_id, a.p = b.p AS here, CASE WHEN greatest(length(a.t), length(b.t)) = 0 THEN 0 ELSE levenshtein(a.t, b.t) / greatest(length(a.t), length(b.t)) END AS d
  FROM c a JOIN c b ON a.conv_id = b.conv_id AND (a.p, a.run) < (b.p, b.run)),
s AS (SELECT conv_id, 2 * sum(CASE WHEN here THEN d * d ELSE 0 END) AS obs, 2 * sum(d * d) AS every FROM d GROUP BY 1)
SELECT k.conv_id, round(CASE WHEN r > 1 THEN CASE WHEN coalesce(every, 0) = 0 THEN 1.0 ELSE 1 - obs / nullif(r - 1, 0) * (k * r - 1) / every END END, 6) AS alpha, r AS n_runs, k AS n_positions
FROM k LEFT JOIN s ON k.conv_id = s.conv_id""")
def alpha_text(spark, sf):
    """How far the two sides of a conversation say the same: each side is a run, its turns are the positions."""
    rows = table(spark, sf, "conversations").select("conv_id", (F.col("turn") % 2).alias("run"), F.floor(F.col("turn") / 2).alias("pos"), F.col("text").alias("t"))
    return statistics.alpha_text(rows, "conv_id", "run", "pos", "t").withColumn("alpha", F.round("alpha", 6))


@query("reverse_agreement", "WITH p AS (SELECT l_partkey, l_suppkey, count(DISTINCT l_returnflag = 'R') <= 1 AS same FROM lineitem GROUP BY 1, 2) SELECT avg(same::INT)::DOUBLE AS agreement, count_if(same)::BIGINT AS n_agree, count(*) AS n_pairs FROM p")
def reverse_agreement(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", (F.col("l_returnflag") == "R").alias("rev"))
    return statistics.reverse_agreement(rows, ["l_partkey", "l_suppkey"], "rev")


@query("icc21", f"""WITH {_RUNS}, g AS (SELECT avg(value) AS g, count(DISTINCT unit)::DOUBLE AS n, count(DISTINCT run)::DOUBLE AS k FROM r), a AS (SELECT sum((m - g) ** 2) AS r FROM (SELECT avg(value) AS m FROM r GROUP BY unit), g), b AS (SELECT sum((m - g) ** 2) AS c FROM (SELECT avg(value) AS m FROM r GROUP BY run), g), t AS (SELECT sum((value - g) ** 2) AS t FROM r, g),
x AS (SELECT n, k, r * k / (n - 1) AS msr, c * n / (k - 1) AS msc, (t - r * k - c * n) / ((n - 1) * (k - 1)) AS mse FROM g, a, b, t)
SELECT round((msr - mse) / (msr + (k - 1) * mse + k * (msc - mse) / n), 6) AS icc FROM x""")
def icc21(spark, sf):
    return statistics.icc21(_runs(spark, sf), "unit", "run", "value").withColumn("icc", F.round("icc", 6))


@query("wilson", """WITH c AS (SELECT event_type, count_if(value > 50) AS k, count(*) AS n FROM events GROUP BY 1), p AS (SELECT *, k::DOUBLE / n AS p, 1.959964 AS z FROM c)
SELECT event_type, round((p + z * z / (2 * n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n), 6) AS low, round((p + z * z / (2 * n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n), 6) AS high FROM p""")
def wilson(spark, sf):
    c = table(spark, sf, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 50).alias("k"), F.count("*").alias("n"))
    w = statistics.wilson(F.col("k"), F.col("n"))
    return c.select("event_type", F.round(w["low"], 6).alias("low"), F.round(w["high"], 6).alias("high"))


@query("compression_stats", "SELECT round(sqrt(greatest(var_samp(value) - avg(0.01), 0)), 6) AS sd_true, round(stddev_samp(value * 0.5 + event_id % 7), 6) AS sd_predicted, round(regr_slope(value, value * 0.5 + event_id % 7), 6) AS slope FROM events")
def compression_stats(spark, sf):
    e = table(spark, sf, "events")
    out = e.agg(*statistics.compression(F.col("value"), F.col("value") * 0.5 + F.col("event_id") % 7, F.lit(0.1)))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("shown_at_cutoffs", "WITH c AS (SELECT unnest([10.0, 30.0, 50.0])::DOUBLE AS cutoff) SELECT cutoff, avg((abs(value - event_id % 20) >= cutoff)::INT)::DOUBLE AS share, count(*) AS n FROM events, c WHERE abs(value) >= 50 GROUP BY 1")
def shown_at_cutoffs(spark, sf):
    e = table(spark, sf, "events").select(F.col("value").alias("truth"), (F.col("value") - F.col("event_id") % 20).alias("shown"))
    return statistics.shown_at(e, "truth", "shown", 50.0, [10.0, 30.0, 50.0])


@query("hashed_subsets", """WITH r AS (SELECT label::BIGINT AS label, vec_id, rep, row_number() OVER (PARTITION BY label, rep ORDER BY ('0x' || substr(md5(rep || '|' || label || '|' || vec_id), 1, 8))::BIGINT, vec_id) AS n FROM embeddings, range(0, 3) t(rep))
SELECT label, rep::BIGINT AS draw, array_to_string(list(vec_id ORDER BY vec_id), ',') AS items FROM r WHERE n <= 4 GROUP BY 1, 2""")
def hashed_subsets(spark, sf):
    v = _embeddings(spark, sf).select(F.col("label").cast("long").alias("label"), "vec_id")
    return statistics.hashed_subsets(v, "label", "vec_id", 4, 3).select("label", "draw", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


def _corpus(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_returnflag").alias("source"), F.col("l_orderkey").alias("doc"), F.when(F.col("l_linenumber") > 1, F.col("l_linenumber").cast("long")).alias("item"), F.col("l_suppkey").alias("scale"), F.array((F.col("l_suppkey") % 5).alias("a"), F.col("l_suppkey") + 100).alias("path"), F.col("l_partkey").alias("ord"))


_CORPUS = "c AS (SELECT l_returnflag AS source, l_orderkey AS doc, CASE WHEN l_linenumber > 1 THEN l_linenumber::BIGINT END AS item, l_suppkey AS scale, [l_suppkey % 5, l_suppkey + 100] AS path FROM lineitem), b AS (SELECT * FROM c UNION ALL SELECT * REPLACE ('(all)' AS source) FROM c)"


@query("counts_by_source", f"""WITH {_CORPUS}, n AS (SELECT source, count(*) AS nodes FROM (SELECT DISTINCT source, doc, unnest(path) AS n FROM b) GROUP BY 1)
SELECT source, count(DISTINCT doc) AS documents, count(*) AS rows, count(item) AS placements, count(DISTINCT CASE WHEN item IS NOT NULL THEN (doc, item) END) AS items, count(DISTINCT (doc, scale)) AS bearing_scales, any_value(nodes) AS nodes FROM b JOIN n USING (source) GROUP BY 1""")
def counts_by_source(spark, sf):
    return report.structure_counts(_corpus(spark, sf), "source", "doc", "item", "scale", "path")


_STRUCTURE = f"""WITH {_CORPUS}, u AS (SELECT DISTINCT doc FROM c), s AS (SELECT u.doc, count(DISTINCT c.item) AS n FROM u LEFT JOIN c ON c.doc = u.doc AND c.item > 2 GROUP BY 1)"""


@query("structure_dist", _STRUCTURE + " SELECT count(n) AS n, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS sd, min(n)::DOUBLE AS least, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.75) AS q3, quantile_cont(n, 0.95) AS p95, max(n)::DOUBLE AS largest FROM s")
def structure_dist(spark, sf):
    c = _corpus(spark, sf)
    n = report.per_unit(c.select("doc").distinct(), c.where("item > 2"), ["doc"], F.col("item"))
    return report.distribution(n, "n").withColumn("mean", F.round("mean", 6)).withColumn("sd", F.round("sd", 6))


@query("nesting_hist", _STRUCTURE + ", l AS (SELECT unnest(range(0, 12)) AS level) SELECT l.level::BIGINT AS level, count(s.n) AS n, round(count(s.n) / sum(count(s.n)) OVER (), 6) AS share, round(sum(count(s.n)) OVER (ORDER BY l.level) / sum(count(s.n)) OVER (), 6) AS cumulative FROM l LEFT JOIN s ON s.n = l.level GROUP BY l.level HAVING l.level BETWEEN (SELECT min(n) FROM s) AND (SELECT max(n) FROM s)")
def nesting_hist(spark, sf):
    c = _corpus(spark, sf)
    out = report.levels(report.per_unit(c.select("doc").distinct(), c.where("item > 2"), ["doc"], F.col("item")), "n")
    return out.withColumn("share", F.round("share", 6)).withColumn("cumulative", F.round("cumulative", 6))


@query("pivot_bucket", "SELECT o_orderpriority, count_if(o_orderstatus = 'F') AS F, count_if(o_orderstatus = 'O') AS O, count_if(o_orderstatus NOT IN ('F', 'O')) AS other FROM orders GROUP BY 1")
def pivot_bucket(spark, sf):
    o = table(spark, sf, "orders").withColumn("b", F.when(F.col("o_orderstatus").isin("F", "O"), F.col("o_orderstatus")).otherwise("other"))
    return o.groupBy("o_orderpriority").pivot("b", ["F", "O", "other"]).count().na.fill(0)


@query("value_counts", "SELECT source AS value, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM documents GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def value_counts(spark, sf):
    return report.value_counts(table(spark, sf, "documents"), "source")


@query("fidelity_bands", """WITH s AS (SELECT event_id, 1 - (event_id % 101) / 100.0 AS sim FROM events)
SELECT CASE WHEN sim >= 1 THEN '100' WHEN sim >= 0.95 THEN '95-100' WHEN sim >= 0.8 THEN '80-95' WHEN sim >= 0.5 THEN '50-80' ELSE '<50' END AS band, count(*) AS n FROM s GROUP BY 1""")
def fidelity_bands(spark, sf):
    sim = (100 - F.col("event_id") % 101) / F.lit(100.0)
    return table(spark, sf, "events").groupBy(report.bands(sim).alias("band")).agg(F.count("*").alias("n"))


@query("summary_text", """SELECT event_type, count(value) AS n,
  format('{:,.2f} ({:,.2f}) · {:,.2f} [{:,.2f}–{:,.2f}]', avg(value), stddev_samp(value), quantile_cont(value, 0.5), quantile_cont(value, 0.25), quantile_cont(value, 0.75)) AS text FROM events GROUP BY 1""")
def summary_text(spark, sf):
    d = report.distribution(table(spark, sf, "events"), "value", ["event_type"])
    return d.select("event_type", "n", report.summary_text(F.col("mean"), F.col("sd"), F.col("median"), F.col("q1"), F.col("q3")).alias("text"))


_TIERS = """t AS (SELECT 0 AS r, 'F' AS tier, o_custkey AS k FROM orders WHERE o_orderstatus = 'F' UNION SELECT 1, 'urgent', o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' UNION SELECT 2, 'all', o_custkey FROM orders)"""


@query("coverage_overlap_incremental", f"""WITH {_TIERS}, j AS (SELECT t.*, c_acctbal AS u, min(r) OVER (PARTITION BY k) = r AS lead FROM t JOIN customer ON c_custkey = k)
SELECT tier, count(*) AS overlapping, count_if(lead)::BIGINT AS incremental, round(sum(CASE WHEN lead THEN u END) / (SELECT sum(c_acctbal) FROM customer), 6) AS usage_share FROM j GROUP BY 1""")
def coverage_overlap_incremental(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    tiers = [("F", o.where("o_orderstatus = 'F'")), ("urgent", o.where("o_orderpriority = '1-URGENT'")), ("all", o)]
    out = report.coverage(table(spark, sf, "customer"), "c_custkey", "c_acctbal", tiers)
    return out.withColumn("usage_share", F.round("usage_share", 6))


@query("set_operations", "SELECT count(*) AS n, sum(k)::BIGINT AS total FROM ((SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders) UNION (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT c_custkey FROM customer))")
def set_operations(spark, sf):
    c, o = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders")
    without = c.subtract(o.select(F.col("o_custkey").alias("k")))
    both = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")).intersect(c)
    return without.union(both).distinct().agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query("multiset_difference", "SELECT source, count(*) AS n FROM (SELECT source FROM documents EXCEPT ALL SELECT source FROM documents WHERE doc_id % 2 = 0) GROUP BY 1")
def multiset_difference(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("source").exceptAll(d.where("doc_id % 2 = 0").select("source")).groupBy("source").agg(F.count("*").alias("n"))


@query("flag_crosstab", "SELECT CASE quality WHEN 1 THEN 'good' ELSE 'poor' END AS quality, count_if(toxic = 1) AS toxic, count_if(toxic = 0) AS clean FROM labels GROUP BY 1")
def flag_crosstab(spark, sf):
    return table(spark, sf, "labels").groupBy(F.when(F.col("quality") == 1, "good").otherwise("poor").alias("quality")).agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean"))


@query("manifest_stats", """SELECT 'vec_id' AS "column", 'bigint' AS type, count_if(vec_id IS NULL) AS nulls, NULL::BIGINT AS dim, NULL::BIGINT AS trues FROM embeddings
UNION ALL SELECT 'embedding', 'array<float>', count_if(embedding IS NULL), max(len(embedding)), NULL FROM embeddings UNION ALL SELECT 'first', 'boolean', 0, NULL, count_if(label = 0) FROM embeddings""")
def manifest_stats(spark, sf):
    e = _embeddings(spark, sf).select("vec_id", "embedding", (F.col("label") == 0).alias("first"))
    return report.manifest(e)


@query("release_projection", "SELECT vec_id, label::BIGINT AS scale_id, len(embedding)::BIGINT AS dim FROM embeddings")
def release_projection(spark, sf):
    from ..sources.release import project

    e = _embeddings(spark, sf).select("vec_id", F.col("label").cast("long").alias("scale_id"), F.col("embedding").alias("item_pooled_m1"), F.lit(1).alias("extra"))
    out, _ = project(e, ["vec_id", "scale_id"], ["item_pooled_"])
    return out.select("vec_id", "scale_id", F.size("item_pooled_m1").cast("long").alias("dim"))


@query("release_columns", "SELECT vec_id, label::BIGINT AS scale_id FROM embeddings")
def release_columns(spark, sf):
    """Two columns of a sealed release of all vectors, opened with the keys of those two."""
    import hashlib

    from ..session import ensure_checkpoint_dir
    from ..sources import release

    e = _embeddings(spark, sf).select("vec_id", F.col("label").cast("long").alias("scale_id"), F.col("embedding").alias("item_pooled_m1"))
    path, key = f"{ensure_checkpoint_dir(spark)}/release-{uuid.uuid4().hex}", hashlib.sha256(b"a key of this query").digest()
    release.publish(e, path, key, ["vec_id", "scale_id"], ["item_pooled_"])
    return release.read_release(spark, path, column_keys={c: release.column_key(key, c) for c in ("vec_id", "scale_id")})


@query("item_match", """WITH a AS (SELECT c.label AS a, v FROM c WHERE label < 5), b AS (SELECT label AS b, v FROM c WHERE label >= 5) SELECT count(*) AS n FROM a, b""".replace("WITH a", _CENTROIDS + ", a"))
def item_match(spark, sf):
    """All scored pairs of two bounded lists."""
    c = _centroids(spark, sf)
    a, b = c.where("label < 5").select(F.col("label").alias("a"), F.col("v").alias("va")), c.where("label >= 5").select(F.col("label").alias("b"), F.col("v").alias("vb"))
    scored = a.join(F.broadcast(b)).select("a", "b", cosine(doubles(F.col("va")), doubles(F.col("vb"))).alias("s"))
    return scored.where(F.col("s").isNotNull()).agg(F.count("*").alias("n"))
