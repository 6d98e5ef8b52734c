"""Queries of joins, reports and records beyond the main ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import biblio, vectors
from ..operators import matching, names, pooling, records, report, search, statistics, trees
from .base import query, table


#: Every form of a translated record's name, around a language.
_FORMS = ("{} version", "x--{}", "({})", "for {} adults", "{} scale", "x {} short 12-item adaptations", "the {}-speaking translated", "plain")


@query("translated_names", "WITH l AS (SELECT unnest([" + ", ".join(f"'{w}'" for w in names.LANGUAGE_WORDS) + "]) AS w), f AS (SELECT unnest([" + ", ".join(f"{{'f': '{f}', 't': {str(f != 'plain').lower()}}}" for f in _FORMS) + "]) AS r) SELECT r_regionkey, w || '|' || r.f AS form, r.t AS translated FROM region, l, f")
def translated_names(spark, sf):
    """The predicate on every language in every form, beside the regions' names."""
    p = table(spark, sf, "region").select("r_regionkey", "r_name")
    languages = F.explode(F.array(*map(F.lit, names.LANGUAGE_WORDS)))
    made = p.withColumn("w", languages).withColumn("f", F.explode(F.array(*map(F.lit, _FORMS))))
    told = F.replace(F.col("f"), F.lit("{}"), F.initcap("w"))
    whole = F.when(F.col("f").startswith("{}"), F.concat(told, F.when(F.col("f") == "{} version", "").otherwise(F.concat(F.lit(" of "), "r_name")))).otherwise(F.concat("r_name", F.lit(" "), told))
    return made.select("r_regionkey", F.concat_ws("|", "w", "f").alias("form"), names.is_translation(whole).alias("translated"))


@query("instrument_names", """
WITH n AS (SELECT p_partkey, p_name || CASE p_partkey % 5 WHEN 0 THEN ' Scale' WHEN 1 THEN ' Testimony' WHEN 2 THEN ' test' WHEN 3 THEN ' (French Version)' ELSE ': German adaptation' END AS x FROM part)
SELECT p_partkey, p_partkey % 5 IN (0, 2) AS instrument, p_partkey % 5 IN (3, 4) AS translation FROM n""")
def instrument_names(spark, sf):
    k = F.col("p_partkey") % 5
    x = F.concat("p_name", F.when(k == 0, " Scale").when(k == 1, " Testimony").when(k == 2, " test").when(k == 3, " (French Version)").otherwise(": German adaptation"))
    return table(spark, sf, "part").select("p_partkey", names.is_instrument(x).alias("instrument"), names.is_translation(x).alias("translation"))


@query("count_gate", """
WITH n AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
SELECT k, (CASE WHEN k % 4 = 0 THEN true ELSE abs(n - k % 7) / greatest(k % 7, 1) <= 0.25 END) AS fits FROM n""")
def count_gate(spark, sf):
    n = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))
    return n.select("k", names.count_fits(F.col("n"), F.when(F.col("k") % 4 != 0, F.col("k") % 7)).alias("fits"))


@query("threshold_status", """
SELECT event_type, count_if(value >= 50) AS passed, bool_and(value >= 1) AS all_pass, count_if(event_id % 9 = 0) AS missing FROM (SELECT event_type, event_id, CASE WHEN event_id % 9 = 0 THEN -1.0 ELSE value END AS value FROM events) GROUP BY 1""")
def threshold_status(spark, sf):
    score = F.when(F.col("event_id") % 9 == 0, F.when(F.col("event_id") % 2 == 0, float("nan"))).otherwise(F.col("value"))
    e = table(spark, sf, "events").select("event_type", "event_id", score.alias("s"))
    return e.groupBy("event_type").agg(F.count_if(names.passes(F.col("s"), F.lit(50.0))).alias("passed"), F.bool_and(names.passes(F.col("s"), F.lit(1.0))).alias("all_pass"), F.count_if(F.col("s").isNull() | F.isnan("s")).alias("missing"))


@query("override_join", """
SELECT d.doc_id, coalesce('page' || l.quality, d.source) AS value FROM documents d LEFT JOIN labels l USING (doc_id)""")
def override_join(spark, sf):
    """The looked-up value wins where there is one."""
    d = table(spark, sf, "documents").select("doc_id", F.col("source").alias("value"))
    return records.overridden(d, table(spark, sf, "labels"), "doc_id", "value", F.concat(F.lit("page"), F.col("quality").cast("string"))).select("doc_id", "value")


@query("alias_remap", """
WITH a AS (SELECT c_custkey AS dropped, c_custkey - 1 AS kept FROM customer WHERE c_custkey % 10 = 5), s AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F')
SELECT c.c_custkey AS k, s.k IS NOT NULL AS covered FROM customer c LEFT JOIN a ON c.c_custkey = a.dropped LEFT JOIN s ON s.k = coalesce(a.kept, c.c_custkey)""")
def alias_remap(spark, sf):
    """A dropped record counts as covered where its kept sibling is."""
    c, o = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders")
    aliases = c.where("k % 10 = 5").select("k", (F.col("k") - 1).alias("kept"))
    return records.covered_through_aliases(c, aliases, o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")), "k", "kept")


@query("best_counterpart", """
WITH s AS (SELECT DISTINCT l_orderkey AS d, l_suppkey AS i FROM lineitem), n AS (SELECT d, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.d AS a, b.d AS b, count(*) AS shared FROM s a JOIN s b ON a.i = b.i AND a.d % 2 = 0 AND b.d % 2 = 1 GROUP BY 1, 2), j AS (SELECT a, b, shared::DOUBLE / (x.n + y.n - shared) AS j FROM p JOIN n x ON x.d = a JOIN n y ON y.d = b)
SELECT a, b, round(j, 6) AS jaccard FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY j DESC, b) AS rn FROM j) WHERE rn = 1""")
def best_counterpart(spark, sf):
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("d"), F.col("l_suppkey").alias("i"))
    return matching.best_counterparts(items, "d", "i", F.col("d") % 2 == 0, F.col("d") % 2 == 1).select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query("fill_items", """
SELECT s_nationkey AS record, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS item_id, s_name AS item FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey <> 0""")
def fill_items(spark, sf):
    """Items of gated records, numbered within the record."""
    gate = table(spark, sf, "nation").where("n_regionkey <> 0").select(F.col("n_nationkey").alias("s_nationkey"))
    return records.numbered_items(table(spark, sf, "supplier"), gate, "s_nationkey", "s_suppkey", "s_name")


@query("node_vectors", """
SELECT n.n_nationkey AS node, CASE WHEN n.n_nationkey % 3 = 0 THEN 'direct' WHEN e.vec_id IS NOT NULL THEN 'sidecar' END AS origin, coalesce(d.embedding, e.embedding)[1]::DOUBLE AS first, len(coalesce(d.embedding, e.embedding))::BIGINT AS dim
FROM nation n LEFT JOIN embeddings d ON d.vec_id = n.n_nationkey AND n.n_nationkey % 3 = 0 LEFT JOIN embeddings e ON e.vec_id = n.n_nationkey AND n.n_nationkey % 3 = 1""")
def node_vectors(spark, sf):
    """A node's own vector, else that of its name in the sidecar."""
    e, n = table(spark, sf, "embeddings"), table(spark, sf, "nation").select(F.col("n_nationkey").alias("node"), "n_name")
    own = e.where("vec_id % 3 = 0").select(F.col("vec_id").alias("node"), F.col("embedding").alias("v"))
    side = n.join(e, n.node == e.vec_id).where("node % 3 = 1").select("n_name", F.col("embedding").alias("v"))
    out = records.vector_or_name(n, own, side, "node", "n_name", "v")
    return out.select("node", "origin", F.get("v", F.lit(0)).cast("double").alias("first"), F.when(F.col("v").isNotNull(), F.size("v")).cast("long").alias("dim"))


@query("verdict_lookup", """
SELECT c_custkey AS doc, CASE WHEN c_custkey % 4 = 0 THEN 'own' WHEN c_custkey % 4 = 1 AND c_custkey % 20 = 1 THEN 'cached' END AS doi FROM customer""")
def verdict_lookup(spark, sf):
    """Accepted verdicts fill documents that have no value at all; rejected ones fill nothing."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("doc"), F.when(F.col("c_custkey") % 4 == 0, "own").alias("doi"))
    cache = c.select("doc").where("doc % 4 = 1").select("doc", F.lit("cached").alias("found"), (F.col("doc") % 20 == 1).alias("accepted"))
    return records.filled(c, cache, "doc", "doi", "found", "accepted")


@query("candidate_check", """
SELECT c_custkey, c_custkey % 3 = 0 AS fits FROM customer""")
def candidate_check(spark, sf):
    k = F.col("c_custkey")
    work = F.struct(F.when(k % 3 < 2, "A Study of Worry").otherwise("Something else entirely").alias("title"), F.when(k % 3 == 1, 1990).otherwise(2001).alias("year"), F.array(F.lit("Doe"), F.lit("Smith")).alias("families"))
    return table(spark, sf, "customer").select("c_custkey", biblio.candidate_fits(F.lit("a study of worry"), F.lit("smith"), F.lit(2000), work).alias("fits"))


@query("lookup_modes", """
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'citation' WHEN 1 THEN 'structured' ELSE 'insufficient' END AS mode FROM customer""")
def lookup_modes(spark, sf):
    k = F.col("c_custkey") % 3
    citation = F.when(k == 0, "Smith, A. (2004). A title that is long enough. Journal.")
    return table(spark, sf, "customer").select("c_custkey", biblio.lookup_mode(citation, F.when(k == 1, "t"), F.when(k == 1, "a"), F.when(k == 1, 2000)).alias("mode"))


@query("extraction_tally", """
WITH c AS (SELECT doc_id, unnest(['items', 'scales']) AS extractor, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
s AS (SELECT extractor, CASE WHEN extractor = 'items' AND toxic = 1 THEN 'failed' WHEN quality IS NOT NULL THEN 'done' ELSE 'pending' END AS state FROM c)
SELECT extractor, state, count(*) AS n FROM s GROUP BY 1, 2""")
def extraction_tally(spark, sf):
    from ..sources.readers import cell_states

    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    content, error = F.when(F.col("quality").isNotNull(), "{}"), F.when(F.col("toxic") == 1, "boom")
    store = d.select("doc_id", content.alias("items_content"), error.alias("items_error"), F.lit(1).alias("items_attempts"), content.alias("scales_content"), F.lit(None).cast("string").alias("scales_error"), F.lit(1).alias("scales_attempts"))
    return cell_states(store, "doc_id", ["items", "scales"]).groupBy("extractor", "state").agg(F.count("*").alias("n"))


@query("fidelity_block", """
WITH i AS (SELECT l_orderkey AS doc, l_linenumber AS item, min(1 - (l_partkey % 50) / 100.0) AS sim FROM lineitem GROUP BY 1, 2), d AS (SELECT doc, round(avg(sim), 9) AS m, round(min(sim), 9) AS lo FROM i GROUP BY 1)
SELECT (SELECT count(*) FROM i) AS items, (SELECT count_if(round(sim, 9) < 0.95) FROM i) AS items_below, count(*) AS docs, count_if(m < 0.95) AS docs_below_mean, count_if(lo < 0.95) AS docs_below_min, round((SELECT quantile_cont(sim, 0.05) FROM i), 6) AS p05 FROM d""")
def fidelity_block(spark, sf):
    """Similarities once an item, then by document: means and least."""
    sim = F.lit(1.0) - (F.col("l_partkey") % 50) / F.lit(100.0)
    items = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("item")).agg(F.min(sim).alias("sim"))
    return records.fidelity(items, "doc", "sim", 0.95).withColumn("p05", F.round("p05", 6))


@query("coverage_by_group", """
WITH c AS (SELECT c_mktsegment AS grp, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS covered, c_acctbal AS u FROM customer)
SELECT grp, covered, count(*) AS n, round(sum(u) / sum(sum(u)) OVER (PARTITION BY grp), 6) AS usage_share FROM c GROUP BY 1, 2""")
def coverage_by_group(spark, sf):
    seen = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    out = records.coverage_by(table(spark, sf, "customer"), seen, "c_custkey", "c_mktsegment", "c_acctbal")
    return out.select(F.col("c_mktsegment").alias("grp"), "covered", "n", F.round("usage_share", 6).alias("usage_share"))


@query("tier_descriptives", """
WITH n AS (SELECT o_orderstatus AS tier, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus), b AS (SELECT * FROM n UNION ALL SELECT '(all)', n FROM n)
SELECT tier, count(*) AS docs, round(avg(n), 6) AS mean, quantile_cont(n, 0.1) AS q10, quantile_cont(n, 0.9) AS q90, round(avg((n = 1)::INT), 6) AS single, round(avg((n <= 3)::INT), 6) AS short FROM b GROUP BY 1""")
def tier_descriptives(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    n = o.join(li, o.o_orderkey == li.l_orderkey).groupBy("o_orderkey", F.col("o_orderstatus").alias("tier")).agg(F.count("*").alias("size"))
    out = records.descriptives_by(n, "tier", "size", 3).withColumnRenamed("n", "docs")
    return out.select("tier", "docs", "q10", "q90", *[F.round(c, 6).alias(c) for c in ("mean", "single", "short")])


@query("text_lengths", """
SELECT lang, count(*) AS n, round(avg(length(text)), 4) AS mean, quantile_cont(length(text), 0.5) AS median FROM documents GROUP BY 1""")
def text_lengths(spark, sf):
    d = table(spark, sf, "documents").select("lang", F.length("text").alias("chars"))
    return report.distribution(d, "chars", ["lang"]).select("lang", "n", F.round("mean", 4).alias("mean"), "median")


@query("worst_first", """
SELECT kind, id, similarity FROM (SELECT CASE WHEN p_partkey % 4 = 0 THEN 'scale' ELSE 'item' END AS kind, p_partkey AS id, p_size / 50.0 AS similarity FROM part) ORDER BY kind <> 'scale', similarity, id LIMIT 25""")
def worst_first(spark, sf):
    p = table(spark, sf, "part").select(F.when(F.col("p_partkey") % 4 == 0, "scale").otherwise("item").alias("kind"), F.col("p_partkey").alias("id"), (F.col("p_size") / 50.0).alias("similarity"))
    return records.worst_first(p, "kind", "scale", "similarity", "id", 25)


@query("newest_kept", """
SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n > 3""")
def newest_kept(spark, sf):
    """What a retention of three newest a user lets go."""
    return records.beyond_newest(table(spark, sf, "events").select("user_id", "event_id", "ts"), "user_id", "ts", "event_id", 3).select("user_id", "event_id")


@query("seeded_order", """
SELECT c_custkey, row_number() OVER (ORDER BY md5('42|' || c_custkey), c_custkey) AS place FROM customer ORDER BY place LIMIT 100""")
def seeded_order(spark, sf):
    """The first hundred in an order drawn by a seed; the same in any engine."""
    return records.seeded(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 42, 100)


@query("set_diff", """
SELECT side, count(*) AS n FROM (SELECT 'old' AS side, * FROM (SELECT text FROM documents WHERE doc_id % 3 <> 0 EXCEPT ALL SELECT text FROM documents WHERE doc_id % 3 <> 1)
UNION ALL SELECT 'new', * FROM (SELECT text FROM documents WHERE doc_id % 3 <> 1 EXCEPT ALL SELECT text FROM documents WHERE doc_id % 3 <> 0)) GROUP BY 1""")
def set_diff(spark, sf):
    d = table(spark, sf, "documents")
    changes = records.multiset_changes(d.where("doc_id % 3 <> 0").select("text"), d.where("doc_id % 3 <> 1").select("text"))
    return changes.groupBy("side").agg(F.count("*").alias("n"))


@query("set_jaccard", """
WITH s AS (SELECT l_orderkey AS d, list(DISTINCT l_suppkey) AS s, list(DISTINCT l_partkey % 100 + 1) AS p FROM lineitem GROUP BY 1)
SELECT d, round(len(list_intersect(s, p))::DOUBLE / (len(s) + len(p) - len(list_intersect(s, p))), 6) AS j FROM s""")
def set_jaccard(spark, sf):
    s = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("d")).agg(F.collect_set("l_suppkey").alias("s"), F.collect_set((F.col("l_partkey") % 100 + 1)).alias("p"))
    return s.select("d", F.round(matching.jaccard(F.col("s"), F.col("p")), 6).alias("j"))


@query("page_fields", """
SELECT p_partkey, p_name AS title, 'Doe, J.' AS authors, (1990 + p_partkey % 30)::VARCHAR AS year, '10.1037/t' || lpad((p_partkey % 100000)::VARCHAR, 5, '0') || '-000' AS doi, NULL::VARCHAR AS language FROM part""")
def page_fields(spark, sf):
    """Fields of a first page by their labels."""
    from ..functions.pages import page_fields as parse

    k = F.col("p_partkey")
    page = F.concat(F.col("p_name"), F.lit("\nDOI: https://doi.org/10.1037/t"), F.lpad((k % 100000).cast("string"), 5, "0"), F.lit("-000\nInstrument Type:\n Rating Scale\nPublication Year: "), (1990 + k % 30).cast("string"), F.lit("\nAuthor(s): Doe, J.\nTest Format:\n Items\nPermissions:\nContact Publisher.\n"))
    fields = parse(page)
    return table(spark, sf, "part").select("p_partkey", *[fields[c].alias(c) for c in ("title", "authors", "year", "doi", "language")])


@query("telemetry", """
SELECT event_id, round(value / 1000, 6) AS seconds, round(event_id / nullif(value / 1000, 0), 4) AS rate FROM events""")
def telemetry(spark, sf):
    made = records.throughput(F.col("value") * 1e6, F.col("event_id"))
    return table(spark, sf, "events").select("event_id", F.round(made["seconds"], 6).alias("seconds"), F.round(made["rate"], 4).alias("rate"))


@query("subtree_rows", """
SELECT count(*) AS n, count(DISTINCT l_orderkey) AS docs FROM lineitem WHERE l_suppkey % 5 = 2""")
def subtree_rows(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.array((F.col("l_suppkey") % 5), F.col("l_suppkey") + 100).alias("path"))
    return trees.subtree(rows, "path", F.array(F.lit(2).cast("long"))).agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("docs"))


@query("derived_items", """
SELECT l_orderkey AS doc, l_linenumber::BIGINT AS item, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2""")
def derived_items(spark, sf):
    """A document's items, each once by its first placement."""
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").cast("long").alias("item"), F.col("l_partkey").alias("part"))
    return pooling.first_values(rows, ["doc", "item"], ["part"], ["part"])


@query("run_grid", """
WITH r AS (SELECT event_id // 3 AS unit, event_id % 3 AS run, event_type AS t FROM events)
SELECT unit, max(CASE WHEN run = 0 THEN t END) AS r0, max(CASE WHEN run = 1 THEN t END) AS r1, max(CASE WHEN run = 2 THEN t END) AS r2, count(DISTINCT t) > 1 AS deviates FROM r GROUP BY 1""")
def run_grid(spark, sf):
    r = table(spark, sf, "events").select(F.floor(F.col("event_id") / 3).alias("unit"), F.concat(F.lit("r"), (F.col("event_id") % 3).cast("string")).alias("run"), F.col("event_type").alias("t"))
    return records.grid(r, "unit", "run", ["r0", "r1", "r2"], "t")


@query("keyed_means", """
SELECT user_id, round(avg(CASE WHEN event_id % 2 = 0 THEN 100 - value ELSE value END), 6) AS m FROM events WHERE event_id % 11 <> 0 GROUP BY 1""")
def keyed_means(spark, sf):
    """Means of responses with reversed ones turned round; missing responses are passed over."""
    given = F.when(F.col("event_id") % 11 != 0, F.col("value"))
    out = records.keyed_means(table(spark, sf, "events"), "user_id", given, F.col("event_id") % 2 == 0, 100)
    return out.select("user_id", F.round("mean", 6).alias("m"))


@query("inferred_keys", """
WITH d AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), e AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM d)
SELECT a.pos::BIGINT AS item, corr(b.x, a.x) < 0 AS reversed FROM e a JOIN e b ON a.vec_id = b.vec_id AND b.pos = 1 WHERE a.pos > 1 GROUP BY 1""")
def inferred_keys(spark, sf):
    """Items that correlate negatively with the first one."""
    return records.inferred_keys(table(spark, sf, "embeddings"), "embedding")


@query("partial_keys", """
WITH k AS (SELECT label::BIGINT AS label, vec_id, vec_id % 5 = 0 AS rev, ('0x' || substr(md5('7|' || vec_id), 1, 8))::BIGINT % 2 = 0 AS marked FROM embeddings)
SELECT label, count_if(rev) AS reversed, count_if(rev AND marked) AS marked FROM k GROUP BY 1""")
def partial_keys(spark, sf):
    """A share of the reverse keys, dropped by hash, so that any engine drops the same."""
    e = table(spark, sf, "embeddings")
    rev, marked = F.col("vec_id") % 5 == 0, statistics.draw(F.lit(7), F.col("vec_id")) % 2 == 0
    return e.groupBy(F.col("label").cast("long").alias("label")).agg(F.count_if(rev).alias("reversed"), F.count_if(rev & marked).alias("marked"))


@query("query_pooling", """
WITH e AS (SELECT unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS pos, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y))) AS n FROM embeddings WHERE vec_id < 3)
SELECT (pos - 1)::BIGINT AS pos, round(avg(x / n), 6) AS x FROM e GROUP BY 1""")
def query_pooling(spark, sf):
    rows = table(spark, sf, "embeddings").where("vec_id < 3")
    out = pooling.keyed_centroid(rows, [], "embedding", F.lit(False))
    return out.select(F.posexplode("centroid").alias("pos", "x")).select(F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x"))


@query("label_search", """
WITH q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = 7) SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 6) AS similarity FROM embeddings, q WHERE label = 3 ORDER BY list_cosine_similarity(embedding::DOUBLE[], q) DESC, vec_id LIMIT 5""")
def label_search(spark, sf):
    e = table(spark, sf, "embeddings")
    q = e.where("vec_id = 7").first()["embedding"]
    out = search.top_k(e.where("label = 3"), "embedding", vectors.literal_vector(q), 5, tie=["vec_id"])
    return out.select("vec_id", F.round("similarity", 6).alias("similarity"))


@query("assembled")
def assembled(spark, sf):
    """The build's steps on placements made of the documents' lines, in their fixed order."""
    from .assemble import build, placements

    return build(placements(spark, sf))[0].select("path", "item_item_id", "flag_item_translated")


@query("report_attrition", """
SELECT lang, count(*) AS before, count_if(length(text) > 200) AS after FROM documents GROUP BY 1""")
def report_attrition(spark, sf):
    return records.remaining_by(table(spark, sf, "documents"), "lang", F.length("text") <= 200)


@query("first_observed", """
SELECT l_suppkey AS k, first(l_orderkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS doc FROM lineitem GROUP BY 1""")
def first_observed(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_orderkey").alias("doc"), "l_linenumber", "l_partkey")
    return matching.best_per_group(rows, ["k"], ["doc", "l_linenumber", "l_partkey"]).select("k", "doc")


@query("dropped_columns", "SELECT doc_id, lang FROM documents")
def dropped_columns(spark, sf):
    from .assemble import without_telemetry

    d = table(spark, sf, "documents").select("doc_id", "lang", F.lit(1).alias("items_extractor_ttft"), F.lit(2).alias("meta_extractor_attempts"))
    return without_telemetry(d)


@query("value_guards", """
SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN NULL WHEN source = 'src1' THEN 'open' ELSE 'choice' END, CASE WHEN source IN ('src1', 'src2') THEN 'rating_scale' END) AS item_type FROM documents""")
def value_guards(spark, sf):
    """Defaults by source, only where the value is null."""
    s = F.col("source")
    d = table(spark, sf, "documents").select("doc_id", "source", F.when(F.col("doc_id") % 3 == 0, None).when(s == "src1", "open").otherwise("choice").alias("item_type"))
    return d.select("doc_id", records.with_default(F.col("item_type"), F.when(s.isin("src1", "src2"), "rating_scale")).alias("item_type"))


@query("flagged_documents", """
SELECT source, bool_or(CASE WHEN quality IS NOT NULL THEN toxic = 1 END) AS flagged, count(quality) AS checked FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def flagged_documents(spark, sf):
    """Three-valued or: true wins, null only where nothing could be checked."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return records.any_flag(d, "source", F.when(F.col("quality").isNotNull(), F.col("toxic") == 1), "quality")


@query("streamed_counts", """
SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def streamed_counts(spark, sf):
    """The same counts kept by a stream that reads the table in small batches."""
    from ..streaming.stream import counts_of

    out = counts_of(spark, sf, "events", "event_type", "value")
    return out.select("event_type", "n", F.round("total", 4).alias("total"))


@query("item_assignment")
def item_assignment(spark, sf):
    """The turns of a conversation matched one to one with their own shortened texts."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("item"), "text")
    return matching.matched_items(c, c.withColumn("text", F.expr("substring(text, 1, greatest(length(text) - 10, 0))")), "doc", "item", "text")


@query("tree_validity")
def tree_validity(spark, sf):
    """Departures of region trees from trees that lack a nation or misspell one."""
    n = table(spark, sf, "nation")
    node = lambda name: F.struct(name.alias("scale_name"))
    short = n.where("n_nationkey % 7 <> 0").withColumn("n_name", F.when(F.col("n_nationkey") % 5 == 0, F.concat("n_name", F.lit(" x y z w v"))).otherwise(F.col("n_name")))
    as_tree = lambda df: df.groupBy("n_regionkey").agg(F.to_json(F.struct(F.sort_array(F.collect_list(node(F.col("n_name")))).alias("scales"))).alias("tree"))
    both = as_tree(n).withColumnRenamed("tree", "expected").join(as_tree(short).withColumnRenamed("tree", "actual"), "n_regionkey")
    return matching.compared_trees(both, "n_regionkey", "expected", "actual")


@query("tree_reliability")
def tree_reliability(spark, sf):
    """Similarity of the trees of three runs, each of which leaves out other nations."""
    n = table(spark, sf, "nation").crossJoin(spark.range(3).withColumnRenamed("id", "run")).where("(n_nationkey + run) % 4 <> 0")
    tree = F.to_json(F.sort_array(F.collect_list(F.struct(F.col("n_name").alias("name")))))
    return matching.tree_agreement(n.groupBy("n_regionkey", "run").agg(tree.alias("tree")), "n_regionkey", "run", "tree")
