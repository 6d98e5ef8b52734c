"""Queries on the validity of displayed values and of flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vectors import dot, keyed, unit
from ..operators import report, statistics, validity
from ..operators.hierarchy import vector_sums
from .base import query, table

CUTOFFS, RELATED, DRAWS = [0.05, 0.1, 0.2, 0.3, 0.5, 0.7], [0.3, 0.6], 25


def _u(*parts: str) -> str:
    return f"((('0x' || substr(md5({" || '|' || ".join(parts)}), 1, 8))::BIGINT + 0.5) / 4294967296.0)"


def _pairs(spark, sf):
    """Parts' prices as observed correlations with an error and a displayed value."""
    p = table(spark, sf, "part").select("p_partkey", (F.col("p_retailprice") % 200 / 100 - 1).alias("observed"), (0.02 + F.col("p_size") % 5 / 100).alias("error"))
    return p.withColumn("displayed", 0.9 * F.col("observed") + (F.col("p_partkey") % 21 - 10) / 50)


_DRAWN = f"""WITH p AS (SELECT p_partkey, p_retailprice % 200 / 100 - 1 AS observed, 0.02 + p_size % 5 / 100 AS error FROM part),
d AS (SELECT p.*, 0.9 * observed + (p_partkey % 21 - 10) / 50 AS displayed, draw, observed + error * sqrt(-2 * ln({_u("draw", "p_partkey", "'r'")})) * cos(2 * pi() * {_u("draw", "p_partkey", "'a'")}) AS truth FROM p, range(0, {DRAWS}) g(draw)),
s AS (SELECT t, draw, c AS cutoff, avg((displayed * sign(truth) >= c)::INT) AS share, count(*) AS n FROM d, (SELECT unnest({RELATED})::DOUBLE AS t), (SELECT unnest({CUTOFFS})::DOUBLE AS c) WHERE abs(truth) >= t GROUP BY 1, 2, 3)"""


def _shares(spark, sf):
    return validity.shown_shares(_pairs(spark, sf), ["p_partkey"], "observed", "error", "displayed", CUTOFFS, RELATED, DRAWS)


@query("sensitivity_draws", f"{_DRAWN} SELECT t, cutoff, round(quantile_cont(share, 0.5), 6) AS share, round(quantile_cont(share, 0.025), 6) AS lower, round(quantile_cont(share, 0.975), 6) AS upper, quantile_cont(n::DOUBLE, 0.5) AS related FROM s GROUP BY 1, 2")
def sensitivity_draws(spark, sf):
    out = validity.sensitivity(_shares(spark, sf), CUTOFFS)
    return out.select("t", "cutoff", *(F.round(c, 6).alias(c) for c in ("share", "lower", "upper")), "related")


@query("read_down_cutoffs", f"""{_DRAWN}, r AS (SELECT t, draw, target, max(CASE WHEN share >= target THEN cutoff END) AS reached FROM s, (SELECT unnest([0.5, 0.8, 0.95])::DOUBLE AS target) GROUP BY 1, 2, 3)
SELECT t, target, round(quantile_cont(reached, 0.5), 6) AS cutoff, round(quantile_cont(reached, 0.025), 6) AS lower, round(quantile_cont(reached, 0.975), 6) AS upper FROM r GROUP BY 1, 2""")
def read_down_cutoffs(spark, sf):
    out = validity.read_down(_shares(spark, sf), CUTOFFS, [0.5, 0.8, 0.95])
    return out.select("t", "target", *(F.round(c, 6).alias(c) for c in ("cutoff", "lower", "upper")))


@query("unmarked_keys", f"""WITH e AS (SELECT vec_id, vec_id % 20 AS s, vec_id // 20 % 3 = 0 AS rev, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
u AS (SELECT *, x / nullif(sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 0) AS u FROM e),
g AS (SELECT share, draw FROM (SELECT unnest([0, 0.25, 0.5, 1])::DOUBLE AS share), range(0, 4) r(draw) WHERE draw = 0 OR share NOT IN (0, 1)),
l AS (SELECT g.share, g.draw, v.vec_id, {_u("g.draw", "v.s", "v.vec_id")} < g.share AS lost FROM g, (SELECT DISTINCT vec_id, s FROM u WHERE rev) v),
n AS (SELECT share, draw, s, pos, sum(CASE WHEN rev THEN -u ELSE u END) AS doc, sum(CASE WHEN rev AND NOT lost THEN -u ELSE u END) AS new FROM (SELECT g.share, g.draw, u.*, coalesce(l.lost, false) AS lost FROM g CROSS JOIN u LEFT JOIN l ON l.share = g.share AND l.draw = g.draw AND l.vec_id = u.vec_id) GROUP BY 1, 2, 3, 4),
v AS (SELECT share, draw, s, list(doc ORDER BY pos) AS doc, list(new ORDER BY pos) AS new FROM n GROUP BY 1, 2, 3),
p AS (SELECT a.share, a.draw, a.doc AS da, b.doc AS db, a.new AS na, b.new AS nb, 0.8 * list_cosine_similarity(a.doc, b.doc) + ({_u("a.s", "b.s")} - 0.5) / 2 AS r FROM v a JOIN v b ON a.share = b.share AND a.draw = b.draw AND a.s < b.s),
x AS (SELECT share, draw, 'query' AS condition, list_cosine_similarity(na, db) AS x, r FROM p UNION ALL SELECT share, draw, 'query', list_cosine_similarity(da, nb), r FROM p UNION ALL SELECT share, draw, 'both', list_cosine_similarity(na, nb), r FROM p)
SELECT x.share, x.draw::INTEGER AS draw, condition, round(corr(x, r), 6) AS accuracy, any_value(k.n) AS n_dropped FROM x JOIN (SELECT share, draw, count_if(lost)::BIGINT AS n FROM l GROUP BY 1, 2) k ON x.share = k.share AND x.draw = k.draw GROUP BY 1, 2, 3""")
def unmarked_keys(spark, sf):
    """Twenty scales of all vectors, with reverse keys that are dropped in draws."""
    e = table(spark, sf, "embeddings").select("vec_id", (F.col("vec_id") % 20).alias("s"), (F.floor(F.col("vec_id") / 20) % 3 == 0).alias("rev"), "embedding")
    sums = vector_sums(e.withColumn("k", keyed(F.col("embedding"), F.col("rev"))), ["s"], "k").select("s", unit(F.col("sums")).alias("u"))
    a, b = (sums.select(F.col("s").alias(x), F.col("u").alias(f"u{x}")) for x in "ab")
    observed = 0.8 * dot(F.col("ua"), F.col("ub")) + (validity.uniform(F.col("a"), F.col("b")) - 0.5) / 2
    pairs = a.join(F.broadcast(b), F.col("a") < F.col("b")).select("a", "b", observed.alias("r"))  # twenty rows
    out = validity.unmarked(e, pairs, "s", "vec_id", "embedding", F.col("rev"), "a", "b", "r", [0, 0.25, 0.5, 1], 4)
    return out.select("share", "draw", "condition", F.round("accuracy", 6).alias("accuracy"), "n_dropped")


@query("flag_cross_check", """WITH d AS (SELECT doc_id, length(text) < 400 AS short, text LIKE '%@%' AS contact, lang <> 'en' AS translated FROM documents WHERE source IS NOT NULL AND source <> 'src3'),
a AS (SELECT l.doc_id, quality = 0 AS genuine, d.doc_id IS NOT NULL AS here, short, contact, translated FROM labels l LEFT JOIN d USING (doc_id)),
f AS (SELECT *, 'short' AS flag, short AS f FROM a UNION ALL SELECT *, 'contact', contact FROM a UNION ALL SELECT *, 'translated', translated FROM a UNION ALL SELECT *, 'any_flag', short OR contact OR translated FROM a)
SELECT flag, count(*) AS audited, count_if(here) AS in_corpus, count_if(f) AS flagged, count_if(f AND genuine) AS caught, count_if(here AND genuine) AS genuine_total, count_if(f AND genuine) / nullif(count_if(f), 0) AS precision FROM f GROUP BY 1""")
def flag_cross_check(spark, sf):
    """Flags on the documents of a corpus against an audit that found some of them poor."""
    p = validity.Predicate
    corpus = validity.searchable([p("no source", F.col("source").isNull()), p("left out", F.col("source") == "src3")])
    flags = [p("short", F.length("text") < 400), p("contact", F.contains("text", F.lit("@"))), p("translated", F.col("lang") != "en")]
    return validity.cross_check(table(spark, sf, "labels"), table(spark, sf, "documents"), "doc_id", p("poor", F.col("quality") == 0), flags, corpus)


@query("top_missing", "SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL) ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 20")
def top_missing(spark, sf):
    """The customers of the largest balance that no order covers."""
    covered = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return report.top_missing(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), covered, "c_custkey", "c_acctbal")


@query("run_spread", """SELECT conv_id, count(*) AS n_runs, round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS sd, min(n) AS least, max(n) AS largest, format('{:,.2f} ± {:,.2f} [{:,.2f}, {:,.2f}]', avg(n), stddev_pop(n), min(n)::DOUBLE, max(n)::DOUBLE) AS text
FROM (SELECT conv_id, role, sum(length(text))::BIGINT AS n FROM conversations GROUP BY 1, 2) GROUP BY 1""")
def run_spread(spark, sf):
    """How much the roles of a conversation write: each role is a run."""
    n = table(spark, sf, "conversations").groupBy("conv_id", "role").agg(F.sum(F.length("text")).alias("n"))
    out = statistics.run_spread(n, ["conv_id"], "n")
    return out.select("conv_id", "n_runs", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"), "least", "largest", "text")
