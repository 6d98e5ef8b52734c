"""Queries of the repair steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import biblio, language, text
from ..operators import curation
from .base import query, table


@query("schema_blank_null", """
SELECT p_partkey, nullif(regexp_replace(x, '^[ \\t\\n]+$', ''), '') AS cleaned
FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN chr(9) || ' ' ELSE p_name END AS x FROM part)""")
def schema_blank_null(spark, sf):
    k = F.col("p_partkey") % 4
    x = F.when(k == 0, "").when(k == 1, "  ").when(k == 2, "\t ").otherwise(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", text.blank_to_null(x).alias("cleaned"))


@query("sentinel_null", """
WITH d AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'None' WHEN 1 THEN ' N/A ' WHEN 2 THEN 'UNKNOWN' WHEN 3 THEN '-' WHEN 4 THEN 'nan' WHEN 5 THEN 'Unknown' ELSE source END AS x FROM documents)
SELECT doc_id, CASE WHEN trim(x, ' ') IN ('None','N/A','UNKNOWN','Unknown','nan','-') THEN NULL ELSE x END AS value,
  concat_ws('|', CASE WHEN trim(x, ' ') IN ('None','N/A','UNKNOWN','Unknown','nan','-') THEN NULL ELSE x END, 'kept') AS listed FROM d""")
def sentinel_null(spark, sf):
    k = F.col("doc_id") % 7
    x = F.when(k == 0, "None").when(k == 1, " N/A ").when(k == 2, "UNKNOWN").when(k == 3, "-").when(k == 4, "nan").when(k == 5, "Unknown").otherwise(F.col("source"))
    listed = F.array_join(text.sentinels_in_array(F.array(x, F.lit("kept"), F.lit("N/A"))), "|")
    return table(spark, sf, "documents").select("doc_id", text.sentinel_to_null(x).alias("value"), listed.alias("listed"))


@query("mojibake", """
SELECT p_partkey, replace(regexp_replace(regexp_replace(x, '([A-Za-z])\\?([A-Za-z])', '\\1-\\2', 'g'), '([A-Za-z])\\?([A-Za-z])', '\\1-\\2', 'g'), chr(182), ' ') AS repaired
FROM (SELECT p_partkey, replace(p_name, ' ', '?') || chr(182) || 'end? ok' AS x FROM part)""")
def mojibake(spark, sf):
    x = F.concat(F.replace("p_name", F.lit(" "), F.lit("?")), F.lit("¶end? ok"))
    return table(spark, sf, "part").select("p_partkey", text.unbroken_hyphens(x).alias("repaired"))


_ENTITIES = "x"
for _ in range(4):
    for _a, _b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        _ENTITIES = f"replace({_ENTITIES}, '{_a}', '{_b}')"


@query("html_unescape", f"SELECT page_id, md5({_ENTITIES}) AS digest, length({_ENTITIES}) AS n_chars FROM (SELECT page_id, '&amp;amp;lt;' || html AS x FROM pages)")
def html_unescape(spark, sf):
    x = text.core_entities(F.concat(F.lit("&amp;amp;lt;"), F.col("html")))
    return table(spark, sf, "pages").select("page_id", F.md5(x).alias("digest"), F.length(x).cast("long").alias("n_chars"))


@query("html_unescape_all")
def html_unescape_all(spark, sf):
    """All entities of the pages, over distinct texts."""
    out = text.all_entities(table(spark, sf, "pages").select("page_id", "html"), "html")
    return out.select("page_id", F.length("html").cast("long").alias("n_chars"))


@query("strip_number", """
SELECT p_partkey, CASE WHEN regexp_matches(x, '^\\s*(\\(?[0-9]{1,3}[.)]|[A-Za-z][.)])\\s+') AND length(trim(regexp_replace(x, '^\\s*(\\(?[0-9]{1,3}[.)]|[A-Za-z][.)])\\s+', ''), ' ')) >= 3
  THEN trim(regexp_replace(x, '^\\s*(\\(?[0-9]{1,3}[.)]|[A-Za-z][.)])\\s+', ''), ' ') ELSE x END AS stripped
FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN (p_partkey % 1000) || '. ' || p_name WHEN 1 THEN '(12) ' || p_name WHEN 2 THEN 'a) ' || p_name WHEN 3 THEN '1. ab' ELSE p_name END AS x FROM part)""")
def strip_number(spark, sf):
    k, name = F.col("p_partkey") % 5, F.col("p_name")
    x = F.when(k == 0, F.concat((F.col("p_partkey") % 1000).cast("string"), F.lit(". "), name)).when(k == 1, F.concat(F.lit("(12) "), name)).when(k == 2, F.concat(F.lit("a) "), name)).when(k == 3, "1. ab").otherwise(name)
    return table(spark, sf, "part").select("p_partkey", text.without_number(x).alias("stripped"))


@query("csv_fix", """
WITH a AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN ',"' || s_name WHEN 1 THEN 'a ""b"" ' || s_name WHEN 2 THEN '"' || s_name ELSE ' ' || s_name || '  x ' END AS x FROM supplier),
b AS (SELECT s_suppkey, trim(x, ' ') AS t FROM a),
c AS (SELECT s_suppkey, CASE WHEN t LIKE ',%' THEN ltrim(ltrim(ltrim(t, ','), ' '), '"') ELSE t END AS t FROM b),
d AS (SELECT s_suppkey, replace(t, '""', '"') AS t FROM c),
e AS (SELECT s_suppkey, CASE WHEN length(t) - length(replace(t, '"', '')) = 1 AND (t LIKE '"%' OR t LIKE '%"') THEN replace(t, '"', '') ELSE t END AS t FROM d)
SELECT s_suppkey, trim(regexp_replace(t, '\\s+', ' ', 'g'), ' ') AS fixed FROM e""")
def csv_fix(spark, sf):
    k, name = F.col("s_suppkey") % 4, F.col("s_name")
    x = F.when(k == 0, F.concat(F.lit(',"'), name)).when(k == 1, F.concat(F.lit('a ""b"" '), name)).when(k == 2, F.concat(F.lit('"'), name)).otherwise(F.concat(F.lit(" "), name, F.lit("  x ")))
    return table(spark, sf, "supplier").select("s_suppkey", text.split_cell_repair(x).alias("fixed"))


@query("source_remarks", """
SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Supplied by author.' WHEN 1 THEN 'Supplied by publisher.' ELSE s_name END AS remark, replace('a\\nb ' || s_name, '\\n', chr(10)) AS lines,
  CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE s_name END AS item FROM supplier""")
def source_remarks(spark, sf):
    k, name = F.col("s_suppkey") % 3, F.col("s_name")
    x = F.when(k == 0, "Provided by Author").when(k == 1, "supplied by PUBLISHER.").otherwise(name)
    item = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("Item "), F.col("s_suppkey").cast("string"), F.lit(" statement group"))).otherwise(name)
    return table(spark, sf, "supplier").select("s_suppkey", text.source_remark(x).alias("remark"), text.newlines(F.concat(F.lit("a\\nb "), name)).alias("lines"), text.placeholder_to_null(item).alias("item"))


@query("normalisers", """
SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', ' ', 'g'), ' ') AS match_key, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS name,
  trim(regexp_replace(url || '  x ', '\\s+', ' ', 'g'), ' ') AS plain, '{"a": ' || page_id || '}' AS json FROM pages""")
def normalisers(spark, sf):
    json = text.braces(F.concat(F.lit("Here:\n```json\n{\"a\": "), F.col("page_id").cast("string"), F.lit("}\n``` done")))
    return table(spark, sf, "pages").select("page_id", text.match_key(F.col("url")).alias("match_key"), text.segment(F.col("url")).alias("name"), text.collapsed(F.concat("url", F.lit("  x "))).alias("plain"), json.alias("json"))


@query("classify_source", """
WITH s AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN 'www.site' || page_id || '.org/x (retrieved)' WHEN 2 THEN 'Smith, A. (2004). A title that is long enough. Journal.' WHEN 3 THEN 'scan' || page_id || '.pdf' ELSE '  ' END AS x FROM pages)
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'url' WHEN 1 THEN 'domain' WHEN 2 THEN 'citation' ELSE 'junk' END AS kind,
 CASE page_id % 5 WHEN 0 THEN x WHEN 1 THEN 'https://www.site' || page_id || '.org/x' WHEN 2 THEN x ELSE NULL END AS value FROM s""")
def classify_source(spark, sf):
    k, n = F.col("page_id") % 5, F.col("page_id").cast("string")
    x = F.when(k == 0, F.col("url")).when(k == 1, F.concat(F.lit("www.site"), n, F.lit(".org/x (retrieved)"))).when(k == 2, "Smith, A. (2004). A title that is long enough. Journal.").when(k == 3, F.concat(F.lit("scan"), n, F.lit(".pdf"))).otherwise("  ")
    return table(spark, sf, "pages").select("page_id", biblio.source_kind(x).alias("kind"), biblio.source_value(x).alias("value"))


@query("doi_extract", """
SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN NULL ELSE '10.' || (1000 + doc_id % 9000) || '/abc-' || doc_id END AS doi FROM documents""")
def doi_extract(spark, sf):
    n = F.col("doc_id")
    own = F.concat(F.lit("see 10.1037/t"), F.lpad((n % 100000).cast("string"), 5, "0"), F.lit("-000. "))
    real = F.concat(F.lit("Also 10."), (1000 + n % 9000).cast("string"), F.lit("/ABC‐"), n.cast("string"), F.lit(". End"))
    x = F.when(n % 3 == 0, F.concat(own, real)).when(n % 3 == 1, real).otherwise(own)
    return table(spark, sf, "documents").select("doc_id", biblio.doi_in_text(x).alias("doi"))


@query("doi_clean", """
SELECT doc_id, '10.1234/x' || doc_id || CASE doc_id % 4 WHEN 1 THEN '(a)' ELSE '' END AS doi FROM documents""")
def doi_clean(spark, sf):
    n = F.col("doc_id")
    tail = F.when(n % 4 == 0, ".,;").when(n % 4 == 1, "(A)/full").when(n % 4 == 2, ")].").otherwise("/Abstract/pdf")
    return table(spark, sf, "documents").select("doc_id", biblio.clean_doi(F.concat(F.lit("10.1234/X"), n.cast("string"), tail)).alias("doi"))


@query("doi_url", """
SELECT doc_id, '10.5555/a b' IS NULL AS never, '10.5555/' || doc_id || '(x)' AS doi, '10.1037/t' || lpad((doc_id % 100000)::VARCHAR, 5, '0') || '-000' AS stem FROM documents""")
def doi_url(spark, sf):
    n = F.col("doc_id").cast("string")
    url = F.concat(F.lit("https://doi.org/10.5555%2F"), n, F.lit("%28x%29"))
    path = F.concat(F.lit("/data/in/9999"), F.lpad((F.col("doc_id") % 100000).cast("string"), 5, "0"), F.lit("_full.pdf"))
    return table(spark, sf, "documents").select("doc_id", F.lit(False).alias("never"), biblio.doi_in_url(url).alias("doi"), biblio.doi_of_stem(path).alias("stem"))


@query("doi_corroborate", """
WITH c AS (SELECT doc_id, 'd' || doc_id % 50 AS a, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'd' || doc_id % 50 END AS b, CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'd' || doc_id % 50 ELSE 'other' END AS c FROM documents)
SELECT doc_id, CASE WHEN (b IS NULL OR a = b) AND (c IS NULL OR a = c) THEN a END AS doi FROM c""")
def doi_corroborate(spark, sf):
    n = F.col("doc_id")
    a = F.concat(F.lit("d"), (n % 50).cast("string"))
    b, c = F.when(n % 4 != 0, a), F.when(n % 3 == 1, a).when(n % 3 == 2, "other")
    return table(spark, sf, "documents").select("doc_id", biblio.corroborated(a, b, c).alias("doi"))


@query("fill_only_null", """
WITH d AS (SELECT d.doc_id, d.source, CASE WHEN l.quality = 1 AND d.doc_id % 5 = 0 THEN d.lang END AS v FROM documents d LEFT JOIN labels l USING (doc_id)),
g AS (SELECT source, min(v) AS v, count(DISTINCT v) AS n FROM d GROUP BY source)
SELECT d.doc_id, coalesce(d.v, CASE WHEN g.n = 1 THEN g.v END) AS value FROM d LEFT JOIN g USING (source)""")
def fill_only_null(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    v = F.when((F.col("quality") == 1) & (F.col("doc_id") % 5 == 0), F.col("lang"))
    return curation.propagate(d.select("doc_id", "source", v.alias("value")), "source", "value").select("doc_id", "value")


@query("lang_normalize", """
SELECT doc_id, lang AS code, lang AS locale, CASE lang WHEN 'en' THEN 'en' WHEN 'de' THEN 'de' WHEN 'fr' THEN 'fr' ELSE 'es' END AS named, NULL::VARCHAR AS none FROM documents""")
def lang_normalize(spark, sf):
    x = F.col("lang")
    named = F.when(x == "en", "English (US)").when(x == "de", "GERMAN").when(x == "fr", "French, Canada").otherwise("Spanish")
    d = table(spark, sf, "documents")
    return d.select("doc_id", language.language_code(F.upper(x)).alias("code"), language.language_code(F.concat(x, F.lit("-XX"))).alias("locale"), language.language_code(named).alias("named"), language.language_code(F.lit("Klingon")).alias("none"))


@query("title_language", """
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'ku' WHEN 1 THEN 'tr' ELSE NULL END AS code FROM documents""")
def title_language(spark, sf):
    k = F.col("doc_id") % 4
    x = F.when(k == 0, "Scale of X — Kurdish Version").when(k == 1, "Scale (Turkish version)").when(k == 2, "Scale -- English Version").otherwise("Version of a Scale")
    return table(spark, sf, "documents").select("doc_id", language.language_in_title(x).alias("code"))


@query("permissions", """
SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'public_domain' WHEN 1 THEN 'free_reproduction' WHEN 2 THEN 'contact_publisher_and_author' WHEN 3 THEN 'contact_publisher' WHEN 4 THEN 'contact_author' WHEN 5 THEN 'not_specified' WHEN 6 THEN 'research_teaching' END AS category FROM documents""")
def permissions(spark, sf):
    texts = ["Test content may be reproduced, as it is in the  public domain.", " Test content may be reproduced freely", "Contact Publisher and Corresponding  Author.", "contact publisher", "Contact Corresponding Author.", "Not Specified", "May use for Research/Teaching.", "Ask someone"]
    x = F.element_at(F.array(*map(F.lit, texts)), (F.col("doc_id") % 8 + 1).cast("int"))
    return table(spark, sf, "documents").select("doc_id", language.permission_category(x).alias("category"))


@query("guarded_const", """
WITH d AS (SELECT doc_id, source, CASE WHEN source IN ('src1', 'src2') THEN 'x' ELSE source END AS grade, CASE WHEN source = 'src2' AND doc_id % 2 = 0 THEN 'y' ELSE 'z' END AS other FROM documents)
SELECT doc_id, CASE WHEN source IN ('src1', 'src2') THEN NULL ELSE grade END AS grade, other FROM d""")
def guarded_const(spark, sf):
    d = table(spark, sf, "documents")
    s = F.col("source")
    d = d.select("doc_id", "source", F.when(s.isin("src1", "src2"), "x").otherwise(s).alias("grade"), F.when((s == "src2") & (F.col("doc_id") % 2 == 0), "y").otherwise("z").alias("other"))
    return curation.null_constants(d, "source", [("src1", "grade", "x"), ("src2", "grade", "x"), ("src2", "other", "z")]).select("doc_id", "grade", "other")


@query("renumber_ids", """
WITH p AS (SELECT l_orderkey AS doc, l_linenumber AS item, l_partkey AS cluster, min(l_suppkey * 1000000 + l_partkey) AS first FROM lineitem GROUP BY ALL),
r AS (SELECT *, dense_rank() OVER (PARTITION BY doc ORDER BY first) AS rnk FROM p),
c AS (SELECT DISTINCT doc FROM p GROUP BY doc, item HAVING count(*) > 1)
SELECT r.doc, r.item::BIGINT AS item, r.cluster, CASE WHEN c.doc IS NULL THEN r.item::BIGINT ELSE r.rnk END AS new_id FROM r LEFT JOIN c ON r.doc = c.doc""")
def renumber_ids(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").cast("long").alias("item"), F.col("l_partkey").alias("cluster"), (F.col("l_suppkey") * 1000000 + F.col("l_partkey")).alias("ord"))
    return curation.renumbered(rows, "doc", "item", "cluster", "ord").select("doc", "item", "cluster", "new_id").distinct()


@query("shift_ids", """
SELECT l_orderkey AS doc, (l_linenumber - 1 + CASE WHEN min(l_linenumber - 1) OVER (PARTITION BY l_orderkey) = 0 THEN 1 ELSE 0 END)::BIGINT AS item, l_partkey AS part FROM lineitem""")
def shift_ids(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") - 1).cast("long").alias("item"), F.col("l_partkey").alias("part"))
    least = rows.groupBy("doc").agg(F.min("item").alias("least"))
    return rows.join(least, "doc").select("doc", (F.col("item") + F.when(F.col("least") == 0, 1).otherwise(0)).alias("item"), "part")


@query("author_apa", """
SELECT c_custkey, 'Smith' || c_custkey % 7 || ', M. J., & Jones, A.' AS apa, 'Doe, J., & Roe, R.' AS piped FROM customer""")
def author_apa(spark, sf):
    a = F.array(F.struct(F.concat(F.lit("Smith"), (F.col("c_custkey") % 7).cast("string")).alias("family"), F.lit("Mary jane").alias("given")), F.struct(F.lit(" ").alias("family"), F.lit("X").alias("given")), F.struct(F.lit("Jones").alias("family"), F.lit("A.").alias("given")))
    return table(spark, sf, "customer").select("c_custkey", biblio.authors_apa(a).alias("apa"), biblio.pipe_authors(F.lit("Doe | J. | University of X | Roe | R.")).alias("piped"))


@query("citation_build", """
SELECT c_custkey,
 CASE c_custkey % 3 WHEN 0 THEN 'Smith, A. (2001). Name ' || c_custkey || ' [Database record]. APA PsycTests. https://doi.org/10.1/x' WHEN 1 THEN 'Name ' || c_custkey || ' [Database record]. (n.d.). APA PsycTests. https://doi.org/10.1/x' ELSE 'APA PsycTests database record. https://doi.org/10.1/x' END AS record,
 CASE c_custkey % 3 WHEN 0 THEN 'Smith, A. (2001). Name ' || c_custkey || '. Journal. https://doi.org/10.1/x' WHEN 1 THEN 'Name ' || c_custkey || '. (n.d.). Journal. https://doi.org/10.1/x' END AS source,
 CASE c_custkey % 3 WHEN 0 THEN 2001::BIGINT END AS year FROM customer""")
def citation_build(spark, sf):
    k = F.col("c_custkey") % 3
    who, year = F.when(k == 0, "Smith, A."), F.when(k == 0, "2001.0")
    title = F.when(k < 2, F.concat(F.lit("Name "), F.col("c_custkey").cast("string"), F.lit(". ")))
    source = biblio.source_citation(who, year, title, F.lit("Journal."), F.lit("10.1/x"))
    return table(spark, sf, "customer").select("c_custkey", biblio.record_citation(who, year, title, F.lit("10.1/x")).alias("record"), source.alias("source"), biblio.public_year(source).alias("year"))


@query("citation_parse", """
SELECT c_custkey, 'Smith' AS family, (1990 + c_custkey % 30)::BIGINT AS year, 'A study of ' || c_custkey AS title FROM customer""")
def citation_parse(spark, sf):
    x = F.concat(F.lit("Smith, A., & Doe, B. ("), (1990 + F.col("c_custkey") % 30).cast("string"), F.lit("). A study of "), F.col("c_custkey").cast("string"), F.lit(". Journal, 1."))
    parts = biblio.citation_parts(x)
    return table(spark, sf, "customer").select("c_custkey", parts["family"].alias("family"), parts["year"].cast("long").alias("year"), parts["title"].alias("title"))


@query("title_case", """
SELECT s_suppkey, 'The Scale of Anxiety and UCLA Self-Report: A Test ' || s_suppkey AS title FROM supplier""")
def title_case(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", text.title_case(F.concat(F.lit("the scale of anxiety And UCLA self-report: a test "), F.col("s_suppkey").cast("string"))).alias("title"))


@query("version_split", """
SELECT s_suppkey, 'Worry Scale' AS name, CASE s_suppkey % 5 WHEN 0 THEN 'Short Form' WHEN 1 THEN 'Adapted Version' WHEN 2 THEN 'Revised' WHEN 3 THEN 'Child Version; Short Form' END AS version FROM supplier""")
def version_split(spark, sf):
    from ..operators.versions import split_versions

    k = F.col("s_suppkey") % 5
    x = F.when(k == 0, "Worry Scale (Short Form)").when(k == 1, "Worry Scale--Adapted Version").when(k == 2, "Worry Scale, Revised").when(k == 3, "Worry Scale - Child Version (Short Form)").otherwise("Worry Scale")
    return split_versions(table(spark, sf, "supplier").select("s_suppkey", x.alias("full")), "full", "name", "version").select("s_suppkey", "name", "version")


@query("dup_files", """
WITH f AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 THEN '/d/f' || (p_partkey - 1) || ' (2).pdf' ELSE '/d/f' || p_partkey || '.pdf' END AS path FROM part)
SELECT p_partkey, path FROM f WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.path = regexp_replace(f.path, ' \\([0-9]+\\)', '') AND f.path LIKE '% (%')""")
def dup_files(spark, sf):
    k = F.col("p_partkey")
    path = F.when(k % 3 == 1, F.concat(F.lit("/d/f"), (k - 1).cast("string"), F.lit(" (2).pdf"))).otherwise(F.concat(F.lit("/d/f"), k.cast("string"), F.lit(".pdf")))
    return curation.without_copies(table(spark, sf, "part").select("p_partkey", path.alias("path")), "path")


@query("changed_mask", """
SELECT doc_id, (doc_id % 3 = 0 OR lang = 'fr') AS changed FROM documents""")
def changed_mask(spark, sf):
    before = table(spark, sf, "documents").select("doc_id", "lang", "source")
    after = before.select("doc_id", F.when(F.col("lang") == "fr", None).otherwise(F.col("lang")).alias("lang"), F.when(F.col("doc_id") % 3 == 0, "moved").otherwise(F.col("source")).alias("source"))
    return curation.changed(before, after, "doc_id")
