"""Queries of linking, reports, kinds, countries, workbooks and importers, and their SQL; catalog adds them to its own."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import countries as places
from ..functions import kinds, text
from ..operators import golden, linking, reports
from ..operators.tables import shared_dir, task_parts
from ..sources import workbooks
from . import importers as route

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("destination_surfaces", """SELECT p_partkey, kind, surface FROM (SELECT p_partkey, 'name' AS kind, p_name AS surface FROM part UNION ALL SELECT p_partkey, 'alias', CASE WHEN p_size > 25 THEN p_brand ELSE 'N/A' END FROM part UNION ALL SELECT p_partkey, 'parent', p_type FROM part) WHERE surface <> 'N/A'""")
def destination_surfaces(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("alias", F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise("N/A"))
    return linking.surfaces(p, "p_partkey", {"name": "p_name", "alias": "alias", "parent": "p_type"})


@query("representatives", """SELECT p_brand, p_name, CAST(count(*) AS BIGINT) AS "N_FILAS", CAST(sum(p_size) AS BIGINT) AS p_size FROM part GROUP BY ALL""")
def representatives(spark, sf_dir):
    return linking.representatives(table(spark, sf_dir, "part"), ["p_brand", "p_name"], ["p_size"])


def _names(spark, sf_dir, low, high, key):
    """Distinct part names of the brands numbered low to high, numbered by their smallest key."""
    p = table(spark, sf_dir, "part").filter(F.substring("p_brand", 7, 9).cast("int").between(low, high))
    return p.groupBy(F.upper("p_name").alias("name")).agg(F.min("p_partkey").alias(key))


_SIDES = """a AS (SELECT upper(p_name) AS name, min(p_partkey) AS key_a FROM part WHERE CAST(substr(p_brand, 7) AS INTEGER) BETWEEN 1 AND 12 GROUP BY 1), b AS (SELECT upper(p_name) AS name, min(p_partkey) AS key_b FROM part WHERE CAST(substr(p_brand, 7) AS INTEGER) BETWEEN 13 AND 25 GROUP BY 1)"""


@query("shared_word_pairs", f"""WITH {_SIDES}, wa AS (SELECT DISTINCT key_a, unnest(string_split(name, ' ')) AS wa FROM a), wb AS (SELECT DISTINCT key_b, unnest(string_split(name, ' ')) AS wb FROM b),
    x AS (SELECT * FROM wa WHERE length(wa) >= 3), y AS (SELECT * FROM wb WHERE length(wb) >= 3)
    SELECT key_a, key_b, CAST(count(DISTINCT wa) AS BIGINT) AS shared FROM x JOIN y ON levenshtein(wa, wb) <= 1 GROUP BY ALL""")
def shared_word_pairs(spark, sf_dir):
    return linking.shared_word_pairs(_names(spark, sf_dir, 1, 12, "key_a"), _names(spark, sf_dir, 13, 25, "key_b"), "key_a", "key_b")


_INITIALS = "array_to_string(list_transform(string_split(name, ' '), lambda w: w[1]), '')"


@query("acronym_pairs", f"""WITH {_SIDES}, n AS (SELECT key_a, {_INITIALS} AS s FROM a WHERE len(string_split(name, ' ')) BETWEEN 2 AND 5), m AS (SELECT DISTINCT {_INITIALS} AS s, min(key_b) AS key_b FROM b WHERE len(string_split(name, ' ')) BETWEEN 2 AND 5 GROUP BY 1)
    SELECT key_a, key_b FROM n JOIN m USING (s)""")
def acronym_pairs(spark, sf_dir):
    b = _names(spark, sf_dir, 13, 25, "key_b")
    short = b.select(F.array_join(F.transform(F.split("name", " "), lambda w: F.substring(w, 1, 1)), "").alias("name"), "key_b").groupBy("name").agg(F.min("key_b").alias("key_b"))
    return linking.acronym_pairs(_names(spark, sf_dir, 1, 12, "key_a"), short, "key_a", "key_b")


def _links(spark, sf_dir):
    """Orders as links: customer an entity, priority's number the destination, total the score."""
    o = table(spark, sf_dir, "orders")
    level = F.element_at(F.array(*map(F.lit, linking.LEVELS)), (F.col("o_orderkey") % 4 + 1).cast("int"))
    band = F.element_at(F.array(*map(F.lit, linking.BANDS)), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return o.select(F.col("o_custkey").alias("entity"), (F.col("o_orderkey") % 5).alias("destination"), "o_orderkey", level.alias("NIVEL"), band.alias("BANDA"), F.col("o_totalprice").alias("score"))


_LINKS = """l AS (SELECT o_custkey AS entity, o_orderkey % 5 AS destination, o_orderkey, ['MATRIZ', 'EMPRESA', 'GRUPO', 'REVISAR'][o_orderkey % 4 + 1] AS "NIVEL", ['A', 'B', 'C'][o_orderkey % 3 + 1] AS "BANDA", o_totalprice AS score, (o_orderkey % 4) * 10 + o_orderkey % 3 AS r FROM orders)"""


@query("best_pair_per_entity", f"""WITH {_LINKS}, k AS (SELECT *, row_number() OVER (PARTITION BY entity, destination ORDER BY r, score DESC, o_orderkey) AS k FROM l) SELECT entity, destination, o_orderkey, "NIVEL", "BANDA", score FROM k WHERE k = 1""")
def best_pair_per_entity(spark, sf_dir):
    return linking.best_per_entity(_links(spark, sf_dir), "entity", "destination", "o_orderkey")


@query("principal_links", f"""WITH {_LINKS}, k AS (SELECT *, row_number() OVER (PARTITION BY entity, destination ORDER BY r, score DESC, o_orderkey) AS k FROM l) SELECT entity, destination, o_orderkey, "NIVEL", "BANDA", score, row_number() OVER (PARTITION BY entity ORDER BY r, score DESC, destination) = 1 AS "PRINCIPAL" FROM k WHERE k = 1""")
def principal_links(spark, sf_dir):
    return linking.mark_principal(best_pair_per_entity(spark, sf_dir), "entity", "destination")


@query("web_propagation", """WITH d AS (SELECT page_id, regexp_extract(url, '://([^/?#]+)', 1) AS domain FROM pages), l AS (SELECT page_id % 7 AS entity, page_id, CASE WHEN page_id % 21 = 0 THEN 'EMPRESA' ELSE 'REVISAR' END AS "NIVEL", 'A' AS "BANDA" FROM pages),
    h AS (SELECT DISTINCT entity, domain FROM l JOIN d USING (page_id) WHERE "NIVEL" = 'EMPRESA' AND domain <> '')
    SELECT entity, page_id, "NIVEL", "BANDA", 'nombre' AS "VIA" FROM l UNION ALL SELECT * FROM (SELECT DISTINCT entity, page_id, 'GRUPO', 'B', 'web' FROM h JOIN d USING (domain) WHERE (entity, page_id) NOT IN (SELECT (entity, page_id) FROM l))""")
def web_propagation(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    links = pages.select((F.col("page_id") % 7).alias("entity"), "page_id", F.when(F.col("page_id") % 21 == 0, "EMPRESA").otherwise("REVISAR").alias("NIVEL"), F.lit("A").alias("BANDA"))
    return linking.propagate_web(links, pages.select("page_id", F.regexp_extract("url", "://([^/?#]+)", 1).alias("domain")), "entity", "page_id")


@query("decisions_join", """WITH p AS (SELECT s_suppkey, 'automatico' AS verdict FROM supplier), d AS (SELECT s_suppkey, CASE WHEN s_suppkey % 9 = 0 THEN 'SI' ELSE 'NO' END AS "DECISION" FROM supplier WHERE s_acctbal < 3000)
    SELECT s_suppkey, verdict, "DECISION", CASE WHEN verdict IS NULL THEN 'decision' WHEN "DECISION" IS NULL THEN 'motor' ELSE 'ambos' END AS "ORIGEN", coalesce("DECISION", verdict) AS "FINAL" FROM p FULL JOIN d USING (s_suppkey)""")
def decisions_join(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    decided = s.filter("s_acctbal < 3000").select("s_suppkey", F.when(F.col("s_suppkey") % 9 == 0, "SI").otherwise("NO").alias("decision"))
    return linking.apply_decisions(s.select("s_suppkey", F.lit("automatico").alias("verdict")), decided, ["s_suppkey"])


@query("entity_sheet", """WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS k FROM c),
    t AS (SELECT o_custkey, string_agg(o_orderpriority, ' | ' ORDER BY k) AS o_orderpriority FROM k WHERE k <= 3 GROUP BY 1)
    SELECT o_custkey, CAST(count(*) AS BIGINT) AS "N_FILAS", CAST(sum(o_orderkey) AS BIGINT) AS o_orderkey, any_value(t.o_orderpriority) AS o_orderpriority FROM orders JOIN t USING (o_custkey) GROUP BY o_custkey""")
def entity_sheet(spark, sf_dir):
    return linking.entity_sheet(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderkey"], ["o_orderpriority"])


@query("same_country", """SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN 'SIN DATO' WHEN n_nationkey % 3 = 0 THEN 'SÍ' ELSE 'NO' END AS label FROM nation""")
def same_country(spark, sf_dir):
    n = F.col("n_nationkey")
    codes = F.when(n % 4 == 0, "").when(n % 3 == 0, F.concat_ws("|", F.lit("XX"), "n_name")).otherwise("XX|YY")
    return table(spark, sf_dir, "nation").select("n_nationkey", linking.same_country(F.col("n_name"), codes).alias("label"))


def _rows(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    return t.select(F.col("l_orderkey").alias("group"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rec_id"), F.col("l_returnflag").alias("src"), F.col("l_partkey").cast("string").alias("name"), F.when(F.col("l_suppkey") % 5 == 0, "").otherwise((F.col("l_suppkey") % 5).cast("string")).alias("base"))


_ROWS = "r AS (SELECT l_orderkey AS g, l_orderkey * 10 + l_linenumber AS rec_id, l_returnflag AS src, CAST(l_partkey AS VARCHAR) AS name, CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE CAST(l_suppkey % 5 AS VARCHAR) END AS base FROM lineitem)"


@query("composition_by_source", f"""WITH {_ROWS}, n AS (SELECT g, count(DISTINCT src) AS n FROM r GROUP BY g), e AS (SELECT g, src, count(*) AS rows FROM r GROUP BY ALL)
    SELECT src, CAST(sum(rows) AS BIGINT) AS "rows", CAST(count(*) AS BIGINT) AS entities, CAST(count(*) FILTER (n > 1) AS BIGINT) AS linked FROM e JOIN n USING (g) GROUP BY src""")
def composition_by_source(spark, sf_dir):
    return reports.composition(_rows(spark, sf_dir))


@query("multi_source_entities", f"""WITH {_ROWS} SELECT g AS "group", CAST(count(DISTINCT src) AS BIGINT) AS sources, CAST(count(*) AS BIGINT) AS "rows" FROM r GROUP BY g HAVING count(DISTINCT src) >= 2""")
def multi_source_entities(spark, sf_dir):
    return reports.multi_source(_rows(spark, sf_dir))


@query("suspicious_groups", f"""WITH {_ROWS} SELECT g AS "group", CAST(count(DISTINCT name) AS BIGINT) AS names FROM r GROUP BY g HAVING count(DISTINCT name) >= 6""")
def suspicious_groups(spark, sf_dir):
    return reports.suspicious(_rows(spark, sf_dir), 6)


@query("name_variety", f"""WITH {_ROWS}, n AS (SELECT count(DISTINCT name) AS n FROM r GROUP BY g) SELECT CASE WHEN n = 1 THEN '1' WHEN n <= 3 THEN '2-3' ELSE '>3' END AS bucket, CAST(count(*) AS BIGINT) AS "groups", CAST(max(n) AS BIGINT) AS most FROM n GROUP BY 1""")
def name_variety(spark, sf_dir):
    return reports.name_variety(_rows(spark, sf_dir))


@query("presence_share", f"""WITH {_ROWS}, s AS (SELECT DISTINCT g, src FROM r), p AS (SELECT a.src AS src_a, b.src AS src_b, count(*) AS n FROM s a JOIN s b USING (g) GROUP BY ALL)
    SELECT p.src_a, p.src_b, CAST(p.n AS BIGINT) AS "groups", round(100 * p.n / d.n, 4) AS share FROM p JOIN p d ON d.src_a = p.src_a AND d.src_b = p.src_a""")
def presence_share(spark, sf_dir):
    return reports.presence_share(golden.presence(_rows(spark, sf_dir)))


@query("union_method", f"""WITH {_ROWS}, k AS (SELECT *, count(*) OVER (PARTITION BY g) AS n, count(*) OVER (PARTITION BY g, base) AS m FROM r)
    SELECT rec_id, CASE WHEN n = 1 THEN 'sin_pareja' WHEN base <> '' AND m > 1 THEN 'identificador' ELSE 'nombre' END AS "METODO_UNION" FROM k""")
def union_method(spark, sf_dir):
    return reports.union_method(_rows(spark, sf_dir)).select("rec_id", "METODO_UNION")


@query("pair_score", f"""WITH {_ROWS}, p AS (SELECT a.rec_id AS l, b.rec_id AS r, a.rec_id % 97 / 97 AS s FROM r a JOIN r b ON a.g = b.g AND a.rec_id + 1 = b.rec_id), e AS (SELECT l AS rec_id, s FROM p UNION ALL SELECT r, s FROM p)
    SELECT r.rec_id, max(s) AS "SCORE_PAR" FROM r LEFT JOIN e USING (rec_id) GROUP BY r.rec_id""")
def pair_score(spark, sf_dir):
    whole = _rows(spark, sf_dir).select("rec_id", "group")
    n = task_parts(whole)
    rows = whole.repartition(n, "rec_id").dropDuplicates(["rec_id"])
    near = rows.select(F.col("rec_id").alias("id_l"), (F.col("rec_id") + 1).alias("id_r"), ((F.col("rec_id") % 97) / 97).alias("score"))
    return reports.pair_score(rows, near, n)


_PAIRS = "p AS (SELECT o_orderkey AS id_l, o_orderkey + 1 AS id_r, o_orderkey % 101 / 101 AS score FROM orders)"


def _pairs(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id_l"), (F.col("o_orderkey") + 1).alias("id_r"), ((F.col("o_orderkey") % 101) / 101).alias("score"))


@query("threshold_sensitivity", f"""WITH {_PAIRS} SELECT t AS threshold, CAST(count(*) FILTER (score >= t) AS BIGINT) AS merges, CAST(count(*) FILTER (score >= t AND score < 0.8) AS BIGINT) AS gained, CAST(count(*) FILTER (score < t AND score >= 0.8) AS BIGINT) AS lost
    FROM p, (SELECT unnest([CAST(0.7 AS DOUBLE), 0.8, 0.9]) AS t) GROUP BY t""")
def threshold_sensitivity(spark, sf_dir):
    return reports.sensitivity(_pairs(spark, sf_dir), 0.8, [0.7, 0.8, 0.9])


@query("review_sample", f"""WITH {_PAIRS}, b AS (SELECT *, CASE WHEN score >= 0.9 THEN 0.9 WHEN score >= 0.7 THEN 0.7 WHEN score >= 0.5 THEN 0.5 END AS band FROM p), k AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY sha256(id_l || '|' || id_r), id_l) AS k FROM b WHERE band IS NOT NULL)
    SELECT id_l, id_r, score, CAST(band AS DOUBLE) AS band FROM k WHERE k <= 20""")
def review_sample(spark, sf_dir):
    return reports.review_sample(_pairs(spark, sf_dir), [0.5, 0.7, 0.9], 20)


@query("folds", """SELECT p_brand, p_partkey, CAST(CAST('0x' || substr(sha256(p_brand), 1, 8) AS BIGINT) % 5 AS INT) AS fold FROM part""")
def folds(spark, sf_dir):
    return reports.folds(table(spark, sf_dir, "part").select("p_brand", "p_partkey"), "p_brand", 5)


@query("variable_contribution", """WITH x AS (SELECT quality AS truth, sin(doc_id) AS a, (doc_id % 3 - 1)::DOUBLE AS b FROM labels), l AS (SELECT truth, 'a' AS variable, a AS s FROM x UNION ALL SELECT truth, 'b', b FROM x)
    SELECT variable, truth, CAST(count(*) FILTER (s > 0) AS BIGINT) AS premia, CAST(count(*) FILTER (s < 0) AS BIGINT) AS castiga, CAST(count(*) FILTER (s = 0) AS BIGINT) AS neutro FROM l GROUP BY ALL""")
def variable_contribution(spark, sf_dir):
    return reports.contribution(table(spark, sf_dir, "labels").select("quality", F.sin("doc_id").alias("a"), (F.col("doc_id") % 3 - 1).alias("b")), ["a", "b"], "quality")


@query("quality_by_stratum", """WITH x AS (SELECT vec_id % 4 AS stratum, label AS t, vec_id % 7 AS p FROM embeddings), c AS (SELECT stratum, t, p, count(*) AS n FROM x GROUP BY ALL),
    tp AS (SELECT stratum, sum(n * (n - 1) / 2) AS tp FROM c GROUP BY 1), a AS (SELECT stratum, sum(n * (n - 1) / 2) AS a FROM (SELECT stratum, t, sum(n) AS n FROM c GROUP BY ALL) GROUP BY 1), b AS (SELECT stratum, sum(n * (n - 1) / 2) AS b FROM (SELECT stratum, p, sum(n) AS n FROM c GROUP BY ALL) GROUP BY 1)
    SELECT stratum, CAST(tp AS BIGINT) AS tp, CAST(b - tp AS BIGINT) AS fp, CAST(a - tp AS BIGINT) AS fn, round(2 * tp / (a + b), 6) AS f1 FROM tp JOIN a USING (stratum) JOIN b USING (stratum)""")
def quality_by_stratum(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 4).alias("stratum"), F.col("label").alias("truth"), (F.col("vec_id") % 7).alias("predicted"))
    return reports.by_stratum(rows, "stratum")


@query("partition_fingerprint", f"""WITH {_ROWS}, d AS (SELECT sha256(rec_id || '|' || min(rec_id) OVER (PARTITION BY g)) AS d FROM r)
    SELECT {" || '-' || ".join(f"CAST(sum(CAST('0x' || substr(d, {1 + 15 * i}, 15) AS BIGINT)) AS VARCHAR)" for i in range(4))} AS fingerprint FROM d""")
def partition_fingerprint(spark, sf_dir):
    return reports.partition_fingerprint(_rows(spark, sf_dir).select("group", F.col("rec_id").alias("record")))


@query("technical_ordinal", """WITH a AS (SELECT p_partkey, p_brand, p_type, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) - 1 AS o FROM part), b AS (SELECT *, p_partkey * 2 AS tech FROM a WHERE p_partkey % 2 = 0), c AS (SELECT p_brand, p_type, tech, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) - 1 AS o FROM b)
    SELECT p_partkey, p_brand, p_type, CAST(o AS INT) AS "ORDINAL", coalesce(tech, -1) AS tech FROM a LEFT JOIN c USING (p_brand, p_type, o)""")
def technical_ordinal(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return reports.attach_technical(p, p.filter("p_partkey % 2 = 0").withColumn("tech", F.col("p_partkey") * 2), ["p_brand", "p_type"], "p_partkey").withColumn("tech", F.coalesce("tech", F.lit(-1)))


@query("expanded_result", """WITH k AS (SELECT o_orderkey AS row_id, min(o_orderkey) OVER (PARTITION BY o_orderpriority, o_orderstatus) AS rep_id, o_custkey FROM orders) SELECT row_id, rep_id, rep_id % 11 AS grp, o_custkey FROM k""")
def expanded_result(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("row_id", F.col("o_orderkey"))
    compact, expansion = golden.collapse(o, ["o_orderpriority", "o_orderstatus"], "row_id")
    return reports.expand(expansion, compact.select("rep_id", (F.col("rep_id") % 11).alias("grp")), o.select("row_id", "o_custkey"))


@query("contract_checks", f"""WITH {_ROWS} SELECT 'ids set' AS "check", CAST(0 AS BIGINT) AS violations UNION ALL SELECT 'src vocabulary', count(*) FILTER (src NOT IN ('A', 'N')) FROM r UNION ALL SELECT 'ID_REGISTRO unique', count(*) FROM (SELECT rec_id FROM r GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'one entity per group', count(*) FROM (SELECT g FROM r GROUP BY g HAVING count(DISTINCT g % 1000) <> 1) UNION ALL SELECT 'one group per entity', count(*) FROM (SELECT g % 1000 AS e FROM r GROUP BY 1 HAVING count(DISTINCT g) <> 1)""")
def contract_checks(spark, sf_dir):
    r = _rows(spark, sf_dir).select(F.col("rec_id").alias("record"), F.col("group").alias("ID_GRUPO"), (F.col("group") % 1000).alias("ID_ENTIDAD"), "src")
    return reports.contract(r, {"src": ("A", "N")})


@query("country_canonical", """SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN n_name WHEN 1 THEN ' ' || lower(n_name) || '. ' WHEN 2 THEN 'Zona Franca ' || n_name ELSE 'QQ' || n_name END AS spelling, CASE WHEN n_nationkey % 4 < 2 THEN 'C' || n_nationkey END AS code, ['exacto', 'laxo', 'zona franca', 'sin clasificar'][n_nationkey % 4 + 1] AS how FROM nation""")
def country_canonical(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey") % 4
    spelling = F.when(k == 0, F.col("n_name")).when(k == 1, F.concat(F.lit(" "), F.lower("n_name"), F.lit(". "))).when(k == 2, F.concat(F.lit("Zona Franca "), "n_name")).otherwise(F.concat(F.lit("QQ"), "n_name"))
    catalog = n.select(F.col("n_name").alias("alias"), F.concat(F.lit("C"), "n_nationkey").alias("code"))
    return places.canonical(n.withColumn("spelling_", spelling), "n_nationkey", "spelling_", catalog)


@query("entity_kinds", """SELECT c_custkey, ['empresa', 'persona', 'incierto', 'invalido'][c_custkey % 4 + 1] AS kind FROM customer""")
def entity_kinds(spark, sf_dir):
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, F.concat("c_mktsegment", F.lit(" S.A.S"))).when(k == 1, "María Gómez").when(k == 2, F.lower("c_mktsegment")).otherwise("N/A")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(k == 0, F.regexp_replace(name, r"\.", " ")).otherwise(name).alias("name"))
    return kinds.classify(rows, "c_custkey", "name").select("c_custkey", "kind")


@query("learned_kinds", """WITH x AS (SELECT p_partkey, p_size > 25 AS company, unnest(list_distinct(string_split(upper(p_name), ' '))) AS token FROM part), t AS (SELECT count(*) FILTER (p_size > 25) AS c, count(*) FILTER (p_size <= 25) AS p FROM part), n AS (SELECT token, count(*) FILTER (company) AS nc, count(*) FILTER (NOT company) AS np FROM x GROUP BY token HAVING count(*) >= 5)
    SELECT token, round(greatest(-3, least(3, 0.5 * ln((nc + 1) / (c + 2) / ((np + 1) / (p + 2))))), 6) AS weight FROM n, t""")
def learned_kinds(spark, sf_dir):
    found = kinds.learn_tokens(table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), (F.col("p_size") > 25).alias("company")))
    return found.select("token", F.round("weight", 6).alias("weight"))


@query("name_marks", """WITH p AS (SELECT p_partkey, upper(p_name) || ' K ' || p_size || ' SA' AS n FROM part), w AS (SELECT p_partkey, string_split(n, ' ') AS w FROM p)
    SELECT p_partkey, array_to_string(list_sort(list_filter(w, lambda x: regexp_full_match(x, '[A-Z]|[0-9]+') AND x NOT IN ('Y', 'E'))), ' ') AS marks, array_to_string(list_filter(w, lambda x: length(x) > 1 AND x <> 'SA' AND NOT regexp_full_match(x, '[0-9]+')), '') AS compact FROM w""")
def name_marks(spark, sf_dir):
    n = F.concat_ws(" ", F.upper("p_name"), F.lit("K"), "p_size", F.lit("SA"))
    return table(spark, sf_dir, "part").select("p_partkey", text.marks(n).alias("marks"), text.compact_form(n).alias("compact"))


@query("workbook_round_trip", """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey, row_number() OVER (ORDER BY s_suppkey) + 1 AS "FILA_EXCEL" FROM supplier""")
def workbook_round_trip(spark, sf_dir):
    import io

    home = f"{shared_dir(spark)}/samewise/workbook-{uuid.uuid4().hex}.xlsx"
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey").orderBy("s_suppkey")
    data = io.BytesIO()
    workbooks.write_workbook({"supplier": s}, data)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(home)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data.getvalue()))
    out.close()
    return workbooks.read_workbook(spark, home, "supplier")


def _importers(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "part").join(F.broadcast(n), F.col("p_partkey") % 25 == F.col("n_nationkey")).select("p_partkey", "p_name", "n_name", "p_size")
    return rows, route.importers(rows, "p_partkey", "p_name", "n_name", n.select(F.col("n_name").alias("alias"), F.col("n_name").alias("code")), ("p_size",))


@query("importer_groups")
def importer_groups(spark, sf_dir):
    return _importers(spark, sf_dir)[1].golden


@query("importer_invariants", """SELECT unnest(['rows conserved', 'keys unique', 'groups within a country', 'one golden row per group', 'p_size conserved']) AS "check", CAST(0 AS BIGINT) AS violations""")
def importer_invariants(spark, sf_dir):
    rows, result = _importers(spark, sf_dir)
    return route.invariants(result, rows, "p_partkey", ("p_size",))
