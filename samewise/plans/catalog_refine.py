"""Queries of groups worked over once more, and their SQL; catalog adds them to its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clusters, golden, refine, similar, suggest
from ..operators.tables import stored

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


@query("identifier_chains", """WITH RECURSIVE r AS (SELECT c_custkey AS old_id, c_custkey // 2 AS new_id FROM customer WHERE c_custkey > 8),
    c AS (SELECT old_id, new_id FROM r UNION ALL SELECT c.old_id, r.new_id FROM c JOIN r ON c.new_id = r.old_id)
    SELECT old_id, min(new_id) AS new_id FROM c GROUP BY old_id""")
def identifier_chains(spark, sf_dir):
    """Each customer above the eighth was retired in favour of the one with half its number."""
    c = table(spark, sf_dir, "customer").filter("c_custkey > 8")
    return refine.compress_chains(c.select(F.col("c_custkey").alias("old_id"), F.expr("c_custkey div 2").alias("new_id")))


_REACH = """both_ways AS (SELECT id_l AS a, id_r AS b FROM e UNION SELECT id_r, id_l FROM e),
    reach AS (SELECT rec_id AS a, rec_id AS b FROM p UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a)"""


@query("refined_groups", f"""WITH RECURSIVE p AS (SELECT p_partkey AS rec_id, upper(p_name) AS name, CAST(substr(p_brand, 7) AS BIGINT) AS g FROM part),
    e AS (SELECT a.rec_id AS id_l, b.rec_id AS id_r FROM p a JOIN p b ON a.g = b.g AND a.rec_id < b.rec_id AND levenshtein(a.name, b.name) <= 2), {_REACH},
    parts AS (SELECT a AS rec_id, min(b) AS part FROM reach GROUP BY a), sized AS (SELECT g, part, count(*) AS n FROM parts JOIN p USING (rec_id) GROUP BY ALL),
    best AS (SELECT g, arg_min(part, (-n, part)) AS largest FROM sized GROUP BY g)
    SELECT rec_id, CASE WHEN part = largest THEN g ELSE part END AS "group" FROM parts JOIN p USING (rec_id) JOIN best USING (g)""")
def refined_groups(spark, sf_dir):
    """Brands as groups, split where names are more than two edits apart."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("rec_id"), F.upper("p_name").alias("name"), F.substring("p_brand", 7, 9).cast("long").alias("group"))
    return refine.refine_groups(p, p, ["name"], lambda pairs: pairs.filter(F.levenshtein("name_l", "name_r") <= 2))


_THRESHOLDS = tuple(round(0.76 + 0.025 * i, 3) for i in range(10))
_SCORED = f"""p AS (SELECT min(p_partkey) AS rec_id, upper(p_name) AS name FROM part GROUP BY 2), t AS (SELECT unnest({list(_THRESHOLDS)}) AS threshold),
    s AS (SELECT a.rec_id AS id_l, b.rec_id AS id_r, jaro_winkler_similarity(a.name, b.name) AS score FROM p a JOIN p b ON a.rec_id <> b.rec_id),
    reach AS (SELECT threshold, rec_id AS a, rec_id AS b FROM t, p UNION SELECT r.threshold, r.a, s.id_r FROM reach r JOIN s ON r.b = s.id_l AND s.score >= r.threshold)"""


def _threshold_groups(spark, sf_dir):
    p = table(spark, sf_dir, "part").groupBy(F.upper("p_name").alias("name")).agg(F.min("p_partkey").alias("rec_id"))
    text = p.select(F.col("name").alias("text"))
    found, _ = similar.jaro_winkler_join(text, text, min(_THRESHOLDS))
    scored = found.filter("l < r").join(p.toDF("l", "id_l"), "l").join(p.toDF("r", "id_r"), "r").select("id_l", "id_r", F.col("similarity").alias("score"))
    return p, refine.threshold_groups(p.select("rec_id"), scored, _THRESHOLDS)


@query("threshold_groups", f"""WITH RECURSIVE {_SCORED} SELECT CAST(threshold AS DOUBLE) AS threshold, a AS rec_id, min(b) AS "group" FROM reach GROUP BY 1, a""")
def threshold_groups(spark, sf_dir):
    """Groups of the distinct part names at ten thresholds of their Jaro-Winkler similarity."""
    return _threshold_groups(spark, sf_dir)[1]


@query("threshold_choice", f"""WITH RECURSIVE {_SCORED}, g AS (SELECT threshold, a AS rec_id, min(b) AS grp FROM reach GROUP BY ALL), l AS (SELECT g.*, string_split(name, ' ')[2] AS label FROM g JOIN p USING (rec_id)),
    pairs AS (SELECT a.threshold, count(*) FILTER (a.grp = b.grp AND a.label = b.label) AS tp, count(*) FILTER (a.grp = b.grp AND a.label <> b.label) AS fp, count(*) FILTER (a.grp <> b.grp AND a.label = b.label) AS fn
        FROM l a JOIN l b ON a.threshold = b.threshold AND a.rec_id < b.rec_id GROUP BY a.threshold),
    j AS (SELECT *, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 1.0 END >= 0.2 AS passes FROM pairs)
    SELECT CAST(threshold AS DOUBLE) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, passes, threshold = (SELECT arg_min(threshold, (fp, -tp, threshold)) FROM j WHERE passes) AS chosen FROM j""")
def threshold_choice(spark, sf_dir):
    """The threshold with fewest false pairs among those with a recall of 0.2, the second word of a name being the truth."""
    p, groups = _threshold_groups(spark, sf_dir)
    points = refine.threshold_points(groups, p.select("rec_id", F.split("name", " ")[1].alias("label")))
    return refine.choose_threshold(points, recall=0.2).select("threshold", "tp", "fp", "fn", "passes", "chosen")


_UNIONS = """p AS (SELECT p_partkey AS rec_id, p_brand, p_size, p_name FROM part),
    u AS (SELECT lag(rec_id) OVER (PARTITION BY p_brand, p_size ORDER BY rec_id) AS id_l, rec_id AS id_r, 2 * rec_id AS number, 'size' AS rule FROM p
        UNION ALL SELECT lag(rec_id) OVER (PARTITION BY p_brand, p_name ORDER BY rec_id), rec_id, 2 * rec_id + 1, 'name' FROM p),
    e AS (SELECT * FROM u WHERE id_l IS NOT NULL)"""


def _unions(spark, sf_dir):
    """Each part with the one before it of its brand and size, and of its brand and name."""
    p = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "rec_id")
    from pyspark.sql import Window

    last = lambda *by: F.lag("rec_id").over(Window.partitionBy(*by).orderBy("rec_id"))
    size = p.select(last("p_brand", "p_size").alias("id_l"), F.col("rec_id").alias("id_r"), (2 * F.col("rec_id")).alias("number"), F.lit("size").alias("rule"))
    name = p.select(last("p_brand", "p_name").alias("id_l"), F.col("rec_id").alias("id_r"), (2 * F.col("rec_id") + 1).alias("number"), F.lit("name").alias("rule"))
    return p.select("rec_id"), stored(size.unionByName(name).filter("id_l IS NOT NULL"), "unions")


@query("union_rules", f"""WITH {_UNIONS}, x AS (SELECT id_l AS rec_id, number, rule FROM e UNION ALL SELECT id_r, number, rule FROM e), f AS (SELECT rec_id, rule, min(number) AS number FROM x GROUP BY ALL)
    SELECT rec_id, string_agg(rule, ' | ' ORDER BY number) AS rules FROM f GROUP BY rec_id""")
def union_rules(spark, sf_dir):
    return refine.union_provenance(_unions(spark, sf_dir)[1])[1]


@query("forest_groups", f"""WITH RECURSIVE {_UNIONS}, {_REACH}, g AS (SELECT a AS rec_id, min(b) AS grp FROM reach GROUP BY a),
    c AS (SELECT count(*) - count(DISTINCT grp) AS needed FROM g) SELECT rec_id, grp AS "group", CAST(needed AS BIGINT) AS unions FROM g, c""")
def forest_groups(spark, sf_dir):
    """The groups that the forest's unions alone rebuild, and how many these are: no more than the groups need."""
    nodes, unions = _unions(spark, sf_dir)
    forest, _ = refine.union_provenance(unions)
    groups = clusters.components(nodes, forest)
    return groups.crossJoin(F.broadcast(forest.agg(F.count(F.lit(1)).alias("unions"))))


_NAME = "CASE p_partkey % 2 WHEN 0 THEN 'ZELVORA ALIMENTOS ' ELSE 'KRAMENTO PLASTICOS ' END || repeat('9', CAST(p_partkey % 5 AS INTEGER))"


@query("identifier_consolidation", f"""WITH g AS (SELECT p_partkey AS grp, trim({_NAME}) AS name, p_brand || p_size AS nit FROM part),
    x AS (SELECT *, first_value(grp) OVER w AS chosen, first_value(name) OVER w AS chosen_name FROM g WINDOW w AS (PARTITION BY nit ORDER BY length(name) DESC, grp))
    SELECT grp AS rec_id, CASE WHEN name[1:7] = chosen_name[1:7] THEN chosen ELSE grp END AS "group" FROM x""")
def identifier_consolidation(spark, sf_dir):
    """Parts as groups of one row, brand and size as their identifier; names of two companies."""
    name = F.expr("trim(concat(CASE p_partkey % 2 WHEN 0 THEN 'ZELVORA ALIMENTOS ' ELSE 'KRAMENTO PLASTICOS ' END, repeat('9', cast(p_partkey % 5 AS int))))")
    key = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(key.alias("rec_id"), key.alias("group"), F.col("p_type").alias("src"), name.alias("name"), F.concat("p_brand", F.col("p_size").cast("string")).alias("nit"))
    gold = golden.confidence(golden.group_metrics(rows)).join(rows.select("group", F.col("nit").alias("NIT_FINAL"), F.col("name").alias("NOMBRE_FINAL")), "group")
    return refine.consolidate_by_identifier(rows, stored(gold, "gold"))[0].select("rec_id", "group")


def _schema_sql(name: str) -> str:
    """Decisions of one table by aggregates over its unpivoted columns."""
    plain = "regexp_replace(v, '[\\s.\\-]', '', 'g')"
    return f"""SELECT '{name}' AS "table", col AS "column", CASE
            WHEN regexp_matches(col, '(?i)RAZON|COMPANY|EMPRESA|BUSINESS|SUPPLIER|PROVEEDOR|CLIENTE') OR (regexp_matches(col, '(?i)NOMBRE|NAME') AND spaces >= 0.3) THEN 'nombre_empresa'
            WHEN regexp_matches(col, '(?i)FECHA|DATE|^FEC_') OR dates >= 0.8 THEN 'fecha'
            WHEN numbers >= 0.9 AND (decimals >= 0.3 OR digit_length <= 5) THEN 'numerico' WHEN numbers >= 0.9 THEN '-' WHEN d / n <= 0.05 AND d <= 100 THEN 'categorico' ELSE '-' END AS kind
        FROM (SELECT col, count(*) AS n, count(DISTINCT v) AS d, coalesce(quantile_disc(length({plain}), 0.5) FILTER (regexp_full_match({plain}, '[0-9]+')), 0) AS digit_length,
            avg(CAST(contains(v, ' ') AS INTEGER)) AS spaces, avg(CAST(regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AS INTEGER)) AS dates,
            avg(CAST(TRY_CAST(v AS DOUBLE) IS NOT NULL AS INTEGER)) AS numbers, avg(CAST(regexp_full_match(v, '-?[0-9]+[.,][0-9]+') AS INTEGER)) AS decimals
            FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM {name}) ON COLUMNS(*) INTO NAME col VALUE v) GROUP BY col)"""


_SUGGESTED = ("region", "nation", "customer", "supplier", "part", "orders")


@query("schema_suggestion", " UNION ALL ".join(_schema_sql(t) for t in _SUGGESTED))
def schema_suggestion(spark, sf_dir):
    """What kind of field each column of the star schema is."""
    found = None
    for name in _SUGGESTED:
        part = suggest.suggest_schema(table(spark, sf_dir, name)).select(F.lit(name).alias("table"), "column", "kind")
        found = part if found is None else found.unionByName(part)
    return found
