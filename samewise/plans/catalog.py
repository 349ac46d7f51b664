"""Registered queries of the engine and the SQL that must give the same rows.

They run over the driver's star schema: parts, customers, suppliers and documents stand for records,
brands, nations and sources for blocks and origins, keys for identifiers.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import comparators as cmp
from ..functions import identifiers as ids
from ..functions import text
from ..operators import blocking, clusters, evaluation, golden, scoring
from ..operators.tables import spread_join
from ..sources import sinks
from . import api

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark, sf_dir):
    """Parts as records: rec_id, name, nit (the key with its check digit), src (type), brand."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("rec_id"), F.upper("p_name").alias("name"), F.col("p_partkey").cast("string").alias("nit"), F.col("p_type").alias("src"), F.col("p_brand").alias("brand"))


def names(spark, sf_dir):
    """Distinct part names with a number each by their smallest key."""
    return table(spark, sf_dir, "part").groupBy(F.upper("p_name").alias("name")).agg(F.min("p_partkey").alias("rec_id"))


NAMES = "n AS (SELECT upper(p_name) AS name, min(p_partkey) AS rec_id FROM part GROUP BY upper(p_name))"


def _near_spellings(p):
    """(brand, nl, nr) of the different names of a brand whose distance is 15 % of the longer one or less, both ways; each spelling is compared once.

    Names meet only where their lengths allow it: by brand and length, with as many lengths as the distance can bridge.
    """
    each = p.select("brand", "name").distinct().withColumn("n", F.length("name"))
    left = each.toDF("brand", "nl", "len_l").withColumn("len_r", F.explode(F.sequence(F.col("len_l"), F.floor(F.col("len_l") / 0.85 + 1e-9).cast("int"))))
    met = left.join(each.toDF("brand", "nr", "len_r"), ["brand", "len_r"]).filter("len_l < len_r OR nl < nr")
    near = met.filter(100 * (F.col("len_r") - F.levenshtein("nl", "nr")) >= 85 * F.col("len_r")).select("brand", "nl", "nr")
    return near.unionAll(near.select("brand", F.col("nr").alias("nl"), F.col("nl").alias("nr")))


def near_names(spark, sf_dir):
    p = parts(spark, sf_dir).select("rec_id", "brand", "name")
    left, right = p.toDF("id_l", "brand", "nl"), p.toDF("id_r", "brand", "nr")
    same = spread_join(left, right.withColumnRenamed("nr", "nl"), ["brand", "nl"], 500, parted=True)
    other = spread_join(left.join(_near_spellings(p), ["brand", "nl"]), right, ["brand", "nr"], 500, parted=True)
    return same.select("id_l", "id_r").unionAll(other.select("id_l", "id_r")).filter("id_l < id_r")


def near_links(spark, sf_dir):
    """Links that connect what near_names() pairs: each record with the first one of its name, and these with each other."""
    p = parts(spark, sf_dir).select("rec_id", "brand", "name")
    first = p.groupBy("brand", "name").agg(F.min("rec_id").alias("first"))
    own = p.join(first, ["brand", "name"]).select(F.col("first").alias("id_l"), F.col("rec_id").alias("id_r")).filter("id_l <> id_r")
    left, right = first.toDF("brand", "nl", "id_l"), first.toDF("brand", "nr", "id_r")
    return own.unionAll(_near_spellings(p).filter("nl < nr").join(left, ["brand", "nl"]).join(right, ["brand", "nr"]).select("id_l", "id_r"))


_NEAR = """p AS (SELECT p_partkey AS rec_id, upper(p_name) AS name, p_brand AS brand, p_type AS src FROM part),
    e AS (SELECT a.rec_id AS id_l, b.rec_id AS id_r FROM p a JOIN p b ON a.brand = b.brand AND a.rec_id < b.rec_id
          WHERE 100 * (greatest(length(a.name), length(b.name)) - levenshtein(a.name, b.name)) >= 85 * greatest(length(a.name), length(b.name))),
    both_ways AS (SELECT id_l AS a, id_r AS b FROM e UNION SELECT id_r, id_l FROM e),
    reach AS (SELECT rec_id AS a, rec_id AS b FROM p UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a),
    grp AS (SELECT a AS rec_id, min(b) AS grp FROM reach GROUP BY a)"""


@query(
    "part_groups",
    f"""WITH RECURSIVE {_NEAR}
    SELECT grp AS "group", string_agg(DISTINCT src, '|' ORDER BY src) AS "SOURCES", CAST(count(DISTINCT src) AS BIGINT) AS "SOURCES_COUNT",
        CAST(count(*) AS BIGINT) AS "RECORDS_COUNT", CAST(count(DISTINCT name) AS BIGINT) AS "NAMES_COUNT"
    FROM grp JOIN p USING (rec_id) GROUP BY grp""",
)
def part_groups(spark, sf_dir):
    rows = parts(spark, sf_dir)
    groups = clusters.components(rows, near_links(spark, sf_dir))
    return golden.group_metrics(groups.join(rows, "rec_id")).select("group", "SOURCES", "SOURCES_COUNT", "RECORDS_COUNT", "NAMES_COUNT")


@query("components", f"WITH RECURSIVE {_NEAR} SELECT rec_id, grp AS \"group\" FROM grp")
def components(spark, sf_dir):
    return clusters.components(parts(spark, sf_dir), near_links(spark, sf_dir))


@query("near_name_pairs", f"WITH RECURSIVE {_NEAR} SELECT id_l, id_r FROM e")
def near_name_pairs(spark, sf_dir):
    return near_names(spark, sf_dir)


@query("text_fold", r"""SELECT doc_id, sha256(trim(regexp_replace(upper(regexp_replace(translate(coalesce(text, ''), 'áéíóúüñàèìòùâêîôûäëïöçÁÉÍÓÚÜÑÀÈÌÒÙÂÊÎÔÛÄËÏÖÇ', 'aeiouunaeiouaeiouaeiocAEIOUUNAEIOUAEIOUAEIOC'), '[^\x00-\x7F]', '', 'g')), '\s+', ' ', 'g'))) AS folded FROM documents""")
def text_fold(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.ascii_upper(F.col("text")), 256).alias("folded"))


@query("phonetic_key", """WITH a AS (SELECT p_partkey, regexp_replace(upper(p_name), '[^A-Z ]', '', 'g') || CASE p_partkey % 5 WHEN 0 THEN ' GUERRA' WHEN 1 THEN ' CHAVEZ' WHEN 2 THEN ' PHILIPS QUESO' WHEN 3 THEN ' WALLES' ELSE '' END AS k FROM part),
    b AS (SELECT p_partkey, replace(replace(replace(k, 'H', ''), 'V', 'B'), 'Z', 'S') AS k FROM a),
    c AS (SELECT p_partkey, replace(replace(regexp_replace(k, 'C([EI])', 'S\\1', 'g'), 'QU', 'K'), 'C', 'K') AS k FROM b),
    d AS (SELECT p_partkey, regexp_replace(regexp_replace(k, 'G([EI])', 'J\\1', 'g'), 'GU([EI])', 'G\\1', 'g') AS k FROM c),
    e AS (SELECT p_partkey, replace(replace(replace(k, 'LL', 'Y'), 'W', 'GU'), 'X', 'KS') AS k FROM d)
    SELECT p_partkey, list_reduce(string_split('ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''), lambda t, l: regexp_replace(t, l || '+', l, 'g'), k) AS key FROM e""")
def phonetic_key(spark, sf_dir):
    more = F.element_at(F.array(*map(F.lit, (" Guerra", " Chávez", " Philips queso", " Walles", ""))), (F.col("p_partkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", text.phonetic_es(F.concat("p_name", more)).alias("key"))


_DV = "(CASE WHEN s % 11 < 2 THEN s % 11 ELSE 11 - s % 11 END)"
_SUM = "list_sum(list_transform(range(1, len(d) + 1), lambda i: CAST(substr(reverse(d), i, 1) AS INT) * [3,7,13,17,19,23,29,37,41,43,47,53,59,67,71][i]))"


@query("check_digit", f"""WITH x AS (SELECT c_custkey, CAST(800000000 + c_custkey AS VARCHAR) AS d FROM customer), y AS (SELECT *, {_SUM} AS s FROM x)
    SELECT c_custkey, d AS nit, CAST({_DV} AS INT) AS dv FROM y""")
def check_digit(spark, sf_dir):
    d = (F.lit(800000000) + F.col("c_custkey")).cast("string")
    return table(spark, sf_dir, "customer").select("c_custkey", d.alias("nit"), ids.check_digit(d).cast("int").alias("dv"))


@query("canonical_base", """SELECT c_custkey, CAST(800000000 + c_custkey AS VARCHAR) AS base FROM customer""")
def canonical_base(spark, sf_dir):
    d = (F.lit(800000000) + F.col("c_custkey")).cast("string")
    full = F.concat(d, F.lit("-"), ids.check_digit(d).cast("string"))
    base = ids.process_nit(full)["NIT_BASE"]
    return table(spark, sf_dir, "customer").select("c_custkey", base.alias("base"))


@query("identifier_types", """SELECT CASE WHEN k = repeat(k[1], length(k)) THEN 'TEST_NUMBER' WHEN length(k) BETWEEN 6 AND 8 THEN 'SHORT' WHEN length(k) = 9 THEN 'STANDARD_9' ELSE 'BAD_LENGTH' END AS kind, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT CASE WHEN c_custkey % 3 = 0 THEN CAST(1000000 + c_custkey AS VARCHAR) WHEN c_custkey % 3 = 1 THEN CAST(800000000 + c_custkey AS VARCHAR) ELSE CAST(c_custkey % 1000 AS VARCHAR) END AS k FROM customer) GROUP BY 1""")
def identifier_types(spark, sf_dir):
    k = F.when(F.col("c_custkey") % 3 == 0, (F.lit(1000000) + F.col("c_custkey")).cast("string")).when(F.col("c_custkey") % 3 == 1, (F.lit(800000000) + F.col("c_custkey")).cast("string")).otherwise((F.col("c_custkey") % 1000).cast("string"))
    return table(spark, sf_dir, "customer").groupBy(ids.process_nit(k)["NIT_TYPE"].alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("fingerprints", "SELECT p_partkey, regexp_replace(upper(p_name), '[^A-Z0-9]', '', 'g') AS print FROM part")
def fingerprints(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.fingerprint(F.col("p_name")).alias("print"))


@query("missing_values", """SELECT event_type, CAST(count(*) FILTER (upper(trim(props)) IN ('', '-', 'X', 'N/A', 'NA', 'NAN', 'NONE', 'NULL') OR props IS NULL) AS BIGINT) AS missing, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type""")
def missing_values(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(text.is_missing(F.col("props"))).alias("missing"), F.count(F.lit(1)).alias("n"))


@query("web_domains", r"""WITH h AS (SELECT page_id, regexp_extract(lower(trim(url)), '^(?:[a-z]+://)?(?:[^@/]*@)?(?:www\.)?([^/:?#]+)', 1) AS host FROM pages)
    SELECT page_id, CASE WHEN contains(host, '.') THEN array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') ELSE '' END AS domain FROM h""")
def web_domains(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", ids.web_domain(F.col("url")).alias("domain"))


@query("pairs_by_key", "SELECT a.s_suppkey AS id_l, b.s_suppkey AS id_r FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey")
def pairs_by_key(spark, sf_dir):
    return blocking.pairs_by_key(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("rec_id"), F.col("s_nationkey").alias("key")), None)


@query("block_overflow", """WITH c AS (SELECT *, count(*) OVER (PARTITION BY s_nationkey) AS n, lag(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS before FROM supplier)
    SELECT a.s_suppkey AS id_l, b.s_suppkey AS id_r FROM c a JOIN c b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey WHERE a.n <= 4
    UNION SELECT before, s_suppkey FROM c WHERE n > 4 AND before IS NOT NULL""")
def block_overflow(spark, sf_dir):
    return blocking.pairs_by_key(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("rec_id"), F.col("s_nationkey").alias("key")), 4, "connect")


@query("source_policy", """SELECT a.s_suppkey AS id_l, b.s_suppkey AS id_r FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey
    WHERE (a.s_suppkey % 3) <> (b.s_suppkey % 3) OR (a.s_suppkey % 3) <> 0""")
def source_policy(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("rec_id"), F.col("s_nationkey").alias("key"), (F.col("s_suppkey") % 3).cast("string").alias("src"))
    return blocking.pairs_by_key(rows, None, trusted=("0",))


@query("identifier_neighbours", """WITH s AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS v FROM supplier)
    SELECT a.k AS id_l, b.k AS id_r FROM s a JOIN s b ON a.k < b.k AND levenshtein(a.v, b.v) <= 1""")
def identifier_neighbours(spark, sf_dir):
    return blocking.identifier_neighbours(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("rec_id"), F.col("s_suppkey").cast("string").alias("nit")), 1, max_block=None)


_TOKENS = f"""{NAMES}, t AS (SELECT DISTINCT rec_id, unnest(string_split(name, ' ')) AS token FROM n), u AS (SELECT * FROM t WHERE length(token) >= 4),
    d AS (SELECT token, count(*) AS df FROM u GROUP BY token)"""


@query("distinctive_tokens", f"""WITH {_TOKENS}, r AS (SELECT u.rec_id, u.token, row_number() OVER (PARTITION BY u.rec_id ORDER BY d.df, u.token) AS k FROM u JOIN d USING (token) WHERE d.df <= 300),
    c AS (SELECT * FROM r WHERE k <= 2)
    SELECT DISTINCT a.rec_id AS id_l, b.rec_id AS id_r FROM c a JOIN c b ON a.token = b.token AND a.rec_id < b.rec_id""")
def distinctive_tokens(spark, sf_dir):
    return blocking.distinctive_tokens(names(spark, sf_dir))


@query("token_idf", f"WITH {_TOKENS} SELECT token, CAST(df AS BIGINT) AS df, round(ln((1 + (SELECT count(*) FROM n)) / (1 + df)) + 1, 6) AS idf FROM d")
def token_idf(spark, sf_dir):
    n = names(spark, sf_dir)
    return blocking.idf(blocking.tokens(n), n.count()).withColumn("idf", F.round("idf", 6))


@query("word_frequency", "SELECT word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(upper(p_name), ' ')) AS word FROM part) GROUP BY word ORDER BY n DESC, word LIMIT 20")
def word_frequency(spark, sf_dir):
    words = parts(spark, sf_dir).select(F.explode(F.split("name", " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(20)


@query("tfidf_pairs", f"""WITH {NAMES}, w AS (SELECT rec_id, ' ' || unnest(string_split(lower(name), ' ')) || ' ' AS w FROM n),
    g AS (SELECT rec_id, substr(w, i, 3) AS gram, count(*) AS tf FROM (SELECT rec_id, w, unnest(range(1, greatest(length(w) - 1, 2))) AS i FROM w) GROUP BY ALL),
    k AS (SELECT count(*) AS k FROM n), d AS (SELECT gram, count(*) AS df FROM g GROUP BY gram HAVING count(*) >= 2 AND count(*) <= greatest(2, 0.3 * (SELECT k FROM k))),
    r AS (SELECT g.rec_id, g.gram, tf * (ln((1 + (SELECT k FROM k)) / (1 + df)) + 1) AS w FROM g JOIN d USING (gram)),
    m AS (SELECT rec_id, sqrt(sum(w * w)) AS m FROM r GROUP BY rec_id), u AS (SELECT r.rec_id, gram, w / m AS w FROM r JOIN m USING (rec_id))
    SELECT a.rec_id AS id_l, b.rec_id AS id_r, round(sum(a.w * b.w), 5) AS cosine FROM u a JOIN u b ON a.gram = b.gram AND a.rec_id < b.rec_id GROUP BY ALL HAVING sum(a.w * b.w) >= 0.4""")
def tfidf_pairs(spark, sf_dir):
    return blocking.tfidf_pairs(names(spark, sf_dir), max_df=0.3, top_k=10_000).withColumn("cosine", F.round("cosine", 5))


@query("sorted_neighbourhood", """WITH r AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r FROM orders)
    SELECT least(a.k, b.k) AS id_l, greatest(a.k, b.k) AS id_r FROM r a JOIN r b ON b.r BETWEEN a.r + 1 AND a.r + 3""")
def sorted_neighbourhood(spark, sf_dir):
    return blocking.sorted_neighbourhood(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("rec_id"), "o_orderdate"), "o_orderdate", 3)


_PLACES = "g AS (SELECT vec_id AS k, CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lon FROM embeddings)"


@query("geo_grid", f"""WITH {_PLACES}, c AS (SELECT k, floor(lat / 0.01) AS x, floor(lon / 0.01) AS y FROM g)
    SELECT a.k AS id_l, b.k AS id_r FROM c a JOIN c b ON a.k < b.k AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1""")
def geo_grid(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("rec_id"), F.col("embedding")[0].cast("double").alias("lat"), F.col("embedding")[1].cast("double").alias("lon"))
    return blocking.geo_grid(e, 0.01)


@query("jaro_winkler", f"WITH {NAMES} SELECT a.rec_id AS id_l, b.rec_id AS id_r, round(jaro_winkler_similarity(a.name, b.name), 6) AS jw FROM n a JOIN n b ON a.rec_id < b.rec_id AND a.name[1] = b.name[1]")
def jaro_winkler(spark, sf_dir):
    n = names(spark, sf_dir).withColumn("key", F.substring("name", 1, 1))
    pairs = blocking.pairs_by_key(n.select("rec_id", "key"), None)
    wide = scoring.attach(pairs, n, ["name"])
    return wide.select("id_l", "id_r", F.round((cmp.jaro_winkler_signed(F.col("name_l"), F.col("name_r")) + 1) / 2, 6).alias("jw"))


@query("levenshtein_signed", f"WITH {NAMES} SELECT a.rec_id AS id_l, b.rec_id AS id_r, round(2 * (1 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name))) - 1, 6) AS s FROM n a JOIN n b ON a.rec_id < b.rec_id AND a.name[1] = b.name[1]")
def levenshtein_signed(spark, sf_dir):
    n = names(spark, sf_dir).withColumn("key", F.substring("name", 1, 1))
    wide = scoring.attach(blocking.pairs_by_key(n.select("rec_id", "key"), None), n, ["name"])
    return wide.select("id_l", "id_r", F.round(cmp.levenshtein_signed(F.col("name_l"), F.col("name_r")), 6).alias("s"))


@query("typed_comparators", """SELECT l_orderkey, l_linenumber,
    round(greatest(-1, least(1, 1 - abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) / 30.0)), 6) AS dates,
    round(greatest(0, least(1, 1 - abs(l_extendedprice - o_totalprice) / greatest(abs(l_extendedprice), abs(o_totalprice)) / 0.1)), 6) AS relative,
    round(greatest(0, least(1, 1 - abs(l_quantity - 25) / 10.0)), 6) AS absolute,
    CASE WHEN l_returnflag = o_orderstatus THEN 1.0 ELSE -1.0 END AS exact
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def typed_comparators(spark, sf_dir):
    j = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    c = F.col
    return j.select(
        "l_orderkey", "l_linenumber", F.round(cmp.date_delta(c("o_orderdate"), c("l_shipdate")), 6).alias("dates"), F.round(cmp.number_relative(c("l_extendedprice"), c("o_totalprice")), 6).alias("relative"),
        F.round(cmp.number_absolute(c("l_quantity"), F.lit(25), 10.0), 6).alias("absolute"), cmp.exact_signed(c("l_returnflag"), c("o_orderstatus")).alias("exact"),
    )


@query("geo_haversine", f"""WITH {_PLACES} SELECT a.k AS id_l, b.k AS id_r, round(greatest(0, 1 - 2 * 6371.0088 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) / 50), 5) AS s
    FROM g a JOIN g b ON b.k = a.k + 1""")
def geo_haversine(spark, sf_dir):
    g = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("k"), F.struct(F.col("embedding")[0].cast("double").alias("lat"), F.col("embedding")[1].cast("double").alias("lon")).alias("g"))
    pairs = g.toDF("id_l", "a").join(g.select(F.col("k").alias("id_r"), (F.col("k") - 1).alias("id_l"), F.col("g").alias("b")), "id_l")
    return pairs.select("id_l", "id_r", F.round(cmp.geo_haversine(F.col("a"), F.col("b"), 50.0), 5).alias("s"))


@query("set_and_prefix", f"""WITH {NAMES}, p AS (SELECT a.rec_id AS id_l, b.rec_id AS id_r, a.name AS x, b.name AS y, string_split(a.name, ' ') AS s, string_split(b.name, ' ') AS t FROM n a JOIN n b ON a.rec_id < b.rec_id AND a.name[1] = b.name[1])
    SELECT id_l, id_r, round(len(list_intersect(list_distinct(s), list_distinct(t))) / len(list_distinct(s || t)), 6) AS jaccard,
        round((1 + CASE WHEN x[1:2] = y[1:2] THEN 1 ELSE 0 END + CASE WHEN x[1:4] = y[1:4] THEN 1 ELSE 0 END) / 3, 6) AS prefix FROM p""")
def set_and_prefix(spark, sf_dir):
    n = names(spark, sf_dir).withColumn("key", F.substring("name", 1, 1))
    wide = scoring.attach(blocking.pairs_by_key(n.select("rec_id", "key"), None), n, ["name"])
    packed = lambda c: F.replace(F.col(c), F.lit(" "), F.lit(";"))
    return wide.select("id_l", "id_r", F.round(cmp.set_jaccard(packed("name_l"), packed("name_r")), 6).alias("jaccard"), F.round(cmp.prefix_levels(F.col("name_l"), F.col("name_r")), 6).alias("prefix"))


@query("token_set_scores")
def token_set_scores(spark, sf_dir):
    n = names(spark, sf_dir).withColumn("key", F.substring("name", 1, 1))
    wide = scoring.attach(blocking.pairs_by_key(n.select("rec_id", "key"), None), n, ["name"])
    return wide.select("id_l", "id_r", cmp.token_set_ratio(F.col("name_l"), F.col("name_r")).alias("set"), cmp.token_sort_signed(F.col("name_l"), F.col("name_r")).alias("sort"), cmp.name_similarity(F.col("name_l"), F.col("name_r")).alias("name"))


@query("soft_tfidf")
def soft_tfidf(spark, sf_dir):
    n = names(spark, sf_dir)
    rows = blocking.tokens(n)
    return scoring.soft_tfidf(blocking.distinctive_tokens(n), rows, blocking.idf(rows, n.count()).select("token", "idf"))


def _lines(spark, sf_dir):
    """Line items as rows of groups: an order is a group, the return flag its source, the supplier its identifier."""
    t = table(spark, sf_dir, "lineitem")
    return t.select(F.col("l_orderkey").alias("group"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rec_id"), F.col("l_returnflag").alias("src"), F.col("l_partkey").cast("string").alias("name"), (F.col("l_suppkey") % 7).cast("string").alias("nit"))


_LINES = "r AS (SELECT l_orderkey AS g, l_orderkey * 10 + l_linenumber AS rec_id, l_returnflag AS src, CAST(l_partkey AS VARCHAR) AS name, CAST(l_suppkey % 7 AS VARCHAR) AS nit FROM lineitem)"
_METRICS = f"{_LINES}, m AS (SELECT g, string_agg(DISTINCT src, '|' ORDER BY src) AS sources, count(DISTINCT src) AS src, count(*) AS rows, count(DISTINCT name) AS names, count(DISTINCT nit) AS nits, list(src ORDER BY rec_id, src)[1] AS primary_source FROM r GROUP BY g)"


@query("golden_metrics", f"""WITH {_METRICS} SELECT g AS "group", sources AS "SOURCES", CAST(src AS BIGINT) AS "SOURCES_COUNT", CAST(rows AS BIGINT) AS "RECORDS_COUNT", CAST(names AS BIGINT) AS "NAMES_COUNT", CAST(nits AS BIGINT) AS "NIT_COUNT", primary_source AS "PRIMARY_SOURCE" FROM m""")
def golden_metrics(spark, sf_dir):
    return golden.group_metrics(_lines(spark, sf_dir))


@query("golden_confidence", f"""WITH {_METRICS} SELECT g AS "group", CASE WHEN nits = 1 AND src >= 2 THEN 'ALTA' WHEN nits <= 2 AND rows <= 5 THEN 'MEDIA' ELSE 'BAJA' END AS "CONFIDENCE",
    CASE WHEN nits <= 1 AND names <= 1 THEN CASE WHEN src = 1 THEN 0.85 ELSE 1.0 END ELSE round(CAST(0.5 AS DOUBLE) / greatest(nits, 1) + CAST(0.4 AS DOUBLE) / greatest(names, 1) + CAST(0.1 AS DOUBLE) * least(1.0, src / 3), 4) END AS "CONFIDENCE_SCORE",
    nits > 3 OR names > 5 OR rows > 20 AS "REQUIRES_REVIEW" FROM m""")
def golden_confidence(spark, sf_dir):
    return golden.confidence(golden.group_metrics(_lines(spark, sf_dir))).select("group", "CONFIDENCE", "CONFIDENCE_SCORE", "REQUIRES_REVIEW")


@query("best_nit", f"""WITH {_LINES}, c AS (SELECT g, nit, count(*) AS n FROM r GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, length(nit) DESC, nit) AS k FROM c)
    SELECT g AS "group", nit AS "NIT_FINAL" FROM k WHERE k = 1""")
def best_nit(spark, sf_dir):
    return golden.best_nit(_lines(spark, sf_dir))


@query("best_name", f"""WITH {_LINES}, c AS (SELECT g, name, count(*) AS n, min(rec_id) AS first FROM r GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, first, name) AS k FROM c)
    SELECT g AS "group", name AS "NOMBRE_FINAL" FROM k WHERE k = 1""")
def best_name(spark, sf_dir):
    return golden.best_name(_lines(spark, sf_dir))


@query("exact_collapse", """WITH k AS (SELECT *, l_orderkey * 10 + l_linenumber AS row_id FROM lineitem) SELECT row_id, min(row_id) OVER (PARTITION BY l_returnflag, l_linestatus, l_quantity, l_discount) AS rep_id FROM k""")
def exact_collapse(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("row_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return golden.collapse(rows, ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"], "row_id")[1]


@query("presence_matrix", "WITH s AS (SELECT DISTINCT lang, source FROM documents) SELECT a.source AS src_a, b.source AS src_b, CAST(count(*) AS BIGINT) AS \"groups\" FROM s a JOIN s b ON a.lang = b.lang GROUP BY ALL")
def presence_matrix(spark, sf_dir):
    return golden.presence(table(spark, sf_dir, "documents").select(F.col("lang").alias("group"), F.col("source").alias("src")))


@query("absent_from_source", "SELECT DISTINCT l_orderkey AS \"group\" FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def absent_from_source(spark, sf_dir):
    return golden.absent_from(_lines(spark, sf_dir), "R")


@query("cross_counts", """WITH g AS (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS b FROM lineitem GROUP BY 1)
    SELECT CAST(count(*) FILTER (a > 0 AND b > 0) AS BIGINT) AS "both", CAST(sum(a * b) AS BIGINT) AS pairs, CAST(count(*) FILTER (a > 0 AND b = 0) AS BIGINT) AS only_a, CAST(count(*) FILTER (a = 0 AND b > 0) AS BIGINT) AS only_b FROM g""")
def cross_counts(spark, sf_dir):
    return golden.cross_counts(_lines(spark, sf_dir), "A", "N")


@query("size_distribution", """WITH g AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT CASE WHEN n = 1 THEN '1' WHEN n <= 5 THEN '2-5' ELSE '>5' END AS bucket, CAST(count(*) AS BIGINT) AS "groups", CAST(max(n) AS BIGINT) AS largest FROM g GROUP BY 1""")
def size_distribution(spark, sf_dir):
    return golden.size_distribution(_lines(spark, sf_dir))


@query("identifier_conflicts", f"WITH {_LINES} SELECT g AS \"group\", CAST(count(DISTINCT nit) AS BIGINT) AS bases FROM r GROUP BY g HAVING count(DISTINCT nit) > 1")
def identifier_conflicts(spark, sf_dir):
    return golden.conflicts(_lines(spark, sf_dir).withColumnRenamed("nit", "base"))


@query("cannot_link", f"""WITH {_LINES}, b AS (SELECT g, rec_id, CASE WHEN nit = '0' THEN '' ELSE nit END AS base FROM r), c AS (SELECT g, base, count(*) AS n, min(rec_id) AS least FROM b WHERE base <> '' GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, base) AS k, count(*) OVER (PARTITION BY g) AS bases FROM c), t AS (SELECT DISTINCT g FROM k WHERE bases > 1)
    SELECT b.rec_id, CASE WHEN t.g IS NULL OR k.k = 1 THEN b.g WHEN b.base = '' THEN b.rec_id ELSE k.least END AS "group" FROM b LEFT JOIN t ON b.g = t.g LEFT JOIN k ON b.g = k.g AND b.base = k.base""")
def cannot_link(spark, sf_dir):
    rows = _lines(spark, sf_dir)
    return clusters.cannot_link(rows.select("rec_id", "group", F.when(F.col("nit") == "0", "").otherwise(F.col("nit")).alias("base")))


@query("group_numbers", "WITH k AS (SELECT p_brand, min(p_partkey) AS k FROM part GROUP BY 1) SELECT p_brand AS \"group\", CAST(row_number() OVER (ORDER BY k) - 1 AS BIGINT) AS \"ID_GRUPO\" FROM k")
def group_numbers(spark, sf_dir):
    return clusters.numbered(parts(spark, sf_dir).select(F.col("brand").alias("group"), "rec_id"), "rec_id")


@query("entity_ids", f"""WITH {_LINES}, g AS (SELECT g, count(*) AS n, min('L-' || rec_id) AS least, string_agg('L-' || rec_id, '|' ORDER BY 'L-' || rec_id) AS records, min(nit) AS base, count(DISTINCT nit) AS bases FROM r GROUP BY g),
    k AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY CASE WHEN bases = 1 THEN 0 ELSE 1 END, n DESC, least) AS k FROM g)
    SELECT g AS "group", CASE WHEN bases = 1 AND k = 1 THEN 'NIT-' || base ELSE 'ENT-' || substr(sha256(records), 1, 16) END AS "ID_ENTIDAD" FROM k""")
def entity_ids(spark, sf_dir):
    rows = _lines(spark, sf_dir).select("group", F.concat(F.lit("L-"), F.col("rec_id").cast("string")).alias("record"), F.col("nit").alias("base"))
    return golden.entity_ids(rows)


@query("crosswalk_inherit", """WITH o AS (SELECT o_orderkey % 50 AS g, o_custkey % 20 AS old, count(*) AS n FROM orders GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY old ORDER BY n DESC, g) AS k FROM o),
    c AS (SELECT old, g, n FROM b WHERE k = 1) SELECT 'E' || old AS old_id, g AS "group", row_number() OVER (PARTITION BY g ORDER BY n DESC, 'E' || old) = 1 AS keeps FROM c""")
def crosswalk_inherit(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("E"), (F.col("o_custkey") % 20).cast("string")).alias("ID_ENTIDAD"), F.col("o_orderkey").cast("string").alias("record"), (F.col("o_orderkey") % 50).alias("group"))
    return golden.inherit(golden.crosswalk(rows), rows.select("record", "group"))


_RATED = "x AS (SELECT label AS t, vec_id % 7 AS p FROM embeddings), b AS (SELECT t, p, count(*) AS n FROM x GROUP BY ALL)"


@query("pairwise_quality", f"""WITH {_RATED}, s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM b) AS tp, (SELECT sum(k * (k - 1) / 2) FROM (SELECT sum(n) AS k FROM b GROUP BY t)) AS t, (SELECT sum(k * (k - 1) / 2) FROM (SELECT sum(n) AS k FROM b GROUP BY p)) AS p)
    SELECT CAST(tp AS BIGINT) AS tp, CAST(p - tp AS BIGINT) AS fp, CAST(t - tp AS BIGINT) AS fn, round(tp / p, 6) AS "precision", round(tp / t, 6) AS recall, round(2 * (tp / p) * (tp / t) / (tp / p + tp / t), 6) AS f1 FROM s""")
def pairwise_quality(spark, sf_dir):
    return evaluation.pairwise(table(spark, sf_dir, "embeddings").select(F.col("label").alias("truth"), (F.col("vec_id") % 7).alias("predicted")))


@query("bcubed_quality", f"""WITH {_RATED}, s AS (SELECT n, sum(n) OVER (PARTITION BY t) AS nt, sum(n) OVER (PARTITION BY p) AS np FROM b) SELECT round(sum(n * n / np) / sum(n), 6) AS "precision", round(sum(n * n / nt) / sum(n), 6) AS recall FROM s""")
def bcubed_quality(spark, sf_dir):
    return evaluation.bcubed(table(spark, sf_dir, "embeddings").select(F.col("label").alias("truth"), (F.col("vec_id") % 7).alias("predicted")))


@query("annotator_kappa", """WITH x AS (SELECT quality AS a, toxic AS b FROM labels), t AS (SELECT count(*) AS t FROM x), o AS (SELECT count(*) AS o FROM x WHERE a = b),
    c AS (SELECT sum(na * nb) AS c FROM (SELECT a, count(*) AS na FROM x GROUP BY a) JOIN (SELECT b, count(*) AS nb FROM x GROUP BY b) ON a = b)
    SELECT round((o / t - c / (t * t)) / (1 - c / (t * t)), 6) AS kappa FROM t, o, c""")
def annotator_kappa(spark, sf_dir):
    return evaluation.kappa(table(spark, sf_dir, "labels").select(F.col("quality").alias("a"), F.col("toxic").alias("b")))


@query("blocking_quality", """WITH p AS (SELECT p_partkey AS rec_id, upper(p_name) AS name, p_brand AS brand FROM part), b AS (SELECT a.rec_id AS l, b.rec_id AS r, a.name = b.name AS hit FROM p a JOIN p b ON a.brand = b.brand AND a.rec_id < b.rec_id)
    SELECT round(count(*) FILTER (hit) / (SELECT sum(k * (k - 1) / 2) FROM (SELECT count(*) AS k FROM p GROUP BY name)), 6) AS pair_completeness, round(1 - count(*) / ((SELECT count(*) FROM p) * ((SELECT count(*) FROM p) - 1) / 2), 6) AS reduction_ratio FROM b""")
def blocking_quality(spark, sf_dir):
    return evaluation.key_blocking_quality(parts(spark, sf_dir).select("rec_id", F.col("name").alias("truth"), F.array("brand").alias("keys")))


@query("quality_report", """WITH k AS (SELECT p_name AS name, CAST(p_partkey AS VARCHAR) AS nit, length(CAST(p_partkey AS VARCHAR)) BETWEEN 6 AND 15 AS ok FROM part)
    SELECT CAST(count(*) AS BIGINT) AS "rows", CAST(0 AS BIGINT) AS missing_names, CAST(count(*) FILTER (NOT ok) AS BIGINT) AS invalid_nits, CAST(count(*) - count(DISTINCT (name, nit)) AS BIGINT) AS repeated,
    round(100 * (1 - (0.4 * count(*) FILTER (NOT ok) + 0.2 * (count(*) - count(DISTINCT (name, nit)))) / count(*)), 4) AS score FROM k""")
def quality_report(spark, sf_dir):
    return golden.quality_report(table(spark, sf_dir, "part"), F.col("p_name"), F.col("p_partkey"))


@query("spreadsheet_safe", r"""SELECT doc_id, sha256(CASE WHEN regexp_matches(t, '^\s*[=+\-@]') THEN '''' || t ELSE t END) AS safe FROM (SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') AS t FROM documents)""")
def spreadsheet_safe(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(sinks.neutralise(F.col("text")), 256).alias("safe"))


@query("star_cover")
def star_cover(spark, sf_dir):
    p = parts(spark, sf_dir)
    return clusters.star_cover(p.withColumn("group", F.min("rec_id").over(Window.partitionBy("brand"))).select("rec_id", "group", "name"))


@query("lsh_pairs")
def lsh_pairs(spark, sf_dir):
    return blocking.lsh_pairs(names(spark, sf_dir))


@query("schema_dedupe")
def schema_dedupe(spark, sf_dir):
    rows = parts(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("rec_id"), "p_size", "p_retailprice"), "rec_id")
    schema = scoring.Schema((scoring.FieldSpec("brand", "exact_signed", 1.0, veto=-0.5), scoring.FieldSpec("name", "token_set_signed", 2.0), scoring.FieldSpec("p_size", "number_relative", 0.5), scoring.FieldSpec("p_retailprice", "number_relative", 0.5)), 0.8, 2)
    return api.dedupe_by_key(rows, F.concat_ws("/", "brand", "name"), schema)


@query("linkage")
def linkage(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", (F.lit(900000000) + F.col("p_partkey") % 300).cast("string").alias("nit"))
    return api.linkage(spark, {"LEFT": p.filter("p_partkey % 2 = 0"), "RIGHT": p.filter("p_partkey % 2 = 1")}, "p_name", "nit", "p_partkey").correlative


from . import catalog_linking, catalog_more, catalog_pairs, catalog_refine  # noqa: E402

QUERIES |= catalog_more.QUERIES | catalog_pairs.QUERIES | catalog_linking.QUERIES | catalog_refine.QUERIES
ORACLES |= catalog_more.ORACLES | catalog_pairs.ORACLES | catalog_linking.ORACLES | catalog_refine.ORACLES
