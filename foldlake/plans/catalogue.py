"""The registered queries of the structural engine, each with its SQL, on the driver's tables.

Each query runs an operator of the library on a table of the same shape; the domain paths themselves are tested on small
structures. Column types are fixed on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlake.functions import residues, text
from foldlake.functions.alignment import affine_identity, lcs_identity
from foldlake.functions.geometry import rigid
from foldlake.functions.superpose import superpose
from foldlake.functions.text import fixed
from foldlake.operators import catalogue, contacts, lookup, sequences, summary

FLAGSHIP = "complex_status"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of a table reader, under its name, with its SQL."""

    def register(make):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return make(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[make.__name__] = run
        if sql:
            ORACLE_SQL[make.__name__] = sql
        return run

    return register


@query("""SELECT p_partkey, p_name, CAST(p_size AS INTEGER) AS p_size FROM part
WHERE lower(p_name) LIKE '%widget%' AND try_cast(trim(CAST(p_size AS VARCHAR)) AS DOUBLE) <= 25
AND p_name IS NOT NULL AND p_name <> 'NA' AND p_brand IS NOT NULL AND p_brand <> 'NA'""")
def catalog_filter(t):
    conditions = [
        ("type", text.contains_ci("p_name", "WIDGET")),
        ("size", text.number_or_null("p_size") <= 25),
        ("name", catalogue.present("p_name")),
        ("brand", catalogue.present("p_brand")),
    ]
    return catalogue.keep_all(t("part"), conditions).select("p_partkey", "p_name", "p_size")


@query("""SELECT CAST(count(*) AS BIGINT) AS n_all, CAST(count(*) FILTER (l_quantity <= 25) AS BIGINT) AS n_quantity,
CAST(count(*) FILTER (l_quantity <= 25 AND l_returnflag = 'R') AS BIGINT) AS n_returned,
CAST(count(*) FILTER (l_quantity <= 25 AND l_returnflag = 'R' AND l_discount > 0.05) AS BIGINT) AS n_discount FROM lineitem""")
def filter_funnel(t):
    conditions = [("quantity", F.col("l_quantity") <= 25), ("returned", F.col("l_returnflag") == "R"), ("discount", F.col("l_discount") > 0.05)]
    return catalogue.funnel(t("lineitem"), conditions)


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey
ORDER BY l_linenumber, l_suppkey) AS k FROM lineitem) WHERE k = 1""")
def dedupe_first(t):
    out = catalogue.first_rows(t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"), ["l_orderkey", "l_partkey"], ["l_linenumber", "l_suppkey"])
    return out


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100")
def head_limit(t):
    return catalogue.head(t("orders").select("o_orderkey", "o_custkey"), 100, ["o_orderkey"])


@query("""SELECT l_partkey, l_orderkey, l_suppkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY
CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END, l_extendedprice NULLS LAST, l_orderkey, l_linenumber, l_suppkey) AS k FROM lineitem) WHERE k = 1""")
def best_candidate(t):
    rows = t("lineitem").select("l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    out = catalogue.best_candidates(rows, ["l_partkey"], F.col("l_returnflag") == "A", "l_extendedprice", ["l_orderkey", "l_linenumber", "l_suppkey"])
    return out.select("l_partkey", "l_orderkey", "l_suppkey", "l_linenumber")


@query("""WITH k AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS q FROM part UNION SELECT DISTINCT p_name FROM part),
p AS (SELECT p_partkey, p_name FROM part),
ex AS (SELECT q, p_partkey, 1 AS tier FROM k JOIN p ON lower(trim(q)) = lower(trim(p_name))),
pa AS (SELECT q, p_partkey, 2 AS tier FROM k JOIN p ON lower(trim(q)) <> '' AND contains(lower(trim(p_name)), lower(trim(q)))
WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.q = k.q))
SELECT q, p_partkey, CAST(tier AS INTEGER) AS tier FROM ex UNION ALL SELECT q, p_partkey, CAST(tier AS INTEGER) FROM pa""")
def tiered_match(t):
    part = t("part")
    names = part.select("p_name").distinct()
    keys = names.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("q")).union(names).distinct()
    return lookup.tiered(keys, part.select("p_partkey", "p_name"), "q", "p_name").select("q", "p_partkey", "tier")


@query("""SELECT c_custkey, coalesce(CAST(o.k AS BIGINT), CAST(n.n_nationkey AS BIGINT)) AS key,
CASE WHEN o.k IS NOT NULL THEN 'orders' WHEN n.n_nationkey IS NOT NULL THEN 'nation' END AS source
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) o ON o_custkey = c_custkey
LEFT JOIN nation n ON n_nationkey = c_nationkey AND n_regionkey = 1""")
def source_priority(t):
    done = catalogue.first_rows(t("orders").where("o_orderstatus = 'F'").select("o_custkey", F.col("o_orderkey").alias("a")), ["o_custkey"], ["a"])
    near = t("nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_nationkey").cast("long").alias("b"))
    rows = t("customer").select("c_custkey", "c_nationkey").join(done.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left").join(near, "c_nationkey", "left")
    return lookup.prefer(rows, {"key": ("a", "b")}, "a", ("orders", "nation")).select("c_custkey", "key", "source")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name, n_name, r_name FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def lookup_chain(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    steps = [
        (t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey"), ["l_suppkey"], ["s_name"]),
        (t("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey"), ["s_nationkey"], ["n_name"]),
        (t("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), ["n_regionkey"], ["r_name"]),
    ]
    for right, on, order in steps:
        rows = lookup.first_match(rows, right, on, order)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "s_name", "n_name", "r_name")


@query("""WITH k AS (SELECT c_custkey FROM customer), ex AS (SELECT o_custkey AS c_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r
FROM orders WHERE o_orderpriority = '1-URGENT'), br AS (SELECT o_custkey AS c_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r
FROM orders WHERE o_totalprice > 0 AND o_custkey IN (SELECT c_custkey FROM k) AND o_custkey NOT IN (SELECT c_custkey FROM ex))
SELECT c_custkey, o_orderkey, o_totalprice, 'exact' AS source FROM ex WHERE r = 1 UNION ALL SELECT c_custkey, o_orderkey, o_totalprice, 'broad' FROM br WHERE r = 1""")
def ortholog_fallback(t):
    hits = t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", "o_orderpriority")
    exact = hits.where("o_orderpriority = '1-URGENT'").drop("o_orderpriority")
    return lookup.fallback(t("customer").select("c_custkey"), exact, hits.drop("o_orderpriority"), "c_custkey", "o_totalprice", ["o_orderkey"])


_LADDER = """CASE WHEN c_custkey IS NULL THEN 'failed' WHEN o_totalprice < 1000 THEN 'failed' WHEN o_orderstatus = 'P' THEN 'dry_run' ELSE 'success' END"""


def _ladder(t):
    rows = t("orders").join(t("customer").select(F.col("c_custkey")), F.col("o_custkey") == F.col("c_custkey"), "left")
    low = F.col("o_totalprice") < 1000
    state, message = lookup.status(
        [
            (F.col("c_custkey").isNull(), "failed", "no customer"),
            (low, "failed", F.concat(F.lit("price "), fixed("o_totalprice", 1), F.lit(" below threshold"))),
            (F.col("o_orderstatus") == "P", "dry_run", ""),
        ]
    )
    return rows.withColumn("status", state).withColumn("error_message", message)


@query(f"""SELECT o_orderkey, {_LADDER} AS status, CASE WHEN c_custkey IS NULL THEN 'no customer' WHEN o_totalprice < 1000
THEN printf('price %.1f below threshold', o_totalprice) ELSE '' END AS error_message FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def status_ladder(t):
    return _ladder(t).select("o_orderkey", "status", "error_message")


@query(f"""WITH s AS (SELECT *, {_LADDER} AS status FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
SELECT CAST(count(*) AS BIGINT) AS n_total, CAST(count(*) FILTER (status = 'success') AS BIGINT) AS n_success, CAST(count(*) FILTER (status = 'failed') AS BIGINT) AS n_failed,
CAST(count(*) FILTER (status = 'dry_run') AS BIGINT) AS n_dry_run, CAST(count(*) FILTER (status <> 'success') AS BIGINT) AS n_not_success,
round(avg(o_totalprice) FILTER (status = 'success'), 4) AS mean_identity, round(avg(CAST(o_orderkey AS DOUBLE)) FILTER (status = 'success'), 4) AS mean_rmsd FROM s""")
def status_summary(t):
    out = summary.status_summary(_ladder(t), "status", "o_totalprice", "o_orderkey")
    return out.withColumns({c: F.round(c, 4) for c in ("mean_identity", "mean_rmsd")})


@query("""SELECT s_nationkey, s_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY
coalesce(nullif(greatest(round(s_acctbal, 0), 0.0), 0.0), CAST('inf' AS DOUBLE)), s_suppkey) AS k FROM supplier) WHERE k = 1""")
def library_argmin(t):
    rows = t("supplier").withColumn("rmsd", F.greatest(F.round("s_acctbal", 0), F.lit(0.0))).withColumn("gene", F.col("s_nationkey").cast("string"))
    return summary.best_of_gene(rows, "gene", "rmsd", ["s_suppkey"]).select("s_nationkey", "s_suppkey")


def _side(t, first: bool) -> DataFrame:
    """One of the two sides of the whole of embeddings, which the middle of its ids parts."""
    rows = t("embeddings")
    middle = rows.agg(((F.min("vec_id") + F.max("vec_id") + 1) / 2).alias("_middle"))
    low = F.coalesce(F.col("vec_id") < F.col("_middle"), F.lit(False))
    return rows.crossJoin(F.broadcast(middle)).where(low if first else ~low).drop("_middle")


def _points(t, mark: str, first: bool) -> DataFrame:
    xyz = [(F.col("embedding")[i].cast("double") * 10).alias(f"{mark}{c}") for i, c in enumerate("xyz")]
    return _side(t, first).select(F.col("vec_id").alias(f"{mark}_id"), F.col("label").alias("label"), *xyz)


_NEAR = """WITH m AS (SELECT (min(vec_id) + max(vec_id) + 1) / 2.0 AS m FROM embeddings), g AS (SELECT vec_id AS g_id, label, CAST(embedding[1] AS DOUBLE)*10 AS gx, CAST(embedding[2] AS DOUBLE)*10 AS gy, CAST(embedding[3] AS DOUBLE)*10 AS gz FROM embeddings, m WHERE coalesce(vec_id < m.m, false)),
b AS (SELECT vec_id AS b_id, label, CAST(embedding[1] AS DOUBLE)*10 AS bx, CAST(embedding[2] AS DOUBLE)*10 AS by_, CAST(embedding[3] AS DOUBLE)*10 AS bz FROM embeddings, m WHERE NOT coalesce(vec_id < m.m, false)),
near AS (SELECT g_id, b_id, g.label FROM g JOIN b ON g.label = b.label AND (gx-bx)*(gx-bx)+(gy-by_)*(gy-by_)+(gz-bz)*(gz-bz) <= 1.5*1.5)"""


@query(f"{_NEAR} SELECT label, g_id, b_id FROM near")
def contact_pairs(t):
    found = contacts.pairs_within(_points(t, "g", True), _points(t, "b", False), "label", ("gx", "gy", "gz"), ("bx", "by", "bz"), 1.5)
    return found.select("label", "g_id", "b_id")


@query(f"""{_NEAR}, n AS (SELECT g.label, g.g_id, count(b_id) AS n FROM g LEFT JOIN near USING (g_id) GROUP BY g.label, g.g_id),
r AS (SELECT *, sum(n) OVER (PARTITION BY label ORDER BY g_id ROWS UNBOUNDED PRECEDING) AS run FROM n)
SELECT label, CAST(coalesce(min(run) FILTER (run >= 10), sum(n)) AS BIGINT) AS contact_count, CAST(sum(n) AS BIGINT) AS contact_count_full,
coalesce(min(run) FILTER (run >= 10), sum(n)) >= 10 AS passed FROM r GROUP BY label""")
def contact_filter(t):
    counts = contacts.counts_within(_points(t, "g", True), _points(t, "b", False), "label", "g_id", ("gx", "gy", "gz"), ("bx", "by", "bz"), 1.5)
    return summary.contact_verdicts(counts, "label", "g_id", 10)


@query(f"{_NEAR} SELECT DISTINCT label, g_id FROM near")
def epitope_semi(t):
    near = contacts.rows_within(_points(t, "g", True), _points(t, "b", False), "label", ("gx", "gy", "gz"), ("bx", "by", "bz"), 1.5)
    return near.select("label", "g_id").distinct()


@query("""WITH m AS (SELECT (min(vec_id) + max(vec_id) + 1) / 2.0 AS m FROM embeddings),
g AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k, embedding AS e FROM embeddings, m WHERE coalesce(vec_id < m.m, false)),
b AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k, embedding AS e FROM embeddings, m WHERE NOT coalesce(vec_id < m.m, false))
SELECT g.label, CAST(count(*) AS BIGINT) AS n_pairs, round(sqrt(avg(pow(CAST(g.e[1] AS DOUBLE)-CAST(b.e[1] AS DOUBLE),2)+pow(CAST(g.e[2] AS DOUBLE)-CAST(b.e[2] AS DOUBLE),2)
+pow(CAST(g.e[3] AS DOUBLE)-CAST(b.e[3] AS DOUBLE),2))), 6) AS rmsd FROM g JOIN b ON g.label = b.label AND g.k = b.k GROUP BY g.label""")
def paired_rmsd(t):
    sides = []
    for first in (True, False):
        sides.append(_side(t, first).select("label", "vec_id", *[F.col("embedding")[i].alias(c) for i, c in enumerate("xyz")]))
    return summary.paired_rmsd(*sides, "label", "vec_id", ("x", "y", "z")).withColumn("rmsd", F.round("rmsd", 6))


@query("""WITH e AS (SELECT l_orderkey, min(l_linenumber) AS a, max(l_linenumber) AS b FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CAST(n AS INTEGER) AS l_linenumber FROM (SELECT l_orderkey, unnest(generate_series(a, b)) AS n FROM e) x
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = x.l_orderkey AND l.l_linenumber = x.n)""")
def missing_numbers(t):
    return summary.missing_numbers(t("lineitem"), "l_orderkey", "l_linenumber")


@query("""WITH s AS (SELECT s_suppkey, s_name || ' | ' || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'B' END || ' |C, D' AS c FROM supplier)
SELECT s_suppkey, list_filter(list_transform(string_split(c, '|'), lambda x: trim(x)), lambda x: x <> '') AS chains,
trim(string_split(c, '|')[1]) AS first_chain, trim(string_split(c, ' | ')[1]) AS first_spaced, array_to_string(list_transform(string_split(c, ','), lambda x: trim(x)), ',') AS joined FROM s""")
def chain_split(t):
    middle = F.when(F.col("s_suppkey") % 3 == 0, "").otherwise("B")
    rows = t("supplier").select("s_suppkey", F.concat("s_name", F.lit(" | "), middle, F.lit(" |C, D")).alias("c"))
    return rows.select("s_suppkey", text.chain_list("c").alias("chains"), text.first_chain("c").alias("first_chain"), text.first_spaced("c").alias("first_spaced"), F.array_join(text.comma_list("c"), ",").alias("joined"))


@query(r"""SELECT page_id, substr(regexp_replace(coalesce(nullif(url, ''), 'Human'), '[^\p{L}\p{N}_-]', '_', 'g'), 1, 50) AS name, 'DP_' || CAST(page_id AS VARCHAR) || '_A' AS id FROM pages""")
def sanitize_names(t):
    return t("pages").select("page_id", text.sanitize("url").alias("name"), F.concat(F.lit("DP_"), F.col("page_id").cast("string"), F.lit("_A")).alias("id"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(replace(regexp_replace(upper(replace(text, 'ß', 's')) || '(MSE)(ABC)', '[\n\r ]', '', 'g'), '(MSE)', 'M'), '\([A-Z]{3}\)', 'X', 'g'), '[^\p{Lu}]', '', 'g') AS sequence
FROM documents""")
def clean_sequence(t):
    rows = t("documents").select("doc_id", F.concat(F.upper(F.replace("text", F.lit("ß"), F.lit("s"))), F.lit("(MSE)(ABC)")).alias("s"))
    return rows.select("doc_id", residues.clean_sequence("s").alias("sequence"))


@query("""WITH c AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'ALA' WHEN 1 THEN 'MSE' WHEN 2 THEN 'gly' WHEN 3 THEN 'QQQ' ELSE 'HOH2' END AS r FROM part)
SELECT p_partkey, CASE upper(r) WHEN 'ALA' THEN 'A' WHEN 'GLY' THEN 'G' ELSE 'X' END AS one, CASE upper(r) WHEN 'ALA' THEN 'A' WHEN 'GLY' THEN 'G' WHEN 'MSE' THEN 'M' WHEN 'QQQ' THEN 'X' END AS modified FROM c""")
def residue_map(t):
    name = F.element_at(F.array(*map(F.lit, ("ALA", "MSE", "gly", "QQQ", "HOH2"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    rows = t("part").select("p_partkey", name.alias("r"))
    return rows.select("p_partkey", residues.one_letter("r").alias("one"), residues.one_letter_modified("r").alias("modified"))


@query("SELECT l_orderkey, string_agg(l_returnflag, '' ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS sequence FROM lineitem GROUP BY l_orderkey")
def sequence_assembly(t):
    return t("lineitem").groupBy("l_orderkey").agg(residues.assemble("l_linenumber", "l_returnflag", "l_partkey", "l_suppkey").alias("sequence"))


@query("""SELECT p_partkey, round(CASE WHEN length(a) = 0 OR length(b) = 0 THEN 0.0 ELSE len(list_filter(range(1, least(length(a), length(b)) + 1), lambda i: a[i] = b[i])) * 100.0 / greatest(length(a), length(b)) END, 6) AS identity
FROM (SELECT p_partkey, p_name AS a, p_type AS b FROM part)""")
def positional_identity(t):
    return t("part").select("p_partkey", F.round(residues.positional_identity("p_name", "p_type"), 6).alias("identity"))


@query("""SELECT vec_id, round(0.0*e[1] - 1.0*e[2] + 1.5, 6) AS x, round(1.0*e[1] + 2.0, 6) AS y, round(e[3] - 0.5, 6) AS z
FROM (SELECT vec_id, list_transform(embedding[1:3], lambda v: CAST(v AS DOUBLE)) AS e FROM embeddings)""")
def rigid_transform(t):
    rows = t("embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xyz")])
    moved = rigid(("x", "y", "z"), ((0, -1, 0), (1, 0, 0), (0, 0, 1)), (1.5, 2.0, -0.5))
    return rows.select("vec_id", *[F.round(v, 6).alias(c) for c, v in zip("xyz", moved, strict=True)])


@query("""WITH i AS (SELECT DISTINCT l_orderkey AS s, l_returnflag AS chain, l_linenumber AS seq FROM lineitem),
c AS (SELECT l_orderkey AS s, l_returnflag AS c1, l_linenumber AS s1, l_linestatus AS c2, l_linenumber + 1 AS s2 FROM lineitem WHERE l_discount < 0.03),
e AS (SELECT * FROM (VALUES ('A', 0), ('N', 0), ('R', 1), ('F', 0), ('O', 1)) v(chain, e))
SELECT DISTINCT CAST(c.s AS VARCHAR) AS structure_id, CAST(e1.e AS INTEGER) AS entity_rank, CAST(s1 - 1 AS INTEGER) AS i, CAST(s2 - 1 AS INTEGER) AS j
FROM c JOIN i i1 ON i1.s = c.s AND i1.chain = c.c1 AND i1.seq = c.s1 JOIN i i2 ON i2.s = c.s AND i2.chain = CASE c.c2 WHEN 'F' THEN 'R' ELSE 'N' END AND i2.seq = c.s2
JOIN e e1 ON e1.chain = c.c1 JOIN e e2 ON e2.chain = CASE c.c2 WHEN 'F' THEN 'R' ELSE 'N' END WHERE e1.e = e2.e""")
def bond_index(t):
    li = t("lineitem").withColumn("structure_id", F.col("l_orderkey").cast("string"))
    atoms = li.select("structure_id", F.col("l_returnflag").alias("label_asym_id"), F.col("l_linenumber").cast("string").alias("label_seq_id"))
    other = F.when(F.col("l_linestatus") == "F", "R").otherwise("N")
    conn = li.where("l_discount < 0.03").select(
        "structure_id",
        F.lit("disulf").alias("conn_type_id"),
        F.col("l_returnflag").alias("ptnr1_label_asym_id"),
        F.col("l_linenumber").cast("string").alias("ptnr1_label_seq_id"),
        other.alias("ptnr2_label_asym_id"),
        (F.col("l_linenumber") + 1).cast("string").alias("ptnr2_label_seq_id"),
    )
    chains = F.explode(F.array(F.struct(F.array(F.lit("A"), F.lit("N")).alias("c"), F.lit(0).alias("e")), F.struct(F.array(F.lit("R")).alias("c"), F.lit(1).alias("e"))))
    seqs = li.select("structure_id").distinct().withColumn("x", chains).select("structure_id", F.col("x.c").alias("chains"), F.col("x.e").alias("entity_rank"))
    return sequences.bonds(sequences.disulfides(conn), sequences.residue_index(atoms), seqs)


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, coalesce(json_extract_string(props, '$.name'), 'Unknown') AS name FROM events""")
def json_extract(t):
    p = F.from_json("props", "k int, name string")
    return t("events").select("event_id", p["k"].alias("k"), text.or_default(p["name"], "Unknown").alias("name"))


@query("""SELECT 0 AS part, l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A' UNION ALL
SELECT 1, l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'""")
def union_parts(t):
    rows = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    from foldlake.operators.chains import merge

    none = rows.withColumns({"label_comp_id": F.lit("ALA"), "group_pdb": F.lit("ATOM")})
    merged = merge([none.where(F.col("l_returnflag") == f) for f in "AR"])
    return merged.select("part", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE (l_returnflag IN ('A', 'F') OR l_linestatus IN ('A', 'F')) AND l_quantity <> 10 AND l_tax <> 0""")
def chain_select(t):
    from foldlake.operators.chains import clean

    atoms = t("lineitem").withColumns(
        {
            "label_asym_id": F.col("l_returnflag"),
            "auth_asym_id": F.col("l_linestatus"),
            "label_comp_id": F.when(F.col("l_quantity") == 10, "HOH").otherwise("ALA"),
            "group_pdb": F.when(F.col("l_tax") == 0, "HETATM").otherwise("ATOM"),
        }
    )
    return clean(atoms, ["A", "F"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'x/1abc_antibody.cif' WHEN 1 THEN 'x/Human_AG.cif' WHEN 2 THEN 'x/mouse_ag_antibody.cif' ELSE 'x/other.name.cif' END AS f FROM pages)
SELECT page_id, CASE WHEN lower(f) LIKE '%antibody%' THEN 'antibody' WHEN lower(f) LIKE '%human_ag%' THEN 'human_ag' WHEN lower(f) LIKE '%mouse_ag%' THEN 'mouse_ag' ELSE 'other.name' END AS label FROM p""")
def component_label(t):
    names = ("x/1abc_antibody.cif", "x/Human_AG.cif", "x/mouse_ag_antibody.cif", "x/other.name.cif")
    rows = t("pages").select("page_id", F.element_at(F.array(*map(F.lit, names)), (F.col("page_id") % 4 + 1).cast("int")).alias("f"))
    return rows.select("page_id", text.component_label("f").alias("label"))


@query("""WITH RECURSIVE p AS (SELECT DISTINCT p_name AS a, p_type AS b FROM part WHERE p_name IS NOT NULL AND p_type IS NOT NULL),
d(a, b, i, r) AS (
  SELECT a, b, 0, list_transform(range(0, length(b) + 1), lambda j: 0) FROM p
  UNION ALL
  SELECT a, b, i + 1, list_transform(range(1, length(b) + 2), lambda j: list_max(list_transform(range(1, j + 1),
    lambda k: CASE WHEN k > 1 AND a[i + 1] = b[k - 1] THEN greatest(r[k], r[k - 1] + 1) ELSE r[k] END))) FROM d WHERE i < length(a)
), l AS (SELECT a, b, r[length(b) + 1] AS n FROM d WHERE i = length(a))
SELECT p_partkey, round(CASE WHEN coalesce(length(p_name), 0) = 0 OR coalesce(length(p_type), 0) = 0 THEN 0.0
ELSE n * 100.0 / (length(p_name) + length(p_type) - n) END, 6) AS identity FROM part LEFT JOIN l ON l.a = p_name AND l.b = p_type""")
def alignment_identity(t):
    return t("part").select("p_partkey", F.round(lcs_identity("p_name", "p_type"), 6).alias("identity"))


@query()
def affine_alignment(t):
    return t("part").select("p_partkey", F.round(affine_identity("p_name", "p_type"), 6).alias("identity"))


# The rmsd in closed form: the roots of the characteristic polynomial of S'S, S being the covariance of the two sides.
@query("""WITH e AS (SELECT label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z, CAST(embedding[4] AS DOUBLE) AS u, CAST(embedding[5] AS DOUBLE) AS v, CAST(embedding[6] AS DOUBLE) AS w FROM embeddings), c AS (SELECT *, avg(x) OVER (PARTITION BY label) AS mx, avg(y) OVER (PARTITION BY label) AS my, avg(z) OVER (PARTITION BY label) AS mz, avg(u) OVER (PARTITION BY label) AS mu, avg(v) OVER (PARTITION BY label) AS mv, avg(w) OVER (PARTITION BY label) AS mw FROM e),
s AS (SELECT label, count(*) AS n, sum((x - mx) * (x - mx) + (y - my) * (y - my) + (z - mz) * (z - mz) + (u - mu) * (u - mu) + (v - mv) * (v - mv) + (w - mw) * (w - mw)) AS g, sum((x - mx) * (u - mu)) AS sxu, sum((x - mx) * (v - mv)) AS sxv, sum((x - mx) * (w - mw)) AS sxw, sum((y - my) * (u - mu)) AS syu, sum((y - my) * (v - mv)) AS syv, sum((y - my) * (w - mw)) AS syw, sum((z - mz) * (u - mu)) AS szu, sum((z - mz) * (v - mv)) AS szv, sum((z - mz) * (w - mw)) AS szw FROM c GROUP BY label),
t AS (SELECT *, sxu * sxu + syu * syu + szu * szu AS tuu, sxv * sxv + syv * syv + szv * szv AS tvv, sxw * sxw + syw * syw + szw * szw AS tww, sxu * sxv + syu * syv + szu * szv AS tuv, sxu * sxw + syu * syw + szu * szw AS tuw, sxv * sxw + syv * syw + szv * szw AS tvw, sxu * (syv * szw - syw * szv) - sxv * (syu * szw - syw * szu) + sxw * (syu * szv - syv * szu) AS d FROM s),
q AS (SELECT *, (tuu + tvv + tww) / 3 AS m FROM t),
p AS (SELECT *, sqrt(((tuu - m) * (tuu - m) + (tvv - m) * (tvv - m) + (tww - m) * (tww - m) + 2 * (tuv * tuv + tuw * tuw + tvw * tvw)) / 6) AS p FROM q),
r AS (SELECT *, acos(greatest(-1.0, least(1.0, ((tuu - m) * ((tvv - m) * (tww - m) - tvw * tvw) - tuv * (tuv * (tww - m) - tvw * tuw)
  + tuw * (tuv * tvw - (tvv - m) * tuw)) / (2 * p * p * p)))) / 3 AS f FROM p),
k AS (SELECT *, m + 2 * p * cos(f) AS k1, m + 2 * p * cos(f + 2 * pi() / 3) AS k3 FROM r)
SELECT label, CAST(n AS BIGINT) AS n, round(sqrt(greatest(0.0, (g - 2 * (sqrt(greatest(k1, 0.0)) + sqrt(greatest(3 * m - k1 - k3, 0.0)) + sign(d) * sqrt(greatest(k3, 0.0)))) / n)), 6) AS rmsd FROM k""")
def superposition(t):
    rows = t("embeddings").select("label", *[F.col("embedding")[i].alias(c) for i, c in enumerate("xyz")], *[F.col("embedding")[i + 3].alias(f"f{c}") for i, c in enumerate("xyz")])
    return superpose(rows, "label").select("label", "n", F.round("rmsd", 6).alias("rmsd"))


@query(f"""WITH u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS k FROM orders WHERE o_totalprice IS NOT NULL) WHERE k = 1)
SELECT status, CAST(count(*) AS BIGINT) AS n, round(avg(o_totalprice), 4) AS mean_price FROM (SELECT *, {_LADDER} AS status FROM u LEFT JOIN customer ON o_custkey = c_custkey) GROUP BY status""")
def complex_status(t):
    """Filter, first of each key, lookup, status ladder and summary: the dataset build in small."""
    rows = catalogue.first_rows(t("orders").where("o_totalprice IS NOT NULL"), ["o_custkey", "o_orderpriority"], ["o_orderkey"])
    ladder = _ladder(lambda name: rows if name == "orders" else t(name))
    return ladder.groupBy("status").agg(F.count("*").cast("long").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_price"))
