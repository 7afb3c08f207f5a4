"""Registered queries of the steps of a build and of the folder commands, each with its SQL, beside those of catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldlake.operators import catalogue
from foldlake.plans import build, contacts
from foldlake.plans.catalogue import query
from foldlake.sources import payloads


def _text(c: str):
    return F.col(c).cast("string")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS pdb, p_brand AS "Hchain", CASE WHEN p_size > 10 THEN p_brand END AS "Lchain",
CASE p_partkey % 4 WHEN 0 THEN 'A | B' WHEN 1 THEN 'C' WHEN 2 THEN ' | ' END AS antigen_chain, CASE p_partkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN ' | ' END AS first_chain,
'Unknown' AS antigen_species, CASE WHEN p_size <> 7 THEN p_name END AS antigen_name, 'N/A' AS resolution FROM part""")
def chain_defaults(t):
    """Parts as a catalogue without species and resolution, which get their defaults; a null name stays null."""
    chain = F.element_at(F.array(F.lit("A | B"), F.lit("C"), F.lit(" | "), F.lit(None)), (F.col("p_partkey") % 4 + 1).cast("int"))
    rows = t("part").select(
        _text("p_partkey").alias("pdb"), F.col("p_brand").alias("Hchain"), F.when(F.col("p_size") > 10, F.col("p_brand")).alias("Lchain"),
        chain.alias("antigen_chain"), F.when(F.col("p_size") != 7, F.col("p_name")).alias("antigen_name"),
    )
    return catalogue.chain_info(rows)


@query("""WITH m AS (SELECT p_partkey, p_name, lower(p_name) AS low, p_size / 20.0 AS res, p_partkey % 3 <> 0 AS complete FROM part WHERE p_size % 4 < 2),
h AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS name FROM part UNION SELECT DISTINCT p_name FROM part WHERE p_size > 25),
t1 AS (SELECT name, m.*, 1 AS tier FROM h JOIN m ON low = lower(name)),
t2 AS (SELECT name, m.*, 2 AS tier FROM h JOIN m ON contains(low, lower(name)) WHERE name NOT IN (SELECT name FROM t1)),
b AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY complete DESC, res, p_partkey) AS k FROM (SELECT * FROM t1 UNION ALL SELECT * FROM t2) WHERE res <= 1.5)
SELECT name AS antigen_name, 'm' || CAST(p_partkey AS VARCHAR) AS sabdab_pdb, 'A' AS sabdab_chain, p_name AS sabdab_name, CAST(tier AS INTEGER) AS tier FROM b WHERE k = 1""")
def catalogue_mice(t):
    """The best mouse complex (a part) of each name: of that name, else of a name that holds it; the resolution is tested after
    the choice between the two, so that a name whose equals are all too coarse has none."""
    part = t("part")
    kind = F.element_at(F.array(F.lit("Mus musculus"), F.lit("house MOUSE"), F.lit("Homo sapiens"), F.lit(None)), (F.col("p_size") % 4 + 1).cast("int"))
    rows = part.select(
        F.concat(F.lit("m"), _text("p_partkey")).alias("pdb"), F.lit("A | B").alias("antigen_chain"), kind.alias("antigen_species"), F.col("p_name").alias("antigen_name"),
        F.when(F.col("p_partkey") % 3 != 0, "H").otherwise("NA").alias("Hchain"), F.lit("L").alias("Lchain"),
        (F.col("p_size") / 20).cast("string").alias("resolution"), F.col("p_partkey").alias("ordinal"),
    )
    names = part.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("antigen_name")).union(part.where("p_size > 25").select("p_name"))
    return build.mouse_candidates(rows, names, build.Options(resolution=1.5))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'A;' ELSE '' END || CAST(c_nationkey AS VARCHAR) END AS chains FROM customer""")
def strand_lists(t):
    """Strand lists of entity payloads, with blanks and empty parts; a payload without a list has no chains."""
    strands = F.concat(F.when(F.col("c_custkey") % 2 == 0, "A , ").otherwise(","), _text("c_nationkey"), F.lit(",,"))
    whole = F.to_json(F.struct(F.struct(F.when(F.col("c_custkey") % 7 != 0, strands).alias("pdbx_strand_id")).alias("entity_poly")))
    out = payloads.entity_chains(t("customer").select("c_custkey", whole.alias("payload")))
    return out.select("c_custkey", F.array_join("chains", ";").alias("chains"))


@query("""WITH f AS (SELECT 'h' || CAST(c_custkey AS VARCHAR) AS path FROM customer WHERE c_nationkey % 2 = 0 UNION SELECT 'b' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION SELECT 'm' || CAST(p_partkey AS VARCHAR) FROM part)
SELECT o_orderkey, o_orderpriority || '_g' || CAST(o_custkey % 10 AS VARCHAR) || '_' || CAST(o_orderkey AS VARCHAR) AS triplet_name,
o_custkey % 7 <> 0 AND 'h' || CAST(o_custkey AS VARCHAR) IN (SELECT path FROM f) AND 'm' || CAST(o_orderkey % 1000 AS VARCHAR) IN (SELECT path FROM f)
AND 'b' || CAST(o_custkey AS VARCHAR) IN (SELECT path FROM f) AS complete FROM orders""")
def complete_triplets(t):
    """Orders as pairs that name three files, against the files that exist, of which each is listed twice."""
    file = lambda mark, c: F.concat(F.lit(mark), c.cast("string"))
    key = F.col("o_custkey")
    rows = t("orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("human_antigen_gene"), file("g", key % 10).alias("mouse_antigen_gene"), _text("o_orderkey").alias("human_antigen_pdb"),
        file("h", key).alias("human_antigen_file"), file("m", F.col("o_orderkey") % 1000).alias("mouse_antigen_file"), F.when(key % 7 != 0, file("b", key)).alias("antibody_file"),
    )
    own = t("customer").select(file("h", F.col("c_custkey")).alias("path")).where("c_nationkey % 2 = 0")
    files = own.union(t("customer").where("c_mktsegment <> 'BUILDING'").select(file("b", F.col("c_custkey")))).union(t("part").select(file("m", F.col("p_partkey"))))
    return contacts.triplets(rows, files.union(files)).select("o_orderkey", "triplet_name", "complete")


@query("""WITH n AS (SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS one, max(CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END) AS two FROM lineitem GROUP BY l_orderkey)
SELECT 'DP_' || CAST(o_orderkey AS VARCHAR) AS dp_id, CASE o_custkey % 5 WHEN 0 THEN 'metadata.json not found' WHEN 1 THEN 'metadata load error' WHEN 2 THEN 'missing antibody or antigen file'
ELSE CASE WHEN coalesce(one + two, 0) < 2 THEN 'PDB files not found' END END AS reason FROM orders LEFT JOIN n ON l_orderkey = o_orderkey
WHERE o_custkey % 11 <> 0 AND (o_custkey % 5 <> 0 OR l_orderkey IS NOT NULL)""")
def folder_reasons(t):
    """Orders as folders and their lines as files: why a folder can't be evaluated. Folders of other names are left out."""
    mark = lambda key: F.concat(F.when(F.col("o_custkey") % 11 == 0, "X_").otherwise("DP_"), key.cast("string"))
    found = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    found = found.select(mark(F.col("o_orderkey")).alias("dp_id"), F.concat(F.lit("file:/x/"), _text("l_linenumber"), F.lit(".pdb")).alias("path"))
    k = F.col("o_custkey") % 5
    both = '{"id": "a", "files": {"antibody_pdb": "1.pdb", "human_ag_pdb": "2.pdb"}}'
    text = F.when(k == 1, "{broken").when(k == 2, '{"id": "a", "files": {"antibody_pdb": "1.pdb", "human_ag_pdb": ""}}').otherwise(both)
    metadata = t("orders").where(k != 0).select(mark(F.col("o_orderkey")).alias("dp_id"), text.alias("text"))
    return contacts.folders(found, metadata).select("dp_id", "reason")
