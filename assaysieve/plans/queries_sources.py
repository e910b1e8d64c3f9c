"""Queries over sources, column roles and catalogue lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaysieve.functions import exprs as X
from assaysieve.functions import molecules
from assaysieve.functions.vocabulary import MASTER_SCHEMA
from assaysieve.operators import catalogue as C
from assaysieve.operators import prepare as P
from assaysieve.operators import roles as R
from assaysieve.plans.catalogue_build import build_catalogue, names_to_library
from assaysieve.plans.registry import DOCS_SQL, doc_library, parts, query, rounded, table
from assaysieve.session import scratch_path
from assaysieve.sources import files, lists, responses

_WS = X.WHITESPACE


@query("control_filter", """
SELECT event_id, user_id, event_type, value FROM events
WHERE NOT coalesce(contains(lower(event_type), 'error'), FALSE)""")
def control_filter(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    return R.without_controls(events, "event_type", "error")


def _customer_places(spark, folder):
    """Customers with their country written in one of several ways."""
    key = F.col("c_nationkey").cast("string")
    place = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(F.lit("\t Nation_"), key, F.lit("  ")))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("NATION_"), key))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("Country "), key))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("Home"))
        .otherwise(F.concat(F.lit("Nowhere "), key))
    )
    own = F.when(F.col("c_acctbal") < 0, F.lit("own value"))
    return table(spark, folder, "customer").select("c_custkey", place.alias("entity"), own.alias("r_name"))


def _nation_catalogue(spark, folder):
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    country = F.concat(F.lit("COUNTRY "), F.col("n_nationkey").cast("string"))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("entity"), country.alias("country"), F.col("r_name").alias("area"), "r_name", "n_nationkey"
    )


_PLACES_SQL = """
WITH places AS (
  SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN chr(9) || ' Nation_' || c_nationkey || '  '
      WHEN 'BUILDING' THEN 'NATION_' || c_nationkey WHEN 'FURNITURE' THEN 'Country ' || c_nationkey
      WHEN 'HOUSEHOLD' THEN 'Home' ELSE 'Nowhere ' || c_nationkey END AS entity,
    CASE WHEN c_acctbal < 0 THEN 'own value' END AS r_name
  FROM customer),
keyed AS (
  SELECT *, CASE trim(lower(entity), chr(9) || ' ') WHEN 'home' THEN 'africa' ELSE trim(lower(entity), chr(9) || ' ') END AS k FROM places),
synonyms AS (
  SELECT lower(n_name) AS k, n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT lower('COUNTRY ' || n_nationkey), n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT lower(r_name), n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
firsts AS (SELECT k, min(n_nationkey) AS n_nationkey, arg_min(r_name, n_nationkey) AS r_name FROM synonyms GROUP BY k)
"""
_SYNONYMS = ("entity", "country", "area")


@query("name_lookup_alias", _PLACES_SQL + """
SELECT c_custkey, entity, coalesce(p.r_name, f.r_name) AS r_name, f.n_nationkey FROM keyed p LEFT JOIN firsts f USING (k)""")
def name_lookup_alias(spark, folder):
    return C.lookup(
        _customer_places(spark, folder), _nation_catalogue(spark, folder), "entity", _SYNONYMS, F.col("n_nationkey"),
        {"home": "africa"}, ["r_name", "n_nationkey"],
    )


@query("synonym_attribute", _PLACES_SQL + """
SELECT c_custkey, entity, f.r_name AS region FROM keyed p LEFT JOIN firsts f USING (k)""")
def synonym_attribute(spark, folder):
    places = _customer_places(spark, folder).drop("r_name")
    found = C.synonym_attribute(
        places, _nation_catalogue(spark, folder), "r_name", "entity", synonyms=_SYNONYMS, order=F.col("n_nationkey"), aliases={"home": "africa"}
    )
    return C.attach_attribute(places, found, "r_name", "region", "entity")


@query("gap_fill_merge", """
SELECT doc_id, quality, coalesce(CASE WHEN l.toxic <> 0 THEN l.toxic END, CASE WHEN d.n_chars > 1000 THEN 1 ELSE 0 END) AS toxic, lang
FROM labels l FULL JOIN documents d USING (doc_id)""")
def gap_fill_merge(spark, folder):
    left = table(spark, folder, "labels").withColumn("toxic", F.when(F.col("toxic") != 0, F.col("toxic")))
    guessed = F.when(F.col("n_chars") > 1000, 1).otherwise(0).alias("toxic")
    right = table(spark, folder, "documents").select("doc_id", guessed, "lang")
    return C.fill_gaps(left, right, "doc_id", F.lit(0))


@query("suffix_repair", """
SELECT o_orderkey, o_custkey, coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END, c_acctbal) AS amount
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def suffix_repair(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("amount_x")
    )
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("amount_y"))
    return R.repair_suffixes(C.lookup_join(orders, customer, ["o_custkey"]))


@query("keyed_refresh", """
WITH stale AS (SELECT p_partkey, p_name, CASE WHEN p_size >= 10 THEN p_retailprice END AS price FROM part),
fetched AS (SELECT l_partkey, max(l_extendedprice) AS price, 'seen' AS p_name FROM lineitem GROUP BY l_partkey)
SELECT p_partkey, CASE WHEN s.price IS NULL THEN coalesce(f.p_name, s.p_name) ELSE s.p_name END AS p_name,
       coalesce(s.price, f.price) AS price
FROM stale s LEFT JOIN fetched f ON l_partkey = p_partkey""")
def keyed_refresh(spark, folder):
    stale = table(spark, folder, "part").select(
        "p_partkey", "p_name", F.when(F.col("p_size") >= 10, F.col("p_retailprice")).alias("price")
    )
    highest = F.max("l_extendedprice").alias("price")
    fetched = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(highest, F.lit("seen").alias("p_name"))
    return C.refresh_missing(stale, fetched, "p_partkey", "price")


@query("schema_conform", """
SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey AS DOUBLE) AS nation, CAST(0 AS DOUBLE) AS balance, 'Unknown' AS segment,
       CAST(0 AS DOUBLE) AS dose
FROM supplier""")
def schema_conform(spark, folder):
    supplier = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("extra")
    )
    schema = [("id", "bigint"), ("name", "string"), ("nation", "int"), ("balance", "double"), ("segment", "string")]
    strict = C.conform(C.conform(supplier, schema, "append"), schema, "strict")
    return R.add_constant(C.align_for_inference(strict, ["nation", "balance"], ["segment"]), "dose")


@query("list_source", f"""
SELECT entity, count(*) AS mentions, min(doc_id) AS first_doc FROM (
  SELECT doc_id, trim(unnest(string_split(text, ',')), '{_WS}') AS entity FROM documents)
WHERE length(entity) > 0 GROUP BY entity""")
def list_source(spark, folder):
    pieces = lists.split_list(table(spark, folder, "documents"), "text", ["doc_id"], to="entity")
    return pieces.groupBy("entity").agg(F.count("*").alias("mentions"), F.min("doc_id").alias("first_doc"))


@query("catalogue_names", f"""
SELECT DISTINCT trim(p_name, '{_WS}') AS p_name FROM part WHERE length(trim(p_name, '{_WS}')) > 0""")
def catalogue_names(spark, folder):
    return C.curated_names(lists.whole_library(table(spark, folder, "part"), "p_name"), "p_name")


def _landed(spark, folder):
    """Events read as landed responses: three consecutive events are three attempts for one entity."""
    k = F.get_json_object("props", "$.k")
    record = F.concat(
        F.lit('{"CID": '), k, F.lit(', "Title": "'), F.col("event_type"), F.lit('", "MolecularWeight": "'), F.col("value").cast("string"),
        F.lit('", "XLogP": '), F.when(F.col("user_id") > 50, k).otherwise("null"), F.lit(', "HBondDonorCount": '), k,
        F.lit(', "TPSA": "n/a", "SMILES": "C'), k, F.lit('"}'),
    )
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "signup", 404).otherwise(200)
    entity = F.concat(F.when(F.col("user_id") == 7, "Control ").otherwise("e"), F.floor(F.col("event_id") / 3).cast("string"))
    return table(spark, folder, "events").select(
        entity.alias("entity"), (F.col("event_id") % 3 + 1).cast("int").alias("attempt"), status.alias("status"),
        F.concat(F.lit('{"PropertyTable": {"Properties": ['), record, F.lit("]}}")).alias("body"),
    )


_LANDED_SQL = """
WITH landed AS (
  SELECT (CASE WHEN user_id = 7 THEN 'Control ' ELSE 'e' END) || CAST(event_id // 3 AS VARCHAR) AS entity,
    CAST(event_id % 3 + 1 AS INTEGER) AS attempt,
    CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 ELSE 200 END AS status,
    CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type, value, user_id FROM events),
settled AS (
  SELECT * FROM landed QUALIFY row_number() OVER (PARTITION BY entity ORDER BY
    CASE WHEN status IN (200, 404) THEN 0 ELSE 1 END, CASE WHEN status IN (200, 404) THEN attempt ELSE -attempt END) = 1)
"""


@query("json_properties", _LANDED_SQL + """
SELECT entity, k AS "PubChem_CID", event_type AS "PubChem_CommonName", '' AS "IUPACName", 'C' || k AS "SMILES",
  '' AS "Molecular_Formula", value AS "Molecular_Weight", CASE WHEN user_id > 50 THEN CAST(k AS DOUBLE) END AS "XLogP",
  CAST(0 AS DOUBLE) AS "Topological_Polar_Surface_Area", CAST(k AS INTEGER) AS "Hydrogen_Bond_Donor_Count",
  0 AS "Hydrogen_Bond_Acceptor_Count", 0 AS "Rotatable_Bond_Count"
FROM settled WHERE status = 200 AND NOT starts_with(lower(entity), 'control')""")
def json_properties(spark, folder):
    accepted, _ = responses.route(responses.latest_attempts(_landed(spark, folder)))
    return responses.parse_properties(accepted)


@query("response_rejects", _LANDED_SQL + """
SELECT entity, attempt, status, CASE status WHEN 404 THEN 'not found' ELSE 'failed' END AS reason
FROM settled WHERE status <> 200 AND NOT starts_with(lower(entity), 'control')""")
def response_rejects(spark, folder):
    _, rejected = responses.route(responses.latest_attempts(_landed(spark, folder)))
    return rejected


@query("catalogue_build", """
SELECT c_name AS "Solvent_Name", CASE WHEN c_acctbal >= 0 THEN c_custkey END AS "PubChem_CID",
  CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS "PubChem_CommonName",
  CASE WHEN c_acctbal >= 0 THEN CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE 'CCl' || repeat('C', c_nationkey) || '[H]' END END AS "SMILES",
  CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS "Molecular_Weight",
  CASE WHEN c_acctbal >= 0 AND c_mktsegment <> 'MACHINERY' THEN CAST(c_nationkey + 2 AS DOUBLE) END AS "Heavy_Atom_Count",
  CAST(NULL AS DOUBLE) AS "Density", CAST(NULL AS DOUBLE) AS "Solvent_Concentration",
  (SELECT count(*) FROM customer) AS total, (SELECT count(*) FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'MACHINERY') AS failed
FROM customer""")
def catalogue_build(spark, folder):
    customer = table(spark, folder, "customer")
    smiles = F.concat(F.lit("CCl"), F.repeat(F.lit("C"), F.col("c_nationkey")), F.lit("[H]"))
    record = F.concat(
        F.lit('{"CID": '), F.col("c_custkey").cast("string"), F.lit(', "Title": "'), F.col("c_mktsegment"), F.lit('", "MolecularWeight": "'),
        F.col("c_acctbal").cast("string"), F.lit('", "SMILES": "'), F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(smiles), F.lit('"}'),
    )
    landed = customer.select(
        F.col("c_name").alias("entity"), F.lit(1).alias("attempt"), F.when(F.col("c_acctbal") >= 0, 200).otherwise(404).alias("status"),
        F.concat(F.lit('{"PropertyTable": {"Properties": ['), record, F.lit("]}}")).alias("body"),
    )
    names = customer.select(F.col("c_name").alias("solvent_name"))
    catalogue, failures = build_catalogue(names, landed)
    counts = failures.first()
    shown = ["Solvent_Name", "PubChem_CID", "PubChem_CommonName", "SMILES", "Molecular_Weight", "Heavy_Atom_Count", "Density", "Solvent_Concentration"]
    assert catalogue.columns == [c for c, _ in MASTER_SCHEMA]
    return catalogue.select(*shown, *[F.lit(counts[c]).cast("bigint").alias(c) for c in ("total", "failed")])


def _people(customer):
    """Customers as names, a third of them in the catalogue with a weight, a third without one, a third unknown; landed responses for all."""
    third = F.col("c_custkey") % 3
    smiles = F.concat(F.lit("C"), F.col("c_nationkey").cast("string"))
    catalogue = customer.where(third < 2).select(
        F.upper("c_name").alias("IUPACName"), F.lit("x").alias("solvent_name"), F.when(third == 0, smiles).alias("SMILES"),
        F.when(third == 0, F.col("c_acctbal")).alias("Molecular_Weight"))
    record = F.concat(F.lit('{"CID": 1, "MolecularWeight": "'), F.col("c_custkey").cast("string"), F.lit('", "SMILES": "'), F.lit("N"), F.lit('"}'))
    landed = customer.select(
        F.col("c_name").alias("entity"), F.lit(1).alias("attempt"), F.when(F.col("c_acctbal") >= 0, 200).otherwise(404).alias("status"),
        F.concat(F.lit('{"PropertyTable": {"Properties": ['), record, F.lit("]}}")).alias("body"))
    return customer.select(F.col("c_name").alias("solvent_name")), catalogue, landed


@query("names_to_library", """
WITH p AS (SELECT c_name, c_custkey, c_nationkey, c_acctbal, c_custkey % 3 AS third, c_acctbal >= 0 AS answered FROM customer),
q AS (SELECT c_name AS solvent_name, CASE WHEN third = 0 THEN 'C' || c_nationkey WHEN answered THEN 'N' ELSE '' END AS "SMILES",
  CASE WHEN third = 0 THEN c_acctbal WHEN answered THEN CAST(c_custkey AS DOUBLE) END AS "Molecular_Weight" FROM p)
SELECT *, "SMILES" <> '' AS resolved FROM q""")
def names_to_library_query(spark, folder):
    ready, unresolved = names_to_library(*_people(table(spark, folder, "customer")), order=F.col("IUPACName"))
    open_ = unresolved.select("solvent_name", F.lit("").alias("SMILES"), F.lit(None).cast("double").alias("Molecular_Weight"), F.lit(False).alias("resolved"))
    return ready.select("solvent_name", "SMILES", "Molecular_Weight", F.lit(True).alias("resolved")).unionByName(open_)


@query("resolved_split", """
SELECT page_id, CASE WHEN contains(url, '?') OR contains(url, '#') THEN url ELSE '' END AS "SMILES",
  CASE WHEN contains(url, '?') OR contains(url, '#') THEN 'resolved' ELSE 'unresolved' END AS state FROM pages""")
def resolved_split(spark, folder):
    pages = table(spark, folder, "pages").select(
        "page_id", F.when(F.contains("url", F.lit("?")), F.col("url")).alias("SMILES"),
        F.when(F.contains("url", F.lit("#")), F.col("url")).alias("IsomericSMILES"),
    )
    found, missing = C.split_resolved(C.merge_smiles(pages))
    return found.withColumn("state", F.lit("resolved")).unionByName(missing.withColumn("state", F.lit("unresolved")))


@query("link_column", """
SELECT page_id, CASE WHEN starts_with(url, 'http:') THEN NULL ELSE
  'https://pubchem.ncbi.nlm.nih.gov/rest/pug/compound/smiles/' || replace(url_encode(url), '%2F', '/') || '/PNG?record_type=3d&image_size=large' END AS link
FROM pages""")
def link_column(spark, folder):
    identifier = F.when(F.startswith("url", F.lit("http:")), F.lit(" Unknown ")).otherwise(F.col("url"))
    return table(spark, folder, "pages").select("page_id", X.image_link(identifier).alias("link"))


@query("token_count", """
SELECT doc_id, len(regexp_extract_all(text, '\\[[^\\]]+\\]|Cl|Br|[BCNOPSFIbcnops]')) - len(regexp_extract_all(text, '\\[[0-9]*H[+-]?[0-9]*\\]')) AS atoms
FROM documents""")
def token_count(spark, folder):
    return table(spark, folder, "documents").select("doc_id", X.heavy_atoms("text").cast("bigint").alias("atoms"))


@query("role_rules", """
SELECT c_custkey AS "Custkey_No", CASE WHEN c_acctbal >= 0 THEN c_name END AS solvent_name, c_nationkey AS "pH",
  'Pichia kudriavzevii' AS "Organism", 30 AS "Temperature"
FROM customer WHERE NOT coalesce(contains(lower(CASE WHEN c_acctbal >= 0 THEN c_name END), '#000000001'), FALSE)""")
def role_rules(spark, folder):
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("Custkey_No"), F.col("c_mktsegment").alias("IUPACName"), F.col("c_nationkey").alias("pH"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("Compound "),
    )
    named = R.name_entity_column(customer)
    shown = R.tag(R.drop_ids(R.without_controls(named, "solvent_name", "#000000001"), ["iupacname"]), Temperature=30)
    return R.with_labels(R.place_first(shown, "solvent_name"))


@query("range_violations", """
SELECT p_partkey, CAST(p_size * 3 AS DOUBLE) AS "Concentration" FROM part WHERE NOT p_size * 3 BETWEEN 0 AND 100""")
def range_violations(spark, folder):
    return R.range_violations(table(spark, folder, "part").select("p_partkey", (F.col("p_size") * 3.0).alias("Concentration")))


@query("csv_roundtrip", """
SELECT p_partkey, CASE WHEN p_size > 5 THEN p_name || ', "' || p_type || '"' END AS p_name, p_size, p_retailprice,
  CASE WHEN p_size > 10 THEN p_size > 20 END AS large FROM part""")
def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "parts-csv")
    quoted = F.concat(F.col("p_name"), F.lit(', "'), F.col("p_type"), F.lit('"'))
    written = table(spark, folder, "part").select(
        "p_partkey", F.when(F.col("p_size") > 5, quoted).alias("p_name"), "p_size", "p_retailprice",
        F.when(F.col("p_size") > 10, F.col("p_size") > 20).alias("large"),
    )
    files.write_csv(written, path)
    return files.read_csv(spark, path).withColumn("p_size", F.col("p_size").cast("int"))


@query("report_table", """
SELECT p_name AS "solvent name", CAST(p_size AS VARCHAR) AS "size", coalesce(CAST(CASE WHEN p_size > 9 THEN p_retailprice END AS VARCHAR), 'nan') AS price,
  printf('%.1f%%', round_even(p_retailprice / 10, 1)) AS "Overall Compatibility"
FROM part""")
def report_table(spark, folder):
    results = table(spark, folder, "part").select(
        F.col("p_name").alias("solvent_name"), "p_brand", F.col("p_size").alias("size_Prediction"),
        F.when(F.col("p_size") > 9, F.col("p_retailprice")).alias("price_Prediction"),
        X.percent_text(F.col("p_retailprice") / 10).alias("Overall_Compatibility"),
    )
    return files.report_table(results).withColumnRenamed("solvent_name", "solvent name")


@query("dedup_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem")
def dedup_rows(spark, folder):
    return P.distinct_rows(table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount"))


@query("missing_report", "WITH " + DOCS_SQL + """,
joined AS (SELECT library.*, quality, toxic FROM library LEFT JOIN labels USING (doc_id))
SELECT * FROM (
  SELECT 'blanks' AS "column", count(*) FILTER (blanks IS NULL) AS missing FROM joined
  UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL) FROM joined
  UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM joined) WHERE missing > 0""")
def missing_report(spark, folder):
    return C.missing_report(C.lookup_join(doc_library(spark, folder), table(spark, folder, "labels"), ["doc_id"]))


@query("missing_ratio", "WITH " + DOCS_SQL + """
SELECT round((count(*) FILTER (blanks IS NULL) + count(*) FILTER (quality IS NULL)) / CAST(count(*) * 4 AS DOUBLE), 6) AS ratio
FROM library LEFT JOIN labels USING (doc_id)""")
def missing_ratio(spark, folder):
    joined = C.lookup_join(doc_library(spark, folder), table(spark, folder, "labels"), ["doc_id"])
    return rounded(joined.agg(C.missing_ratio(joined, ["blanks", "quality", "chars", "lang"]).alias("ratio")), "ratio")


@query("curated_brands", "SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL ORDER BY p_brand")
def curated_brands(spark, folder):
    return C.curated_names(parts(spark, folder, "left"), "p_brand")


@query("table_sources", """
SELECT n_name AS solvent_name, CAST(n_nationkey AS DOUBLE) AS glucose_uptake, CAST(n_regionkey AS DOUBLE) AS substrate_conversion FROM nation
UNION ALL SELECT r_name, CAST(r_regionkey AS DOUBLE), NULL FROM region
UNION ALL SELECT * FROM (VALUES ('Water', 95, 71), ('Ethanol', 40, 55), ('Hexane', 5, 12), ('Toluene', 2, 3))""")
def table_sources(spark, folder):
    """An experiment from memory, a blank one that is filled, and the sample one, put together."""
    held = table(spark, folder, "nation").select(F.col("n_nationkey").cast("double").alias("glucose_uptake"), F.col("n_regionkey").cast("double").alias("substrate_conversion"), F.col("n_name").alias("Solvent Name"))
    blank = files.blank_experiment(spark)
    filled = blank.unionByName(table(spark, folder, "region").select(F.col("r_name").alias("solvent_name"), F.col("r_regionkey").cast("double").alias("glucose_uptake")), allowMissingColumns=True)
    return files.load_experiment(spark, held).unionByName(filled).unionByName(files.sample_experiment(spark)).select(*blank.columns)


@query("catalogue_scan", "SELECT p_name AS solvent_name, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def catalogue_scan(spark, folder):
    """A catalogue in a CSV file."""
    path = scratch_path(spark, "catalogue") + ".csv"
    files.write_csv(table(spark, folder, "part").select(F.col("p_name").alias("Solvent_Name"), "p_size", "p_retailprice"), path)
    return files.load_catalogue(spark, path)


@query("molecule_counts", """
SELECT p_partkey, CAST(p_size + CASE p_partkey % 3 WHEN 0 THEN 6 WHEN 1 THEN 10 ELSE 5 END AS INTEGER) AS heavy_atoms,
  CAST(CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS INTEGER) AS aromatic_rings,
  round(CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS DOUBLE) / (p_size + 6) WHEN 1 THEN CAST(p_size AS DOUBLE) / (p_size + 10) ELSE 1 END, 6) AS fraction_csp3
FROM part""")
def molecule_counts(spark, folder):
    """A chain as long as the part's size on a benzene, a naphthalene or a cyclopentane ring."""
    ring = F.when(F.col("p_partkey") % 3 == 0, "C1=CC=CC=C1").when(F.col("p_partkey") % 3 == 1, "C1=CC=C2C=CC=CC2=C1").otherwise("C1CCCC1")
    smiles = F.concat(F.repeat(F.lit("C"), F.col("p_size")), ring)
    written = molecules.dealt(table(spark, folder, "part").select("p_partkey", smiles.alias("smiles")))
    told = written.select("p_partkey", molecules.molecule_counts("smiles").alias("m"))
    return told.select("p_partkey", "m.heavy_atoms", "m.aromatic_rings", F.round("m.fraction_csp3", 6).alias("fraction_csp3"))
