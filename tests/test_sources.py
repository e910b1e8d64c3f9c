import pytest
from pyspark.sql import functions as F

from assaysieve.operators import catalogue as catalogue_ops
from assaysieve.operators import roles as R
from assaysieve.plans.catalogue_build import build_catalogue
from assaysieve.sources import files, lists, responses

TEXT = 'Compound,glucose_uptake,note,flag,empty\n"1,4-Dioxane",5,café,True,\nWater,,N/A,False,NA\n"say ""hi""",7.5,x,True,\n'


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1", "utf-16"])
def test_csv_encodings(spark, tmp_path, encoding):
    path = tmp_path / "in.csv"
    path.write_bytes(TEXT.encode(encoding))
    df = files.load_experiment(spark, str(path))
    assert df.dtypes == [("solvent_name", "string"), ("glucose_uptake", "double"), ("note", "string"), ("flag", "boolean"), ("empty", "string")]
    rows = {r["solvent_name"]: r for r in df.collect()}
    assert set(rows) == {"1,4-Dioxane", "Water", 'say "hi"'}
    assert rows["1,4-Dioxane"]["note"] == "café" and rows["Water"]["note"] is None and rows["Water"]["glucose_uptake"] is None


def test_type_inference_is_strict(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b,c,d\n1,1.5,1d,y\n2,3,2,n\n")
    assert [t for _, t in files.read_csv(spark, str(path)).dtypes] == ["bigint", "double", "string", "string"]


def test_declared_schema_skips_inference(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b\n1,NaN\n")
    row = files.read_csv(spark, str(path), "a int, b double").first()
    assert row["a"] == 1 and row["b"] is None


def test_blank_and_sample_experiment(spark):
    assert R.infer_targets(files.sample_experiment(spark)) == ["glucose_uptake", "substrate_conversion"]
    assert files.blank_experiment(spark).dtypes[1] == ("glucose_uptake", "double")


def test_split_list(spark):
    df = spark.createDataFrame([(1, " a , b,,c "), (2, ","), (3, None)], "id int, t string")
    got = [(r["id"], r["solvent_name"]) for r in lists.split_list(df, "t", ["id"]).orderBy("id", "position").collect()]
    assert got == [(1, "a"), (1, "b"), (1, "c")]
    pipes = lists.split_list(spark.createDataFrame([("1,4-Dioxane|Water",)], "t string"), "t", delimiter="|").collect()
    assert [r["solvent_name"] for r in pipes] == ["1,4-Dioxane", "Water"]


def test_whole_library(spark):
    df = spark.createDataFrame([(" a ",), ("b",), (None,), ("b",), (" ",)], "solvent_name string")
    assert sorted(r[0] for r in lists.whole_library(df).collect()) == ["a", "b"]


def landed(spark):
    def body(text):
        return '{"PropertyTable": {"Properties": [%s]}}' % text

    return spark.createDataFrame([
        ("Ethanol", 1, 500, None), ("Ethanol", 2, 200, body('{"CID": 702, "Title": "Ethanol", "MolecularWeight": "46.07", "XLogP": -0.1, "IsomericSMILES": "CCO"}')),
        ("Ethanol", 3, 200, body('{"CID": 1}')), ("Gone", 1, 404, None), ("Down", 1, 500, None), ("Down", 2, 503, None), ("Late", 4, 200, body('{"CID": 9}')),
        ("control 1", 1, 200, body('{"CID": 5}')), ("Bare", 1, 200, body('{"SMILES": "O", "TPSA": "bad"}')), ("Empty", 1, 200, '{"PropertyTable": {"Properties": []}}'),
        ("Broken", 1, 200, "not json"),
    ], "entity string, attempt int, status int, body string")


def test_responses(spark):
    accepted, rejected = responses.route(responses.latest_attempts(landed(spark)))
    rows = {r["entity"]: r for r in responses.parse_properties(accepted).collect()}
    assert set(rows) == {"Ethanol", "Bare"}
    e, b = rows["Ethanol"], rows["Bare"]
    assert (e["PubChem_CID"], e["SMILES"], e["Molecular_Weight"], e["XLogP"]) == (702, "CCO", 46.07, -0.1)
    assert (b["PubChem_CID"], b["XLogP"], b["Molecular_Weight"], b["Topological_Polar_Surface_Area"], b["IUPACName"]) == (None, None, 0.0, 0.0, "")
    assert {(r["entity"], r["attempt"], r["reason"]) for r in rejected.collect()} == {("Gone", 1, "not found"), ("Down", 2, "failed"), ("Late", 4, "too many attempts")}


def test_catalogue_build(spark):
    names = spark.createDataFrame([("Ethanol",), ("Gone",), ("Ethanol",), ("Bare",)], "solvent_name string")
    catalogue, failures = build_catalogue(names, landed(spark))
    rows = catalogue.collect()
    assert [r["Solvent_Name"] for r in rows] == ["Bare", "Ethanol", "Gone"] and len(catalogue.columns) == 26
    assert rows[1]["Heavy_Atom_Count"] == 3.0 and rows[2]["SMILES"] is None and rows[0]["Density"] is None
    assert tuple(failures.first()) == (3, 1)


def test_report_table_is_text(spark):
    df = spark.createDataFrame([("a", 1.5, None, "80.0%", 2)], "solvent_name string, up_take_Prediction double, b_Prediction double, Overall_Compatibility string, x int")
    table = files.report_table(df)
    assert table.columns == ["solvent name", "up take", "b", "Overall Compatibility"]
    assert tuple(table.first()) == ("a", "1.5", "nan", "80.0%")
    assert "generated_on" in files.with_report_stamp(table).columns


def test_name_column_rules(spark):
    def renamed(schema, row):
        return R.name_entity_column(spark.createDataFrame([row], schema)).columns

    assert renamed("x int, `Solvent Name ` string", (1, "a")) == ["x", "solvent_name"]
    assert renamed("MOLECULE string, solvent string", ("a", "b")) == ["solvent_name", "solvent"]
    assert renamed("x int, solvent_name string", (1, "a")) == ["x", "solvent_name"]
    assert renamed("x int, label string, other string", (1, "a", "b")) == ["x", "solvent_name", "other"]
    assert renamed("x int, y int", (1, 2)) == ["solvent_name", "y"]


def test_target_inference(spark):
    df = spark.createDataFrame([("a", 1.0, 2, True, 3.0, 4)], "solvent_name string, LogP double, `cfu/ml` long, ok boolean, v double, Viscosity int")
    assert R.infer_targets(df) == ["cfu/ml", "v"]
    assert R.feature_columns(df, ["cfu/ml", "v"]) == ["solvent_name", "LogP", "ok", "Viscosity"]
    with pytest.raises(ValueError):
        R.infer_targets(df.select("solvent_name", "LogP"))


def test_mandated_selection():
    groups = (("xlogp", "logp"), ("dielectric_constant",), ("viscosity",))
    assert R.mandated_selection(["Density", "Viscosity", "LogP"], ["Density", "Viscosity", "LogP"], groups) == (["Viscosity", "LogP"], ["dielectric_constant"])
    assert R.mandated_selection(["t", "a", "b", "c"], ["a", "b", "c"], groups)[0] == ["a", "b"]


def test_apply_selection_errors(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    assert R.apply_selection(df, ["b", "a"]).columns == ["a"]
    with pytest.raises(ValueError):
        R.apply_selection(df, [])
    with pytest.raises(ValueError):
        R.apply_selection(df, ["b"])


def test_controls_and_tags(spark):
    df = spark.createDataFrame([("Control 1",), ("my CONTROL",), (None,), ("a",)], "n string")
    assert [r[0] for r in R.without_controls(df, "n").collect()] == [None, "a"]
    assert R.tag(df, pH=5).select("Organism", "pH").first()[:] == ("Pichia kudriavzevii", 5)


def test_labels(spark):
    df = spark.createDataFrame([(1.0, 120.0, 3)], "Molecular_Weight double, Concentration double, my_value int")
    labelled = R.with_labels(df).schema
    assert labelled["Molecular_Weight"].metadata == {"label": "MW (g/mol)", "format": "%.2f"}
    assert labelled["my_value"].metadata["label"] == "my value"
    assert R.range_violations(df).count() == 1


def test_small_column_rules(spark):
    df = spark.createDataFrame([(None, 2.0, 1)], "v_x double, v_y double, a int")
    assert R.repair_suffixes(df).select("v").first()[0] == 2.0 and R.repair_suffixes(df).columns == ["a", "v"]
    assert R.add_constant(df, "a").columns == df.columns and R.add_constant(df, "").columns == df.columns
    assert R.add_constant(df, "new").select("new").first()[0] == 0.0
    nan = spark.createDataFrame([(float("nan"),)], "f double")
    assert R.nan_as_null(nan).where(F.col("f").isNull()).count() == 1


def test_each_file_has_its_own_encoding(spark, tmp_path):
    for name, text, encoding in (("a", "n,v\nCafé,1\n", "utf-8"), ("b", "n,v\nThé,2\n", "latin-1"), ("c d", "n,v\nÖl,3\nEis,4\n", "utf-16"), ("e", "n,v\nNA,n/a\n", "utf-8")):
        (tmp_path / f"{name}.csv").write_bytes(text.encode(encoding))
    want = {("Café", 1), ("Thé", 2), ("Öl", 3), ("Eis", 4), (None, None)}
    assert {tuple(r) for r in files.read_csv(spark, str(tmp_path)).collect()} == want
    assert {tuple(r) for r in files.read_csv(spark, str(tmp_path), "n string, v int").collect()} == want


def test_first_catalogue_row_is_first_in_file_order(spark, tmp_path):
    """Spark reads the larger file first; the row that counts is that of the file which comes first by name."""
    for name, rows in (("a", 1), ("b", 200_000)):
        spark.range(rows).select(F.lit("x").alias("solvent_name"), F.lit(name).alias("v"), "id").coalesce(1).write.parquet(str(tmp_path / "t" / name))
    catalogue = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "t"))
    names = spark.createDataFrame([("X",)], "solvent_name string")
    assert catalogue_ops.lookup(names, catalogue).select("v", "id").collect() == [("a", 0)]
    only_b = spark.read.parquet(str(tmp_path / "t" / "b"))
    assert catalogue_ops.fill_gaps(names.withColumn("solvent_name", F.lit("x")), only_b, "solvent_name").select("v", "id").collect() == [("b", 0)]
    # A frame that is not read from files is taken in its own order.
    made = spark.range(10, 13).select(F.lit("x").alias("solvent_name"), "id").coalesce(1)
    assert catalogue_ops.lookup(names, made).first()["id"] == 10


def test_every_entity_is_accepted_or_rejected(spark):
    rows = [("a", 1, 500, "x"), ("a", 5, 200, "x"), ("late", 4, 200, "x"), ("late", 6, 404, "x"), ("none", None, None, None), ("ok", 3, 200, "x")]
    latest = responses.latest_attempts(spark.createDataFrame(rows, "entity string, attempt int, status int, body string"))
    accepted, rejected = responses.route(latest)
    assert [r["entity"] for r in accepted.collect()] == ["ok"]
    assert {(r["entity"], r["attempt"], r["reason"]) for r in rejected.collect()} == {("a", 1, "failed"), ("late", 4, "too many attempts"), ("none", None, "failed")}
