from urllib.parse import quote

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaysieve.functions import exprs as X


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expr.alias("r")).first()["r"]


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["r"] for r in df.select("i", expr.alias("r")).orderBy("i").collect()]


def test_half_even_is_numpy_round(spark):
    values = [2.25, 0.05, 0.15, 0.25, 0.35, 1.005, -2.25, -0.05, 1e9 + 0.25, 87.25, 99.95]
    assert column(spark, values, "double", X.half_even("v", 1)) == [float(np.round(v, 1)) for v in values]


def test_strip_and_key_follow_python(spark):
    values = ["  A b\t", "\n\x1c x　", "", " \xa0É ", "a​"]
    assert column(spark, values, "string", X.strip("v")) == [v.strip() for v in values]
    assert column(spark, values, "string", X.lookup_key("v")) == [v.strip().lower() for v in values]


def test_path_quote_is_urllib_quote(spark):
    values = ["CC(=O)C", "a b/~*+%é(1,2)[=#]!'", "C/C=C\\C", "N#N", "[Na+].[Cl-]", ""]
    assert column(spark, values, "string", X.path_quote("v")) == [quote(v) for v in values]


def test_image_link_needs_an_identifier(spark):
    values = ["CCO", " nan ", "Unknown", "", None, "  "]
    links = column(spark, values, "string", X.image_link("v", "p/", "/s"))
    assert links == ["p/CCO/s", None, None, None, None, None]


def test_clip_keeps_null(spark):
    assert column(spark, [-1.0, 0.5, 7.0, None], "double", X.clip("v", 0.0, 1.0)) == [0.0, 0.5, 1.0, None]


def test_number_or_takes_malformed_text(spark):
    assert column(spark, ["1.5", "x", None], "string", X.number_or("v", 0.0)) == [1.5, 0.0, 0.0]
    assert column(spark, ["3", "x", None], "string", X.number_or("v", 0, "int")) == [3, 0, 0]


def test_finite_or_null(spark):
    assert column(spark, [1.0, float("nan"), None], "double", X.finite_or_null("v")) == [1.0, None, None]


def test_unit_scale(spark):
    assert column(spark, [0.0, 5.0, 20.0, None], "double", X.unit_scale("v", 0.0, 10.0)) == [0.001, 0.5, 1.0, None]
    assert column(spark, [3.0, 9.0], "double", X.unit_scale("v", 3.0, 3.0)) == [1.0, 1.0]
    assert column(spark, [3.0], "double", X.unit_scale("v", None, None)) == [1.0]


def test_row_geometric_mean_skips_null(spark):
    df = spark.createDataFrame([(0.25, 1.0), (0.25, None), (None, None)], "a double, b double")
    got = [r[0] for r in df.select(X.row_geometric_mean([F.col("a"), F.col("b")])).collect()]
    assert got[0] == pytest.approx(0.5) and got[1] == pytest.approx(0.25) and got[2] is None


def test_three_classes(spark):
    df = spark.createDataFrame([(51.0, 51.0), (51.0, 50.0), (10.0, 21.0), (20.0, 20.0), (None, 60.0)], "a double, b double")
    got = [r[0].split()[0] for r in df.select(X.three_classes([F.col("a"), F.col("b")])).collect()]
    assert got == ["Highly", "Moderately", "Moderately", "Incompatible", "Moderately"]


def test_percent_text_and_back(spark):
    assert column(spark, [87.25, 100.0, 0.1], "double", X.percent_text("v")) == ["87.2%", "100.0%", "0.1%"]
    assert column(spark, ["87.2%", "x"], "string", X.percent_value("v")) == [87.2, None]


def test_heavy_atoms(spark):
    smiles = ["O", "CCO", "CC1=CC=CC=C1", "C(Cl)Cl", "CS(=O)C", "[Na+].[Cl-]", "[H][H]", "BrCCBr", "C[N+](=O)[O-]"]
    assert column(spark, smiles, "string", X.heavy_atoms("v")) == [1, 3, 7, 3, 4, 2, 0, 4, 4]


def test_substitute(spark):
    assert column(spark, ["dmso", "x", None], "string", X.substitute("v", {"dmso": "y"})) == ["y", "x", None]


def test_local_stamp_has_report_form(spark):
    stamp = one(spark, X.local_stamp())
    assert stamp.endswith(" IST") and len(stamp) == 20


def test_title_case_of_a_column(spark):
    words = ["glucose_uptake", "o'neil's 2nd cAFÉ", "", None, "a-b_c  d", "ÉTÉ été"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(X.title_case("w")).collect()
    assert [r[0] for r in got] == [None if w is None else w.replace("_", " ").title() for w in words]


# Molecules: heavy atoms, aromatic rings, share of saturated carbons.
MOLECULES = [
    ("C1=CC=C2C=CC=CC2=C1", (10, 2, 0.0)), ("c1ccc2ccccc2c1", (10, 2, 0.0)), ("C1=CC=C2C=CC=C2C=C1", (10, 2, 0.0)), ("C1=CNC=C1", (5, 1, 0.0)), ("n1ccccc1", (6, 1, 0.0)),
    ("O=C1C=CNC=C1", (7, 1, 0.0)), ("C1CCCCC1", (6, 0, 1.0)), ("C1=CC=CC=CC=C1", (8, 0, 0.0)), ("C12C3C4C1C5C2C3C45", (8, 0, 1.0)), ("CN1C=NC2=C1C(=O)N(C(=O)N2C)C", (14, 2, 3 / 8)),
    ("CC(Cl)(Cl)Cl", (5, 0, 1.0)), ("CCOC(=O)C", (6, 0, 0.75)), ("C1COC(=O)O1", (6, 0, 2 / 3)), ("CC#N", (3, 0, 0.5)), ("[Na+].[Cl-]", (2, 0, 0.0)), ("[13CH4]", (1, 0, 1.0)), ("O", (1, 0, 0.0)),
    ("C%10CCCC%10", (5, 0, 1.0)), ("C/C=C\\C", (4, 0, 0.5)), ("[H]O[H]", (1, 0, 0.0)), ("C1=CC=C(C=C1)C2=CC=CS2", (11, 2, 0.0)),
]


def test_molecule_counts(spark):
    from assaysieve.functions import molecules

    bad = ["C1CC", "C(", "C)", "C==C", "1CC1", "[C", "Qx", "", "  ", None, "C11"]
    df = spark.createDataFrame([(t,) for t, _ in MOLECULES] + [(t,) for t in bad], "SMILES string")
    got = {r["SMILES"]: r for r in molecules.with_molecule_counts(df).collect()}
    for text, want in MOLECULES:
        r = got[text]
        assert (r["Heavy_Atom_Count"], r["Aromatic_Ring_Count"], r["Fraction_CSP3"]) == pytest.approx(want), text
    assert all(got[t]["Heavy_Atom_Count"] is None and got[t]["Fraction_CSP3"] is None for t in bad)
    cube = molecules.smallest_rings(molecules.parse("C12C3C4C1C5C2C3C45"))
    assert sorted(map(len, cube)) == [4] * 5 and sorted(map(len, molecules.smallest_rings(molecules.parse("C1CC2CCC1CC2")))) == [6, 6]


def test_rings_are_sought_among_ring_atoms_and_counting_is_dealt(spark):
    from assaysieve.functions import molecules

    tail = molecules.parse("C" * 400 + "C1CC2CCC1CC2" + "C" * 400)
    assert sorted(map(len, molecules._without_ends(tail).values())) == [2] * 6 + [3] * 2  # the ring atoms alone
    assert sorted(map(len, molecules.smallest_rings(tail))) == [6, 6]
    one = spark.range(50).coalesce(1).selectExpr("id", "'C1CCCCC1' AS smiles")
    assert molecules.dealt(one).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
