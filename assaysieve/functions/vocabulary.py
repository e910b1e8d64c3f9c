"""Default names used by the screening jobs. Every job takes them as parameters."""

from __future__ import annotations

from typing import NamedTuple

ENTITY = "entity"

# Headings accepted for the entity column (lower case, "_" read as space).
ENTITY_HEADINGS = ("solvent", "solvent name", "compound", "chemical", "molecule")

# Numeric columns that describe an entity and are never targets (lower case).
KNOWN_DESCRIPTORS = (
    "molecular_weight", "xlogp", "logp", "topological_polar_surface_area",
    "hydrogen_bond_donor_count", "hydrogen_bond_acceptor_count",
    "rotatable_bond_count", "heavy_atom_count", "aromatic_ring_count",
    "fraction_csp3", "density", "dynamic_viscosity", "dielectric_constant",
    "dipole_moment", "surface_tension", "vapor_pressure", "boiling_point",
    "melting_point", "flash_point", "refractive_index", "water_solubility",
    "hansen_dispersion", "hansen_polar", "hansen_hydrogen",
    "hansen_dd", "hansen_dp", "hansen_dh", "hildebrand_parameter",
    "critical_temperature", "critical_pressure", "enthalpy_of_vaporization",
    "viscosity", "pubchem_cid", "solvent_concentration",
)

# Identifier columns that never reach a model (lower case).
ID_COLUMNS = (
    "solvent_name", "pubchem_cid", "pubchem_commonname", "iupacname",
    "molecular_formula", "smiles",
)

# Required descriptors, one group per rank, first alias present wins.
MANDATED_GROUPS = (
    ("xlogp", "logp"),
    ("dielectric_constant",),
    ("water_solubility",),
    ("dynamic_viscosity", "viscosity"),
)

# Everyday names and the catalogue name they stand for.
ENTITY_ALIASES = {
    "dmso": "dimethyl sulfoxide",
    "butanol": "1-butanol",
    "n-butanol": "1-butanol",
    "thf": "tetrahydrofuran",
    "dmf": "n,n-dimethylformamide",
    "dcm": "dichloromethane",
    "ipa": "2-propanol",
    "isopropanol": "2-propanol",
    "nmp": "n-methyl-2-pyrrolidone",
}

# Catalogue schema in column order, as (name, Spark type).
MASTER_SCHEMA = (
    ("Solvent_Name", "string"),
    ("PubChem_CID", "bigint"),
    ("PubChem_CommonName", "string"),
    ("IUPACName", "string"),
    ("Molecular_Formula", "string"),
    ("SMILES", "string"),
    ("Molecular_Weight", "double"),
    ("XLogP", "double"),
    ("Topological_Polar_Surface_Area", "double"),
    ("Hydrogen_Bond_Donor_Count", "int"),
    ("Hydrogen_Bond_Acceptor_Count", "int"),
    ("Rotatable_Bond_Count", "int"),
    ("Heavy_Atom_Count", "double"),
    ("Aromatic_Ring_Count", "double"),
    ("Fraction_CSP3", "double"),
    ("Density", "double"),
    ("Dynamic_Viscosity", "double"),
    ("Dielectric_Constant", "double"),
    ("Surface_Tension", "double"),
    ("Vapor_Pressure", "double"),
    ("Boiling_Point", "double"),
    ("Water_Solubility", "double"),
    ("Hansen_Dispersion", "double"),
    ("Hansen_Polar", "double"),
    ("Hansen_Hydrogen", "double"),
    ("Solvent_Concentration", "double"),
)


class Label(NamedTuple):
    aliases: tuple[str, ...]
    text: str
    fmt: str | None
    low: float | None = None
    high: float | None = None


# Display text, number format and allowed range per column (aliases in lower case).
COLUMN_LABELS = (
    Label(("solvent_name", "solventname"), "Solvent Name", None),
    Label(("molecular_weight", "molecularweight", "mw"), "MW (g/mol)", "%.2f"),
    Label(("pubchem_cid",), "PubChem CID", "%d"),
    Label(("pubchem_commonname",), "Common Name", None),
    Label(("iupacname",), "IUPAC Name", None),
    Label(("molecular_formula",), "Formula", None),
    Label(("smiles",), "SMILES", None),
    Label(("xlogp",), "LogP", "%.2f"),
    Label(("topological_polar_surface_area", "tpsa"), "TPSA (Å²)", "%.1f"),
    Label(("hydrogen_bond_donor_count", "hbonddonorcount"), "HB Donors", "%d"),
    Label(("hydrogen_bond_acceptor_count", "hbondacceptorcount"), "HB Acceptors", "%d"),
    Label(("rotatable_bond_count", "rotatablebondcount"), "Rotatable Bonds", "%d"),
    Label(("heavy_atom_count", "heavyatomcount"), "Heavy Atoms", "%d"),
    Label(("aromatic_ring_count", "aromaticringcount"), "Aromatic Rings", "%d"),
    Label(("fraction_csp3", "fractioncsp3"), "Fraction CSP3", "%.3f"),
    Label(("density",), "Density (g/mL)", "%.4f"),
    Label(("dynamic_viscosity", "viscosity"), "Viscosity (mPa·s)", "%.4f"),
    Label(("dielectric_constant", "dielectricconstant"), "Dielectric Const", "%.2f"),
    Label(("surface_tension", "surfacetension"), "Surf Tension (mN/m)", "%.2f"),
    Label(("vapor_pressure", "vaporpressure"), "Vapor Pres (kPa)", "%.3f"),
    Label(("boiling_point", "boilingpoint"), "Boiling Pt (°C)", "%.1f"),
    Label(("water_solubility", "watersolubility"), "Water Sol (mg/L)", "%.2f"),
    Label(("hansen_dispersion", "hansen_dd"), "Hansen δd", "%.2f"),
    Label(("hansen_polar", "hansen_dp"), "Hansen δp", "%.2f"),
    Label(("hansen_hydrogen", "hansen_dh"), "Hansen δh", "%.2f"),
    Label(("solvent_concentration", "solventconcentration", "concentration"), "Concentration (%)", "%.2f", 0.0, 100.0),
    Label(("glucose_uptake", "glucoseuptake"), "Glucose Uptake", "%.2f"),
    Label(("sne",), "SNE", "%.2f"),
    Label(("substrate_conversion", "substrateconversion"), "Substrate Conv", "%.2f"),
)

# Where a structure picture is served, and the texts that mean "no identifier".
IMAGE_PREFIX = "https://pubchem.ncbi.nlm.nih.gov/rest/pug/compound/smiles/"
IMAGE_SUFFIX = "/PNG?record_type=3d&image_size=large"
BLANK_IDENTIFIERS = ("", "nan", "Unknown")

# Texts read as missing in CSV input.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
