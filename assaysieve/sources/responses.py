"""Property-service responses landed as rows (entity, attempt, status, body)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaysieve.functions.exprs import number_or

# The part of the response that is read.
RESPONSE_SCHEMA = (
    "PropertyTable struct<Properties: array<struct<"
    "CID: string, Title: string, IUPACName: string, IsomericSMILES: string, SMILES: string, "
    "MolecularFormula: string, MolecularWeight: string, XLogP: string, TPSA: string, "
    "HBondDonorCount: string, HBondAcceptorCount: string, RotatableBondCount: string>>>"
)


MAX_ATTEMPTS = 3


def latest_attempts(landed: DataFrame, key: str = "entity", max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The attempt that settles each entity: its first answer (200 or 404), else its last try, both among the first attempts.

    An entity that was tried only later keeps its row, with its earliest such try, so that it can be rejected with a reason. An aggregate
    rather than a window, so many retries of one entity are combined before the shuffle.
    """
    late, answered = F.col("attempt") > max_attempts, F.col("status").isin(200, 404)
    order = F.struct(late.cast("int"), (~answered & ~late).cast("int"), F.when(answered | late, F.col("attempt")).otherwise(-F.col("attempt")))
    return (
        landed.groupBy(key)
        .agg(F.min_by(F.struct("attempt", "status", "body"), order).alias("r"))
        .select(key, "r.attempt", "r.status", "r.body")
    )


def route(latest: DataFrame, key: str = "entity", max_attempts: int = MAX_ATTEMPTS) -> tuple[DataFrame, DataFrame]:
    """Parsable answers, and the rest with a reason. Control entities are never looked up."""
    asked = latest.where(~F.startswith(F.lower(F.col(key)), F.lit("control")))
    late, good = F.coalesce(F.col("attempt") > max_attempts, F.lit(False)), F.coalesce(F.col("status") == 200, F.lit(False))
    reason = F.when(late, "too many attempts").when(F.col("status") == 404, "not found").otherwise("failed")
    return asked.where(good & ~late), asked.where(~good | late).select(key, "attempt", "status", reason.alias("reason"))


def parse_properties(accepted: DataFrame, key: str = "entity", body: str = "body") -> DataFrame:
    """First property record of each response as typed descriptor columns with the documented defaults."""
    record = F.try_element_at(F.from_json(body, RESPONSE_SCHEMA)["PropertyTable"]["Properties"], F.lit(1))
    p = F.col("p")

    def text(name: str):
        return F.coalesce(p[name], F.lit(""))

    return (
        accepted.withColumn("p", record)
        .where("p is not null")
        .select(
            key,
            p["CID"].try_cast("bigint").alias("PubChem_CID"),
            text("Title").alias("PubChem_CommonName"),
            text("IUPACName").alias("IUPACName"),
            F.coalesce(p["IsomericSMILES"], p["SMILES"], F.lit("")).alias("SMILES"),
            text("MolecularFormula").alias("Molecular_Formula"),
            number_or(p["MolecularWeight"], 0.0).alias("Molecular_Weight"),
            p["XLogP"].try_cast("double").alias("XLogP"),
            number_or(p["TPSA"], 0.0).alias("Topological_Polar_Surface_Area"),
            number_or(p["HBondDonorCount"], 0, "int").alias("Hydrogen_Bond_Donor_Count"),
            number_or(p["HBondAcceptorCount"], 0, "int").alias("Hydrogen_Bond_Acceptor_Count"),
            number_or(p["RotatableBondCount"], 0, "int").alias("Rotatable_Bond_Count"),
        )
    )
