"""Tumour-registry XML reports as flat rows, and incremental pulls from registry tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TNM = (
    "struct<_TNM_ID:string,TNM_Datum:string,TNM_Version:string,"
    "TNM_c_p_u_Praefix_T:string,TNM_T:string,TNM_c_p_u_Praefix_N:string,TNM_N:string,"
    "TNM_c_p_u_Praefix_M:string,TNM_M:string>"
)
_HISTOLOGY = (
    "struct<_Histologie_ID:string,Tumor_Histologiedatum:string,Morphologie_Code:string,"
    "Morphologie_ICD_O_Version:string,Grading:string>"
)
_TUMOUR = (
    "struct<_Tumor_ID:string,Primaertumor_ICD_Code:string,Primaertumor_ICD_Version:string,"
    "Diagnosedatum:string,Seitenlokalisation:string>"
)
_DIAGNOSIS = (
    "struct<_Tumor_ID:string,Primaertumor_ICD_Code:string,Primaertumor_Topographie_ICD_O:string,"
    f"Diagnosedatum:string,Menge_Histologie:struct<Histologie:array<{_HISTOLOGY}>>,"
    f"cTNM:{_TNM},pTNM:{_TNM}>"
)
REPORT_DDL = (
    "Patienten_Stammdaten struct<_Patient_ID:string,Patienten_Geschlecht:string,"
    "Patienten_Geburtsdatum:string>, "
    "Menge_Meldung struct<Meldung:array<struct<_Meldung_ID:string,Meldedatum:string,"
    f"Meldeanlass:string,Tumorzuordnung:{_TUMOUR},Diagnose:{_DIAGNOSIS}>>>"
)


def read_registry_xml(spark: SparkSession, path: str) -> DataFrame:
    """One row per patient element, nested as reported."""
    return (
        spark.read.format("xml")
        .option("rowTag", "Patient")
        .option("ignoreNamespace", True)
        .schema(REPORT_DDL)
        .load(path)
    )


def parse_registry_xml(df: DataFrame, xml: Column | str) -> DataFrame:
    """The same out of a column that holds one patient element per row."""
    c = F.col(xml) if isinstance(xml, str) else xml
    return df.select(F.from_xml(c, REPORT_DDL).alias("_p")).select("_p.*")


def registry_reports(patients: DataFrame) -> DataFrame:
    """One row per report and histology; reports without histology keep NULLs."""
    report = F.col("_m")
    return (
        patients.select("Patienten_Stammdaten", F.explode_outer("Menge_Meldung.Meldung").alias("_m"))
        .select("*", F.explode_outer("_m.Diagnose.Menge_Histologie.Histologie").alias("_h"))
        .select(
            F.col("Patienten_Stammdaten._Patient_ID").alias("patient_id"),
            F.col("Patienten_Stammdaten.Patienten_Geschlecht").alias("gender"),
            F.col("Patienten_Stammdaten.Patienten_Geburtsdatum").alias("birthdate"),
            report["_Meldung_ID"].alias("report_id"),
            report["Meldedatum"].alias("report_date"),
            report["Meldeanlass"].alias("report_reason"),
            report["Tumorzuordnung"]["_Tumor_ID"].alias("tumour_id"),
            report["Tumorzuordnung"]["Primaertumor_ICD_Code"].alias("icd10_code"),
            report["Tumorzuordnung"]["Diagnosedatum"].alias("diagnosis_date"),
            report["Diagnose"]["Primaertumor_Topographie_ICD_O"].alias("topography"),
            F.col("_h._Histologie_ID").alias("histology_id"),
            F.col("_h.Morphologie_Code").alias("morphology"),
            F.col("_h.Grading").alias("grading"),
            report["Diagnose"]["cTNM"]["TNM_T"].alias("c_t"),
            report["Diagnose"]["cTNM"]["TNM_N"].alias("c_n"),
            report["Diagnose"]["cTNM"]["TNM_M"].alias("c_m"),
            report["Diagnose"]["pTNM"]["TNM_T"].alias("p_t"),
            report["Diagnose"]["pTNM"]["TNM_N"].alias("p_n"),
            report["Diagnose"]["pTNM"]["TNM_M"].alias("p_m"),
        )
    )


def read_increment(source: DataFrame, col: str, last) -> DataFrame:
    """Rows changed since ``last`` by a timestamp or an ever-growing id; pushed to the source."""
    return source if last is None else source.where(F.col(col) > F.lit(last))


def next_offset(increment: DataFrame, col: str) -> DataFrame:
    """One-row table with the position to continue from."""
    return increment.agg(F.max(col).alias("last"), F.count(F.lit(1)).alias("n_rows"))
