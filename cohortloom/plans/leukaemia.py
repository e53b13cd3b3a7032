"""The leukaemia export: registry part, hospital part, medication catalogue, summary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import codes as C
from cohortloom.functions import dates as D
from cohortloom.functions import fhir as P
from cohortloom.functions import text as X
from cohortloom.functions.deid import numeric_id, strip_type
from cohortloom.operators import deaths as DE
from cohortloom.operators import linkage as L
from cohortloom.operators import ordering as O
from cohortloom.operators import stats as S
from cohortloom.operators import views as V
from cohortloom.operators.deident import (
    TABLE_SPECS,
    RunSecret,
    deidentify_drug_export,
    deidentify_table,
    mrn_lookup_table,
)
from cohortloom.operators.predicates import fill_missing_columns
from cohortloom.plans.base import Source, Tables


def registry_part(
    source: Source, code_list: DataFrame, excluded: DataFrame | None, mrn_system: str
) -> Tables:
    """Cohort by code list, and every registry table restricted to its patients or conditions."""
    obs = source["Observation"]
    patients = V.patient_mrns(source["Patient"], mrn_system)
    every = V.onset_conditions(source["Condition"]).withColumn(
        "diagnosis_assertedDateTime", F.lit(None).cast("string")
    )
    listed = L.code_list_join(every, code_list, "icd_code", "icd_code")
    in_cohort = L.cohort_semi(
        every, listed, "condition_patient_reference", "condition_patient_reference"
    )
    others = in_cohort if excluded is None else L.exclude_codes(in_cohort, excluded, "icd_code", "icd_code")

    def of_patients(df: DataFrame, ref: str = "observation_patient_reference") -> DataFrame:
        kept = L.cohort_semi(df, listed, ref, "condition_patient_reference")
        return L.lookup_first_mrn(kept, patients, ref, "patient_resource_id", "patient_mrn")

    def of_conditions(df: DataFrame, ref: str, patient: str) -> DataFrame:
        kept = L.condition_semi(df, listed, ref, "condition_id")
        return L.lookup_first_mrn(kept, patients, patient, "patient_resource_id", "patient_mrn")

    deaths = V.deaths(obs, every_cause=True).select(
        F.col("observation_resource_id").alias("observation_id"),
        F.col("observation_death_patient_resource_id").alias("patient_id"),
        F.col("date_death").alias("death_dateTime"),
        F.col("death_cause_icd10").alias("cause_of_death"),
        F.col("death_cause_tumor").alias("death_caused_by_tumor"),
    )
    statements = L.resolve_medication(
        V.medication_statements(source["MedicationStatement"]), V.medications(source["Medication"])
    ).select(
        "medication_statement_id",
        F.col("subject_reference").alias("patient_reference"),
        F.col("reason_reference").alias("condition_id"),
        F.col("medication_statement_start_date").alias("medication_start_date"),
        F.col("medication_statement_text").alias("medication_text"),
        F.col("medication_statement_atc_code").alias("medication_atc_code"),
    )
    return Tables({
        "tumour_conditions": lambda: of_conditions(listed, "condition_id", "condition_patient_reference"),
        "all_tumour_conditions": lambda: L.lookup_first_mrn(
            others, patients, "condition_patient_reference", "patient_resource_id", "patient_mrn"
        ),
        "deaths": lambda: of_patients(deaths, "patient_id"),
        "vital_status": lambda: of_patients(V.vital_status(obs)),
        "ecog": lambda: of_patients(V.ecog_status(obs)),
        "progressions": lambda: of_conditions(
            V.progressions(obs), "condition_id", "observation_patient_reference"
        ),
        "classifications": lambda: of_patients(V.patient_classifications(obs)),
        "genetic_variants": lambda: of_patients(V.genetic_variants(obs)),
        "system_therapies": lambda: of_conditions(statements, "condition_id", "patient_reference"),
        "tumour_procedures": lambda: of_conditions(
            V.ops_procedures(source["Procedure"]),
            "procedure_condition_reference",
            "procedure_patient_reference",
        ),
    })


def hospital_part(
    source: Source, registry: Mapping[str, DataFrame], code_list: DataFrame, mrn_system: str,
    ops_book: DataFrame,
) -> Tables:
    """Patients with final death facts, and encounters, conditions, labs, procedures of theirs."""
    patients = V.view(
        source["Patient"],
        {
            "condition_patient_reference": P.resource_key("Patient"),
            "patient_mrn": P.identifier_value(mrn_system),
            "birth_date": F.col("birthDate"),
            "gender": F.col("gender"),
            "deceased_boolean": F.col("deceasedBoolean"),
            "deceased_dateTime": F.col("deceasedDateTime"),
        },
    )
    diagnosed = L.code_list_join(
        V.onset_conditions(source["Condition"]), code_list, "icd_code", "icd_code"
    )
    joined = diagnosed.join(patients, "condition_patient_reference", "inner")
    merged = L.drop_duplicates_by(
        fill_missing_columns(
            joined, {"deceased_boolean": False, "deceased_dateTime": None, "diagnosis_onsetDateTime": None}
        ),
        ["condition_id"],
        ["patient_mrn"],
    )
    all_patients = DE.death_precedence(merged, registry["deaths"], registry["vital_status"])
    lookup = patients.select("condition_patient_reference", "patient_mrn")

    def linked(df: DataFrame, ref: str) -> DataFrame:
        kept = L.cohort_semi(df, all_patients, ref, "condition_patient_reference")
        return L.lookup_first_mrn(kept, lookup, ref, "condition_patient_reference", "patient_mrn")

    labs = linked(V.labs(source["Observation"]), "observation_patient_reference")
    procedures = linked(V.server_procedures(source["Procedure"]), "procedure_patient_reference")
    return Tables({
        "patients": lambda: all_patients,
        "encounters": lambda: linked(V.encounters(source["Encounter"]), "encounter_patient_reference"),
        "conditions": lambda: linked(
            V.server_conditions(source["Condition"]), "all_condition_patient_reference"
        ),
        "labs": lambda: labs,
        "lab_value_counts": lambda: S.value_counts(
            labs, ["loinc_code", "loinc_display", "lab_quantity_unit"]
        ),
        "procedures": lambda: L.display_lookup(
            procedures, ops_book, "procedure_ops_code", "code", "title", "procedure_ops_display"
        ),
        "unmapped_ops_codes": lambda: L.unmapped_codes(
            procedures,
            ops_book,
            ["procedure_ops_version", "procedure_ops_code"],
            "procedure_ops_code",
            "code",
        ),
        "mrn_conflicts": lambda: L.mrn_conflicts(lookup, "condition_patient_reference", "patient_mrn"),
    })


def medication_catalogue(
    request: DataFrame,
    statement: DataFrame,
    administration: DataFrame,
    medication: DataFrame,
    patients: DataFrame,
    atc_book: DataFrame,
    ops_book: DataFrame,
) -> Tables:
    """Medication events of all three kinds, and the medications they name with display text."""
    events = L.drop_duplicates_by(
        V.medication_events(request, statement, administration), ["type", "id"], ["datetime"]
    )
    events = L.lookup_first_mrn(
        events, patients, "patient_reference", "patient_resource_id", "patient_mrn"
    )
    named = strip_type("medication_reference", "Medication")
    used = events.select(named.alias("medication_id"))
    catalogue = L.drop_duplicates_by(
        L.cohort_semi(V.medications_full(medication), used, "medication_id", "medication_id"),
        ["medication_id"],
        ["medication_atc_code", "medication_code_text"],
    )
    catalogue = L.display_lookup(
        catalogue, atc_book, "medication_atc_code", "atc_code", "title", "medication_atc_display"
    )
    catalogue = L.display_lookup(
        catalogue, ops_book, "medication_ops_code", "code", "title", "medication_ops_display"
    )
    return Tables({
        "medication_events": lambda: events.withColumn("medication_reference", named),
        "medications": lambda: catalogue.withColumn(
            "medication_display",
            P.choice(
                "medication_atc_display",
                "medication_code_text",
                "medication_pzn_display",
                "medication_ops_display",
                "medication_ingredient_text",
            ),
        ),
    })


# Reports on the linkage itself, never part of an export.
INTERNAL = frozenset({"lab_value_counts", "mrn_conflicts", "unmapped_ops_codes", "match_report", "labs_with_drugs"})


def deidentified_export(
    tables: Mapping[str, DataFrame],
    secret: RunSecret,
    drug_exports: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> tuple[Tables, DataFrame]:
    """Every table, de-identified, and the lookup that must stay inside.

    Reports for use inside stay there. Any other table without a specification is an error: nothing
    falls out of an export unnoticed.
    """
    if unknown := sorted(set(tables) - set(TABLE_SPECS) - INTERNAL):
        raise KeyError(f"no specification for {', '.join(unknown)}")

    def table(name: str):
        return lambda: deidentify_table(tables[name], TABLE_SPECS[name], secret)

    def drugs(name: str):
        return lambda: deidentify_drug_export(*drug_exports[name], secret)

    builders = {name: table(name) for name in tables if name not in INTERNAL}
    builders |= {name: drugs(name) for name in drug_exports or {}}
    return Tables(builders), mrn_lookup_table(tables["patients"], "patient_mrn", secret.key)


def with_drug_data(tables: Mapping[str, DataFrame], drugs: DataFrame, drug_mrn: str) -> Tables:
    """Labs of patients with drug data, and how well both sides match."""
    return Tables({
        "labs_with_drugs": lambda: L.matched_subset(
            tables["labs"],
            tables["patients"],
            drugs,
            "observation_patient_reference",
            "condition_patient_reference",
            "patient_mrn",
            drug_mrn,
        ),
        "match_report": lambda: L.match_report(tables["patients"], drugs, "patient_mrn", drug_mrn),
    })


def summary(
    patients: DataFrame, labs: DataFrame, ecog: DataFrame, classifications: DataFrame
) -> Tables:
    """Distributions of age, gender, diagnosis, ECOG and ELN, and lab panel means."""
    recorded = D.parse_iso("diagnosis_recordedDate")
    born = D.parse_iso("birth_date")
    people = patients.withColumns(
        {
            "diagnosed_at": recorded,
            "age_at_diagnosis": D.age_at(recorded.cast("date"), born.cast("date"), None),
            "icd_bin": C.leukaemia_bin("icd_code"),
        }
    ).withColumn("age_group", C.age_group("age_at_diagnosis"))
    eln = O.latest_per_key(
        classifications.where(F.col("code_text").startswith("ELN")).withColumn(
            "_at", D.parse_iso("effective_dateTime")
        ),
        ["patient_mrn"],
        "_at",
        ["observation_id", "value_code"],
    )
    return Tables({
        "ecog_distribution": lambda: S.distribution(ecog, "ecog_performance_status"),
        "eln_distribution": lambda: S.distribution(eln, "value_code", "eln_classification"),
        "age_group_distribution": lambda: S.distribution(people, "age_group"),
        "gender_distribution": lambda: S.distribution(people, "gender"),
        "icd_bin_distribution": lambda: S.distribution(people, "icd_bin"),
        "unparsable_dates": lambda: people.where(D.parse_failed("diagnosis_recordedDate")),
        "lab_distribution": lambda: S.lab_panel_means(
            # Bound by a generator of a list of one: what reads the time does not parse its text again.
            people.select(
                F.col("condition_patient_reference").alias("observation_patient_reference"),
                F.inline(F.array(F.struct("diagnosed_at"))),
            ),
            labs,
            "observation_patient_reference",
            "diagnosed_at",
            "lab_dateTime",
        ),
    })


# Drug preparation exports ---------------------------------------------------------------------

# Columns of both export layouts, and where the second one finds them.
DRUG_LAYOUT = [
    "Datum", "Zeit", "Herstellungs-ID", "Herstellungsdatum", "Herstellungszeit", "Privatpatient",
    "Patienten-ID", "KIS-Patienten-ID", "Kostenstellennummer", "Station", "Wirkstoff", "Dosierung",
    "Dosis", "Reduktion", "Trägerlösung", "AdVolumen", "Volumen (ml)", "Applikationsart",
    "Therapieprotokoll", "Aufnahmenummer", "Retoure",
]
SHORT_LAYOUT = [
    "Datum", "Zeit", "Herstellungs-ID", "Herstellungsdatum", "Herstellungszeit", "KIS-Patienten-ID",
    "Station", "Wirkstoff", "Dosierung", "Dosis", "Trägerlösung", "AdVolumen", "Volumen (ml)",
    "Applikationsart", "Therapieprotokoll", "Retoure",
]
CATO_SOURCES = {
    "Herstellungs-ID": "Herst.Nr.",
    "Station": "Station",
    "Wirkstoff": "Arzneiform",
    "Dosierung": "Verordnete Dosis",
    "Dosis": "Ist-Dosis ",
    "Reduktion": "Differenz",
}


def cato_layout(df: DataFrame) -> DataFrame:
    """The second drug export brought into the layout of the first; unknown columns blank."""

    def cell(name: str):
        return F.coalesce(F.col(f"`{name}`"), F.lit("")) if name in df.columns else F.lit("")

    used, made = (
        D.split_datetime(cell(c))
        for c in ("Geplanter Verabreichungszeitpunkt", "Herstellungsstart Medikation")
    )
    values = {c: cell(src) for c, src in CATO_SOURCES.items()}
    values["KIS-Patienten-ID"] = F.regexp_replace(cell("Pat.Nr."), "^0+", "")
    for (date, time), names in ((used, ("Datum", "Zeit")), (made, ("Herstellungsdatum", "Herstellungszeit"))):
        values[names[0]] = F.coalesce(date, F.lit(""))
        values[names[1]] = F.coalesce(time, F.lit(""))
    return df.select(*[values.get(c, F.lit("")).alias(c) for c in DRUG_LAYOUT])


def zenzy_layout(df: DataFrame) -> DataFrame:
    """The first drug export with multi-line cells flattened and columns in order."""
    flat = {c: X.lines_to_bars(F.coalesce(F.col(c), F.lit(""))) for c in ("Dosis", "Dosierung", "Wirkstoff")}
    return df.withColumns(flat).select(*[F.col(f"`{c}`") for c in SHORT_LAYOUT])


def registry_patient_id(df: DataFrame, col: str) -> DataFrame:
    """Registry patient numbers without leading zeros; alphanumeric ones as they are."""
    return df.withColumn(col, numeric_id(col))
