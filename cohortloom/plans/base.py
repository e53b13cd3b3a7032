"""Pieces shared by the studies.

A study takes a mapping from resource type to DataFrame and returns a mapping from table name to
DataFrame, in which a table is planned only when asked for. Nothing runs until one is written, except base tables that several results read:
those pass through ``keep``, by default ``session.materialise``, which writes them once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import dates as OD
from cohortloom.operators import deaths as DE
from cohortloom.operators import linkage as L
from cohortloom.operators import ordering as O
from cohortloom.operators import therapies as T
from cohortloom.operators import views as V
from cohortloom.operators.deident import RunSecret, deidentify
from cohortloom.session import materialise
from cohortloom.sources.sinks import StudyLayout, write_csv, write_parquet

Source = Mapping[str, DataFrame]
Keep = Callable[[DataFrame, str], DataFrame]
Builders = dict[str, Callable[[], DataFrame]]


class Tables(Mapping[str, DataFrame]):
    """Result tables of a study by name, each planned when it is first asked for."""

    def __init__(self, builders: Builders):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def lazily(df: DataFrame, label: str) -> DataFrame:
    """``keep`` that recomputes: for single results and tests."""
    return df


def conditions_patients_deaths(source: Source, *, primary_only: bool = False) -> DataFrame:
    """Conditions with patient, flag for several conditions, first death event (all its causes).

    The flag is set before the deaths are attached: a second cause of death repeats a condition's
    row but is no second tumour.
    """
    view = V.primary_conditions if primary_only else V.conditions
    joined = L.conditions_with_patients(view(source["Condition"]), V.patients(source["Patient"]))
    flagged = O.multi_flag(joined, "patid_pseudonym", "double_patid")
    first = O.first_event_with_ties(
        V.deaths(source["Observation"], every_cause=True),
        DE.PATIENT,
        "date_death",
        "observation_resource_id",
    )
    return DE.is_deceased(L.attach_deaths(flagged, first))


def one_row_per_condition(df: DataFrame) -> DataFrame:
    """Conditions with the alphabetically first cause of death only."""
    return O.top_per_key(
        df, ["condition_id"], [F.col("death_cause_icd10"), F.col("observation_resource_id")]
    )


def first_gleason(source: Source) -> DataFrame:
    return O.first_per_key(
        V.gleason(source["Observation"]),
        ["observation_gleason_condition_resource_id"],
        "gleason_date",
        ["observation_gleason_resource_id"],
    )


def system_therapies(source: Source) -> DataFrame:
    """System therapies with the drugs and ATC codes of their statements in one cell each."""
    statements = L.resolve_medication(
        V.medication_statements(source["MedicationStatement"]), V.medications(source["Medication"])
    )
    drugs = T.concat_children(
        statements.where(F.col("part_of_reference").isNotNull()),
        ["part_of_reference"],
        ["medication_statement_text", "medication_statement_atc_code"],
    )
    procedures = V.system_therapy_procedures(source["Procedure"])
    return procedures.join(
        drugs.withColumnRenamed("part_of_reference", "therapy_id"), "therapy_id", "left"
    ).fillna("", subset=["medication_statement_text", "medication_statement_atc_code"])


def radiotherapies(source: Source) -> DataFrame:
    """Courses with the target regions and ids of their irradiations."""
    parts = V.irradiations(source["Procedure"]).where(F.col("part_of_reference").isNotNull())
    children = T.concat_children(
        parts.withColumnRenamed("therapy_id", "therapy_id_child"),
        ["part_of_reference"],
        ["zielgebiet", "therapy_id_child"],
    )
    parents = V.radiotherapies(source["Procedure"]).drop("zielgebiet", "part_of_reference")
    return parents.join(
        children.withColumnRenamed("part_of_reference", "therapy_id"), "therapy_id", "left"
    ).fillna("", subset=["zielgebiet", "therapy_id_child"])


def registry_facts(source: Source, conditions: Callable[[], DataFrame]) -> Builders:
    """All facts of a set of conditions (condition_id, patient_resource_id, asserted_date).

    Every table keeps each condition, with NULLs where nothing was reported; metastases keep every
    observation; vital status and classifications keep conditions with an entry. A condition that
    fills several rows (one per cause of death) takes part once, so no fact is multiplied.
    """
    obs = source["Observation"]

    @cache
    def persons() -> DataFrame:
        return conditions().select("condition_id", "patient_resource_id", "asserted_date").distinct()

    @cache
    def parents() -> DataFrame:
        return OD.cast_dates(V.tnm_parent(obs), ["parent_tnm_date"])

    def cond() -> DataFrame:
        return persons().drop("patient_resource_id")

    def by_condition(df: DataFrame, dates: list[str]) -> DataFrame:
        return L.attach_to_all_conditions(OD.cast_dates(df, dates), cond(), ["condition_id"])

    def by_reason(df: DataFrame, dates: list[str]) -> DataFrame:
        return by_condition(df.withColumnRenamed("reason_reference", "condition_id"), dates)

    def staged(df: DataFrame, date: str) -> DataFrame:
        return L.tnm_with_parent(by_condition(df, [date]), parents())

    def metastasis() -> DataFrame:
        dated = OD.cast_dates(V.metastases(obs), ["metastasis_date"])
        return L.attach_left(dated, cond(), ["condition_id"])

    def ops_grouped() -> DataFrame:
        dated = OD.cast_dates(V.surgeries(source["Procedure"]), ["therapy_start_date"])
        grouped = T.group_surgeries(dated).withColumnRenamed("reason_reference", "condition_id")
        return L.attach_to_all_conditions(grouped, cond(), ["condition_id"])

    def vital_status() -> DataFrame:
        status = OD.cast_dates(V.vital_status(obs), ["effective_dateTime"])
        return L.restrict_inner(
            status.withColumnRenamed("observation_patient_reference", "patient_resource_id"),
            persons(),
            ["patient_resource_id"],
        )

    def other_classifications() -> DataFrame:
        dated = OD.cast_dates(V.other_classifications(obs), ["weitere_klassifikation_date"])
        return L.restrict_inner(dated, cond(), ["condition_id"])

    period = ["therapy_start_date", "therapy_end_date"]
    seen = ["effective_dateTime"]
    return {
        "metastasis": metastasis,
        "system_therapies": lambda: by_reason(system_therapies(source), period),
        "radiotherapies_joined": lambda: by_reason(radiotherapies(source), period),
        "ops": lambda: by_reason(V.surgeries(source["Procedure"]), period[:1]).drop("meta_profile"),
        "ops_grouped": ops_grouped,
        "tnm_t": lambda: staged(V.tnm_t(obs), "t_tnm_date"),
        "tnm_n": lambda: staged(V.tnm_n(obs), "n_tnm_date"),
        "tnm_m": lambda: staged(V.tnm_m(obs), "m_tnm_date"),
        "tnm_uicc": lambda: by_condition(V.tnm_uicc(obs), ["uicc_tnm_date"]),
        "tnm_y": lambda: staged(V.tnm_y(obs), "y_tnm_date"),
        "progressions": lambda: by_condition(V.progressions(obs), seen),
        "gradings": lambda: by_condition(V.gradings(obs), ["grading_date"]),
        "performance_status": lambda: by_condition(V.performance_status(obs), seen),
        "vital_status": vital_status,
        "other_classifications": other_classifications,
    }


def server_conditions_of(clean: DataFrame, server: DataFrame) -> DataFrame:
    """Conditions of the hospital system beside the registry ones, linked by record number.

    ``server`` has patient_mrn and the columns of ``views.server_conditions``.
    """
    dated = server.withColumnRenamed("condition_id", "condition_id_mii").withColumns(
        {
            c: F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")
            for c in ("diagnosis_onsetDateTime", "diagnosis_recordedDate")
        }
    )
    base = clean.select("condition_patient_resource_id", "asserted_date", "patid_pseudonym")
    return base.join(dated, F.col("patid_pseudonym") == F.col("patient_mrn"), "left")


def server_labs_of(base: DataFrame, labs: DataFrame) -> DataFrame:
    """Laboratory values of the hospital system for the conditions of a study, by record number.

    ``labs`` has patient_mrn and the columns of ``views.labs``. A condition that fills several rows
    takes part once.
    """
    persons = base.select("condition_id", "patid_pseudonym", "asserted_date").distinct()
    dated = labs.withColumn("lab_dateTime", F.try_to_date(F.substring("lab_dateTime", 1, 10), "yyyy-MM-dd"))
    return persons.join(dated, F.col("patid_pseudonym") == F.col("patient_mrn"))


def deidentified(tables: Tables, secret: RunSecret) -> Tables:
    def build(name: str) -> Callable[[], DataFrame]:
        return lambda: deidentify(tables[name], secret.key)

    return Tables({name: build(name) for name in tables})


def save(tables: Tables, layout: StudyLayout, *, is_deidentified: bool = False, csv: bool = True) -> Tables:
    """Write every table of a study once, as Parquet; CSV, unless switched off, comes from that.

    Returns the tables as they were saved, so that nothing derived from them computes them again.
    """
    saved: Builders = {}
    for name, df in tables.items():
        path = layout.parquet(name, is_deidentified)
        write_parquet(df, path)
        kept = df.sparkSession.read.schema(df.schema).parquet(path)
        if csv:
            write_csv(kept, layout.csv(name, is_deidentified))
        saved[name] = lambda kept=kept: kept
    return Tables(saved)


__all__ = [
    "Builders",
    "Keep",
    "Source",
    "Tables",
    "conditions_patients_deaths",
    "deidentified",
    "first_gleason",
    "lazily",
    "materialise",
    "one_row_per_condition",
    "radiotherapies",
    "registry_facts",
    "save",
    "server_conditions_of",
    "server_labs_of",
    "system_therapies",
]
