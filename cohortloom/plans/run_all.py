"""All jobs over their sources, in sequence, each saved under its own folder."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohortloom.operators.deident import RunSecret, run_secret
from cohortloom.plans import leukaemia as LK
from cohortloom.plans import studies as ST
from cohortloom.plans.base import Source, Tables, deidentified, save
from cohortloom.plans.letter_study import letter_study
from cohortloom.plans.treatment_question import treatment_question
from cohortloom.sources.sinks import StudyLayout, write_parquet

STUDIES = {
    "treatment_question": treatment_question,
    "study_a": lambda s: Tables({"study_a": lambda: ST.study_a(s)}),
    "study_d": ST.study_d,
    "study_pca": ST.study_pca,
    "leukaemia_filter": lambda s: Tables({"leukaemia": lambda: ST.leukaemia_filter(s)}),
    "reacto_counts": ST.reacto_counts,
    "all_conditions": ST.all_conditions,
    "data_quality": ST.data_quality,
}
DEIDENTIFIED = ("study_d", "study_pca", "all_conditions")


@dataclass(frozen=True)
class LeukaemiaInputs:
    """What the leukaemia export takes beside the resources."""

    code_list: DataFrame
    ops_book: DataFrame
    mrn_system: str
    excluded: DataFrame | None = None
    drug_exports: Mapping[str, tuple[DataFrame, str]] | None = None


def run_study(name: str, source: Source, results: str, secret: RunSecret | None = None) -> Tables:
    """Save a study; what is de-identified comes from the saved tables, so each is computed once."""
    layout = StudyLayout(results, name)
    tables = save(STUDIES[name](source), layout)
    if name in DEIDENTIFIED:
        save(deidentified(tables, secret or run_secret()), layout, is_deidentified=True)
    return tables


def run_leukaemia(source: Source, inputs: LeukaemiaInputs, results: str, secret: RunSecret | None = None) -> Tables:
    """Registry part, hospital part, de-identified export; the lookup of record numbers apart."""
    registry = save(
        LK.registry_part(source, inputs.code_list, inputs.excluded, inputs.mrn_system),
        StudyLayout(results, "leukaemia_registry"),
    )
    layout = StudyLayout(results, "leukaemia")
    hospital = save(LK.hospital_part(source, registry, inputs.code_list, inputs.mrn_system, inputs.ops_book), layout)
    out, lookup = LK.deidentified_export(hospital, secret or run_secret(), inputs.drug_exports)
    save(out, layout, is_deidentified=True)
    write_parquet(lookup, layout.mrn_lookup())
    return hospital


def run_federated(sites: Mapping[str, DataFrame], results: str) -> Tables:
    """Totals over all sites."""
    return save(ST.pca_federated(sites), StudyLayout(results, "study_pca_federated"))


def run_letters(
    documents: DataFrame | None, results: str, entries: DataFrame | None = None, done: DataFrame | None = None
) -> Tables:
    """Findings of letters by rules, with skipped documents and rejected findings counted."""
    tables = letter_study(documents, entries, done=done)
    # Findings are nested: they are kept as Parquet only.
    return save(tables, StudyLayout(results, "letters"), csv=False)


def run_all(
    source: Source,
    results: str,
    *,
    leukaemia: LeukaemiaInputs | None = None,
    sites: Mapping[str, DataFrame] | None = None,
    documents: DataFrame | None = None,
) -> None:
    """All studies, and the jobs whose further inputs are given, with one secret for the run."""
    secret = run_secret()
    for name in STUDIES:
        run_study(name, source, results, secret)
    if leukaemia is not None:
        run_leukaemia(source, leukaemia, results, secret)
    if sites is not None:
        run_federated(sites, results)
    if documents is not None:
        run_letters(documents, results)
