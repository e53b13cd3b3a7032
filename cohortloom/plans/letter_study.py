"""Letters to findings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortloom.operators import letters as LT
from cohortloom.plans.base import Tables


def letter_study(
    documents: DataFrame | None = None,
    entries: DataFrame | None = None,
    extractor: LT.Extractor | None = None,
    done: DataFrame | None = None,
) -> Tables:
    """Findings tables out of XML documents and tabular entries.

    ``done`` holds earlier results; only letters without one are processed.
    """
    parts = []
    if documents is not None:
        parts.append(LT.letters_from_documents(documents))
    if entries is not None:
        parts.append(LT.letters_from_entries(entries))
    letters = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    keyed = LT.letter_key(letters)
    found = LT.extract_findings(keyed, extractor, done)
    if extractor is None:
        # The rules find what is there: a finding may break a limit, a letter can't.
        rejected = LT.rejected_single_findings(found)
        valid = LT.unique_findings(LT.sound_findings(found))
    else:
        results = LT.validate_findings(LT.unique_findings(found))
        rejected, valid = LT.rejected_findings(results), LT.valid_findings(results)
    tables = LT.findings_tables(valid)
    more = {} if documents is None else {"skipped": lambda: LT.skipped_documents(documents)}
    return Tables({
        **more,
        "letters": lambda: keyed,
        "key_collisions": lambda: LT.key_collisions(keyed),
        "results": lambda: valid,
        "rejected": lambda: rejected,
        "genes": lambda: LT.dedupe_genes(tables["genes"]),
        "karyotypes": lambda: LT.distinct_assessments(tables["karyotypes"], "source_file", "classification"),
        "eln_risk": lambda: LT.distinct_assessments(tables["eln_risk"], "source_file", "risk_category"),
    })
