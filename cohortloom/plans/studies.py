"""The study jobs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import codes as C
from cohortloom.functions import dates as D
from cohortloom.operators import dates as OD
from cohortloom.operators import deaths as DE
from cohortloom.operators import federate as FE
from cohortloom.operators import linkage as L
from cohortloom.operators import ordering as O
from cohortloom.operators import predicates as PR
from cohortloom.operators import quality as Q
from cohortloom.operators import stats as S
from cohortloom.operators import survival as SV
from cohortloom.operators import therapies as T
from cohortloom.operators import tumours as TU
from cohortloom.operators import views as V
from cohortloom.operators.nearest import nearest_per_key
from cohortloom.plans.base import (
    Keep,
    Source,
    Tables,
    conditions_patients_deaths,
    first_gleason,
    materialise,
    one_row_per_condition,
    radiotherapies,
    registry_facts,
    server_conditions_of,
    server_labs_of,
    system_therapies,
)


def study_a(source: Source, *, with_gleason: bool = True) -> DataFrame:
    """Conditions with patients, consolidated deaths, nearest Gleason grade and metastasis.

    Without Gleason data the study ends after the deaths.
    """
    joined = L.conditions_with_patients(
        V.conditions(source["Condition"]), V.patients(source["Patient"])
    )
    dead = DE.consolidate_deaths(V.deaths(source["Observation"], every_cause=True))
    base = DE.is_deceased(L.attach_deaths(O.multi_flag(joined, "patid_pseudonym"), dead))
    if not with_gleason:
        return base
    anchor = base.select("condition_id", "asserted_date")
    grades = V.gleason(source["Observation"]).select(
        F.col("observation_gleason_condition_resource_id").alias("condition_id"),
        "observation_gleason_resource_id",
        "gleason_sct",
        "gleason_date",
    )
    grade = nearest_per_key(
        anchor,
        grades,
        "condition_id",
        "asserted_date",
        "gleason_date",
        "observation_gleason_resource_id",
        how="inner",
    ).drop("asserted_date")
    sites = nearest_per_key(
        anchor,
        T.metastasis_by_day(V.metastases(source["Observation"])),
        "condition_id",
        "asserted_date",
        "metastasis_date",
        "metastasis_loc",
        how="inner",
    ).drop("asserted_date")
    return (
        base.join(grade, "condition_id", "left")
        .withColumn("gleason_score", C.gleason_score("gleason_sct"))
        .join(sites, "condition_id", "left")
    )


def leukaemia_filter(source: Source) -> DataFrame:
    """Study A for leukaemia and lymphoma codes."""
    return PR.filter_icd_codes(study_a(source))


def prepare_conditions(df: DataFrame) -> DataFrame:
    """Dates, age, tumour groups."""
    dated = OD.compute_age(OD.cast_dates(df, ["asserted_date", "birthdate", "date_death"]))
    # Filters on a plain projection are written out again below the joins, with the parsing of both
    # dates in each; they stop at the generator of a list of one.
    bound = ["asserted_date", "age_at_diagnosis"]
    others = [c for c in dated.columns if c not in bound]
    dated = dated.select(*others, F.inline(F.array(F.struct(*bound)))).select(*dated.columns)
    return dated.withColumns(
        {
            "icd10_parent_code": C.icd_parent("icd10_code"),
            "entity_or_parent": C.entity_group("icd10_code"),
        }
    )


def _clean_primary_tumours(source: Source) -> DataFrame:
    return PR.clean_conditions(
        prepare_conditions(conditions_patients_deaths(source, primary_only=True))
    )


def all_conditions(
    source: Source, server: DataFrame | None = None, keep: Keep = materialise
) -> Tables:
    """All primary tumours with all of their registry facts."""

    @cache
    def clean() -> DataFrame:
        return keep(_clean_primary_tumours(source), "all-conditions")

    out = {
        "all_obds_clean": clean,
        "year_range": lambda: OD.year_range(clean()),
        "entity_summary": lambda: S.entity_summary(one_row_per_condition(clean()), "entity_or_parent"),
        **registry_facts(source, clean),
    }
    if server is not None:
        out["mii_conditions"] = lambda: server_conditions_of(one_row_per_condition(clean()), server)
    return Tables(out)


def earliest_metastasis(source: Source) -> DataFrame:
    """Per condition the first day with metastases and all sites of that day."""
    days = T.metastasis_by_day(V.metastases(source["Observation"])).withColumnRenamed(
        "metastasis_date", "metastasis_date_first"
    )
    return O.first_per_key(
        days.where(F.col("condition_id").isNotNull()),
        ["condition_id"],
        "metastasis_date_first",
        ["metastasis_loc"],
    )


def study_d(source: Source, server: DataFrame | None = None, keep: Keep = materialise) -> Tables:
    """Patients with two primary tumours against those with one."""

    @cache
    def clean() -> DataFrame:
        return keep(_clean_primary_tumours(source), "primary-tumours")

    @cache
    def tumours() -> DataFrame:
        return one_row_per_condition(clean())

    @cache
    def two() -> DataFrame:
        return keep(TU.two_malignancies(tumours()), "two-tumours")

    @cache
    def one() -> DataFrame:
        return TU.one_malignancy(tumours())

    @cache
    def stats() -> DataFrame:
        return TU.pair_statistics(TU.tumour_pairs(two()))

    def both() -> DataFrame:
        shared = ["condition_id", "asserted_date", "patient_resource_id"]
        return one().select(*shared).unionByName(two().select(*shared))

    @cache
    def timing() -> Tables:
        sites = earliest_metastasis(source)
        spread = ["metastasis_loc", "metastasis_date_first"]
        wide = TU.pivot_tumours(
            two().join(sites, "condition_id", "left"),
            one().join(sites, "condition_id", "left"),
            [*TU.TUMOUR_COLUMNS, *spread],
        )
        return two_tumour_timing(wide)

    def timed(name: str) -> Callable[[], DataFrame]:
        return lambda: timing()[name]

    out = {
        "oBDS_primaerdiagnosen": clean,
        "year_range": lambda: OD.year_range(clean()),
        "2_malignancies": two,
        "1_malignancy": one,
        "1_malignancy_check": lambda: TU.one_row_per_patient(one()),
        "pivot_multi_single": lambda: TU.pivot_tumours(two(), one()),
        "pair_statistics": stats,
        "pair_outliers": lambda: TU.pair_outliers(TU.tumour_pairs(two())),
        "pair_matrix_top30": lambda: S.pair_matrix(stats(), top_n=30),
        "pair_matrix_top100": lambda: S.pair_matrix(stats(), top_n=100),
        "pair_matrix_gt5": lambda: S.pair_matrix(stats(), min_count=5),
        **{f"timing_{name}": timed(name) for name in TIMING_TABLES},
        **registry_facts(source, both),
    }
    if server is not None:
        out["mii_conditions_2_mals"] = lambda: server_conditions_of(
            two().where(F.col("malignancy_number") == 1), server
        )
        out["mii_conditions_1_mal"] = lambda: server_conditions_of(one(), server)
    return Tables(out)


TIMING_TABLES = [
    "flags",
    "date_quality",
    "signs",
    "flag_by_entity",
    "location_counts",
    "location_counts_by_entity",
    "timediff_quantiles",
    "timediff_histogram",
    "cumulative_all",
    "cumulative_by_flag",
    "kaplan_meier",
    "kaplan_meier_by_entity",
]


def two_tumour_timing(wide: DataFrame, months: int = 3) -> Tables:
    """Time from first to second tumour, by whether the first had spread before.

    ``wide`` is the two-tumour table with metastasis columns for both tumours.
    """
    dated = PR.has_second_tumour(wide).withColumns(
        {
            "date1": D.parse_mixed_date("asserted_date_1")["date"],
            "date2": D.parse_mixed_date("asserted_date_2")["date"],
            "meta_date1": D.parse_mixed_date("metastasis_date_first_1")["date"],
            "meta_date2": D.parse_mixed_date("metastasis_date_first_2")["date"],
            "entity_label_1": C.entity_label("icd10_code_1"),
            "entity_label_2": C.entity_label("icd10_code_2"),
        }
    )
    dated = PR.drop_exact_placeholders(PR.drop_exact_placeholders(dated, "date1"), "date2")
    valid = dated.where(F.col("date1").isNotNull() & F.col("date2").isNotNull()).withColumn(
        "timediff", D.days_between("date2", "date1")
    )
    flagged = S.meta_flags(valid, months)
    flag = "meta_before_dx_T1_interval_yes"
    timed = flagged.where(F.col("timediff") >= 0)
    spread = flagged.where(F.col(flag) == "yes")
    return Tables({
        "flags": lambda: flagged,
        "date_quality": lambda: S.date_quality_profile(
            wide,
            [
                "asserted_date_1",
                "asserted_date_2",
                "metastasis_date_first_1",
                "metastasis_date_first_2",
            ],
        ),
        "signs": lambda: S.sign_counts(dated, "date2", "date1"),
        "flag_by_entity": lambda: S.flag_by_entity(flagged, "entity_label_2", flag),
        "location_counts": lambda: S.location_entity_counts(spread, "metastasis_loc_1", "entity_label_2"),
        "location_counts_by_entity": lambda: S.location_entity_counts(
            spread, "metastasis_loc_1", "entity_label_2", "entity_label_1", 10
        ),
        "timediff_quantiles": lambda: S.quantile_summary(timed, "timediff"),
        "timediff_histogram": lambda: S.day_histogram(timed, "timediff"),
        "cumulative_all": lambda: O.running_count(timed, "timediff"),
        "cumulative_by_flag": lambda: O.running_count(timed, "timediff", [flag]),
        "kaplan_meier": lambda: SV.kaplan_meier(timed, "timediff", [flag]),
        "kaplan_meier_by_entity": lambda: SV.kaplan_meier_per_group(timed, "timediff", "entity_label_1", flag),
    })


def prostate_base(source: Source) -> DataFrame:
    """Prostate tumours with first Gleason grade, earliest metastasis and cohort flag."""
    base = conditions_patients_deaths(source, primary_only=True).where(
        F.col("icd10_code").startswith("C61")
    )
    grades = first_gleason(source).withColumnRenamed(
        "observation_gleason_condition_resource_id", "condition_id"
    )
    joined = (
        base.join(grades, "condition_id", "left")
        .withColumn("gleason_score", C.gleason_score("gleason_sct"))
        .join(earliest_metastasis(source), "condition_id", "left")
    )
    dated = OD.compute_age(
        OD.cast_dates(joined, ["asserted_date", "birthdate", "gleason_date", "metastasis_date_first"])
    )
    flagged = PR.flag_cohort(dated)
    flagged = OD.months_diff(flagged, "gleason_date", "asserted_date")
    flagged = OD.months_diff(flagged, "metastasis_date_first", "asserted_date")
    return PR.clean_conditions(flagged, code=None)


def study_pca(
    source: Source,
    atc_mapping: DataFrame | None = None,
    first_line_months: float = 4,
    keep: Keep = materialise,
    server_labs: DataFrame | None = None,
) -> Tables:
    """Prostate cancer: facts, therapy sequences, site aggregates, and linked laboratory values."""

    @cache
    def base() -> DataFrame:
        return keep(prostate_base(source), "prostate-base")

    @cache
    def tumours() -> DataFrame:
        return one_row_per_condition(base())

    @cache
    def therapies() -> DataFrame:
        surgeries = T.group_surgeries(V.surgeries(source["Procedure"]))
        return T.all_therapies(surgeries, radiotherapies(source), system_therapies(source))

    @cache
    def sequence() -> DataFrame:
        return T.therapy_sequence(tumours(), therapies())

    @cache
    def first_line() -> DataFrame:
        return keep(
            T.therapy_sequence(tumours(), therapies(), first_line_months=first_line_months),
            "first-line",
        )

    @cache
    def combined() -> DataFrame:
        return keep(T.all_combinations(tumours(), therapies(), first_line_months), "combinations")

    def flagged(flag: int) -> DataFrame:
        return combined().where(F.col("cohort_flag") == flag)

    def sliced() -> DataFrame:
        periods = combined().withColumn("year_slice", PR.year_slice("asserted_date"))
        return periods.where(F.col("year_slice").isNotNull())

    def export() -> DataFrame:
        leading = T.leading_ordinals(sequence())
        if atc_mapping is None:
            return leading
        return T.atc_groups(leading, atc_mapping, "condition_id")

    combinations, by_metastasis = T.therapy_combinations, T.therapy_combinations_by_metastasis
    labs = {} if server_labs is None else {"mii_labs": lambda: server_labs_of(base(), server_labs)}
    return Tables(
        {
            **labs,
            "c61_base": base,
            "therapy_sequence": sequence,
            "therapy_sequence_first_line": first_line,
            "sequence_export": export,
            "sequence_counts": lambda: T.sequence_counts(first_line()),
            "diagnosis_year": lambda: S.counts_by_year(first_line()),
            "metastasis_loc": lambda: S.counts_by_metastasis(first_line()),
            "age_class": lambda: S.counts_by_age_class(first_line()),
            "therapy_combinations_cohort": lambda: combinations(flagged(1)),
            "therapy_combinations_rest": lambda: combinations(flagged(0)),
            "therapy_combinations_met_cohort": lambda: by_metastasis(flagged(1)),
            "therapy_combinations_met_rest": lambda: by_metastasis(flagged(0)),
            "therapy_combinations_met_by_period": lambda: by_metastasis(
                sliced(), ["cohort_flag", "year_slice"]
            ),
            **registry_facts(source, base),
        }
    )


def pca_federated(sites: Mapping[str, DataFrame]) -> Tables:
    """Totals over all sites of the aggregates above.

    ``sites`` maps diagnosis_year, age_class, metastasis_loc and therapy_combinations_met to the
    stacked tables of all sites; therapy_combinations_met_by_period, where given, adds the totals of
    cohort and rest for each period.
    """
    years = FE.merge_sites(sites["diagnosis_year"], ["diagnosis_year"])
    ages = FE.merge_sites(sites["age_class"], ["age_class"])
    kinds = FE.merge_sites(sites["metastasis_loc"], ["metastasis_kind"])
    combos = FE.merge_sites(
        sites["therapy_combinations_met"], ["combo_label", "metastatic_flag"], normalise_keys=True
    )
    by_period = sites.get("therapy_combinations_met_by_period")
    more: dict[str, Callable[[], DataFrame]] = {}
    if by_period is not None:
        keys = ["cohort_flag", "year_slice", "combo_label", "metastatic_flag"]
        merged = FE.merge_sites(by_period, keys, normalise_keys=True)
        more["therapy_combinations_met_by_period"] = lambda: merged
    return Tables({
        **more,
        "diagnosis_year": lambda: FE.recent_years(years),
        "age_class": lambda: FE.collapse_tail_classes(ages),
        "metastasis_loc": lambda: FE.min_cell_filter(kinds),
        "therapy_combinations_met": lambda: combos,
        "therapies_metastasis_split": lambda: FE.split_metastatic_pivot(combos),
    })


def reacto_counts(source: Source, years: tuple[int, int] = (2018, 2025)) -> Tables:
    """Tumours of five organs in the diagnosis window, and how many of each gender."""
    base = study_a(source, with_gleason=False)
    primary = PR.filter_primary_diagnosis(base)
    classified = primary.join(
        V.first_classifications(source["Observation"])
        .withColumnRenamed("focus_reference", "condition_id")
        .drop("meta_profile", "observation_id"),
        "condition_id",
        "left",
    )
    window = PR.filter_entity_window(OD.cast_dates(classified, ["asserted_date"]), years=years)
    return Tables({"reacto": lambda: window, "reacto_counts": lambda: TU.gender_counts(window)})


def data_quality(source: Source) -> Tables:
    return Tables({
        "substanzen-to-atc-mappings": lambda: Q.uncoded_medications(
            V.uncoded_medication_statements(source["MedicationStatement"])
        ),
        "weitere-klassifikationen-mappings": lambda: Q.uncoded_classifications(
            V.uncoded_observations(source["Observation"])
        ),
        "adverse-event-mappings": lambda: Q.uncoded_side_effects(
            V.uncoded_adverse_events(source["AdverseEvent"])
        ),
    })
