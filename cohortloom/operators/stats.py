"""Distributions, cohort counts, quality profiles. Everything aggregates map-side first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import codes as C
from cohortloom.functions import dates as D
from cohortloom.operators.nearest import nearest_event
from cohortloom.operators.quantiles import exact_quantiles, join_null_safe
from cohortloom.operators.ordering import share_of_total, share_within_group
from cohortloom.operators.skew import spread_join

GLEASON = [6, 7, 8, 9, 10]


def counts_by_dimension(
    df: DataFrame,
    dimension: str,
    total: str = "count",
    extra: Mapping[str, Column] | None = None,
    flag: str = "cohort_flag",
    score: str = "gleason_score",
) -> DataFrame:
    """Rows, cohort rows and rows per score for each bucket; NULL is no bucket."""
    return (
        df.where(F.col(dimension).isNotNull())
        .groupBy(dimension)
        .agg(
            F.count(F.lit(1)).alias(total),
            F.count_if(F.col(flag) == 1).alias("cohort_count"),
            *[F.count_if(c).alias(name) for name, c in (extra or {}).items()],
            *[F.count_if(F.col(score) == g).alias(f"gleason_{g}_count") for g in GLEASON],
        )
    )


def counts_by_year(df: DataFrame, date: str = "asserted_date") -> DataFrame:
    return counts_by_dimension(df.withColumn("diagnosis_year", F.year(date)), "diagnosis_year")


SYNCHRONOUS_DAYS = 121.75


def counts_by_metastasis(
    df: DataFrame, loc: str = "metastasis_loc", found: str = "metastasis_date_first", date: str = "asserted_date"
) -> DataFrame:
    early = F.datediff(found, date) < F.lit(SYNCHRONOUS_DAYS)
    return counts_by_dimension(
        df.withColumn("metastasis_kind", C.normalise_set_string(loc)),
        "metastasis_kind",
        "overall_count",
        {"synchron_count": early},
    )


def counts_by_age_class(df: DataFrame, age: str = "age_at_diagnosis") -> DataFrame:
    return counts_by_dimension(df.withColumn("age_class", C.age_class(age)), "age_class")


def distribution(df: DataFrame, col: str, name: str | None = None, *, keep_null: bool = False) -> DataFrame:
    """Value, count, percentage; NULL is left out of both unless ``keep_null``."""
    rows = df if keep_null else df.where(F.col(col).isNotNull())
    counted = rows.groupBy(F.col(col).alias(name or col)).agg(F.count(F.lit(1)).alias("count"))
    return share_of_total(counted)


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per combination, NULL as a value, most frequent first."""
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), *[F.col(c).asc_nulls_first() for c in cols])
    )


def distinct_patients_by(
    df: DataFrame, keys: Sequence[str], patient: str, name: str = "num_patients", *, approx: bool = False
) -> DataFrame:
    count = F.approx_count_distinct(patient) if approx else F.count_distinct(patient)
    return df.groupBy(*keys).agg(count.alias(name))


def cohort_funnel(df: DataFrame, steps: Mapping[str, Column], patient: str) -> DataFrame:
    """Patients per step as (step_no, step, n).

    Flags are combined per patient first, map-side included, and then summed: several distinct
    counts side by side would repeat every row once per step.
    """
    reached = (
        df.where(F.col(patient).isNotNull())
        .groupBy(patient)
        .agg(*[F.bool_or(cond).alias(f"_s{i}") for i, cond in enumerate(steps.values())])
    )
    sums = reached.agg(*[F.count_if(F.col(f"_s{i}")).alias(f"_s{i}") for i in range(len(steps))])
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.col(f"_s{i}").alias("n"))
            for i, name in enumerate(steps)
        ]
    )
    return sums.select(F.inline(rows))


def entity_summary(
    df: DataFrame, entity: str, age: str = "age_at_diagnosis", top_n: int | None = None
) -> DataFrame:
    """Count and mean age of all entities, or of the ``top_n`` most frequent, ordered by mean age."""
    counted = df.groupBy(entity).agg(F.count(F.lit(1)).alias("count"), F.avg(age).alias("mean_age"))
    if top_n is not None:
        counted = counted.orderBy(F.desc("count"), entity).limit(top_n)
    return counted.orderBy("mean_age", entity)


def pair_matrix(
    stats: DataFrame,
    entity: str = "entity_or_parent",
    top_n: int | None = None,
    min_count: int | None = None,
) -> DataFrame:
    """Pair counts with the female share: the table behind a bubble chart."""
    out = stats.withColumn("female_ratio", F.col("count_female_pair") / F.col("count_pair"))
    if min_count is not None:
        out = out.where(F.col("count_pair") > min_count)
    if top_n is not None:
        out = out.orderBy(F.desc("count_pair"), f"{entity}_1", f"{entity}_2").limit(top_n)
    return out


def wide_matrix(stats: DataFrame, columns: Sequence[str], value: str, entity: str = "entity_or_parent") -> DataFrame:
    """The same as a matrix over given second entities, missing pairs 0."""
    wide = stats.groupBy(f"{entity}_1").pivot(f"{entity}_2", list(columns)).agg(F.sum(value))
    return wide.fillna(0, subset=[c for c in wide.columns if c != f"{entity}_1"])


def lab_panel_means(
    patients: DataFrame,
    labs: DataFrame,
    patient: str,
    diagnosed: str,
    lab_time: str,
    panels: Mapping[str, Sequence[str]] = C.LAB_PANELS,
    code: str = "loinc_code",
    value: str = "lab_quantity_value",
    unit: str = "lab_quantity_unit",
    tie: str = "observation_id",
) -> DataFrame:
    """Per panel and unit, count and mean of each patient's value nearest to diagnosis.

    The nearest row of every panel comes from one as-of match over patients for all panels.
    """
    panel_of = C.lookup({c: p for p, codes in panels.items() for c in codes}, code)
    key = F.col(patient).cast("string").alias("_pk")
    named = labs.withColumn("lab_value", panel_of).where(F.col("lab_value").isNotNull())
    base = patients.where(F.col(patient).isNotNull()).select(key, diagnosed)
    events = named.select(key, "lab_value", value, unit, lab_time, tie)
    near = nearest_event(base, events, "_pk", diagnosed, lab_time, tie, how="inner", each="lab_value", values=list(panels))
    number = F.col(value).try_cast("double")
    return (
        near.where(F.col(unit).isNotNull())
        .groupBy("lab_value", F.col(unit).alias("unit"))
        .agg(F.count(number).alias("count"), F.avg(number).alias("mean"))
    )


def location_entity_counts(
    df: DataFrame,
    loc: str,
    entity_2: str,
    entity_1: str | None = None,
    min_n: int | None = None,
    sep: str = "|",
) -> DataFrame:
    """Metastasis sites of the first tumour against the second; per first entity on request."""
    first = [entity_1] if entity_1 else []
    rows = df
    if entity_1 and min_n is not None:
        big = df.groupBy(entity_1).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > min_n)
        rows = spread_join(df, big.select(entity_1), [entity_1], "left_semi")
    sites = F.split(F.col(loc), "\\Q" + sep + "\\E")
    return (
        rows.where(F.trim(loc) != "")
        .select(*first, entity_2, F.explode(sites).alias("_site"))
        .withColumn("location", F.trim("_site"))
        .where(F.col("location") != "")
        .groupBy(*first, "location", entity_2)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def location_combinations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct().orderBy(*cols)


def meta_flags(
    df: DataFrame,
    months: int,
    loc_1: str = "metastasis_loc_1",
    meta_date_1: str = "meta_date1",
    meta_date_2: str = "meta_date2",
    date_2: str = "date2",
) -> DataFrame:
    """Metastasis of the first tumour at all, and long enough before the second diagnosis."""
    early = D.at_least_months_before(meta_date_1, date_2, months)
    hit = F.when(early, F.lit(1)).otherwise(F.lit(0))
    return df.withColumns(
        {
            "meta_at_first": F.when(F.trim(loc_1) != "", F.lit("yes")).otherwise(F.lit("no")),
            "meta_1_before_T2_interval": hit,
            "meta_before_dx_T2": F.when(F.col(meta_date_2) < F.col(date_2), F.lit(1)).otherwise(F.lit(0)),
            "meta_before_dx_T1_interval_yes": F.when(early, F.lit("yes")).otherwise(F.lit("no")),
        }
    )


def flag_by_entity(df: DataFrame, entity: str, flag: str) -> DataFrame:
    """Count and share of a flag within each entity."""
    counted = df.groupBy(entity, flag).agg(F.count(F.lit(1)).alias("n"))
    return share_within_group(counted, [entity])


EPOCH = "1970-01-01"


def date_quality_profile(df: DataFrame, cols: Sequence[str], fill: str = "mid") -> DataFrame:
    """One row per date column: how much is filled, parsed, epoch, and of which precision.

    The columns are stacked and grouped by their parsed value first, so each text is parsed once
    and the counting runs over distinct values only.
    """
    cells = F.array(
        *[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("text")) for c in cols]
    )
    values = (
        df.select(F.inline(cells))
        .groupBy("col", D.parse_mixed_date("text", fill).alias("p"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    raw, date, prec, full = (F.col(f"p.{x}") for x in ("raw", "date", "precision", "full"))
    there = raw.isNotNull()
    measures = {
        "n_total": F.lit(True),
        "n_nonempty": there,
        "n_parsed": date.isNotNull(),
        "n_na": date.isNull(),
        "n_1970": date == F.lit(EPOCH).cast("date"),
        "prec_day": there & (prec == "day"),
        "prec_month": there & (prec == "month"),
        "prec_year": there & (prec == "year"),
        "n_inconsistent": (prec == "day") & raw.rlike(D.ISO_DAY) & (raw != full),
        "n_implausible_year": ~F.year(date).between(1950, 2030),
    }
    return values.groupBy("col").agg(
        *[
            F.coalesce(F.sum(F.when(test, F.col("_n"))), F.lit(0)).alias(name)
            for name, test in measures.items()
        ]
    )


def epoch_raw_values(df: DataFrame, col: str, top_n: int) -> DataFrame:
    """Raw text behind dates that parse to 1 January 1970, most frequent first."""
    # Grouping by the parsed value parses each text once and keeps the plan small.
    values = df.groupBy(D.parse_mixed_date(col).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return (
        values.where(F.col("p.date") == F.lit(EPOCH).cast("date"))
        .select(F.col("p.raw").alias("raw"), "n")
        .orderBy(F.desc("n"), "raw")
        .limit(top_n)
    )


def sign_counts(df: DataFrame, later: str, earlier: str) -> DataFrame:
    """How many day differences are negative, zero, positive."""
    d = F.datediff(later, earlier)
    return df.agg(
        F.count(d).alias("valid"),
        F.count_if(d < 0).alias("negative"),
        F.count_if(d == 0).alias("zero"),
        F.count_if(d > 0).alias("positive"),
    )


# Probabilities and day breaks of the timing reports.
PROBS = [0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0]
DAY_BREAKS = [-1, 0, 30, 90, 180, 365, 730, 1825, 3650]


def quantile_summary(
    df: DataFrame, col: str, probs: Sequence[float] = PROBS, group: Sequence[str] = ()
) -> DataFrame:
    """Count, extremes, mean and interpolated quantiles, exact for groups of any size."""
    group = list(group)
    aggs = [F.count(col).alias("n"), F.min(col).alias("min"), F.avg(col).alias("mean"), F.max(col).alias("max")]
    out = df.groupBy(*group).agg(*aggs)
    found = exact_quantiles(df, group, [col], probs)
    joined = join_null_safe(out, found, group)
    named = [F.col(f"{col}_quantiles")[i].alias(f"q{round(p * 100):02d}") for i, p in enumerate(probs)]
    return joined.select(*group, "n", "min", "mean", "max", *named)


def day_histogram(df: DataFrame, col: str, breaks: Sequence[float] = DAY_BREAKS) -> DataFrame:
    """Rows per right-closed interval, the last one open."""
    edges = [*breaks, float("inf")]
    labels = [f"({lo},{hi}]" if hi != float("inf") else f"({lo},inf)" for lo, hi in zip(edges, edges[1:], strict=False)]
    binned = df.withColumn("bin", C.right_closed_bins(F.col(col).cast("double"), edges, labels))
    return binned.where(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A reproducible handful of rows for looking at, by the digest of key and seed."""
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(digest, key).limit(n)


def head_by(df: DataFrame, order: Sequence[str], n: int, *, tail: bool = False) -> DataFrame:
    keys = [F.desc(c) if tail else F.asc(c) for c in order]
    return df.orderBy(*keys).limit(n)
