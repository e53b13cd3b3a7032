"""Therapies: parts per course, sequences, combinations, drug groups."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.dates import months_since
from cohortloom.operators.ordering import top_per_key
from cohortloom.operators.quantiles import join_null_safe
from cohortloom.operators.skew import spread_join
from cohortloom.session import materialise

SEP = "| "


def concat_children(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], sep: str = SEP
) -> DataFrame:
    """Distinct children of a parent, sorted and joined; '' where all are NULL.

    Cells hold distinct codes or names, so their size follows the code system, not the rows.
    """
    return df.groupBy(*keys).agg(
        *[F.array_join(F.sort_array(F.collect_set(c)), sep).alias(c) for c in cols]
    )


def ordered_concat(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: Sequence[str],
    sep: str = SEP,
) -> DataFrame:
    """Children of a group in id order, repeats kept, NULLs skipped, as one cell per column.

    For groups with a natural bound, such as the surgeries of a day; ``paged_concat`` takes any.
    Rows whose keys are all known give one row for each group, whatever its size. Rows with a NULL
    key belong to no group and stay single, so the only group without natural bound is never built.
    """
    text = {c: F.col(c).cast("string") for c in cols}
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    child = F.struct(F.col(order).alias("_by"), *[text[c].alias(f"_{i}") for i, c in enumerate(cols)])
    grouped = (
        df.where(known)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(child)).alias("_all"))
        .select(*keys, *[F.array_join(F.col(f"_all._{i}"), sep).alias(c) for i, c in enumerate(cols)])
    )
    single = df.where(~known).select(*keys, *[F.coalesce(text[c], F.lit("")).alias(c) for c in cols])
    return grouped.unionByName(single)


def paged_concat(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, sep: str = SEP, page: int = 1 << 20
) -> DataFrame:
    """Values of a group in ``order`` as cells of bounded length: ``keys``, ``page`` (1, 2, ...), ``col``.

    A value belongs to the page in which its place in the joined text of its group begins, so a cell
    has at most ``page`` characters and one value; joined again by ``sep`` the pages give the whole
    text. NULL values are skipped, a group without values has no page, NULL keys are a group.

    Rows are dealt by ranges of keys and order and stored once. Lengths of earlier ranges, a small
    row each, and running sums inside a range give each value its place, so a group of any size is
    worked on by many tasks, each of which holds a page at a time.
    """
    keys = list(keys)
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    text = F.col(col).cast("string")
    rows = df.where(text.isNotNull()).select(
        *[F.col(k).alias(n) for k, n in names.items()],
        *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
        text.alias("_text"),
        (F.char_length(text) + len(sep)).cast("bigint").alias("_length"),
    )
    sorting = [F.asc_nulls_first(c) for c in [*names.values(), *[f"_o{i}" for i in range(len(order))], "_text"]]
    ranged = rows.repartitionByRange(*sorting).withColumn("_part", F.spark_partition_id())
    stored = materialise(ranged, "paged")
    piece = [*names.values(), "_part"]
    sums = stored.groupBy(*piece).agg(F.sum("_length").alias("_sum"))
    earlier = Window.partitionBy(*names.values()).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(*piece, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*piece).orderBy(*sorting[len(keys) :]).rowsBetween(Window.unboundedPreceding, -1)
    placed = join_null_safe(stored, shifts, piece, "inner").withColumn("_at", F.coalesce(F.sum("_length").over(inside), F.lit(0)) + F.col("_shift"))
    paged = placed.groupBy(*names.values(), (F.floor(F.col("_at") / page) + 1).alias("page"))
    cells = paged.agg(F.array_sort(F.collect_list(F.struct("_at", "_text"))).alias("_all"))
    return cells.select(*[F.col(n).alias(k) for k, n in names.items()], "page", F.array_join("_all._text", sep).alias(col))


def group_surgeries(surgeries: DataFrame) -> DataFrame:
    """Surgeries of one known condition, patient and day in one row; others stay single."""
    return ordered_concat(
        surgeries,
        ["reason_reference", "subject_reference", "therapy_start_date"],
        "therapy_id",
        ["ops_code", "surgery_outcome", "therapy_intention", "therapy_id"],
    )


def metastasis_by_day(
    metastases: DataFrame, condition: str = "condition_id", date: str = "metastasis_date"
) -> DataFrame:
    return concat_children(metastases, [condition, date], ["metastasis_loc"], "|")


# Columns of the common therapy table, and those laid out in sequence.
THERAPY_COLUMNS = {
    "therapy_id": "string",
    "meta_profile": "string",
    "subject_reference": "string",
    "reason_reference": "string",
    "therapy_type": "string",
    "therapy_intention": "string",
    "stellung_op": "string",
    "therapy_start_date": "date",
    "therapy_end_date": "date",
    "therapy_end_reason": "string",
    "ops_code": "string",
    "surgery_outcome": "string",
    "zielgebiet": "string",
    "therapy_protocol_text": "string",
    "medication_statement_text": "string",
    "medication_statement_atc_code": "string",
}
SEQUENCE_COLUMNS = [
    "therapy_type",
    "therapy_id",
    "therapy_intention",
    "therapy_start_date",
    "therapy_end_date",
    "therapy_end_reason",
    "months_diff",
    "stellung_op",
    "ops_code",
    "surgery_outcome",
    "zielgebiet",
    "therapy_protocol_text",
    "medication_statement_text",
    "medication_statement_atc_code",
]


def _to_master(df: DataFrame, therapy_type: str | None) -> DataFrame:
    if therapy_type is not None:
        df = df.withColumn("therapy_type", F.lit(therapy_type))
    have = set(df.columns)
    return df.select(
        *[
            (F.col(c).try_cast(t) if c in have else F.lit(None).cast(t)).alias(c)
            for c, t in THERAPY_COLUMNS.items()
        ]
    )


def all_therapies(surgeries: DataFrame, radio: DataFrame, system: DataFrame) -> DataFrame:
    """Surgery (OP), radiotherapy (ST) and system therapy in one schema."""
    return (
        _to_master(surgeries, "OP")
        .unionByName(_to_master(radio, "ST"))
        .unionByName(_to_master(system, None))
    )


def dated_therapies(
    therapies: DataFrame, conditions: DataFrame, first_line_months: float | None = None
) -> DataFrame:
    """Therapies with the months since the diagnosis of their condition; on request early ones only."""
    diagnosed = conditions.select(
        F.col("condition_id").alias("reason_reference"), "asserted_date"
    ).distinct()
    months = months_since("therapy_start_date", "asserted_date")
    # Therapies are dealt before the diagnoses are known to be few. Broadcast then, each task would read
    # the shuffle files of adjacent tasks, and one most of the surgeries; merged, it reads by key.
    dated = spread_join(therapies, diagnosed.hint("merge"), ["reason_reference"]).withColumn("months_diff", months)
    return dated if first_line_months is None else dated.where(F.col("months_diff").between(0, first_line_months))


def therapy_index(
    therapies: DataFrame,
    conditions: DataFrame,
    max_n: int = 10,
    first_line_months: float | None = None,
) -> DataFrame:
    """The first ``max_n`` therapies of each condition by months since diagnosis.

    A condition that fills several rows (one per cause of death) counts once. Conditions are cut to
    ``max_n`` therapies before the shuffle.
    """
    return top_per_key(
        dated_therapies(therapies, conditions, first_line_months),
        ["reason_reference"],
        [F.col("months_diff").asc_nulls_first(), F.col("therapy_id"), F.col("therapy_type")],
        max_n,
        rank_as="therapy_index",
    )


def therapy_sequence(
    conditions: DataFrame,
    therapies: DataFrame,
    max_n: int = 10,
    first_line_months: float | None = None,
    cols: Sequence[str] = SEQUENCE_COLUMNS,
) -> DataFrame:
    """Conditions with ``<col>_1 .. <col>_n`` of their therapies, from a single pivot.

    With ``first_line_months`` only therapies that early count, and only conditions with one stay.
    """
    long = therapy_index(therapies, conditions, max_n, first_line_months)
    ordinals = list(range(1, max_n + 1))
    wide = (
        long.where(F.col("reason_reference").isNotNull())
        .groupBy("reason_reference")
        .pivot("therapy_index", ordinals)
        .agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
    )
    wide = wide.select(
        F.col("reason_reference").alias("condition_id"),
        *[F.col(f"{n}_{c}").alias(f"{c}_{n}") for c in cols for n in ordinals],
    )
    out = conditions.join(wide, "condition_id", "left")
    return out if first_line_months is None else out.where(F.col("months_diff_1").isNotNull())


def ordinal_columns(df: DataFrame, prefix: str) -> list[str]:
    """Columns ``<prefix>_<number>`` by number."""
    found = [(int(m.group(1)), c) for c in df.columns if (m := re.fullmatch(rf"{prefix}_(\d+)", c))]
    return [c for _, c in sorted(found)]


def leading_ordinals(df: DataFrame, keep: int = 3) -> DataFrame:
    """Columns without an ordinal suffix, and ordinals 1 to ``keep``."""
    cols = [
        c
        for c in df.columns
        if not (m := re.fullmatch(r".*_(\d+)", c)) or 1 <= int(m.group(1)) <= keep
    ]
    return df.select(*cols)


def all_combinations(
    conditions: DataFrame, therapies: DataFrame, first_line_months: float | None = None, name: str = "combo_label"
) -> DataFrame:
    """Conditions with the distinct therapy types of all of their therapies, sorted, as ``A+B``.

    Taken from the therapies themselves, not from the ordinals of a wide table, so no therapy is
    left out. With ``first_line_months`` only therapies that early count, and only conditions with
    one stay; otherwise a condition without therapies has the empty combination.
    """
    dated = dated_therapies(therapies, conditions, first_line_months)
    types = (
        dated.where(F.col("reason_reference").isNotNull())
        .groupBy(F.col("reason_reference").alias("condition_id"))
        .agg(F.array_join(F.array_sort(F.collect_set("therapy_type")), "+").alias(name))
    )
    how = "left" if first_line_months is None else "inner"
    joined = spread_join(conditions, types, ["condition_id"], how)
    return joined.withColumn(name, F.coalesce(name, F.lit("")))


def combination_label(df: DataFrame, prefix: str = "therapy_type") -> Column:
    """Distinct therapy types of a sequence, sorted, as ``A+B``."""
    types = F.array(*[F.col(c) for c in ordinal_columns(df, prefix)])
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(types))), "+")


def therapy_combinations(df: DataFrame, by: Sequence[str] = (), prefix: str = "therapy_type") -> DataFrame:
    """Conditions per combination of therapy types: ``combo_label`` if there, else the ordinals."""
    labelled = df if "combo_label" in df.columns else df.withColumn("combo_label", combination_label(df, prefix))
    return (
        labelled.groupBy(*by, "combo_label")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def metastatic_flag() -> Column:
    there = F.col("metastasis_loc").isNotNull() | F.col("metastasis_date_first").isNotNull()
    return F.when(there, F.lit("metastatic")).otherwise(F.lit("non_metastatic"))


def therapy_combinations_by_metastasis(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Conditions per combination and metastatic flag."""
    return therapy_combinations(
        df.withColumn("metastatic_flag", metastatic_flag()), [*by, "metastatic_flag"]
    )


def sequence_counts(df: DataFrame, prefix: str = "therapy_type") -> DataFrame:
    """Conditions per full sequence, with its pattern text, most frequent first."""
    cols = ordinal_columns(df, prefix)
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("pattern", F.concat_ws("+", *cols))
        .orderBy(F.desc("count"), *[F.col(c).asc_nulls_first() for c in cols])
    )


def atc_groups(
    df: DataFrame,
    mapping: DataFrame,
    id_col: str,
    code_prefix: str = "medication_statement_atc_code",
    out_prefix: str = "gruppe",
    code: str = "atc_code",
    group: str = "gruppe",
    sep: str = "|",
) -> DataFrame:
    """Replace the codes in every ordinal column by their groups, order kept, unknown ones gone.

    ``id_col`` names each row.

    All columns are unfolded together, joined to the mapping once, and folded back: the mapping may
    be of any size and never visits the driver.
    """
    cols = ordinal_columns(df, code_prefix)
    if not cols:
        return df
    numbers = [int(c.rsplit("_", 1)[1]) for c in cols]
    cells = F.array(*[F.struct(F.lit(n).alias("n"), F.col(c).alias("codes")) for n, c in zip(numbers, cols, strict=True)])
    long = (
        df.select(id_col, F.explode(cells).alias("_cell"))
        .where(F.col("_cell.codes").isNotNull())
        .select(
            id_col,
            F.col("_cell.n").alias("_n"),
            F.posexplode(F.split("_cell.codes", "\\Q" + sep + "\\E")).alias("_pos", "_raw"),
        )
        .withColumn("_code", F.trim("_raw"))
    )
    known = (
        mapping.select(F.trim(code).alias("_code"), F.col(group).alias("_group"))
        .where((F.col("_code") != "") & F.col("_group").isNotNull())
        .groupBy("_code")
        .agg(F.min("_group").alias("_group"))
    )
    joined = spread_join(long, known, ["_code"], "inner")

    def cell(n: int) -> Column:
        entries = F.array_sort(F.collect_list(F.when(F.col("_n") == n, F.struct("_pos", "_group"))))
        return F.array_join(F.transform(entries, lambda e: e["_group"]), sep).alias(f"{out_prefix}_{n}")

    folded = joined.groupBy(id_col).agg(*[cell(n) for n in numbers])
    out = df.join(folded, id_col, "left")
    return out.withColumns(
        {f"{out_prefix}_{n}": F.coalesce(f"{out_prefix}_{n}", F.lit("")) for n in numbers}
    )
