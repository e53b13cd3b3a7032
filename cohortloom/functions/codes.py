"""Code systems: tumour groups, scores, bins and look-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(mapping: Mapping, key: Column | str) -> Column:
    """Value for a key out of a small constant map; NULL for unknown keys."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _col(key))


# Grade-group codes and the score each stands for.
GLEASON_SCORES = {
    "1279715000": 6,
    "1279714001": 7,
    "1279716004": 7,
    "1279718003": 8,
    "1279717008": 8,
    "1279719006": 8,
    "1279720000": 9,
    "1279721001": 9,
    "1279722008": 10,
}


def gleason_score(code: Column | str) -> Column:
    return lookup(GLEASON_SCORES, code)


def icd_parent(code: Column | str) -> Column:
    """Text before the dot."""
    return F.substring_index(_col(code), ".", 1)


def icd_category(code: Column | str) -> Column:
    """First three characters."""
    return F.substring(_col(code), 1, 3)


# Registry groups as inclusive ranges of three-character codes.
ENTITY_GROUPS = [
    ("C00", "C14"), ("C15", "C15"), ("C16", "C16"), ("C18", "C21"), ("C22", "C22"), ("C23", "C24"),
    ("C25", "C25"), ("C32", "C32"), ("C33", "C34"), ("C43", "C43"), ("C50", "C50"), ("C53", "C53"),
    ("C54", "C55"), ("C56", "C56"), ("C61", "C61"), ("C62", "C62"), ("C64", "C64"), ("C67", "C67"),
    ("C70", "C72"), ("C73", "C73"), ("C81", "C81"), ("C82", "C88"), ("C90", "C90"), ("C91", "C95"),
]


def _case(branches: Sequence[tuple[Column, Column]], default: Column) -> Column:
    return reduce(lambda acc, b: acc.when(b[0], b[1]), branches[1:], F.when(*branches[0])).otherwise(default)


def entity_group(code: Column | str) -> Column:
    """Registry group of a diagnosis, or its parent code where no group covers it."""
    parent = icd_parent(code)
    return _case(
        [
            (parent.between(lo, hi), F.lit(lo if lo == hi else f"{lo}-{hi}"))
            for lo, hi in ENTITY_GROUPS
        ],
        parent,
    )


# German entity names over inclusive ranges of the two digits after "C".
ENTITY_LABELS = [
    (0, 14, "Lippe, Mundhöhle und Rachen"),
    (15, 15, "Speiseröhre"),
    (16, 16, "Magen"),
    (18, 21, "Dickdarm und Rektum"),
    (22, 22, "Leber"),
    (23, 24, "Gallenblase und Gallenwege"),
    (25, 25, "Bauchspeicheldrüse"),
    (32, 32, "Kehlkopf"),
    (33, 34, "Trachea, Bronchien und Lunge"),
    (43, 43, "Malignes Melanom der Haut"),
    (50, 50, "Brust"),
    (53, 53, "Gebärmutterhals"),
    (54, 55, "Gebärmutterkörper"),
    (56, 56, "Eierstöcke"),
    (61, 61, "Prostata"),
    (62, 62, "Hoden"),
    (64, 64, "Niere"),
    (67, 67, "Harnblase"),
    (70, 72, "Gehirn und zentrales Nervensystem"),
    (73, 73, "Schilddrüse"),
    (81, 81, "Morbus Hodgkin"),
    (82, 88, "Non-Hodgkin-Lymphome"),
    (90, 90, "Plasmozytom"),
    (91, 95, "Leukämien"),
    (96, 96, "Non-Hodgkin-Lymphome"),
]
ENTITY_LABELS_IN_SITU = {"D05": "Brust", "D06": "Gebärmutterhals"}
ENTITY_LABELS_EXACT = {"D09.0": "Harnblase", "D39.1": "Eierstöcke", "D41.4": "Harnblase"}


def entity_label(code: Column | str) -> Column:
    """German entity name of a diagnosis; its category where none is defined; NULL if malformed."""
    icd = F.upper(F.trim(_col(code)))
    category = F.substring(icd, 1, 3)
    number = F.substring(icd, 2, 2).try_cast("int")
    named = [
        ((F.substring(icd, 1, 1) == "C") & number.between(lo, hi), F.lit(label))
        for lo, hi, label in ENTITY_LABELS
    ]
    named += [(category == k, F.lit(v)) for k, v in ENTITY_LABELS_IN_SITU.items()]
    named += [(icd == k, F.lit(v)) for k, v in ENTITY_LABELS_EXACT.items()]
    return F.when(F.substring(icd, 2, 2).rlike(r"^[0-9]{2}$"), _case(named, category))


def right_closed_bins(value: Column | str, edges: Sequence[float], labels: Sequence) -> Column:
    """Label of the bin ``(edge[i], edge[i+1]]``; NULL outside."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin is needed")
    c = _col(value)
    branches = [
        ((c > F.lit(lo)) & (c <= F.lit(hi)), F.lit(label))
        for lo, hi, label in zip(edges, edges[1:], labels, strict=False)
    ]
    return _case(branches, F.lit(None))


# Edges and names of the age groups.
AGE_GROUP_EDGES = [0, 18, 30, 45, 60, 75, 90, 120]
AGE_GROUP_LABELS = ["0-18", "18-30", "30-45", "45-60", "60-75", "75-90", "90+"]


def age_group(age: Column | str) -> Column:
    return right_closed_bins(age, AGE_GROUP_EDGES, AGE_GROUP_LABELS)


def age_class(age: Column | str) -> Column:
    """Five-year class, named by its lower edge; everything above 100 in one class."""
    edges = [*range(0, 101, 5), 150]
    return right_closed_bins(age, edges, edges[:-1])


# Codes of each leukaemia bin; everything else belongs to the default.
LEUKAEMIA_BINS = {
    "C93.1": ["C93.1", "C93.10", "C93.11"],
    "C92.3": ["C92.3", "C92.30", "C92.31"],
    "C92.4": ["C92.4", "C92.40", "C92.41"],
}
LEUKAEMIA_DEFAULT = "C92.0"


def leukaemia_bin(code: Column | str) -> Column:
    c = _col(code)
    return _case(
        [(c.isin(codes), F.lit(name)) for name, codes in LEUKAEMIA_BINS.items()],
        F.lit(LEUKAEMIA_DEFAULT),
    )


# LOINC codes of each laboratory panel.
LAB_PANELS = {
    "leukocytes": ["26464-8", "6690-2", "806-0", "24122-4", "53964-3"],
    "platelets": ["777-3", "26515-7", "32623-1"],
    "hemoglobin": ["718-7", "20509-6", "30352-9", "30350-3"],
    "blasts": ["709-6", "30376-8", "26446-5", "21114-4", "708-8", "44017-2"],
    "macroblasts": ["51629-4"],
    "normoblasts": ["33990-3", "715-3"],
    "pronormoblasts": ["26033-1"],
    "myeloblasts": ["11113-8"],
    "cells in bone marrow": ["38257-2"],
    "abnormal lymphocytes/Leukocytes in blood": ["30413-9", "735-1", "29261-5"],
}


def lab_panel(loinc: Column | str) -> Column:
    return lookup({code: panel for panel, codes in LAB_PANELS.items() for code in codes}, loinc)


def normalise_set_string(text: Column | str, sep: str = "|", empty: str = "NON") -> Column:
    """Split, trim, drop blanks, dedupe, sort, rejoin; nothing left gives ``empty``."""
    parts = F.split(F.coalesce(_col(text), F.lit("")), "\\Q" + sep + "\\E")
    clean = F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")
    joined = F.array_join(F.array_sort(F.array_distinct(clean)), sep)
    return F.when(joined == "", F.lit(empty)).otherwise(joined)


def map_code_list(text: Column | str, mapping: Column, sep: str = "|") -> Column:
    """Replace each code of a joined list by its mapped value; unknown codes vanish."""
    parts = F.split(_col(text), "\\Q" + sep + "\\E")
    return F.concat_ws(sep, F.transform(parts, lambda x: F.try_element_at(mapping, F.trim(x))))
