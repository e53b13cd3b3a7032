"""Navigation of nested health-record resources as ordinary Spark expressions.

A scalar column takes the first matching element of a repeated one. Every builder returns NULL for
missing structure, so nothing raises under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first(array: Column | str) -> Column:
    return F.get(_col(array), F.lit(0))


def first_where(array: Column | str, test) -> Column:
    return first(F.filter(_col(array), test))


def resource_key(resource_type: str, id_col: Column | str = "id") -> Column:
    """``Type/id``, the form every reference has."""
    return F.concat(F.lit(resource_type + "/"), _col(id_col))


def reference_key(ref: Column | str) -> Column:
    """``Type/id`` of a reference struct; server address and version are cut off."""
    text = _col(ref).getField("reference")
    found = F.regexp_extract(text, r"([A-Za-z]+/[^/]+)(?:/_history/.*)?$", 1)
    return F.nullif(found, F.lit(""))


def first_reference_key(refs: Column | str) -> Column:
    return reference_key(first(refs))


def coding_field(coding: Column | str, systems: str | Sequence[str], field: str = "code") -> Column:
    """``field`` of the first coding that belongs to one of ``systems``."""
    wanted = [systems] if isinstance(systems, str) else list(systems)
    return first_where(coding, lambda c: c["system"].isin(wanted)).getField(field)


def coding_code(concept: Column | str, system: str, field: str = "code") -> Column:
    return coding_field(_col(concept)["coding"], system, field)


def coding_code_any(concept: Column | str, systems: Sequence[str], field: str = "code") -> Column:
    return coding_field(_col(concept)["coding"], systems, field)


def list_coding_code(concepts: Column | str, system: str, field: str = "code") -> Column:
    """As ``coding_code`` over a list of concepts."""
    return coding_field(F.flatten(F.transform(_col(concepts), lambda k: k["coding"])), system, field)


def first_code(concept: Column | str, field: str = "code") -> Column:
    return first(_col(concept)["coding"]).getField(field)


def has_coding(concept: Column | str, system: str, codes: Iterable[str] | None = None) -> Column:
    wanted = None if codes is None else list(codes)

    def test(c: Column) -> Column:
        same = c["system"] == system
        return same if wanted is None else same & c["code"].isin(wanted)

    return F.coalesce(F.exists(_col(concept)["coding"], test), F.lit(False))


def lacks_code(concept: Column | str, system: str | None = None) -> Column:
    """No coding carries a code (of ``system``); a missing concept lacks one too."""

    def test(c: Column) -> Column:
        there = c["code"].isNotNull()
        return there if system is None else there & (c["system"] == system)

    return ~F.coalesce(F.exists(_col(concept)["coding"], test), F.lit(False))


def extension_value(url: str, variant: str, extensions: Column | str = "extension") -> Column:
    """``value[x]`` of the first extension with this URL, e.g. variant ``valueDateTime``."""
    return first_where(extensions, lambda e: e["url"] == url).getField(variant)


def component_code(system: str, code: str, components: Column | str = "component") -> Column:
    """First code of the value of the component identified by ``code``."""
    match = first_where(
        components,
        lambda k: F.exists(k["code"]["coding"], lambda c: (c["system"] == system) & (c["code"] == code)),
    )
    return first_code(match.getField("valueCodeableConcept"))


def identifier_value(system: str | None = None, identifiers: Column | str = "identifier") -> Column:
    if system is None:
        return first(identifiers).getField("value")
    return first_where(identifiers, lambda i: i["system"] == system).getField("value")


def choice(*alternatives: Column | str) -> Column:
    return F.coalesce(*[_col(a) for a in alternatives])


def profile_is(prefix: str, profiles: Column | str = "meta.profile") -> Column:
    """Any profile URL starts with ``prefix`` (versions follow after ``|``)."""
    return F.coalesce(F.exists(_col(profiles), lambda p: p.startswith(prefix)), F.lit(False))


def profile_exactly(url: str, profiles: Column | str = "meta.profile") -> Column:
    """Any profile equals ``url`` apart from its version."""
    return F.coalesce(
        F.exists(_col(profiles), lambda p: F.substring_index(p, "|", 1) == url), F.lit(False)
    )


def first_profile() -> Column:
    return first("meta.profile")
