"""Imports every module that registers queries."""

from checks import cohorts, dates, deid, files, ingest, linkage, reports, studies, texts, views  # noqa: F401
