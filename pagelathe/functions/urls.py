"""Hosts, sites and authors of urls, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host_of(url: Column | str) -> Column:
    """Host of a url in lower case, without user and port; null without one."""
    found = F.regexp_extract(F.col(url) if isinstance(url, str) else url, r"(?i)^\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", F.lower(found))


def site_of(url: Column | str) -> Column:
    """Host without a leading www."""
    return F.regexp_replace(host_of(url), r"^www\.", "")
