"""Hosts and reversed-host keys of urls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinfold.llm.common import ascii_lower


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one or for a null url."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column, separator: str) -> Column:
    """Labels from the last to the first, each followed by ``separator``."""
    labels = F.reverse(F.split(host, r"\."))
    return F.concat(F.array_join(labels, separator), F.lit(separator))
