"""Classes of visits, from header values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Browser markers, more specific ones first.
BROWSERS = (("Edg/", "Edge"), ("OPR/", "Opera"), ("Chrome/", "Chrome"), ("Firefox/", "Firefox"))


def browser_family(agent: Column) -> Column:
    agent = F.coalesce(agent, F.lit(""))
    out = F.when(agent.contains("Safari/") & agent.contains("Version/"), "Safari").otherwise("Other")
    for marker, family in reversed(BROWSERS):
        out = F.when(agent.contains(marker), family).otherwise(out)
    return out


def device_family(agent: Column) -> Column:
    agent = F.coalesce(agent, F.lit(""))
    return F.when(agent.rlike("Mobi|Android|iPhone|iPod|iPad|Tablet"), "mobile").when(agent == "", "other").otherwise("desktop")


def primary_language(header: Column) -> Column:
    first = F.split_part(F.trim(F.split_part(F.coalesce(header, F.lit("")), F.lit(","), F.lit(1))), F.lit("-"), F.lit(1))
    language = F.lower(F.split_part(first, F.lit(";"), F.lit(1)))
    return F.when(language == "", "unknown").otherwise(language)


def referrer_host(url: Column) -> Column:
    host = F.try_parse_url(url, F.lit("HOST"))
    return F.when(host.isNull() | (host == ""), "direct").otherwise(F.lower(host))
