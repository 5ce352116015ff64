"""Region lookup in comma-separated host lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DOMAIN_URL = r"(?i)^https://[^.]+\.([^.]+)\.es\.amazonaws\.com"


def region_from_hosts(hosts: Column) -> Column:
    """Struct of region and status (``ok``, ``none``, ``too many regions``, ``mismatched regions``).

    The walk is left to right and the first conflict decides: a second domain URL is one even when
    it names the same region, and so is any other URL after a domain URL.
    """
    regions = F.transform(
        F.split(hosts, ",", -1), lambda url: F.regexp_extract(url, DOMAIN_URL, 1)
    )
    first = F.array_position(F.transform(regions, lambda r: r != ""), True)
    after = F.get(regions, first.cast("int"))
    return F.when(
        hosts.isNotNull(),
        F.when(first == 0, _answer(None, "none"))
        .when(after.isNull(), _answer(F.get(regions, first.cast("int") - 1), "ok"))
        .when(after != "", _answer(None, "too many regions"))
        .otherwise(_answer(None, "mismatched regions")),
    )


def _answer(region: Column | None, status: str) -> Column:
    return F.struct(
        (F.lit(None) if region is None else region).cast("string").alias("region"),
        F.lit(status).alias("status"),
    )
