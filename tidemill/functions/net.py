"""IPv4 addresses and lookup of address ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ip_number(ip) -> Column:
    """A dotted address as one number: every octet shifts the ones before it by 8 bits."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    return F.aggregate(
        F.split(ip, "[.]"),
        F.lit(0).cast("long"),
        lambda acc, octet: F.shiftleft(acc, 8).bitwiseOR(octet.cast("long")),
    )


def check_rules(rules: DataFrame) -> DataFrame:
    """Pairs of neighbouring rules that overlap; empty if the rule set is sound.

    Sorting runs through the blocked scan, so no single task sees all rules.
    """
    from tidemill.operators.scans import running, scan_max

    return running(rules, [], "start_num", {"reach": scan_max("end_num")}, inclusive=False).filter(
        F.col("start_num") <= F.col("reach")
    )
