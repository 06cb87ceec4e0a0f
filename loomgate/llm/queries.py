"""Named queries of the corpus operators; none of them can be stated in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomgate.llm import canonical, leakage, mixing, reading

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": canonical.found,
    "p1_unmatched": canonical.unmatched,
    "p6_found": leakage.found,
    "p6_spans": leakage.spans,
    "p6_items": leakage.items_leaked,
    "p7_mix": mixing.mix,
    "p7_shares": mixing.shares,
    "p8_found": reading.found,
    "p8_profile": reading.profile,
}
ORACLES: dict[str, str] = {}
