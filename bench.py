"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from pitchvault.operators.elo import elo_history
from pitchvault.plans import registry
from pitchvault.session import local_session
from pitchvault.sources.tables import export_mart, scratch

HEADLINE = [
    "mart_match_facts", "mart_team_xg_trend", "mart_league_table", "mart_top_scorers",
    "mart_player_overperformers", "mart_team_elo_history", "mart_team_elo_current",
    "stg_match_same_as", "sat_match_xg", "sat_event_first_load", "sat_event_increment",
    "hub_party_two_sources", "link_part_supplier_role", "upsert_customer_order",
    "lookup_supplier_of_part", "hash_keys_lineitem", "row_number_split", "percent_rank_split",
    "driver_checks", "dash_upsets",
]


LONG = 4.0  # seconds from which one warm run must do


def timed(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def measured(run) -> float:
    """Median of three runs after a warm one; a run of over ``LONG`` seconds counts as it is."""
    first = run()
    if first > LONG:
        return run()
    return statistics.median(run() for _ in range(3))


def elo_fold(spark, sf_dir: str) -> tuple[float, int]:
    """The fold alone, over written match facts: what the published figure times."""
    path = scratch(spark, "bench-facts")
    matches = export_mart(registry.QUERIES["mart_match_facts"](spark, sf_dir), path)
    return measured(lambda: timed(elo_history(spark.read.parquet(path)))), matches


def main() -> None:
    sf_dir = Path(os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    timed(registry.QUERIES["latest_event_per_type"](spark, str(sf_dir)))
    timed(registry.QUERIES["mart_match_facts"](spark, str(sf_dir)))

    def query(name: str) -> float:
        start = time.perf_counter()
        timed(registry.QUERIES[name](spark, str(sf_dir)))
        return time.perf_counter() - start

    seconds = {name: round(measured(lambda n=name: query(n)), 3) for name in HEADLINE}
    folds = {}
    for d in sorted({*sf_dir.parent.glob("sf*"), sf_dir}):
        if d == sf_dir or d.name in ("sf0.001", "sf0.01"):
            took, matches = elo_fold(spark, str(d))
            folds[d.name] = {"sec": round(took, 3), "matches": matches}
    seconds["elo_fold"] = folds[sf_dir.name]["sec"]

    print(json.dumps({
        "metric": "headline queries, total wall-clock",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.name.removeprefix("sf"), "elo_folds": folds,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
