"""End-to-end runs over parquet tables below one root folder.

Every layer reads the written tables of the one before it, so a mart never works its way
back to the raw payload, and a lost run resumes from what is on storage.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchvault.operators.elo import elo_history, ratings_after
from pitchvault.operators.elo_corrections import correct_history
from pitchvault.operators.quality import check_all
from pitchvault.operators.vault import PART
from pitchvault.plans import business_vault as bv
from pitchvault.plans import checks, marts, raw_vault, stage_loads, stage_models
from pitchvault.plans.contracts import CONTRACTS, FIND_BY
from pitchvault.plans.models import Models
from pitchvault.sources.together import together
from pitchvault.sources.tables import (
    append_bucketed, append_parts, bucketed_table, export_laid_out, export_mart, publish_mart, read_table, replace_table,
    scratch,
)

# Endpoint of the first source to its stage table.
STAGE_A = {"matches": "understat_matches", "players": "understat_players", "teams": "understat_teams"}


class Warehouse:
    """Table folders of one warehouse: ``<root>/<layer>/<table>``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, parts: int = 16):
        """``buckets`` of every hub and link, ``parts`` of every satellite: some hundred MB each when full.

        Both are fixed when a table is first written.
        """
        self.spark, self.root, self.buckets, self.parts = spark, root.rstrip("/"), buckets, parts

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def vault(self) -> dict[str, DataFrame]:
        return {name: self.table("raw_vault", name).drop(PART) for name in raw_vault.TABLES}

    def load_stage(
        self, lake: str, dt: str | date, season: int | None = None, mapping=stage_models.LEAGUES,
        leagues=stage_loads.SOURCE_A_LEAGUES, loaded_at: Column | None = None,
    ) -> dict[str, int]:
        """Load one day's snapshots into the stage tables; returns the rows written to each.

        The first source is upserted: of its tables, the partitions (league and season) that
        the day names are rewritten, the others are neither read nor written. The second source
        is replaced; a table is written beside the old one and takes its place when complete.
        """
        endpoints = {name: endpoint for endpoint, name in STAGE_A.items()}
        written = self._each(endpoints, lambda name: stage_loads.upsert_source_a(
            self.spark, lake, endpoints[name], dt, self.path("stage", name), season, leagues, loaded_at))
        tables = {
            "sb_competitions": stage_loads.load_competitions(self.spark, lake, dt, mapping, loaded_at),
            "sb_matches": stage_loads.load_matches_b(self.spark, lake, dt, mapping, loaded_at),
        }
        return written | self._each(tables, lambda name: replace_table(tables[name], self.path("stage", name)))

    def stage(self) -> dict[str, DataFrame]:
        return {name: self.table("stage", name) for name in (*STAGE_A.values(), "sb_competitions", "sb_matches")}

    def load_raw_vault(self, tables: Mapping[str, DataFrame], mapping=stage_models.LEAGUES) -> dict[str, int]:
        """Append what the stage tables add; returns new rows per table.

        Payloads are parsed once: the typed stage models are written, and the tables of the
        vault read those. Hubs and links are kept in buckets of their key, so that a load
        shuffles what is new only; satellites in parts, of which a load reads those it touches.
        """
        typed = stage_models.stage_builders(mapping)
        stage = Models(typed, tables, typed, self.path("typed", "").rstrip("/"))
        return self._each(raw_vault.TABLES, lambda name: self._load_vault(name, stage))

    def _each(self, names: Iterable[str], job: Callable[[str], int]) -> dict[str, int]:
        """One job per table, several at a time."""
        return together(self.spark, {name: functools.partial(job, name) for name in names})

    def _load_vault(self, name: str, stage: Models) -> int:
        path = self.path("raw_vault", name)
        existing = read_table(self.spark, path)
        if name in raw_vault.SATS:
            return append_parts(raw_vault.load(name, stage, existing, parts=self.parts), path, PART)
        if existing is None:
            new = raw_vault.load(name, stage, buckets=self.buckets)
            table = self._bucketed(name, new)
        else:
            table = self._bucketed(name, existing)
            new = raw_vault.load(name, stage, self.spark.table(table), self.buckets)
        return append_bucketed(new, table)

    def _bucketed(self, name: str, like: DataFrame) -> str:
        key = (raw_vault.HUBS.get(name) or raw_vault.LINKS[name]).key
        return bucketed_table(self.spark, self.path("raw_vault", name), like.schema, [key], self.buckets)

    def build_business_vault(self) -> dict[str, int]:
        root = self.path("business_vault", "").rstrip("/")
        return self._built(Models(bv.BUILDERS, self.vault(), checks.BUSINESS_VAULT, root), checks.BUSINESS_VAULT)

    def _built(self, models: Models, names: Iterable[str]) -> dict[str, int]:
        return self._each(names, lambda name: models[name].count())

    def build_marts(
        self, tables: Mapping[str, DataFrame],
        focus_team: str = marts.FOCUS_TEAM, focus_league: str = marts.FOCUS_LEAGUE,
        rate_from: date | None = None, correct: bool = False,
    ) -> dict[str, int]:
        """Rebuild every mart; the ratings read the written match facts and history.

        With ``rate_from``, ratings before that day stay as they are stored, and only the
        matches from it on are rated: the daily run. With ``correct``, the stored history is
        held against the match facts, and what changed scores reach is rated again.
        """
        given = self.vault() | {n: self.table("business_vault", n) for n in checks.BUSINESS_VAULT}
        given["stg_sb_matches"] = stage_models.stg_sb_matches(tables["sb_matches"])
        builders = marts.builders(focus_team, focus_league)
        stored = read_table(self.spark, self.path("marts", "elo_history"))
        if rate_from is not None and stored is not None:
            # A copy: the stored history is replaced by one that reads it.
            before = scratch(self.spark, "elo-before")
            export_mart(stored.filter(F.col("match_date") < F.lit(rate_from)), before)
            builders["elo_history"] = lambda m: _rated_from(m["mart_match_facts"], self.spark.read.parquet(before), rate_from)
        elif correct and stored is not None:
            before = scratch(self.spark, "elo-before")
            export_mart(stored, before)
            builders["elo_history"] = lambda m: correct_history(
                self.spark.read.parquet(before), m["mart_match_facts"])[0].select(*stored.columns)
        root = self.path("marts", "").rstrip("/")
        return self._built(Models(builders, given, builders, root, _export_laid_out), builders)

    def check(self) -> DataFrame:
        """Failures of all checks over the written tables."""
        tables = self.vault()
        tables |= {n: self.table("business_vault", n) for n in checks.BUSINESS_VAULT}
        tables |= {n: self.table("marts", n) for n in checks.MARTS}
        return check_all(checks.ALL, tables)

    def publish(self) -> dict[str, int]:
        """Replace the serving copies, each behind its contract."""
        return self._each(CONTRACTS, lambda name: publish_mart(
            self.spark, self.path("marts", name), self.path("serving", name), CONTRACTS[name], FIND_BY))


def _export_laid_out(name: str, mart: DataFrame, path: str) -> int:
    sort_by = CONTRACTS[name].sort_by if name in CONTRACTS else [c for c in ("league_id", "match_seq") if c in mart.columns]
    return export_laid_out(mart, path, sort_by, FIND_BY)


def _rated_from(facts: DataFrame, before: DataFrame, day: date) -> DataFrame:
    """The stored history before a day, and the ratings of the matches from that day on."""
    later = elo_history(facts.filter(F.col("match_date") >= F.lit(day)), ratings=ratings_after(before))
    return before.unionByName(later.select(*before.columns))
