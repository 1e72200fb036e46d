"""The football models as plain SQL over the driver tables, for checking results.

``CTES`` holds one SELECT per model; ``with_models`` puts the ones a query needs, and the
ones those need, in front of it.
"""

from __future__ import annotations

import re


def md5_of(*parts: str, source: str | None = None) -> str:
    tokens = [f"coalesce(CAST({p} AS VARCHAR), '^^')" for p in parts]
    if source is not None:
        tokens.insert(0, f"'{source}'")
    return "md5(" + " || '||' || ".join(tokens) + ")"


def md5_keys(*keys: str) -> str:
    return "md5(" + " || '||' || ".join(keys) + ")"


def doubles(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


def hub_sql(sources: list[str], key: str, *bks: str) -> str:
    cols = ", ".join([key, *bks, "ldts", "rsrc"])
    union = " UNION ALL ".join(f"SELECT {cols} FROM {s}" for s in sources)
    order = ", ".join(["ldts", "rsrc", *bks])
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
            f"FROM ({union})) WHERE rn = 1")


def sat_sql(source: str, key: str, hashdiff: str, payload: str, context: str = "") -> str:
    ident = ", ".join(filter(None, [key, context]))
    return (f"SELECT {key}, {hashdiff}, {payload}, ldts, rsrc FROM (SELECT DISTINCT ON ({ident}, ldts, {hashdiff}) * "
            f"FROM {source} ORDER BY {ident}, ldts, {hashdiff}, {payload}) "
            f"QUALIFY lag({hashdiff}) OVER (PARTITION BY {ident} ORDER BY ldts, {hashdiff}) IS DISTINCT FROM {hashdiff}")


def newest_sql(source: str, keys: str, hashdiff: str) -> str:
    return (f"SELECT * FROM {source} QUALIFY row_number() OVER "
            f"(PARTITION BY {keys} ORDER BY ldts DESC, {hashdiff} DESC) = 1")


MATCH_XG = ("home_xg, away_xg, home_goals, away_goals, home_team_title, away_team_title, "
            "match_datetime, league_id, season_year")
PLAYER_XG = ("xg, xa, npxg, npg, xg_chain, xg_buildup, goals, assists, shots, key_passes, games, minutes, "
             "position, player_name, team_title, league_id, season_year")
TEAM_XG = ("xg_for, npxg_for, xg_against, npxg_against, npxg_diff, ppda, oppda, deep_completions, "
           "opp_deep_completions, xpts, matches, wins, draws, losses, points, goals_for, goals_against, "
           "league_id, season_year")
SEASON = "league_id, season_year"

# Forms of a name: as it is, and with one club prefix off. Two names agree if one of them,
# as it is, is a form of the other.
STRIP = "regexp_replace({0}, '^(afc |fc |cf |ac |as )', '')"


def agree(left: str, right: str) -> str:
    forms = [f"[{x}, {STRIP.format(x)}]" for x in (left, right)]
    return f"(list_contains({forms[0]}, {right}) OR list_contains({forms[1]}, {left}))"


CTES = {
    "places": """
        SELECT c_custkey, c_name, c_mktsegment, c_nationkey, n_name AS c_nation, r_name, lower(r_name) AS league_id
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "first_line": """
        SELECT * FROM lineitem QUALIFY row_number() OVER
        (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""",
    "match_frame": """
        SELECT o_orderkey AS match_id, league_id, CAST(year(o_orderdate) AS INTEGER) AS season_year,
          o_orderdate AS match_datetime, c_nation || ' ' || c_custkey // 15 AS home_team_title, n_name || ' ' || s_suppkey AS away_team_title,
          c_custkey // 15 AS home_id, s_suppkey AS away_id,
          CAST(floor(l_quantity) AS INTEGER) % 5 AS home_goals,
          CAST(CAST(floor(l_extendedprice) AS BIGINT) % 4 AS INTEGER) AS away_goals,
          CAST(CAST(round(l_discount * 100) AS INTEGER) * CAST('0.2' AS DECIMAL(2,1)) AS DECIMAL(12,1)) AS home_xg,
          CAST(CAST(round(l_tax * 100) AS INTEGER) * CAST('0.2' AS DECIMAL(2,1)) AS DECIMAL(12,1)) AS away_xg,
          o_orderstatus, o_orderpriority, l_shipdate AS loaded_at
        FROM first_line JOIN orders ON l_orderkey = o_orderkey JOIN places ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        WHERE c_nation <> n_name""",
    "sb_frame": """
        SELECT *, CAST(CAST(loaded_at AS DATE) + 1 AS TIMESTAMP) AS ldts, CAST(match_datetime AS DATE) AS match_date,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'FC ' WHEN '2-HIGH' THEN 'AC FC ' ELSE '' END || home_team_title AS home_team,
          upper(away_team_title) AS away_team,
          CASE WHEN o_orderstatus <> 'O' THEN home_goals END AS home_score,
          CASE WHEN o_orderstatus <> 'O' THEN away_goals END AS away_score,
          CASE o_orderstatus WHEN 'F' THEN 'available' WHEN 'O' THEN 'scheduled' ELSE 'processing' END AS match_status
        FROM match_frame""",
    "player_teams": """
        SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, n_name || ' ' || s_suppkey AS team, count(*) AS games,
          sum(CAST(floor(l_quantity) AS INTEGER)) AS quantity, sum(CAST(floor(l_quantity) AS INTEGER) % 3) AS goals,
          sum(l_linenumber) AS shots, sum(CAST(round(l_discount * 100) AS INTEGER)) AS discount,
          sum(CAST(round(l_tax * 100) AS INTEGER)) AS tax, max(l_shipdate) AS loaded_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""",
    "player_frame": """
        SELECT o_custkey, season, CAST(sum(games) AS INTEGER) AS games, CAST(sum(quantity) AS INTEGER) AS quantity,
          CAST(sum(goals) AS INTEGER) AS goals, CAST(sum(shots) AS INTEGER) AS shots,
          CAST(sum(discount) AS INTEGER) AS discount, CAST(sum(tax) AS INTEGER) AS tax,
          max(loaded_at) AS loaded_at, string_agg(team, ',' ORDER BY team) AS team_title,
          any_value(c_name) AS player_name, any_value(c_mktsegment) AS position, any_value(league_id) AS league_id
        FROM player_teams JOIN places ON o_custkey = c_custkey GROUP BY o_custkey, season""",
    "sides": """
        SELECT league_id, season_year, loaded_at, home_team_title AS team_title, home_goals AS gf, away_goals AS ga,
          home_xg AS xf, away_xg AS xa FROM match_frame
        UNION ALL SELECT league_id, season_year, loaded_at, away_team_title, away_goals, home_goals,
          away_xg, home_xg FROM match_frame""",
    "team_frame": """
        SELECT team_title, league_id, season_year AS season, CAST(count(*) AS INTEGER) AS m,
          CAST(count(*) FILTER (gf > ga) AS INTEGER) AS w, CAST(count(*) FILTER (gf = ga) AS INTEGER) AS d,
          CAST(count(*) FILTER (gf < ga) AS INTEGER) AS l, CAST(sum(gf) AS INTEGER) AS g, CAST(sum(ga) AS INTEGER) AS ga,
          CAST(sum(xf) AS DECIMAL(20,1)) AS xf, CAST(sum(xa) AS DECIMAL(20,1)) AS xa, max(loaded_at) AS loaded_at
        FROM sides GROUP BY team_title, league_id, season_year""",
    "stg_sb_competitions": f"""
        SELECT {md5_of('league_id')} AS hub_competition_hk, league_id, TIMESTAMP '1990-01-01 00:00:00' AS ldts, 'sb' AS rsrc
        FROM (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN lower(r_name)
              WHEN c_mktsegment = 'MACHINERY' AND r_name = 'EUROPE' THEN 'cup' END AS league_id FROM places)
        WHERE league_id IS NOT NULL""",
    "stg_sb_matches": f"""
        SELECT {md5_of('match_id', source='sb')} AS hub_match_hk, {md5_of('lower(trim(league_id))')} AS hub_competition_hk,
          CAST(match_id AS VARCHAR) AS match_id, 'sb|' || match_id AS match_bk, league_id,
          home_score AS home_goals, away_score AS away_goals, home_team, away_team, match_status,
          CAST(match_date AS TIMESTAMP) AS match_ts,
          {md5_of('home_score', 'away_score', 'match_status', "strftime(match_date, '%Y-%m-%d 00:00:00') || '+00'")} AS sat_match_score_hashdiff,
          ldts, 'sb' AS rsrc
        FROM sb_frame""",
    "stg_understat_matches": f"""
        SELECT *, {md5_keys('hub_match_hk', 'hub_competition_hk', 'hub_season_hk')} AS lnk_match_comp_season_hk
        FROM (SELECT {md5_of('match_id', source='understat')} AS hub_match_hk,
          {md5_of('lower(trim(league_id))')} AS hub_competition_hk, {md5_of('season_year')} AS hub_season_hk,
          'understat|' || match_id AS match_bk, season_year, league_id, home_team_title, away_team_title,
          CAST(home_id AS VARCHAR) AS home_understat_team_id, CAST(away_id AS VARCHAR) AS away_understat_team_id,
          home_goals, away_goals, home_xg, away_xg, match_datetime,
          {md5_of('home_xg', 'away_xg', 'home_goals', 'away_goals', 'league_id', 'season_year')} AS sat_match_xg_hashdiff,
          {md5_of('home_goals', 'away_goals', "strftime(match_datetime, '%Y-%m-%d %H:%M:%S')")} AS sat_match_score_understat_hashdiff,
          loaded_at AS ldts, 'understat' AS rsrc FROM match_frame)""",
    "stg_understat_matches_teams": f"""
        SELECT *, {md5_keys('hub_match_hk', 'hub_team_hk', 'team_role')} AS lnk_match_team_hk
        FROM (SELECT {md5_of('match_id', source='understat')} AS hub_match_hk,
            {md5_of('lower(trim(team_title))', source='understat')} AS hub_team_hk, team_role, loaded_at AS ldts, 'understat' AS rsrc
          FROM (SELECT match_id, home_team_title AS team_title, 'home' AS team_role, loaded_at FROM match_frame
                UNION ALL SELECT match_id, away_team_title, 'away', loaded_at FROM match_frame))""",
    "stg_understat_players": f"""
        SELECT {md5_of('o_custkey', source='understat')} AS hub_player_hk, {md5_of('season')} AS hub_season_hk,
          {md5_of('lower(trim(league_id))')} AS hub_competition_hk, 'understat|' || o_custkey AS player_bk,
          season AS season_year, league_id, player_name, team_title, xg, xa, npxg, xg_chain, xg_buildup,
          goals AS npg, goals, games AS assists, shots, quantity AS key_passes, games, quantity * 4 AS minutes, position,
          {md5_of('xg', 'xa', 'npxg', 'xg_chain', 'xg_buildup', 'goals', 'games', 'games', 'quantity * 4', 'league_id', 'season')} AS sat_player_xg_hashdiff,
          loaded_at AS ldts, 'understat' AS rsrc
        FROM (SELECT *, {', '.join(f"CAST({c} * CAST('0.1' AS DECIMAL(2,1)) AS DECIMAL(20,1)) AS {n}" for c, n in (
            ('discount', 'xg'), ('tax', 'xa'), ('discount', 'npxg'), ('shots', 'xg_chain'), ('games', 'xg_buildup')))}
          FROM player_frame)""",
    "stg_understat_player_team": f"""
        SELECT *, {md5_keys('hub_player_hk', 'hub_team_hk', 'hub_season_hk')} AS lnk_player_team_hk
        FROM (SELECT {md5_of('o_custkey', source='understat')} AS hub_player_hk,
            {md5_of('lower(team)', source='understat')} AS hub_team_hk, {md5_of('p.season')} AS hub_season_hk,
            team AS team_title, p.season AS season_year, f.loaded_at AS ldts, 'understat' AS rsrc
          FROM player_teams p JOIN player_frame f USING (o_custkey, season))""",
    "stg_understat_teams": f"""
        SELECT *, {md5_keys('hub_team_hk', 'hub_competition_hk', 'hub_season_hk')} AS lnk_team_comp_season_hk
        FROM (SELECT {md5_of('lower(trim(team_title))', source='understat')} AS hub_team_hk, {md5_of('season')} AS hub_season_hk,
          {md5_of('lower(trim(league_id))')} AS hub_competition_hk, 'understat|' || lower(trim(team_title)) AS team_bk,
          season AS season_year, league_id, team_title, xf AS xg_for, xf AS npxg_for, xa AS xg_against, xa AS npxg_against,
          xf - xa AS npxg_diff, ppda, oppda, g + ga AS deep_completions, abs(g - ga) AS opp_deep_completions, xpts,
          m AS matches, w AS wins, d AS draws, l AS losses, 3 * w + d AS points, g AS goals_for, ga AS goals_against,
          {md5_of('xf', 'xf', 'xa', 'ppda', 'oppda', 'xpts', 'm', 'g', 'ga', 'league_id', 'season')} AS sat_team_xg_hashdiff,
          {md5_of('team_title', 'lower(trim(league_id))')} AS sat_team_details_hashdiff,
          loaded_at AS ldts, 'understat' AS rsrc
        FROM (SELECT *, CAST(m * CAST('0.5' AS DECIMAL(2,1)) AS DECIMAL(20,1)) AS ppda,
          CAST(g * CAST('0.5' AS DECIMAL(2,1)) AS DECIMAL(20,1)) AS oppda,
          CAST(xf * CAST('0.5' AS DECIMAL(2,1)) AS DECIMAL(20,2)) AS xpts FROM team_frame))""",
    "stg_match_same_as": f"""
        SELECT {md5_keys('u.hub_match_hk', 's.hk')} AS lnk_match_same_as_hk, u.hub_match_hk AS hub_match_hk_understat,
          s.hk AS hub_match_hk_sb, greatest(u.ldts, s.ldts) AS ldts, 'derived' AS rsrc
        FROM (SELECT *, lower(trim(home_team_title)) AS h, lower(trim(away_team_title)) AS a FROM stg_understat_matches) u
        JOIN (SELECT league_id, match_date, ldts, {md5_of('match_id', source='sb')} AS hk,
                {STRIP.format('lower(trim(home_team))')} AS h, {STRIP.format('lower(trim(away_team))')} AS a FROM sb_frame) s
        ON CAST(u.match_datetime AS DATE) = s.match_date AND u.league_id = s.league_id
        AND {agree('u.h', 's.h')} AND {agree('u.a', 's.a')}""",
    "hub_team": hub_sql(["stg_understat_teams"], "hub_team_hk", "team_bk"),
    "hub_player": hub_sql(["stg_understat_players"], "hub_player_hk", "player_bk"),
    "hub_match": hub_sql(["stg_sb_matches", "stg_understat_matches"], "hub_match_hk", "match_bk"),
    "hub_competition": hub_sql(
        ["stg_sb_competitions", "stg_understat_teams", "stg_understat_players"], "hub_competition_hk", "league_id"),
    "hub_season": hub_sql(["stg_understat_players", "stg_understat_teams"], "hub_season_hk", "season_year"),
    "lnk_match_team": hub_sql(
        ["stg_understat_matches_teams"], "lnk_match_team_hk", "hub_match_hk", "hub_team_hk", "team_role"),
    "lnk_team_competition_season": hub_sql(
        ["stg_understat_teams"], "lnk_team_comp_season_hk", "hub_team_hk", "hub_competition_hk", "hub_season_hk"),
    "lnk_player_team": hub_sql(
        ["stg_understat_player_team"], "lnk_player_team_hk", "hub_player_hk", "hub_team_hk", "hub_season_hk"),
    "lnk_match_competition_season": hub_sql(
        ["stg_understat_matches"], "lnk_match_comp_season_hk", "hub_match_hk", "hub_competition_hk", "hub_season_hk"),
    "lnk_match_same_as": hub_sql(
        ["stg_match_same_as"], "lnk_match_same_as_hk", "hub_match_hk_understat", "hub_match_hk_sb"),
    "sat_match_score": sat_sql(
        "stg_sb_matches", "hub_match_hk", "sat_match_score_hashdiff", "home_goals, away_goals, match_status, match_ts"),
    "sat_match_score_understat": sat_sql(
        "stg_understat_matches", "hub_match_hk", "sat_match_score_understat_hashdiff",
        "home_goals, away_goals, match_datetime"),
    "sat_match_xg": sat_sql("stg_understat_matches", "hub_match_hk", "sat_match_xg_hashdiff", MATCH_XG),
    "sat_player_xg": sat_sql("stg_understat_players", "hub_player_hk", "sat_player_xg_hashdiff", PLAYER_XG, SEASON),
    "sat_team_details": sat_sql("stg_understat_teams", "hub_team_hk", "sat_team_details_hashdiff", "team_title, league_id"),
    "sat_team_xg": sat_sql("stg_understat_teams", "hub_team_hk", "sat_team_xg_hashdiff", TEAM_XG, SEASON),
    "newest_team_xg": newest_sql("sat_team_xg", f"hub_team_hk, {SEASON}", "sat_team_xg_hashdiff"),
    "newest_details": newest_sql("sat_team_details", "hub_team_hk", "sat_team_details_hashdiff"),
    "newest_player_xg": newest_sql("sat_player_xg", f"hub_player_hk, {SEASON}", "sat_player_xg_hashdiff"),
    "newest_match_xg": newest_sql("sat_match_xg", "hub_match_hk", "sat_match_xg_hashdiff"),
    "pit_team_season": f"""
        SELECT {md5_keys('l.hub_team_hk', 'l.hub_competition_hk', 'l.hub_season_hk')} AS pit_team_season_hk,
          l.hub_team_hk, l.hub_competition_hk, l.hub_season_hk, team_bk, c.league_id, s.season_year, d.team_title,
          x.* EXCLUDE (hub_team_hk, league_id, season_year, sat_team_xg_hashdiff, ldts, rsrc),
          greatest(x.ldts, d.ldts) AS pit_ldts
        FROM lnk_team_competition_season l JOIN hub_competition c USING (hub_competition_hk)
        JOIN hub_season s USING (hub_season_hk) JOIN hub_team t USING (hub_team_hk)
        LEFT JOIN newest_team_xg x ON x.hub_team_hk = l.hub_team_hk AND x.league_id = c.league_id AND x.season_year = s.season_year
        LEFT JOIN newest_details d ON d.hub_team_hk = l.hub_team_hk""",
    "pit_player_season": f"""
        SELECT {md5_keys('x.hub_player_hk', 'c.hub_competition_hk', 's.hub_season_hk')} AS pit_player_season_hk,
          x.hub_player_hk, c.hub_competition_hk, s.hub_season_hk, player_bk, player_name, team_title AS team_title_raw,
          x.league_id, x.season_year, xg, xa, npxg, npg, xg_chain, xg_buildup, goals, assists, shots, key_passes,
          games, minutes, position, x.ldts AS pit_ldts
        FROM newest_player_xg x JOIN hub_player p ON p.hub_player_hk = x.hub_player_hk
        JOIN hub_competition c ON c.league_id = x.league_id JOIN hub_season s ON s.season_year = x.season_year""",
    # A player's season in a league, with each of the player's teams of that season in that league.
    "br_player_team_season": f"""
        SELECT {md5_keys('hub_player_hk', 'hub_team_hk', 'hub_competition_hk', 'hub_season_hk')} AS br_hk,
          hub_player_hk, hub_team_hk, hub_competition_hk, hub_season_hk, q.player_bk, q.player_name,
          t.team_bk, t.team_title, q.league_id, q.season_year
        FROM pit_player_season q JOIN lnk_player_team USING (hub_player_hk, hub_season_hk)
        JOIN pit_team_season t USING (hub_team_hk, hub_competition_hk, hub_season_hk)""",
    "br_team_competition_season": """
        SELECT pit_team_season_hk AS br_hk, hub_team_hk, hub_competition_hk, hub_season_hk, team_bk, league_id,
          season_year, team_title FROM pit_team_season""",
    "mart_league_table": """
        SELECT team_bk, team_title, league_id, season_year, matches AS gp, wins AS w, draws AS d, losses AS l,
          goals_for AS gf, goals_against AS ga, goals_for - goals_against AS gd, points AS pts, xpts, xg_for, xg_against,
          npxg_diff, ppda, oppda, round(points - xpts, 2) AS pts_overperf,
          row_number() OVER (PARTITION BY league_id, season_year ORDER BY points DESC NULLS FIRST,
            goals_for - goals_against DESC NULLS FIRST, goals_for DESC NULLS FIRST, team_bk) AS position
        FROM pit_team_season""",
    # The ratio is rounded in whole numbers: xg is a count of tenths.
    "mart_top_scorers": """
        SELECT player_bk, player_name, coalesce(teams_concat, player_name) AS teams_concat,
          coalesce(teams_count, 1) AS teams_count, league_id, season_year, position, games, minutes, goals, assists,
          shots, key_passes, xg, xa, npxg, npg,
          CASE WHEN xg > 0 THEN (2000 * CAST(goals AS BIGINT) + CAST(xg * 10 AS BIGINT)) // (2 * CAST(xg * 10 AS BIGINT)) / 100.0 END AS goals_per_xg
        FROM pit_player_season LEFT JOIN (
          SELECT hub_player_hk, hub_competition_hk, hub_season_hk, string_agg(team_title, ' → ' ORDER BY team_title) AS teams_concat,
            count(*) AS teams_count FROM br_player_team_season GROUP BY ALL)
        USING (hub_player_hk, hub_competition_hk, hub_season_hk)""",
    "mart_match_facts": """
        SELECT hub_match_hk AS match_hk, match_datetime, CAST(match_datetime AS DATE) AS match_date, league_id,
          season_year, home_team_title, away_team_title, home_goals, away_goals, home_xg, away_xg,
          home_goals - away_goals AS goal_diff, round(home_xg - away_xg, 3) AS xg_diff,
          CASE WHEN home_goals > away_goals THEN 'home' WHEN home_goals < away_goals THEN 'away' ELSE 'draw' END AS result,
          home_goals + away_goals AS total_goals, round(home_xg + away_xg, 3) AS total_xg
        FROM newest_match_xg""",
    "mart_player_overperformers": """
        SELECT hub_player_hk AS player_hk, player_bk, player_name, team_title_raw AS team_title, league_id, season_year,
          position, minutes, games, goals, xg, assists, xa, npxg, npg, round(goals - xg, 3) AS goals_minus_xg,
          round(assists - xa, 3) AS assists_minus_xa,
          round(percent_rank() OVER (PARTITION BY league_id, season_year ORDER BY goals - xg NULLS LAST), 4) AS overperf_pct_rank
        FROM pit_player_season WHERE minutes >= 450""",
    # Means are rounded in whole numbers: the metrics are counts of tenths.
    "mart_team_xg_trend": """
        SELECT league_id, season_year, team_title, count(*) AS matches,
          CAST((200 * CAST(sum(xf) * 10 AS BIGINT) + count(*)) // (2 * count(*)) AS BIGINT) / 1000.0 AS avg_xg_for,
          CAST((200 * CAST(sum(xa) * 10 AS BIGINT) + count(*)) // (2 * count(*)) AS BIGINT) / 1000.0 AS avg_xg_against,
          round(stddev_samp(xf), 3) AS std_xg_for, round(stddev_samp(xa), 3) AS std_xg_against,
          max(xf) AS max_xg_for, max(xa) AS max_xg_against, CAST(sum(gf) AS BIGINT) AS total_gf,
          CAST(sum(ga) AS BIGINT) AS total_ga, sum(gf) - sum(xf) AS gf_minus_xg, sum(ga) - sum(xa) AS ga_minus_xga
        FROM (SELECT league_id, season_year, home_team_title AS team_title, home_xg AS xf, away_xg AS xa,
                home_goals AS gf, away_goals AS ga FROM newest_match_xg
              UNION ALL SELECT league_id, season_year, away_team_title, away_xg, home_xg, away_goals, home_goals FROM newest_match_xg)
        GROUP BY league_id, season_year, team_title""",
    "focus_matches": """
        SELECT CAST(year(match_ts) - CASE WHEN month(match_ts) >= 7 THEN 0 ELSE 1 END AS INTEGER) AS season_year,
          CASE WHEN home_team = 'NATION_18 3' THEN home_goals ELSE away_goals END AS s,
          CASE WHEN home_team = 'NATION_18 3' THEN away_goals ELSE home_goals END AS c
        FROM stg_sb_matches WHERE league_id = 'europe' AND match_status = 'available' AND home_goals IS NOT NULL
          AND away_goals IS NOT NULL AND match_ts IS NOT NULL AND (home_team = 'NATION_18 3' OR away_team = 'NATION_18 3')""",
    "mart_sb_la_liga_history": """
        SELECT season_year, CAST(count(*) AS INTEGER) AS matches_played, CAST(count(*) FILTER (s > c) AS INTEGER) AS wins,
          CAST(count(*) FILTER (s = c) AS INTEGER) AS draws, CAST(count(*) FILTER (s < c) AS INTEGER) AS losses,
          CAST(sum(s) AS INTEGER) AS goals_scored, CAST(sum(c) AS INTEGER) AS goals_conceded,
          CAST((200 * sum(s) + count(*)) // (2 * count(*)) AS BIGINT) / 100.0 AS avg_goals_scored,
          CAST((200 * sum(c) + count(*)) // (2 * count(*)) AS BIGINT) / 100.0 AS avg_goals_conceded
        FROM focus_matches GROUP BY season_year""",
    "elo_matches": """
        SELECT *, row_number() OVER (PARTITION BY league_id ORDER BY match_date, home_team_title, match_hk) AS match_seq
        FROM mart_match_facts WHERE home_goals IS NOT NULL AND away_goals IS NOT NULL""",
    "elo_teams": """
        SELECT league_id, team, row_number() OVER (PARTITION BY league_id ORDER BY team) AS i
        FROM (SELECT DISTINCT league_id, unnest([home_team_title, away_team_title]) AS team FROM elo_matches)""",
    "elo_input": """
        SELECT m.league_id, match_seq, h.i AS h, a.i AS a, home_goals AS gh, away_goals AS ga,
          20.0::DOUBLE * CASE WHEN abs(home_goals - away_goals) >= 2 THEN ln(abs(home_goals - away_goals) + 1) ELSE 1.0::DOUBLE END AS k
        FROM elo_matches m JOIN elo_teams h ON h.league_id = m.league_id AND h.team = home_team_title
        JOIN elo_teams a ON a.league_id = m.league_id AND a.team = away_team_title""",
    # One row per match: ratings of all teams of the league as a list, updated match by match.
    "elo_run": """
        SELECT league_id, CAST(0 AS BIGINT) AS match_seq, 0.0::DOUBLE AS rh, 0.0::DOUBLE AS ra, 0.0::DOUBLE AS nh, 0.0::DOUBLE AS na,
          list_transform(range(count(*)), lambda x: 1500.0::DOUBLE) AS ratings FROM elo_teams GROUP BY league_id
        UNION ALL
        SELECT league_id, match_seq, rh, ra, nh, na,
          list_transform(ratings, lambda x, i: CASE i WHEN h THEN nh WHEN a THEN na ELSE x END)
        FROM (SELECT *, rh + k * (sh - eh) AS nh, ra + k * ((1.0::DOUBLE - sh) - (1.0::DOUBLE - eh)) AS na
          FROM (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + pow(10.0::DOUBLE, (ra - rh - 100.0::DOUBLE) / 400.0::DOUBLE)) AS eh,
              CASE WHEN gh > ga THEN 1.0::DOUBLE WHEN gh < ga THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS sh
            FROM (SELECT i.*, ratings[h] AS rh, ratings[i.a] AS ra, ratings
              FROM elo_run e JOIN elo_input i ON i.league_id = e.league_id AND i.match_seq = e.match_seq + 1)))""",
    "elo_rated": """
        SELECT m.league_id, m.season_year, m.match_date, m.match_seq, home_team_title, away_team_title, home_goals, away_goals,
          rh, ra, nh, na FROM elo_run e JOIN elo_matches m ON m.league_id = e.league_id AND m.match_seq = e.match_seq""",
    "elo_history": """
        SELECT home_team_title AS team_title, league_id, season_year, match_date, match_seq, away_team_title AS opponent_title,
          1 AS is_home, home_goals AS goals_for, away_goals AS goals_against, rh AS rating_before, nh AS rating_after FROM elo_rated
        UNION ALL SELECT away_team_title, league_id, season_year, match_date, match_seq, home_team_title, 0, away_goals,
          home_goals, ra, na FROM elo_rated""",
    "elo_top": """
        SELECT team_title, league_id FROM (SELECT team_title, league_id, arg_max(rating_after, match_seq) AS r,
          min(match_seq * 2 + 1 - is_home) AS seen FROM elo_history GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY league_id ORDER BY r DESC, seen) <= 3""",
    "mart_team_elo_history": """
        SELECT h.* EXCLUDE (match_seq), rating_after - rating_before AS rating_delta,
          CASE WHEN t.team_title IS NULL THEN 0 ELSE 1 END AS is_top3_in_league
        FROM elo_history h LEFT JOIN elo_top t ON t.team_title = h.team_title AND t.league_id = h.league_id""",
    "elo_peak": """
        SELECT team_title, league_id, rating_after AS peak_rating, match_date AS peak_match_date FROM elo_history
        QUALIFY row_number() OVER (PARTITION BY team_title, league_id ORDER BY rating_after DESC, match_seq) = 1""",
    "mart_team_elo_current": """
        SELECT team_title, league_id, arg_max(rating_after, match_seq) AS current_rating, any_value(peak_rating) AS peak_rating,
          any_value(peak_match_date) AS peak_match_date, CAST(count(*) AS INTEGER) AS matches_played, arg_max(match_date, match_seq) AS last_match_date
        FROM elo_history JOIN elo_peak USING (team_title, league_id) GROUP BY team_title, league_id""",
}

_WORD = re.compile(r"\w+")


def _needed(sql: str, found: list[str], inside: str = "") -> None:
    """Add the models ``sql`` names to ``found``, each behind the models it reads itself."""
    for word in dict.fromkeys(_WORD.findall(sql)):
        if word in CTES and word not in found and word != inside:
            _needed(CTES[word], found, word)
            found.append(word)


def with_models(sql: str) -> str:
    """``sql`` with the models it names in front of it, each after those it reads."""
    found: list[str] = []
    _needed(sql, found)
    if not found:
        return sql
    parts = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in found)
    return f"WITH RECURSIVE {parts}\n{sql}"


def model_sql(name: str, decimals: tuple[str, ...] = ()) -> str:
    """All rows of a model, with the named decimal columns as doubles."""
    replace = f" REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in decimals)})" if decimals else ""
    return f"SELECT *{replace} FROM {name}"
