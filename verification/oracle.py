"""Plain SQL for the same questions, for DuckDB on the generated tables.

The texts follow the meaning of the operations, not the way the Spark side computes them: raw
streams are scanned once per market level, ranks are windows over all rows, territories are
compared with OR.
"""

from __future__ import annotations

import re
from datetime import date, timedelta
from typing import NamedTuple

from verification.inputs import APP, COUNTRIES, REPORT_DAY, SOURCES, SUBSCRIPTION

D = REPORT_DAY


class Source(NamedTuple):
    """A counter: rows with this source, and an empty (True) or filled (False) uri if it matters."""

    column: str
    stream_source: str
    uri_empty: bool | None = None


class Side(NamedTuple):
    """A partner as the SQL sees it, stated apart from the library."""

    name: str
    sources: tuple[Source, ...]
    blocks: tuple[str, ...]
    region_from_postcode: bool
    prefixed_regions_only: bool
    country_rank_change_is_tw_minus_lw: bool

    @property
    def counters(self) -> list[str]:
        return ["streams", *(s.column for s in self.sources)]


# Counters in the order of the base table, blocks in that of the trending tables.
SPOTIFY = Side(
    "Spotify",
    (
        Source("streams_collection", "collection"),
        Source("streams_playlist", "others_playlist", False),
        Source("streams_undeveloped_playlist", "others_playlist", True),
        Source("streams_other", "other"),
        Source("streams_artist", "artist"),
        Source("streams_album", "album"),
        Source("streams_search", "search"),
    ),
    ("collection", "other", "artist", "album", "search", "playlist", "undeveloped_playlist"),
    False, True, False,
)
APPLE = Side(
    "Apple",
    (
        Source("streams_collection", "collection"),
        Source("streams_playlist", "playlist"),
        Source("streams_undeveloped_playlist", "others_playlist"),
        Source("streams_other", "other"),
        Source("streams_album", "album"),
        Source("streams_search", "search"),
        Source("streams_radio", "radio"),
    ),
    ("collection", "other", "radio", "album", "search", "playlist", "undeveloped_playlist"),
    True, False, True,
)
SIDES = {"Spotify": SPOTIFY, "Apple": APPLE}
# Markets whose region codes begin with the market's code.
PREFIXED = "'SE', 'AR', 'AU', 'BE', 'BR', 'DE', 'DK', 'NO', 'ES', 'FI', 'FR', 'GB', 'IT', 'MX', 'NL'"


def trend_columns(side: Side) -> list[str]:
    """Columns of a country trend table, in order."""
    parts = ("tw", "lw", "change", "change_perc")
    keys = [c.strip() for c in ITEM.split(",")]
    totals = ["streams_tw", "streams_lw", "streams_change"]
    blocks = [f"streams_{block}_{part}" for block in side.blocks for part in parts]
    ranks = ["rank_tw", "rank_lw", "rank_change", "rank_adj_score"]
    return keys + totals + blocks + ["collection_perc", "playlist_perc"] + ranks


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _day(day: date) -> str:
    return f"DATE '{day.isoformat()}'"


def dbl(expression: str, name: str | None = None) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) AS {name or expression}"


def big(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


INPUTS = {
    "streams": f"""
        SELECT DATE '2024-01-01' + CAST(
                 date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 28 AS INTEGER
               ) AS part_day,
               'ISRC' || lpad(CAST(l_partkey // 4 AS VARCHAR), 8, '0') AS isrc,
               CASE WHEN k % 97 <> 0 THEN cc END AS user_country_code,
               'Country ' || cc AS user_country_name,
               CASE WHEN cc = 'US' THEN CAST(500 + k % 10 AS VARCHAR) ELSE '' END
                 AS user_dma_number,
               CASE WHEN k % 89 = 0 THEN NULL
                    WHEN cc = 'US' OR k % 13 = 0 THEN ''
                    WHEN k % 11 = 0 THEN 'ZZ-1'
                    ELSE cc || '-' || CAST(k % 4 + 1 AS VARCHAR) END AS user_region_code,
               CASE WHEN cc = 'US' THEN 'DMA ' || CAST(500 + k % 10 AS VARCHAR) ELSE '' END
                 AS user_dma_name,
               lpad(CAST(k % 40 AS VARCHAR), 5, '0') AS user_postal_code,
               {_list(SOURCES)}[(l_linenumber + l_suppkey) % 8 + 1] AS stream_source,
               CASE WHEN l_suppkey % 2 = 0 THEN '' ELSE 'uri:' || CAST(l_suppkey AS VARCHAR) END
                 AS source_uri
        FROM (SELECT *, l_orderkey AS k, {_list(COUNTRIES)}[l_suppkey % 25 + 1] AS cc
              FROM lineitem)""",
    "customers_in": f"""
        SELECT c_custkey AS k, {_list(COUNTRIES)}[c_nationkey + 1] AS cc FROM customer""",
    "parts_in": "SELECT p_partkey AS p, p_name, p_partkey // 4 AS m FROM part",
    "resources": """
        SELECT CASE WHEN m % 50 <> 13 THEN 'ISRC' || lpad(CAST(m AS VARCHAR), 8, '0') END AS isrc,
               m // 5 + CASE WHEN m % 25 = 0 AND p % 4 >= 2 THEN 1 ELSE 0 END AS canopus_id,
               CASE WHEN m % 50 <> 7 THEN p_name END AS formatted_title,
               m + 1000 AS resource_rollup_id
        FROM parts_in""",
    "names": """
        SELECT a AS canopus_id,
               CASE WHEN a % 41 <> 39 THEN 'Artist ' || CAST(a AS VARCHAR)
                 || CASE WHEN a % 37 = 5 AND p % 2 = 1 THEN ' (alias)' ELSE '' END END
                 AS default_name
        FROM (SELECT p, p // 20 AS a FROM parts_in)""",
    "subdivisions": """
        SELECT cc AS iso,
               CASE WHEN k % 41 = 0 THEN '' ELSE lpad(CAST(k % 40 AS VARCHAR), 5, '0') END
                 AS postcode,
               CASE WHEN k % 40 = 5 THEN '' ELSE cc || '-' || CAST(k % 3 + 1 AS VARCHAR) END
                 AS iso2
        FROM customers_in WHERE cc <> 'US'""",
    "zips": """
        SELECT DISTINCT cc AS country_code,
               CASE WHEN k % 40 = 39 THEN '99999' ELSE lpad(CAST(k % 40 AS VARCHAR), 5, '0') END
                 AS zip_code,
               CAST(500 + (k % 40) % 10 AS VARCHAR) AS dma_id,
               'DMA ' || CAST(500 + (k % 40) % 10 AS VARCHAR)
                 || CASE WHEN k % 40 < 10 AND k % 80 >= 40 THEN ' alt' ELSE '' END AS dma_name
        FROM customers_in WHERE cc = 'US'""",
    "release_dates": f"""
        SELECT DISTINCT 'ISRC' || lpad(CAST(m AS VARCHAR), 8, '0') AS isrc,
               {_day(D)} - CAST((m % 200) * 5 AS INTEGER) AS first_stream_date
        FROM parts_in""",
    "images": """
        SELECT 'ISRC' || lpad(CAST(m AS VARCHAR), 8, '0') AS isrc,
               CASE WHEN m % 3 <> 0 THEN 'https://img.example.com/' || CAST(p AS VARCHAR) END
                 AS track_image
        FROM parts_in""",
    "products": """
        SELECT 'ISRC' || lpad(CAST(m AS VARCHAR), 8, '0') AS isrc,
               'LBL' || CAST(m // 100 AS VARCHAR) AS sap_segment_code
        FROM parts_in""",
}

# One row per user, application and subscription, in document order. `app_no` and `sub_no` keep
# the order; flags and territories are flat columns.
_COUNTRY_OF_USER = f"{_list(COUNTRIES)}[k % 25 + 1]"
INPUTS |= {
    "users": """
        SELECT k, 'u' || k AS _id, 'First' || k AS firstname, 'Last' || k AS lastname,
               CASE WHEN k % 17 <> 0 THEN 'user' || k || '@example.com' END AS email,
               k % 7 <> 0 AS active
        FROM customers_in""",
    "applications": f"""
        SELECT k, 1 AS app_no, '{APP}' AS app_name, true AS app_active, k // 15 AS artist_1,
               k // 15 + 7 AS artist_2, k % 23 <> 0 AS has_artists FROM customers_in
        UNION ALL
        SELECT k, 2, 'catalog', true, k // 15, NULL, true FROM customers_in WHERE k % 5 = 0
        UNION ALL
        SELECT k, 3, '{APP}-beta', false, k // 15 + 1, NULL, true
        FROM customers_in WHERE k % 19 = 0""",
    "user_subscriptions": f"""
        SELECT k, 1 AS app_no, 1 AS sub_no, '{SUBSCRIPTION}' AS sub_name,
               k % 2 = 0 AS your_artists, CASE WHEN k % 29 <> 0 THEN k % 3 = 0 END AS your_labels,
               CASE WHEN k % 10 = 0 THEN 'XX' ELSE {_COUNTRY_OF_USER} END AS code_1,
               CASE WHEN k % 10 = 0 THEN 'Global' ELSE 'Country ' || {_COUNTRY_OF_USER} END
                 AS name_1,
               CASE WHEN k % 4 = 0 THEN 'US' END AS code_2,
               CASE WHEN k % 4 = 0 THEN 'Country US, home' END AS name_2,
               k % 2 = 0 OR k % 3 = 0 AS to_spotify, k % 3 <> 0 AS to_apple
        FROM customers_in
        UNION ALL
        SELECT k, app_no, 2, 'weeklyDigest', true, true, NULL, NULL, NULL, NULL, true, true
        FROM applications WHERE app_no < 3
        UNION ALL
        SELECT k, 1, 3, '{SUBSCRIPTION}', false, true, 'NO', 'Country NO', 'DK', 'Country DK',
               true, false FROM customers_in WHERE k % 31 = 0
        UNION ALL
        SELECT k, 3, 1, '{SUBSCRIPTION}', true, true, 'SE', 'Country SE', NULL, NULL, false, true
        FROM customers_in WHERE k % 19 = 0""",
    "chosen": f"""
        SELECT s.*, a.app_active, a.artist_1, a.artist_2, a.has_artists
        FROM user_subscriptions s JOIN applications a ON s.k = a.k AND s.app_no = a.app_no
        WHERE contains(a.app_name, '{APP}') AND s.sub_name = '{SUBSCRIPTION}'
          AND (s.your_artists IS TRUE OR s.your_labels IS TRUE)""",
    "gated": """
        SELECT * FROM users u
        WHERE email IS NOT NULL AND active
          AND EXISTS (SELECT 1 FROM chosen c WHERE c.k = u.k AND c.app_active AND c.has_artists)""",
    "user_territories": """
        SELECT k, app_no, code, name,
               row_number() OVER (PARTITION BY k, app_no ORDER BY sub_no, place) AS pos
        FROM (SELECT k, app_no, sub_no, 1 AS place, code_1 AS code, name_1 AS name FROM chosen
              UNION ALL
              SELECT k, app_no, sub_no, 2, code_2, name_2 FROM chosen WHERE code_2 IS NOT NULL)""",
    "user_partners": """
        SELECT k, app_no, 'Spotify' AS partner FROM chosen WHERE to_spotify
        UNION ALL
        SELECT k, app_no, 'Apple' FROM chosen WHERE to_apple""",
    "user_items": """
        SELECT k, app_no, 'artist' AS category, artist_1 AS artist, CAST(NULL AS VARCHAR) AS label,
               CAST(NULL AS VARCHAR) AS labelname
        FROM chosen WHERE your_artists AND has_artists
        UNION ALL
        SELECT k, app_no, 'artist', artist_2, NULL, NULL
        FROM chosen WHERE your_artists AND has_artists AND artist_2 IS NOT NULL
        UNION ALL
        SELECT k, app_no, 'label', NULL, 'LBL' || (k // 300), 'Label, no. ' || (k // 300)
        FROM chosen WHERE your_labels""",
    "subscriptions": """
        SELECT u._id AS "userId", u.firstname, u.lastname, u.email, i.category, i.artist, i.label,
               i.labelname, t1.code AS "primaryTerritoryCode", t1.name AS "primaryTerritoryName",
               t2.code AS "secondaryTerritoryCode", t2.name AS "secondaryTerritoryName", p.partner
        FROM gated u
        JOIN user_items i ON u.k = i.k
        JOIN user_partners p ON u.k = p.k AND i.app_no = p.app_no
        JOIN user_territories t1 ON u.k = t1.k AND i.app_no = t1.app_no AND t1.pos = 1
        LEFT JOIN user_territories t2 ON u.k = t2.k AND i.app_no = t2.app_no AND t2.pos = 2""",
}

SUB_COLUMNS = (
    '"userId", firstname, lastname, email, category, artist, label, labelname, '
    '"primaryTerritoryCode", "primaryTerritoryName", "secondaryTerritoryCode", '
    '"secondaryTerritoryName", partner'
)


def counts(partner) -> str:
    partner = SIDES[partner.name]
    parts = ["count(*) AS streams"]
    for rule in partner.sources:
        test = f"stream_source = '{rule.stream_source}'"
        if rule.uri_empty is not None:
            test += " AND source_uri " + ("= ''" if rule.uri_empty else "<> ''")
        parts.append(f"count(CASE WHEN {test} THEN 1 END) AS {rule.column}")
    return ", ".join(parts)


def window_filter(day: date) -> str:
    return f"part_day BETWEEN {_day(day - timedelta(13))} AND {_day(day)}"


def week_case(day: date) -> str:
    return (
        f"CASE WHEN part_day BETWEEN {_day(day - timedelta(13))} AND {_day(day - timedelta(7))} "
        f"THEN 'LW' WHEN part_day BETWEEN {_day(day - timedelta(6))} AND {_day(day)} "
        "THEN 'TW' END"
    )


def levels(partner: Side, day: date) -> str:
    """Country and region level, everything, and everything outside the home market."""
    report, where = f"{_day(day)} AS report_date", f"WHERE {window_filter(day)}"
    inner = f"(SELECT *, {week_case(day)} AS week FROM streams {where})"
    aggregates = counts(partner)
    names = ", ".join(partner.counters)
    if partner.region_from_postcode:
        local = f"""
            SELECT {report}, s.user_country_code AS country_code,
                   s.user_country_name AS country_name,
                   concat(ifnull(z.dma_id, ''), ifnull(c.iso2, '')) AS region_dma_code,
                   ifnull(z.dma_name, '') AS dma_name, isrc, week, {names}
            FROM (SELECT user_country_code, user_country_name, user_postal_code, isrc, week,
                         {aggregates}
                  FROM {inner} GROUP BY ALL) s
            LEFT JOIN postcodes c
              ON s.user_country_code = c.iso AND s.user_postal_code = c.postcode
            LEFT JOIN zips z
              ON s.user_country_code = z.country_code AND s.user_postal_code = z.zip_code"""
    else:
        local = f"""
            SELECT {report}, user_country_code AS country_code,
                   user_country_name AS country_name,
                   user_dma_number || user_region_code AS region_dma_code,
                   user_dma_name AS dma_name, isrc, week, {aggregates}
            FROM {inner} GROUP BY ALL"""
    rollups = ""
    for code, name, condition in (
        ("XX", "Global", ""),
        ("EX-US", "Global Ex-U.S.", "WHERE user_country_code <> 'US'"),
    ):
        rollups += f"""
            UNION ALL
            SELECT {report}, '{code}', '{name}', '', '', isrc, week, {aggregates}
            FROM {inner} {condition} GROUP BY isrc, week"""
    return local + rollups


TITLES = """
    SELECT isrc, canopus_id, formatted_title, resource_rollup_id
    FROM (SELECT *, row_number() OVER (PARTITION BY isrc, canopus_id, resource_rollup_id
                                       ORDER BY formatted_title ASC NULLS LAST) AS rn
          FROM resources)
    WHERE rn = 1"""
POSTCODES = """
    SELECT iso, postcode, iso2
    FROM (SELECT *, row_number() OVER (PARTITION BY iso, postcode
                                       ORDER BY iso2 ASC NULLS LAST) AS rn
          FROM subdivisions WHERE postcode <> '' AND iso2 <> '')
    WHERE rn = 1"""


def base(partner: Side, levels_table: str) -> str:
    names = ", ".join(f"t.{c}" for c in partner.counters)
    return f"""
        SELECT t.report_date, n.canopus_id, c.resource_rollup_id, n.default_name AS track_artist,
               c.formatted_title AS track_title, t.country_code, t.country_name,
               t.region_dma_code, t.dma_name, t.isrc, t.week, {names}
        FROM {levels_table} t
        LEFT JOIN titles c ON c.isrc = t.isrc
        LEFT JOIN (SELECT DISTINCT canopus_id, default_name FROM names) n
          ON n.canopus_id = c.canopus_id
        WHERE n.default_name IS NOT NULL AND c.formatted_title IS NOT NULL"""


ITEM = (
    "report_date, isrc, canopus_id, resource_rollup_id, track_artist, track_title, "
    "country_code, country_name"
)


def region_filter(partner) -> str:
    if not SIDES[partner.name].prefixed_regions_only:
        return "region_dma_code <> ''"
    return f"""region_dma_code <> '' AND (
        (country_code IN ({PREFIXED}) AND substr(region_dma_code, 1, 2) = country_code)
        OR (country_code = 'US' AND regexp_matches(region_dma_code, '^[0-9]')))"""


def pivot(partner: Side, base_table: str, regional: bool = False) -> str:
    keys = ITEM + (", region_dma_code, dma_name" if regional else "")
    sums = ", ".join(
        big(f"sum(CASE WHEN week = '{w.upper()}' THEN {c} END)", f"{c}_{w}")
        for c in partner.counters
        for w in ("tw", "lw")
    )
    where = f"WHERE {region_filter(partner)}" if regional else ""
    return f"SELECT {keys}, {sums} FROM {base_table} {where} GROUP BY {keys}"


def ranked(pivot_table: str, regional: bool = False) -> str:
    keys = "report_date, country_code" + (", region_dma_code" if regional else "")
    return f"""
        SELECT *,
               rank() OVER (PARTITION BY {keys} ORDER BY streams_lw DESC NULLS LAST) AS rank_lw,
               rank() OVER (PARTITION BY {keys} ORDER BY streams_tw DESC NULLS LAST) AS rank_tw
        FROM {pivot_table}"""


def diffs(ranked_table: str, cap: int) -> str:
    return f"""
        SELECT *, CAST(sign(move) * asinh(abs(move)) AS DOUBLE) AS transformed_diff
        FROM (SELECT *, CASE WHEN rank_lw <= {cap} THEN rank_lw ELSE {cap} END
                        - CASE WHEN rank_tw <= {cap} THEN rank_tw ELSE {cap} END AS move
              FROM {ranked_table})"""


def scores(diff_table: str, regional: bool = False) -> str:
    keys = "report_date, " + ("country_code, region_dma_code" if regional else "country_name")
    return f"""
        SELECT *, CASE WHEN std <> 0 AND divider <> 0
                       THEN ((transformed_diff - mean) / std) / divider END AS raw_score
        FROM (SELECT *, avg(transformed_diff) OVER (PARTITION BY {keys}) AS mean,
                     stddev_samp(transformed_diff) OVER (PARTITION BY {keys}) AS std,
                     asinh(CAST(least(rank_tw, rank_lw) AS DOUBLE)) AS divider
              FROM {diff_table})"""


GUARDED = (
    "CASE WHEN raw_score > 0 AND (streams_tw < streams_lw OR rank_tw > rank_lw) "
    "THEN 0 ELSE raw_score END"
)


def trends(partner: Side, score_table: str, regional: bool = False, top: int = 2000) -> str:
    region = "region_dma_code, dma_name," if regional else ""
    blocks = ""
    for name in partner.blocks:
        c = f"streams_{name}"
        share = f"CASE WHEN streams_tw - streams_lw <> 0 THEN ({c}_tw - {c}_lw) / (streams_tw - streams_lw) END"
        blocks += f"{c}_tw, {c}_lw, {c}_tw - {c}_lw AS {c}_change, {dbl(share, f'{c}_change_perc')}, "
    change = "rank_lw - rank_tw"
    if partner.country_rank_change_is_tw_minus_lw and not regional:
        change = "rank_tw - rank_lw"
    shares = ", ".join(
        dbl(f"CASE WHEN streams_tw <> 0 THEN streams_{s}_tw / streams_tw END", f"{s}_perc")
        for s in ("collection", "playlist")
    )
    return f"""
        SELECT {ITEM}, {region} streams_tw, streams_lw, streams_tw - streams_lw AS streams_change,
               {blocks} {shares}, rank_tw,
               CASE WHEN streams_lw IS NOT NULL THEN rank_lw END AS rank_lw,
               CASE WHEN streams_lw IS NOT NULL THEN {change} END AS rank_change,
               {GUARDED} AS rank_adj_score
        FROM {score_table} WHERE rank_tw <= {top}"""


def averages(trend_table: str) -> str:
    return f"""SELECT report_date, country_code, avg(rank_adj_score) AS avg_velocity
               FROM {trend_table} WHERE rank_adj_score > 0 GROUP BY report_date, country_code"""


def alert_branch(partner: Side, trend_table: str, label: bool) -> str:
    """One branch; the differing source of the second partner lands in the first one's columns."""
    columns = ", ".join(
        f"b.{own} AS {name}" for own, name in zip(trend_columns(partner), trend_columns(SPOTIFY))
    )
    if label:
        join = f"""JOIN products g ON a.label = g.sap_segment_code
                   JOIN {trend_table} b ON g.isrc = b.isrc"""
    else:
        join = f"JOIN {trend_table} b ON a.artist = b.canopus_id"
    return f"""
        SELECT a.*, {columns}, c.avg_velocity, e.track_image, d.first_stream_date
        FROM subscriptions a {join}
        JOIN ({averages(trend_table)}) c
          ON b.report_date = c.report_date AND b.country_code = c.country_code
        JOIN release_dates d ON b.isrc = d.isrc
        LEFT JOIN (SELECT isrc, max(track_image) AS track_image FROM images GROUP BY isrc) e
          ON b.isrc = e.isrc
        WHERE b.rank_adj_score >= c.avg_velocity AND a.partner = '{partner.name}'
          AND d.first_stream_date >= {_day(D)} - INTERVAL 2 YEAR
          AND d.first_stream_date < {_day(D)} - INTERVAL 14 DAY
          AND (a."primaryTerritoryCode" = b.country_code
               OR (a."secondaryTerritoryCode" IS NOT NULL
                   AND a."secondaryTerritoryCode" = b.country_code))"""


TABLES = dict(INPUTS, titles=TITLES, postcodes=POSTCODES)


def _add_partner(partner: Side, tag: str, day: date, cap: int, top: int) -> None:
    TABLES[f"levels_{tag}"] = levels(partner, day)
    TABLES[f"base_{tag}"] = base(partner, f"levels_{tag}")
    for regional, place in ((False, "countries"), (True, "regions")):
        t = f"{place}_{tag}"
        TABLES[f"pivot_{t}"] = pivot(partner, f"base_{tag}", regional)
        TABLES[f"ranked_{t}"] = ranked(f"pivot_{t}", regional)
        TABLES[f"diffs_{t}"] = diffs(f"ranked_{t}", cap)
        TABLES[f"scores_{t}"] = scores(f"diffs_{t}", regional)
        TABLES[f"trends_{t}"] = trends(partner, f"scores_{t}", regional, top)


for _partner in (SPOTIFY, APPLE):
    _tag = _partner.name.lower()
    _add_partner(_partner, _tag, D, 5000, 2000)
    _add_partner(_partner, f"{_tag}_cut", D, 100, 50)
    for _branch, _label in (("artist", False), ("label", True)):
        TABLES[f"alerts_{_branch}_{_tag}"] = alert_branch(_partner, f"trends_countries_{_tag}", _label)
for _back in (1, 2, 5):
    _add_partner(SPOTIFY, f"spotify_d{_back}", D - timedelta(_back), 5000, 2000)
TABLES["alerts"] = " UNION ALL ".join(
    f"SELECT * FROM alerts_{branch}_{tag}"
    for tag in ("spotify", "apple")
    for branch in ("artist", "label")
)

DIGEST_ORDER = (
    "rank_adj_score DESC NULLS LAST, "
    + ", ".join(
        f"{c} ASC NULLS LAST"
        for c in (
            "isrc", "canopus_id", "resource_rollup_id", "artist", "label", '"userId"',
            "firstname", "lastname", "labelname", "track_artist", "track_title",
            '"primaryTerritoryCode"', '"secondaryTerritoryCode"', '"primaryTerritoryName"',
            '"secondaryTerritoryName"', "first_stream_date",
        )
    )
)
TABLES["distinct_alerts"] = "SELECT DISTINCT * EXCLUDE (category) FROM alerts"
TABLES["top_alerts"] = f"""
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY email, partner, country_code
                                   ORDER BY {DIGEST_ORDER}) AS rn
      FROM distinct_alerts)
    WHERE rn <= 10"""


def query(sql: str, own: dict[str, str] | None = None) -> str:
    """Put the tables that `sql` needs in front of it, in order; `own` adds tables or replaces them."""
    done: list[str] = []
    tables = TABLES | (own or {})

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"(?:FROM|JOIN)\s+([a-z_0-9]+)", text)):
            if name in tables and name not in done:
                visit(tables[name])
                done.append(name)

    visit(sql)
    if not done:
        return sql
    ctes = ", ".join(f"{name} AS ({tables[name]})" for name in done)
    return f"WITH {ctes} {sql}"
