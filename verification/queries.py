"""The registered queries: every operator over the whole derived tables, next to its SQL."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upswing import APPLE, SPOTIFY, Partner
from upswing.functions import scalar
from upswing.functions.nested import label_names
from upswing.operators import alerts as A
from upswing.operators import checks, counting, enrichment, trends
from upswing.operators.archive import cohort_archive, write_cohorts
from upswing.operators.fingerprints import (
    changed_groups,
    fingerprints,
    report_days_of,
    whole_build_diff,
)
from upswing.operators.digests import digest_columns, digests, distinct_alerts, messages, top_alerts
from upswing.operators.subscriptions import (
    flatten_subscriptions,
    gated_users,
    matching_applications,
)
from upswing.partners import HOME_MARKET
from upswing.plans.daily import (
    Paths,
    Sources,
    days_between,
    days_listed,
    rebuild,
    rebuild_changed,
    written_days,
)
from upswing.plans.velocity import RANK_CAP, market_rows, trending, velocity_base
from upswing.schemas import SUBSCRIPTIONS, trend_schema
from upswing.sources import documents as docs_io
from upswing.sources import tables as tables_io
from upswing.streaming.outbox import message_counter, message_total, outbox_stream
from verification import inputs, oracle
from verification.inputs import APP, SUBSCRIPTION
from verification.oracle import D, big, dbl

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None, own: dict[str, str] | None = None):
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = oracle.query(sql, own)
        return function

    return add


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six digits, as on the SQL side."""
    return df.select(
        *(
            F.round(f.name, 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema
        )
    )


def tag_of(partner: Partner) -> str:
    return partner.name.lower()


# --- tables derived on the way -----------------------------------------------------------------


def base_of(spark: SparkSession, sf: str, partner: Partner, day: date = D) -> DataFrame:
    return velocity_base(
        inputs.streams(spark, sf), inputs.resources(spark, sf), inputs.names(spark, sf), partner,
        day=day, subdivisions=inputs.subdivisions(spark, sf), zips=inputs.zips(spark, sf),
    )


def trends_of(
    spark: SparkSession, sf: str, partner: Partner, regional: bool = False, day: date = D, **limits
) -> DataFrame:
    base = tables_io.staged(base_of(spark, sf, partner, day), "base")
    return trending(base, partner, regional, **limits)


# Tables that several queries of a run start from, written once per application and input folder.
WRITTEN: dict[tuple, DataFrame] = {}


def written_once(
    spark: SparkSession, sf: str, label: str, make: Callable[[], DataFrame], *key: object
) -> DataFrame:
    place = (spark.sparkContext.applicationId, sf, label, *key)
    if place not in WRITTEN:
        WRITTEN[place] = tables_io.staged(make(), label)
    return WRITTEN[place]


def staged_trends(spark: SparkSession, sf: str, partner: Partner) -> DataFrame:
    return written_once(spark, sf, "trends", lambda: trends_of(spark, sf, partner), partner.name)


def subscriptions_of(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_subscriptions(inputs.user_docs(spark, sf, dealt=True), APP, SUBSCRIPTION)


def staged_subscriptions(spark: SparkSession, sf: str) -> DataFrame:
    return written_once(spark, sf, "subscriptions", lambda: subscriptions_of(spark, sf))


def side_by_side(spark: SparkSession, make: Callable[[Partner], object]) -> dict[str, object]:
    """What `make` gives for each partner. Partners need nothing of each other, so each has a thread that
    submits its jobs, and the cluster is not idle while one of them has few tasks."""
    partners = (SPOTIFY, APPLE)
    with ThreadPoolExecutor(len(partners)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(make), p) for p in partners]
        return {p.name: job.result() for p, job in zip(partners, running)}


def alerts_of(spark: SparkSession, sf: str) -> DataFrame:
    by_partner = side_by_side(spark, lambda partner: staged_trends(spark, sf, partner))
    return A.alerts(
        by_partner, staged_subscriptions(spark, sf), inputs.products(spark, sf),
        inputs.release_dates(spark, sf), inputs.images(spark, sf), D,
    )


def staged_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return written_once(spark, sf, "alerts", lambda: alerts_of(spark, sf))


def with_part_day(df: DataFrame) -> DataFrame:
    return df.withColumn("part_day", F.col("report_date"))


ROUND_SCORE = "* REPLACE (round(rank_adj_score, 6) AS rank_adj_score)"
ROUND_ALERT = (
    "* REPLACE (round(rank_adj_score, 6) AS rank_adj_score, "
    "round(avg_velocity, 6) AS avg_velocity)"
)

# --- scans and counts --------------------------------------------------------------------------


@register("stream_window_scan", f"SELECT * FROM streams WHERE {oracle.window_filter(D)}")
def stream_window_scan(spark, sf):
    return tables_io.stream_window(inputs.streams(spark, sf), D)


@register("day_scan", f"SELECT * FROM streams WHERE part_day = {oracle._day(D)}")
def day_scan(spark, sf):
    return tables_io.on_day(inputs.streams(spark, sf), D)


@register(
    "events_since_day",
    """SELECT event_id, event_type, CAST(ts AS DATE) AS part_day FROM events
       WHERE CAST(ts AS DATE) >= DATE '2024-01-20'""",
)
def events_since_day(spark, sf):
    events = inputs.table(spark, sf, "events").withColumn("part_day", F.col("ts").cast("date"))
    return tables_io.since_day(events, "2024-01-20").select("event_id", "event_type", "part_day")


@register(
    "week_label",
    f"""SELECT part_day, {oracle.week_case(D)} AS week, count(*) AS n_rows
        FROM streams GROUP BY ALL""",
)
def week_label(spark, sf):
    week = scalar.week_label(F.col("part_day"), F.lit(D))
    return (
        inputs.streams(spark, sf)
        .groupBy("part_day", week.alias("week"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _source_counts(partner: Partner) -> None:
    @register(
        f"source_counts_{tag_of(partner)}",
        f"SELECT isrc, part_day, {oracle.counts(partner)} FROM streams GROUP BY isrc, part_day",
    )
    def query(spark, sf):
        return (
            inputs.streams(spark, sf)
            .groupBy("isrc", "part_day")
            .agg(*counting.source_counters(partner))
        )


_source_counts(SPOTIFY)
_source_counts(APPLE)


@register(
    "region_code_concat",
    """SELECT user_dma_number || user_region_code AS region_dma_code, count(*) AS n_rows
       FROM streams GROUP BY ALL""",
)
def region_code_concat(spark, sf):
    code = scalar.field_region_code(F.col("user_dma_number"), F.col("user_region_code"))
    return (
        inputs.streams(spark, sf)
        .groupBy(code.alias("region_dma_code"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _levels(name: str, partner: Partner) -> None:
    @register(name, f"SELECT * FROM levels_{tag_of(partner)}")
    def query(spark, sf):
        counted = counting.count_window(inputs.streams(spark, sf), partner, D)
        return market_rows(
            counted, partner, inputs.subdivisions(spark, sf), inputs.zips(spark, sf)
        )


_levels("geo_rollup_levels", SPOTIFY)
_levels("geo_rollup_levels_apple", APPLE)


@register(
    "abroad_only",
    f"""SELECT user_country_code, count(*) AS n_rows FROM streams
        WHERE user_country_code <> '{HOME_MARKET}' GROUP BY user_country_code""",
)
def abroad_only(spark, sf):
    return (
        inputs.streams(spark, sf)
        .filter(counting.abroad(F.col("user_country_code")))
        .groupBy("user_country_code")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


# --- lookups -----------------------------------------------------------------------------------


@register("title_dedup", "SELECT * FROM titles")
def title_dedup(spark, sf):
    return enrichment.one_title(inputs.resources(spark, sf))


@register("artist_names", "SELECT DISTINCT canopus_id, default_name FROM names")
def artist_names(spark, sf):
    return enrichment.artist_names(inputs.names(spark, sf))


@register("postcode_dedup", "SELECT * FROM postcodes")
def postcode_dedup(spark, sf):
    return enrichment.one_subdivision(inputs.subdivisions(spark, sf))


_ENRICHED = """
    SELECT l.*, c.canopus_id, c.resource_rollup_id, n.default_name AS track_artist,
           c.formatted_title AS track_title
    FROM levels_spotify l
    LEFT JOIN titles c ON c.isrc = l.isrc
    LEFT JOIN (SELECT DISTINCT canopus_id, default_name FROM names) n
      ON n.canopus_id = c.canopus_id"""


@register(
    "postcode_dma_enrich",
    f"""SELECT s.user_country_code AS country_code, s.user_postal_code, s.n_rows,
               concat(ifnull(z.dma_id, ''), ifnull(c.iso2, '')) AS region_dma_code,
               ifnull(z.dma_name, '') AS dma_name
        FROM (SELECT user_country_code, user_postal_code, count(*) AS n_rows
              FROM streams GROUP BY ALL) s
        LEFT JOIN postcodes c
          ON s.user_country_code = c.iso AND s.user_postal_code = c.postcode
        LEFT JOIN zips z
          ON s.user_country_code = z.country_code AND s.user_postal_code = z.zip_code""",
)
def postcode_dma_enrich(spark, sf):
    counted = (
        inputs.streams(spark, sf)
        .groupBy(F.col("user_country_code").alias("country_code"), "user_postal_code")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("postcode", F.col("user_postal_code"))
    )
    located = enrichment.with_postcode_region(
        counted, inputs.subdivisions(spark, sf), inputs.zips(spark, sf)
    )
    return located.withColumnRenamed("postcode", "user_postal_code")


def _spotify_levels(spark, sf):
    return market_rows(counting.count_window(inputs.streams(spark, sf), SPOTIFY, D), SPOTIFY)


@register("metadata_enrich", _ENRICHED)
def metadata_enrich(spark, sf):
    return enrichment.with_metadata(
        _spotify_levels(spark, sf), inputs.resources(spark, sf), inputs.names(spark, sf)
    )


@register(
    "enriched_only",
    f"SELECT * FROM ({_ENRICHED}) WHERE track_artist IS NOT NULL AND track_title IS NOT NULL",
)
def enriched_only(spark, sf):
    return enrichment.with_known_metadata(
        _spotify_levels(spark, sf), inputs.resources(spark, sf), inputs.names(spark, sf)
    )


@register(
    "lookup_duplicates",
    """SELECT country_code, zip_code, count(*) AS n_rows FROM zips
       GROUP BY ALL HAVING count(*) > 1""",
)
def lookup_duplicates(spark, sf):
    return checks.duplicate_keys(inputs.zips(spark, sf), ["country_code", "zip_code"])


def _base(partner: Partner) -> None:
    @register(f"base_{tag_of(partner)}", f"SELECT * FROM base_{tag_of(partner)}")
    def query(spark, sf):
        return base_of(spark, sf, partner)


_base(SPOTIFY)
_base(APPLE)

# --- pivot, ranks, score -----------------------------------------------------------------------

COUNTRY_KEYS, NAME_KEYS = ["report_date", "country_code"], ["report_date", "country_name"]
REGION_KEYS = ["report_date", "country_code", "region_dma_code"]


def _pivoted(spark, sf, counters=None, regional=False):
    base = base_of(spark, sf, SPOTIFY)
    if regional:
        base = trends.regional_rows(base, SPOTIFY)
    return trends.week_pivot(base, counters or SPOTIFY.counters, regional)


@register("week_pivot", "SELECT * FROM pivot_countries_spotify")
def week_pivot(spark, sf):
    return _pivoted(spark, sf)


@register(
    "week_deltas",
    "SELECT *, "
    + ", ".join(f"{c}_tw - {c}_lw AS {c}_change" for c in SPOTIFY.counters)
    + " FROM pivot_countries_spotify",
)
def week_deltas(spark, sf):
    return trends.week_deltas(_pivoted(spark, sf), SPOTIFY.counters)


_SHARE_KEYS = ["isrc", "canopus_id", "resource_rollup_id", "track_artist", "country_code"]


@register(
    "change_share",
    f"SELECT {', '.join(_SHARE_KEYS)}, country_name, "
    + ", ".join(
        dbl(
            f"CASE WHEN streams_tw - streams_lw <> 0 THEN ({r.column}_tw - {r.column}_lw)"
            " / (streams_tw - streams_lw) END",
            f"{r.column}_change_perc",
        )
        for r in SPOTIFY.sources
    )
    + " FROM pivot_countries_spotify",
)
def change_share(spark, sf):
    deltas = trends.week_deltas(_pivoted(spark, sf), SPOTIFY.counters)
    shares = trends.change_shares(deltas, SPOTIFY)
    return rounded(
        shares.select(
            *_SHARE_KEYS, "country_name", *(f"{r.column}_change_perc" for r in SPOTIFY.sources)
        )
    )


@register(
    "share_of_total",
    f"SELECT {', '.join(_SHARE_KEYS)}, country_name, streams_tw, "
    + ", ".join(
        dbl(f"CASE WHEN streams_tw <> 0 THEN streams_{s}_tw / streams_tw END", f"{s}_perc")
        for s in ("collection", "playlist")
    )
    + " FROM pivot_countries_spotify",
)
def share_of_total(spark, sf):
    counters = ["streams", "streams_collection", "streams_playlist"]
    shares = trends.total_shares(_pivoted(spark, sf, counters))
    return rounded(
        shares.select(
            *_SHARE_KEYS, "country_name", "streams_tw", "collection_perc", "playlist_perc"
        )
    )


def _rank(name: str, regional: bool, keys: list[str]) -> None:
    place = "regions" if regional else "countries"
    columns = oracle.ITEM + (", region_dma_code, dma_name" if regional else "")

    @register(
        name,
        f"SELECT {columns}, streams_tw, streams_lw, rank_tw, rank_lw FROM ranked_{place}_spotify",
    )
    def query(spark, sf):
        rows = tables_io.staged(_pivoted(spark, sf, ["streams"], regional), "pivot")
        by_tw = trends.ranked_by(rows, keys, "streams_tw", "rank_tw")
        return trends.ranked_by(by_tw, keys, "streams_lw", "rank_lw")


_rank("rank_country", False, COUNTRY_KEYS)
_rank("rank_region", True, REGION_KEYS)


def _ranked_pairs(spark, sf, regional=False):
    rows = _pivoted(spark, sf, ["streams"], regional)
    if regional:
        return trends.ranked_pairs(rows, REGION_KEYS, REGION_KEYS)
    return trends.ranked_pairs(rows, COUNTRY_KEYS, NAME_KEYS)


@register(
    "rank_diff_transform",
    f"""SELECT country_code, country_name, streams_tw, streams_lw, rank_tw, rank_lw,
               count(*) AS n, {dbl("transformed_diff")}
        FROM diffs_countries_spotify_cut GROUP BY ALL""",
)
def rank_diff_transform(spark, sf):
    return rounded(
        trends.with_rank_difference(_ranked_pairs(spark, sf), rank_cap=100).drop("report_date")
    )


@register(
    "rank_diff_default_cap",
    f"""SELECT country_code, country_name, streams_tw, streams_lw, rank_tw, rank_lw,
               count(*) AS n, {dbl("transformed_diff")}
        FROM diffs_countries_spotify GROUP BY ALL""",
)
def rank_diff_default_cap(spark, sf):
    return rounded(
        trends.with_rank_difference(_ranked_pairs(spark, sf), RANK_CAP).drop("report_date")
    )


def _stats(name: str, regional: bool, keys: list[str]) -> None:
    place = "regions" if regional else "countries"

    @register(
        name,
        f"""SELECT {", ".join(keys)}, {dbl("avg(transformed_diff)", "mean_transformed_diff")},
                   {dbl("stddev_samp(transformed_diff)", "std_transformed_diff")}
            FROM diffs_{place}_spotify GROUP BY {", ".join(keys)}""",
    )
    def query(spark, sf):
        ranked = tables_io.staged(_ranked_pairs(spark, sf, regional), "ranked")
        moved = trends.with_rank_difference(ranked, rank_cap=5000)
        return rounded(trends.difference_stats(moved, keys))


_stats("group_mean_std", False, NAME_KEYS)
_stats("group_mean_std_region", True, REGION_KEYS)

_SCORE_KEYS = "country_code, country_name, streams_tw, streams_lw, rank_tw, rank_lw"


def _scored(spark, sf):
    return trends.scored_pairs(
        _pivoted(spark, sf, ["streams"]), COUNTRY_KEYS, NAME_KEYS, rank_cap=5000
    )


@register(
    "velocity_score",
    f"""SELECT {_SCORE_KEYS}, count(*) AS n, {dbl("raw_score")}
        FROM scores_countries_spotify GROUP BY ALL""",
)
def velocity_score(spark, sf):
    keys = [c.strip() for c in _SCORE_KEYS.split(",")]
    return rounded(_scored(spark, sf).select(*keys, "n", "raw_score"))


@register(
    "momentum_guard",
    f"""SELECT {_SCORE_KEYS.replace(", rank_lw", "")}, count(*) AS n,
               CASE WHEN streams_lw IS NOT NULL THEN rank_lw END AS rank_lw,
               CASE WHEN streams_lw IS NOT NULL THEN rank_lw - rank_tw END AS rank_change,
               {dbl(oracle.GUARDED, "rank_adj_score")}
        FROM scores_countries_spotify GROUP BY ALL""",
)
def momentum_guard(spark, sf):
    guarded = trends.guarded_scores(_scored(spark, sf), rank_change_is_tw_minus_lw=False)
    columns = [c.strip() for c in _SCORE_KEYS.split(",")]
    return rounded(guarded.select(*columns, "n", "rank_change", "rank_adj_score"))


def _regions(name: str, partner: Partner) -> None:
    tag = tag_of(partner)

    @register(
        name,
        f"""SELECT country_code, region_dma_code, {big("sum(streams)", "streams")}
            FROM levels_{tag} WHERE {oracle.region_filter(partner)} GROUP BY ALL""",
    )
    def query(spark, sf):
        counted = counting.count_window(inputs.streams(spark, sf), partner, D)
        rows = market_rows(
            counted, partner, inputs.subdivisions(spark, sf), inputs.zips(spark, sf)
        )
        return (
            trends.regional_rows(rows, partner)
            .groupBy("country_code", "region_dma_code")
            .agg(F.sum("streams").alias("streams"))
        )


_regions("region_whitelist", SPOTIFY)
_regions("region_not_empty", APPLE)


def _trending(partner: Partner, regional: bool, cut: bool) -> None:
    place = "regions" if regional else "countries"
    tag = tag_of(partner) + ("_cut" if cut else "")
    limits = {"rank_cap": 100, "top_n": 50} if cut else {}

    @register(f"trending_{place}_{tag}", f"SELECT {ROUND_SCORE} FROM trends_{place}_{tag}")
    def query(spark, sf):
        return rounded(trends_of(spark, sf, partner, regional, **limits))


for _partner in (SPOTIFY, APPLE):
    for _regional in (False, True):
        for _cut in (False, True):
            _trending(_partner, _regional, _cut)

_ORDER_TRACKS = {
    "streams": oracle.INPUTS["streams"].replace("l_partkey // 4", "k"),
    "resources": """
        SELECT DISTINCT 'ISRC' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS isrc,
               l_orderkey AS canopus_id, 'Track ' || l_orderkey AS formatted_title,
               l_orderkey + 1000 AS resource_rollup_id FROM lineitem""",
    "names": """
        SELECT DISTINCT l_orderkey AS canopus_id, 'Artist ' || l_orderkey AS default_name
        FROM lineitem""",
}


@register("trending_many_items", f"SELECT {ROUND_SCORE} FROM trends_countries_spotify", _ORDER_TRACKS)
def trending_many_items(spark, sf):
    """Markets with more items than the default rank cap and cut."""
    base = velocity_base(
        inputs.streams(spark, sf, item="l_orderkey"), inputs.order_resources(spark, sf),
        inputs.order_names(spark, sf), SPOTIFY, day=D,
    )
    return rounded(trending(tables_io.staged(base, "base"), SPOTIFY))


# --- subscribers -------------------------------------------------------------------------------


@register("user_gate", 'SELECT _id AS "userId", email FROM gated')
def user_gate(spark, sf):
    passed = gated_users(inputs.user_docs(spark, sf), APP, SUBSCRIPTION)
    return passed.select(F.col("_id").alias("userId"), "email")


def _chosen(spark, sf):
    return matching_applications(inputs.user_docs(spark, sf), APP, SUBSCRIPTION)


@register(
    "territories",
    """SELECT u._id AS "userId", t.pos, t.code, t.name
       FROM users u JOIN user_territories t ON u.k = t.k""",
)
def territories_query(spark, sf):
    listed = _chosen(spark, sf).select("userId", F.posexplode("territories"))
    return listed.select(
        "userId", (F.col("pos") + 1).cast("bigint").alias("pos"),
        F.col("col.id").alias("code"), F.col("col.name").alias("name"),
    )


@register(
    "enabled_partners",
    'SELECT u._id AS "userId", p.partner FROM users u JOIN user_partners p ON u.k = p.k',
)
def enabled_partners_query(spark, sf):
    return _chosen(spark, sf).select("userId", F.explode("partners").alias("partner"))


@register(
    "followed_items",
    """SELECT u._id AS "userId", i.category, i.artist, i.label, i.labelname
       FROM users u JOIN user_items i ON u.k = i.k""",
)
def followed_items_query(spark, sf):
    return _chosen(spark, sf).select("userId", F.inline("items"))


@register(
    "label_names",
    """SELECT 'u' || k AS "userId", 'Label, no. ' || (k // 300) AS label_name
       FROM applications""",
)
def label_names_query(spark, sf):
    applications = inputs.user_docs(spark, sf).select(
        F.col("_id").alias("userId"), F.explode("applications").alias("a")
    )
    return applications.select(
        "userId", F.explode(label_names(F.col("a"))).alias("label_name")
    )


@register("flatten_subscriptions", f"SELECT {oracle.SUB_COLUMNS} FROM subscriptions")
def flatten_subscriptions_query(spark, sf):
    return subscriptions_of(spark, sf)


@register("document_scan", f"SELECT {oracle.SUB_COLUMNS} FROM subscriptions")
def document_scan(spark, sf):
    """Documents written as NDJSON, read back under the declared schema and flattened."""
    path = tables_io.work_path(spark, "user-docs")
    docs_io.export_json(inputs.user_docs(spark, sf), path)
    return flatten_subscriptions(docs_io.read_user_docs(spark, path), APP, SUBSCRIPTION)


def _damaged_docs(spark, sf) -> str:
    """The documents as lines, of which some are cut off, have a number for a list, have no `_id`, or
    are a text instead of an object."""
    docs = inputs.user_docs(spark, sf)
    number = F.regexp_extract("_id", "[0-9]+", 0).cast("long")
    line = F.to_json(F.struct(*docs.columns))
    wrong = F.to_json(F.struct("_id", "email", F.lit(7).alias("applications")))
    nameless = F.to_json(F.struct(F.col("_id").alias("id"), "email"))
    value = (
        F.when(number % 13 == 0, F.substring(line, 1, 40))
        .when(number % 13 == 1, wrong)
        .when(number % 13 == 2, nameless)
        .when(number % 13 == 3, F.concat(F.lit('"'), F.col("_id"), F.lit('"')))
        .otherwise(line)
    )
    path = tables_io.work_path(spark, "damaged-docs")
    docs.select(value.alias("value")).write.text(path)
    return path


@register(
    "document_good_rows",
    f"""SELECT {oracle.SUB_COLUMNS} FROM subscriptions
        WHERE CAST(substr("userId", 2) AS BIGINT) % 13 > 3""",
)
def document_good_rows(spark, sf):
    docs = docs_io.read_user_docs(spark, _damaged_docs(spark, sf))
    return flatten_subscriptions(docs, APP, SUBSCRIPTION)


@register(
    "document_quarantine",
    """SELECT k AS user_number, CASE k % 13 WHEN 1 THEN 'a field has another type than declared'
              WHEN 2 THEN 'no _id' ELSE 'not a JSON object' END AS reason
       FROM users WHERE k % 13 <= 3""",
)
def document_quarantine(spark, sf):
    broken = docs_io.broken_user_docs(spark, _damaged_docs(spark, sf))
    number = F.regexp_extract("record", '"u([0-9]+)"', 1).cast("long")
    return broken.select(number.alias("user_number"), "reason")


# --- alerts ------------------------------------------------------------------------------------


@register(
    "avg_velocity",
    f"""SELECT report_date, country_code, {dbl("avg_velocity")}
        FROM ({oracle.averages("trends_countries_spotify")})""",
)
def avg_velocity(spark, sf):
    return rounded(A.average_velocity(trends_of(spark, sf, SPOTIFY)))


@register(
    "above_average",
    f"""SELECT {ROUND_ALERT}
        FROM (SELECT b.*, c.avg_velocity FROM trends_countries_spotify b
              JOIN ({oracle.averages("trends_countries_spotify")}) c
                ON b.report_date = c.report_date AND b.country_code = c.country_code
              WHERE b.rank_adj_score >= c.avg_velocity)""",
)
def above_average(spark, sf):
    return rounded(A.above_average(staged_trends(spark, sf, SPOTIFY)))


@register(
    "track_image_pick", "SELECT isrc, max(track_image) AS track_image FROM images GROUP BY isrc"
)
def track_image_pick(spark, sf):
    return A.one_image(inputs.images(spark, sf))


@register(
    "release_age_filter",
    f"""SELECT * FROM release_dates
        WHERE first_stream_date >= {oracle._day(D)} - INTERVAL 2 YEAR
          AND first_stream_date < {oracle._day(D)} - INTERVAL 14 DAY""",
)
def release_age_filter(spark, sf):
    return inputs.release_dates(spark, sf).filter(
        scalar.released_in_window(F.col("first_stream_date"), D)
    )


@register(
    "territory_match",
    """SELECT s."userId", s.category, s.artist, s.label, s.partner, m.cc AS country_code
       FROM subscriptions s JOIN (SELECT DISTINCT cc FROM customers_in) m
         ON s."primaryTerritoryCode" = m.cc
            OR (s."secondaryTerritoryCode" IS NOT NULL AND s."secondaryTerritoryCode" = m.cc)""",
)
def territory_match(spark, sf):
    markets = inputs._customers(spark, sf).select("cc").distinct()
    matched = A.by_territory(subscriptions_of(spark, sf)).join(
        markets, F.col("territory") == F.col("cc")
    )
    return matched.select(
        "userId", "category", "artist", "label", "partner", F.col("cc").alias("country_code")
    )


def _branch(partner: Partner, branch: str) -> None:
    name = f"alerts_{branch}_{tag_of(partner)}"

    @register(name, f"SELECT {ROUND_ALERT} FROM {name}")
    def query(spark, sf):
        eligible = A.eligible_trends(
            {partner.name: staged_trends(spark, sf, partner)},
            inputs.release_dates(spark, sf), inputs.images(spark, sf), D,
        )
        subscriptions = subscriptions_of(spark, sf)
        if branch == "artist":
            return rounded(A.artist_alerts(subscriptions, eligible))
        return rounded(A.label_alerts(subscriptions, inputs.products(spark, sf), eligible))


for _partner in (SPOTIFY, APPLE):
    for _name in ("artist", "label"):
        _branch(_partner, _name)


@register("alerts_all", f"SELECT {ROUND_ALERT} FROM alerts")
def alerts_all(spark, sf):
    return rounded(alerts_of(spark, sf))


@register("alerts_distinct", f"SELECT {ROUND_ALERT} FROM distinct_alerts")
def alerts_distinct(spark, sf):
    return rounded(distinct_alerts(staged_alerts(spark, sf)))


@register("digest_top10", f"SELECT {ROUND_ALERT} FROM top_alerts")
def digest_top10(spark, sf):
    return rounded(top_alerts(distinct_alerts(staged_alerts(spark, sf)))).withColumn(
        "rn", F.col("rn").cast("bigint")
    )


_TRACK_FIELDS = [
    c
    for c in digest_columns()
    if c
    not in {
        "userId", "firstname", "lastname", "email", "artist", "label", "primaryTerritoryCode",
        "primaryTerritoryName", "secondaryTerritoryCode", "secondaryTerritoryName", "partner",
        "report_date", "country_code", "country_name",
    }
]
_DIGEST_SQL = f"""
    SELECT report_date, email, partner, country_code, country_name,
           first_value(firstname) OVER w AS firstname, first_value(lastname) OVER w AS lastname,
           rn AS position,
           {", ".join(c for c in _TRACK_FIELDS if c != "track_image")},
           coalesce(track_image, 'No image') AS track_image
    FROM top_alerts
    WINDOW w AS (PARTITION BY email, partner, country_code ORDER BY rn)"""


def _exploded(documents: DataFrame) -> DataFrame:
    tracks = documents.select(
        "report_date", "user.*", "territory.*", "partner",
        F.posexplode("isrcs").alias("pos", "track"),
    )
    return rounded(
        tracks.select(
            "report_date", "email", "partner", "country_code", "country_name", "firstname",
            "lastname", (F.col("pos") + 1).cast("bigint").alias("position"),
            *(F.col(f"track.{c}").alias(c) for c in _TRACK_FIELDS),
        )
    )


@register("digest_documents", f"SELECT {ROUND_ALERT} FROM ({_DIGEST_SQL})")
def digest_documents(spark, sf):
    return _exploded(digests(staged_alerts(spark, sf)))


_MESSAGE_SQL = """
    SELECT email, 'Velocity Alerts' AS subject, min(firstname) AS firstname,
           min(lastname) AS lastname, partner, country_code, count(*) AS n_tracks,
           string_agg(isrc, ',' ORDER BY rn) AS isrcs,
           round(sum(rank_adj_score), 4) AS total_score
    FROM top_alerts GROUP BY email, partner, country_code"""

_PAYLOAD = """partner STRING, territory STRUCT<country_code: STRING>,
              isrcs ARRAY<STRUCT<isrc: STRING, rank_adj_score: DOUBLE>>"""


def _payload_columns(payload: Column) -> list[Column]:
    tracks = payload["isrcs"]
    total = F.aggregate(tracks, F.lit(0.0), lambda a, t: a + t["rank_adj_score"])
    return [
        payload["partner"].alias("partner"),
        payload["territory"]["country_code"].alias("country_code"),
        F.size(tracks).cast("bigint").alias("n_tracks"),
        F.array_join(F.transform(tracks, lambda t: t["isrc"]), ",").alias("isrcs"),
        F.round(total, 4).alias("total_score"),
    ]


@register("messages", _MESSAGE_SQL)
def messages_query(spark, sf):
    made = messages(digests(staged_alerts(spark, sf)))
    parsed = made.withColumn("payload", F.from_json("value", _PAYLOAD))
    attributes = [
        F.element_at("attributes", a).alias(a)
        for a in ("email", "subject", "firstname", "lastname")
    ]
    return parsed.select(*attributes, *_payload_columns(F.col("payload")))


# --- streaming ---------------------------------------------------------------------------------


def staged_messages(spark: SparkSession, sf: str) -> DataFrame:
    return written_once(spark, sf, "messages", lambda: messages(digests(staged_alerts(spark, sf))))


def _published(spark, sf):
    """All messages in one topic, published by market in two batches."""
    topic = tables_io.work_path(spark, "topic")
    made = staged_messages(spark, sf)
    yield topic
    country = F.get_json_object("value", "$.territory.country_code")
    abroad = F.coalesce(country != HOME_MARKET, F.lit(True))
    for batch in (made.filter(abroad), made.filter(~abroad)):
        docs_io.publish(batch, topic)
        yield topic


SQL_OF_OUTBOX = f"""
    SELECT email AS "to", subject || ' for ' || firstname || ' ' || lastname AS subject,
           partner, country_code, n_tracks, isrcs, total_score
    FROM ({_MESSAGE_SQL})"""


def _mails(spark, out: str) -> DataFrame:
    payload = F.from_json(F.regexp_extract("html", "(?s)^<b>(.*)</b>$", 1), _PAYLOAD)
    return (
        spark.read.parquet(out)
        .withColumn("payload", payload)
        .select("to", "subject", *_payload_columns(F.col("payload")))
    )


@register("outbox", SQL_OF_OUTBOX)
def outbox(spark, sf):
    """Two rounds of publishing and consuming; the second one takes only what is new."""
    steps = _published(spark, sf)
    topic = next(steps)
    out, checkpoint = (tables_io.work_path(spark, n) for n in ("outbox", "outbox-checkpoint"))
    for _ in steps:
        outbox_stream(spark, topic, out, checkpoint).awaitTermination()
    return _mails(spark, out)


@register(
    "delivery_off",
    f"""SELECT email AS "to", partner, country_code FROM ({_MESSAGE_SQL})
        WHERE country_code = '{HOME_MARKET}'""",
)
def delivery_off(spark, sf):
    """Messages published while delivery is off are taken and give no mail, also not later; those
    published after it is on again do."""
    steps = _published(spark, sf)
    topic = next(steps)
    out, checkpoint = (tables_io.work_path(spark, n) for n in ("outbox", "outbox-checkpoint"))
    for deliver, _ in zip((False, True), steps):
        outbox_stream(spark, topic, out, checkpoint, deliver=deliver).awaitTermination()
    payload = F.from_json(F.regexp_extract("html", "(?s)^<b>(.*)</b>$", 1), _PAYLOAD)
    return spark.read.parquet(out).select(
        "to", payload["partner"].alias("partner"),
        payload["territory"]["country_code"].alias("country_code"),
    )


@register("outbox_republished", SQL_OF_OUTBOX)
def outbox_republished(spark, sf):
    """Everything is published twice, the second time after the first was consumed."""
    made = staged_messages(spark, sf)
    topic, out, checkpoint = (
        tables_io.work_path(spark, n) for n in ("topic", "outbox", "outbox-checkpoint")
    )
    for _ in range(2):
        docs_io.publish(made, topic)
        outbox_stream(spark, topic, out, checkpoint).awaitTermination()
    return _mails(spark, out)


@register("message_count", f"SELECT count(*) AS messages FROM ({_MESSAGE_SQL})")
def message_count(spark, sf):
    steps = _published(spark, sf)
    topic = next(steps)
    counts, checkpoint = (tables_io.work_path(spark, n) for n in ("counts", "counts-checkpoint"))
    for _ in steps:
        message_counter(spark, topic, counts, checkpoint).awaitTermination()
    return message_total(spark, counts)


# --- tables, backfill, archive -----------------------------------------------------------------


@register("table_overwrite", f"SELECT {oracle.SUB_COLUMNS} FROM subscriptions")
def table_overwrite(spark, sf):
    """A table loaded twice with different rows; the second load replaces the first."""
    path = tables_io.work_path(spark, "subscriptions")
    whole = subscriptions_of(spark, sf)
    first = whole.withColumn("email", F.upper("email")).unionByName(whole.filter("artist IS NULL"))
    for load in (first, whole):
        tables_io.write_table(load, path, SUBSCRIPTIONS)
    return tables_io.read_table(spark, path, SUBSCRIPTIONS)


@register("ndjson_roundtrip", f"SELECT {ROUND_SCORE} FROM trends_countries_spotify_cut")
def ndjson_roundtrip(spark, sf):
    made = trends_of(spark, sf, SPOTIFY, rank_cap=100, top_n=50)
    path = tables_io.work_path(spark, "export")
    docs_io.export_json(made, path)
    return rounded(spark.read.schema(made.schema).json(path))


def _sources(spark, sf) -> Sources:
    return Sources(
        inputs.streams(spark, sf), inputs.resources(spark, sf), inputs.names(spark, sf),
        inputs.subdivisions(spark, sf), inputs.zips(spark, sf),
    )


def _paths(spark) -> Paths:
    return Paths(*(tables_io.work_path(spark, n) for n in ("base", "countries", "regions")))


@register(
    "partition_overwrite",
    """SELECT part_day, isrc, CASE WHEN part_day = DATE '2024-01-27' THEN 2 ELSE 1 END * count(*)
              AS streams
       FROM streams GROUP BY part_day, isrc""",
)
def partition_overwrite(spark, sf):
    """All days written, then one of them replaced by doubled counts; the others stay."""
    path = tables_io.work_path(spark, "by-day")
    counted = (
        inputs.streams(spark, sf)
        .groupBy("part_day", "isrc")
        .agg(F.count(F.lit(1)).alias("streams"))
    )
    tables_io.write_days(counted, path)
    again = tables_io.on_day(counted, "2024-01-27").withColumn("streams", F.col("streams") * 2)
    tables_io.write_days(again, path, days=[date(2024, 1, 27)])
    return spark.read.parquet(path)


@register(
    "catalog_day_table",
    """SELECT isrc, CASE WHEN part_day = DATE '2024-01-27' THEN 2 ELSE 1 END * count(*) AS streams,
              part_day
       FROM streams WHERE part_day >= DATE '2024-01-26' GROUP BY part_day, isrc""",
)
def catalog_day_table(spark, sf):
    """Two writes of several days and one of a single day, read by the table's name."""
    path, name = tables_io.work_path(spark, "catalog"), f"days_{uuid4().hex}"
    counted = inputs.streams(spark, sf).groupBy("part_day", "isrc").agg(
        F.count(F.lit(1)).alias("streams")
    )
    schema = T.StructType().add("isrc", "string").add("streams", "long").add("part_day", "date")
    tables_io.create_day_table(spark, name, schema, path)
    for first, last, times in (("26", "27", 1), ("28", "31", 1), ("27", "27", 2)):
        part = tables_io.in_days(counted, f"2024-01-{first}", f"2024-01-{last}")
        tables_io.write_days(part.withColumn("streams", F.col("streams") * times), path, table=name)
    return spark.table(name)


@register(
    "catalog_day_swap",
    """SELECT isrc, CASE WHEN part_day = DATE '2024-01-27' THEN 2 ELSE 1 END * count(*) AS streams,
              part_day
       FROM streams WHERE part_day >= DATE '2024-01-24' AND part_day <> DATE '2024-01-25'
       GROUP BY part_day, isrc""",
)
def catalog_day_swap(spark, sf):
    """Days written to build folders and swapped in the catalog: several, one again, one emptied."""
    path, name = tables_io.work_path(spark, "catalog"), f"days_{uuid4().hex}"
    counted = inputs.streams(spark, sf).groupBy("part_day", "isrc").agg(
        F.count(F.lit(1)).alias("streams")
    )
    schema = T.StructType().add("isrc", "string").add("streams", "long").add("part_day", "date")
    tables_io.create_day_table(spark, name, schema, path)
    for first, last, times in (("24", "27", 1), ("28", "31", 1), ("27", "27", 2)):
        part = tables_io.in_days(counted, f"2024-01-{first}", f"2024-01-{last}")
        tables_io.swap_days(part.withColumn("streams", F.col("streams") * times), name, path)
    nothing = counted.filter(F.col("streams") < 0)
    tables_io.swap_days(nothing, name, path, days=[date(2024, 1, 25)])
    return spark.table(name)


def _days_sql(place: str, tags: list[str]) -> str:
    union = " UNION ALL ".join(f"SELECT * FROM trends_{place}_{tag}" for tag in tags)
    return f"SELECT {ROUND_SCORE} FROM ({union}) trends"


@register("backfill_range", _days_sql("countries", ["spotify_d2", "spotify_d1", "spotify"]))
def backfill_range(spark, sf):
    days, paths = days_between(D - timedelta(2), D + timedelta(1)), _paths(spark)
    rebuild(spark, _sources(spark, sf), SPOTIFY, days, paths)
    return rounded(written_days(spark, paths.countries, days).drop("part_day"))


@register("backfill_list", _days_sql("regions", ["spotify_d5", "spotify"]))
def backfill_list(spark, sf):
    """Days named by a query: stream days whose number in the month is 23 or 28."""
    listed = inputs.streams(spark, sf).select(F.col("part_day").alias("partner_load_date"))
    listed = listed.filter(F.dayofmonth("partner_load_date").isin(23, 28)).distinct()
    days, paths = days_listed(listed), _paths(spark)
    rebuild(spark, _sources(spark, sf), SPOTIFY, days, paths)
    return rounded(written_days(spark, paths.regions, days).drop("part_day"))


# A second version of the streams: a day is gone, one has fewer rows, one has rows twice, one has a
# column changed, and one is new; its rows are repeated from another day.
_LATER = """
    SELECT * REPLACE (CASE WHEN part_day = DATE '2024-01-20' AND stream_source = 'album'
                           THEN 'search' ELSE stream_source END AS stream_source)
    FROM all_streams
    WHERE part_day <> DATE '2024-01-02'
      AND NOT (part_day = DATE '2024-01-05' AND isrc LIKE '%7')
    UNION ALL SELECT * FROM all_streams WHERE part_day = DATE '2024-01-12' AND isrc LIKE '%3'
    UNION ALL SELECT * REPLACE (DATE '2024-01-29' AS part_day) FROM all_streams
              WHERE part_day = DATE '2024-01-28'"""
_CHANGED = """
    SELECT part_day, CASE WHEN sum(before) = 0 THEN 'new' WHEN sum(now) = 0 THEN 'gone'
                          ELSE 'changed' END AS change,
           CAST(sum(before) AS BIGINT) AS rows_before, CAST(sum(now) AS BIGINT) AS rows_now
    FROM (SELECT * EXCLUDE (before, now), sum(before) AS before, sum(now) AS now
          FROM (SELECT *, 1 AS before, 0 AS now FROM all_streams
                UNION ALL SELECT *, 0, 1 FROM later_streams) GROUP BY ALL)
    GROUP BY part_day HAVING count(*) FILTER (before <> now) > 0"""
_VERSIONS = {
    "all_streams": oracle.INPUTS["streams"],
    "later_streams": _LATER,
    "changed_streams": _CHANGED,
}


def _later_streams(spark, sf) -> DataFrame:
    streams, day = inputs.streams(spark, sf), F.col("part_day")
    on = lambda text: day == F.lit(date.fromisoformat(text))
    source = F.when(on("2024-01-20") & (F.col("stream_source") == "album"), "search")
    fewer = on("2024-01-05") & F.col("isrc").endswith("7")
    kept = streams.filter(~on("2024-01-02") & ~fewer).withColumn(
        "stream_source", source.otherwise(F.col("stream_source"))
    )
    twice = streams.filter(on("2024-01-12") & F.col("isrc").endswith("3"))
    new = streams.filter(on("2024-01-28")).withColumn("part_day", F.lit(date(2024, 1, 29)))
    return kept.unionByName(twice).unionByName(new)


def _changed_streams(spark, sf) -> DataFrame:
    before, now = (
        fingerprints(streams(spark, sf), ["part_day"])
        for streams in (inputs.streams, _later_streams)
    )
    return changed_groups(before, now, ["part_day"])


@register("changed_days", "SELECT * FROM changed_streams", _VERSIONS)
def changed_days(spark, sf):
    return _changed_streams(spark, sf)


@register(
    "late_report_days",
    """SELECT DISTINCT report_date
       FROM (SELECT part_day + CAST(unnest(range(14)) AS INTEGER) AS report_date FROM changed_streams)
       WHERE report_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-30'""",
    _VERSIONS,
)
def late_report_days(spark, sf):
    return report_days_of(_changed_streams(spark, sf), "2024-01-08", "2024-01-30")


_LATE_DAY = date(2024, 1, 15)


@register("late_rebuild", _days_sql("countries", ["spotify_d2", "spotify_d1", "spotify"]))
def late_rebuild(spark, sf):
    """Three report days built while two thirds of a stream day's rows were missing, and again when they
    have arrived. Only the two report days that look at that day are built a second time."""
    paths, marks = _paths(spark), tables_io.work_path(spark, "marks")
    full, first, last = _sources(spark, sf), D - timedelta(2), D
    late = F.col("part_day") == F.lit(_LATE_DAY)
    early = full.streams.filter(~late | F.col("isrc").rlike("[036]$"))
    for streams in (early, full.streams, full.streams):
        version = Sources(streams, full.resources, full.names, full.subdivisions, full.zips)
        rebuild_changed(spark, version, SPOTIFY, first, last, paths, marks)
    days = days_between(first, last + timedelta(1))
    return rounded(written_days(spark, paths.countries, days).drop("part_day"))


@register(
    "cohort_archive",
    """SELECT s.isrc, part_day,
              CAST(part_day - first_stream_date AS BIGINT) AS days_since_first_stream,
              '1' || lpad(CAST(part_day - first_stream_date AS VARCHAR), 3, '0') || '0101'
                AS partition_code,
              count(*) AS streams
       FROM streams s JOIN release_dates r ON s.isrc = r.isrc
       WHERE part_day - first_stream_date BETWEEN 0 AND 364 GROUP BY ALL""",
)
def cohort_archive_query(spark, sf):
    path = tables_io.work_path(spark, "cohorts")
    write_cohorts(cohort_archive(inputs.streams(spark, sf), inputs.release_dates(spark, sf)), path)
    return spark.read.parquet(path).withColumn(
        "days_since_first_stream", F.col("days_since_first_stream").cast("bigint")
    )


# --- checks ------------------------------------------------------------------------------------


def _event_days(spark, sf) -> DataFrame:
    return inputs.table(spark, sf, "events").withColumn("part_day", F.col("ts").cast("date"))


@register(
    "readiness",
    """SELECT 'streams' AS name, DATE '2024-01-28' AS part_day, count(*) AS n_rows,
              count(*) > 100 AS ready
       FROM streams WHERE part_day = DATE '2024-01-28'
       UNION ALL
       SELECT 'events', DATE '2024-01-28', count(*), count(*) > 100
       FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-28'""",
)
def readiness(spark, sf):
    tables = {"streams": inputs.streams(spark, sf), "events": _event_days(spark, sf)}
    return checks.readiness(tables, D, more_than=100)


@register(
    "existence_probe",
    " UNION ALL ".join(
        f"SELECT DATE '{day}' AS part_day, count(*) > 0 AS found FROM streams WHERE part_day = DATE '{day}'"
        for day in ("2024-01-28", "2024-02-15")
    ),
)
def existence_probe(spark, sf):
    days = ("2024-01-28", "2024-02-15")
    streams = inputs.streams(spark, sf)
    found = [(date.fromisoformat(d), checks.has_rows(tables_io.on_day(streams, d))) for d in days]
    return spark.createDataFrame(found, "part_day date, found boolean")


@register(
    "empty_output_alarm",
    " UNION ALL ".join(
        f"""SELECT 'streams' AS name, DATE '{day}' AS part_day, count(*) AS n_rows,
                   count(*) > 0 AS ready,
                   CASE WHEN count(*) = 0 THEN 'streams has no rows for {day}' END AS message
            FROM streams WHERE part_day = DATE '{day}'"""
        for day in ("2024-02-15", "2024-01-28")
    ),
)
def empty_output_alarm(spark, sf):
    streams = inputs.streams(spark, sf)
    days = ("2024-02-15", "2024-01-28")
    empty, filled = (checks.empty_output_alarm(streams, "streams", day) for day in days)
    return empty.unionByName(filled)


_AUDITED = [
    (f"{p} {place}", table.format(p=p))
    for p in ("spotify", "apple")
    for place, table in (
        ("base", "base_{p}"), ("countries", "trends_countries_{p}"), ("regions", "trends_regions_{p}"),
    )
]


@register(
    "audit_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, {oracle._day(D)} AS part_day, {count} AS n_rows FROM {table}"
        for name, table, count in [
            *((n, t, "count(*)") for n, t in _AUDITED),
            ("velocity alerts", "alerts", "count(*)"),
            ("velocity emails", "alerts", "count(DISTINCT email)"),
        ]
    ),
)
def audit_counts(spark, sf):
    def tables_of(partner: Partner) -> dict[str, DataFrame]:
        base = tables_io.staged(base_of(spark, sf, partner), "base")
        countries = tables_io.staged(trending(base, partner), "countries")
        return {"base": base, "countries": countries, "regions": trending(base, partner, regional=True)}

    built = side_by_side(spark, tables_of)
    audited = {
        f"{name.lower()} {place}": with_part_day(table)
        for name, tables in built.items()
        for place, table in tables.items()
    }
    countries = {name: tables["countries"] for name, tables in built.items()}
    made = A.alerts(
        countries, staged_subscriptions(spark, sf), inputs.products(spark, sf),
        inputs.release_dates(spark, sf), inputs.images(spark, sf), D,
    )
    made = tables_io.staged(made, "alerts")
    return checks.audit_counts(audited, with_part_day(made), D)


_VOLUMES = """
    SELECT 'streams' AS name, part_day, count(*) AS n_rows FROM streams
    WHERE part_day >= DATE '2024-01-10' GROUP BY part_day
    UNION ALL
    SELECT 'events', CAST(ts AS DATE), count(*) FROM events
    WHERE CAST(ts AS DATE) >= DATE '2024-01-10' GROUP BY CAST(ts AS DATE)"""


@register("partition_volumes", _VOLUMES)
def partition_volumes(spark, sf):
    tables = {"streams": inputs.streams(spark, sf), "events": _event_days(spark, sf)}
    return checks.partition_volumes(tables, "2024-01-10")


@register("footer_volumes", _VOLUMES)
def footer_volumes(spark, sf):
    """The same from the footers of written tables."""
    folders = {}
    for name, df in (("streams", inputs.streams(spark, sf)), ("events", _event_days(spark, sf))):
        folders[name] = tables_io.work_path(spark, name)
        tables_io.write_days(df, folders[name])
    return checks.footer_volumes(spark, folders, "2024-01-10")


def _ties_sql(table: str, where: str = "country_code = 'US'") -> str:
    return f"""SELECT rank_lw, streams_lw, count(*) AS n_items FROM {table}
               WHERE {where} GROUP BY rank_lw, streams_lw HAVING count(*) > 1"""


@register("tie_profile", _ties_sql("trends_countries_spotify"))
def tie_profile(spark, sf):
    return checks.tie_profile(trends_of(spark, sf, SPOTIFY), "US")


@register(
    "tie_profile_region",
    _ties_sql("trends_regions_apple", "country_code = 'US' AND region_dma_code = '503'"),
)
def tie_profile_region(spark, sf):
    return checks.tie_profile(trends_of(spark, sf, APPLE, regional=True), "US", "503")


@register(
    "build_diff",
    f"""SELECT coalesce(a.rank_lw, b.rank_lw) AS rank_lw,
               coalesce(a.streams_lw, b.streams_lw) AS streams_lw,
               a.n_items AS n_items_left, b.n_items AS n_items_right,
               CASE WHEN a.n_items IS NULL THEN 0 ELSE 1 END AS rows_left,
               CASE WHEN b.n_items IS NULL THEN 0 ELSE 1 END AS rows_right
        FROM ({_ties_sql("trends_countries_spotify")}) a
        FULL JOIN ({_ties_sql("trends_countries_spotify_d1")}) b
          ON a.rank_lw IS NOT DISTINCT FROM b.rank_lw
             AND a.streams_lw IS NOT DISTINCT FROM b.streams_lw
        WHERE a.n_items IS DISTINCT FROM b.n_items""",
)
def build_diff(spark, sf):
    left = checks.tie_profile(trends_of(spark, sf, SPOTIFY), "US")
    right = checks.tie_profile(trends_of(spark, sf, SPOTIFY, day=D - timedelta(1)), "US")
    return checks.build_diff(left, right, ["rank_lw", "streams_lw"], "n_items")


# A second build of the country trends of two days: on the later one a market has lost rows, one has
# other counts, one has rows twice and one has rows that the first build lacks.
_DIFF_KEYS = ["report_date", *trends.ITEM_KEYS[1:]]
_DIFF_VALUES = [c for c in trend_schema(SPOTIFY).names if c not in _DIFF_KEYS]
_SECOND = f"""
    SELECT * REPLACE (CASE WHEN report_date = {oracle._day(D)} AND country_code = 'GB'
                                AND streams_tw % 2 = 0 THEN streams_tw + 1 ELSE streams_tw END
                      AS streams_tw)
    FROM first_build
    WHERE NOT (report_date = {oracle._day(D)} AND country_code = 'SE'
               AND coalesce(canopus_id % 3 = 0, false))
    UNION ALL SELECT * FROM first_build
              WHERE report_date = {oracle._day(D)} AND country_code = 'DE' AND canopus_id % 4 = 0
    UNION ALL SELECT * REPLACE ('NEW' || isrc AS isrc) FROM first_build
              WHERE report_date = {oracle._day(D)} AND country_code = 'FR' AND canopus_id % 5 = 0"""


@register(
    "whole_build_diff",
    f"""SELECT {", ".join(_DIFF_KEYS)}, report_date AS part_day,
               CAST(coalesce(sum(n) FILTER (n > 0), 0) AS BIGINT) AS rows_left,
               CAST(coalesce(-sum(n) FILTER (n < 0), 0) AS BIGINT) AS rows_right,
               CASE WHEN max(n) > 0 AND min(n) < 0 THEN concat_ws(',', {", ".join(
                   f"CASE WHEN min({c}) FILTER (n > 0) IS DISTINCT FROM min({c}) FILTER (n < 0) THEN '{c}' END"
                   for c in _DIFF_VALUES)}) END AS changed
        FROM (SELECT * EXCLUDE (side), sum(side) AS n
              FROM (SELECT *, 1 AS side FROM first_build UNION ALL SELECT *, -1 FROM second_build)
              GROUP BY ALL HAVING sum(side) <> 0)
        GROUP BY {", ".join(_DIFF_KEYS)}""",
    {
        "first_build": "SELECT * FROM trends_countries_spotify "
        "UNION ALL SELECT * FROM trends_countries_spotify_d1",
        "second_build": _SECOND,
    },
)
def whole_build_diff_query(spark, sf):
    folders = [tables_io.work_path(spark, f"build-{n}") for n in (1, 2)]
    for day in (D - timedelta(1), D):
        tables_io.write_days(trends_of(spark, sf, SPOTIFY, day=day), folders[0], days=[day])
    first = tables_io.read_table(spark, folders[0])
    country, later = F.col("country_code"), F.col("report_date") == F.lit(D)
    even = later & (country == "GB") & (F.col("streams_tw") % 2 == 0)
    lost = later & (country == "SE") & F.coalesce(F.col("canopus_id") % 3 == 0, F.lit(False))
    other = F.when(even, F.col("streams_tw") + 1).otherwise(F.col("streams_tw"))
    twice = first.filter(later & (country == "DE") & (F.col("canopus_id") % 4 == 0))
    new = first.filter(later & (country == "FR") & (F.col("canopus_id") % 5 == 0))
    second = (
        first.filter(~lost)
        .withColumn("streams_tw", other)
        .unionByName(twice)
        .unionByName(new.withColumn("isrc", F.concat(F.lit("NEW"), "isrc")))
    )
    tables_io.write_days(second, folders[1])
    builds = [tables_io.read_table(spark, folder) for folder in folders]
    return whole_build_diff(*builds, [*_DIFF_KEYS, "part_day"], ["part_day", "country_code"])


_COUNT_TEXT = """CASE c_custkey % 7 WHEN 0 THEN '12x' WHEN 1 THEN '' WHEN 2 THEN ' 7'
    WHEN 3 THEN '3000000000' WHEN 4 THEN '-' || CAST(c_custkey AS VARCHAR(20))
    WHEN 5 THEN '+' || CAST(c_custkey % 1000000 * 1000 AS VARCHAR(20))
    ELSE CAST(c_custkey % 1000000 * 1000 AS VARCHAR(20)) END"""


@register(
    "grouped_thousands",
    f"""SELECT c_custkey, CASE WHEN regexp_full_match(t, '[+-]?[0-9]+') AND TRY_CAST(t AS INTEGER) IS NOT NULL
              THEN format('{{:,}}', TRY_CAST(t AS INTEGER)) ELSE '0,000' END AS shown
        FROM (SELECT c_custkey, {_COUNT_TEXT} AS t FROM customer)""",
)
def grouped_thousands(spark, sf):
    return inputs.table(spark, sf, "customer").select(
        "c_custkey", scalar.grouped_thousands(F.expr(_COUNT_TEXT)).alias("shown")
    )
