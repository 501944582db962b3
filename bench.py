"""The daily run, step by step, on local[$BENCH_CPUS]; prints one JSON line.

Setup (reported, not part of the value) derives the input tables from $BENCH_SF_DIR and writes them
the way they are kept in use: streams partitioned by day, everything else as plain tables. Each step
then reads its input tables and writes its output table in full.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from datetime import timedelta

from upswing import APPLE, SPOTIFY
from upswing.operators.archive import cohort_archive, write_cohorts
from upswing.operators.digests import digests, messages
from upswing.operators.subscriptions import flatten_subscriptions
from upswing.plans.daily import Paths, Sources, days_between, rebuild, rebuild_alerts
from upswing.plans.velocity import trending, velocity_base
from upswing.sources.documents import publish, read_user_docs
from upswing.sources.tables import read_table, work_path, write_days, write_table
from upswing.streaming.outbox import outbox_stream
from verification import inputs
from verification.compare import local_session

DIMENSIONS = [
    "resources", "names", "subdivisions", "zips", "release_dates", "images", "products",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    root, day = work_path(spark, "bench"), inputs.REPORT_DAY
    timed: dict[str, float] = {}

    def step(name: str, action: Callable[[], object]) -> None:
        start = time.perf_counter()
        action()
        timed[name] = round(time.perf_counter() - start, 3)

    def prepare() -> None:
        write_days(inputs.streams(spark, sf_dir), f"{root}/streams")
        inputs.user_docs(spark, sf_dir).write.json(f"{root}/user_docs")
        for name in DIMENSIONS:
            write_table(getattr(inputs, name)(spark, sf_dir), f"{root}/{name}")

    step("setup", prepare)
    setup = timed.pop("setup")
    tables = {name: read_table(spark, f"{root}/{name}") for name in ["streams", *DIMENSIONS]}
    sources = Sources(*(tables[n] for n in ("streams", *DIMENSIONS[:4])))

    def base(partner) -> None:
        made = velocity_base(
            sources.streams, sources.resources, sources.names, partner, day=day,
            subdivisions=sources.subdivisions, zips=sources.zips,
        )
        write_days(made, f"{root}/base_{partner.name}", days=[day])

    def trend(partner, regional: bool) -> None:
        read = read_table(spark, f"{root}/base_{partner.name}").drop("part_day")
        place = "regions" if regional else "countries"
        write_days(trending(read, partner, regional), f"{root}/{place}_{partner.name}", days=[day])

    def subscriptions() -> None:
        docs = read_user_docs(spark, f"{root}/user_docs")
        flat = flatten_subscriptions(docs, inputs.APP, inputs.SUBSCRIPTION)
        write_table(flat, f"{root}/subscriptions")

    def alerts() -> None:
        rebuild_alerts(
            spark, {p.name: f"{root}/countries_{p.name}" for p in (SPOTIFY, APPLE)},
            read_table(spark, f"{root}/subscriptions"), tables["products"],
            tables["release_dates"], tables["images"], day, f"{root}/alerts",
        )

    def digest_messages() -> None:
        written = read_table(spark, f"{root}/alerts").drop("part_day")
        publish(messages(digests(written)), f"{root}/topic")

    def outbox() -> None:
        outbox_stream(
            spark, f"{root}/topic", f"{root}/outbox", f"{root}/outbox-checkpoint"
        ).awaitTermination()

    def backfill() -> None:
        paths = Paths(*(f"{root}/backfill/{n}" for n in ("base", "countries", "regions")))
        days = days_between(day - timedelta(2), day + timedelta(1))
        rebuild(spark, sources, SPOTIFY, days, paths)

    for partner in (SPOTIFY, APPLE):
        tag = partner.name.lower()
        step(f"base_{tag}", lambda: base(partner))
        step(f"trending_countries_{tag}", lambda: trend(partner, False))
        step(f"trending_regions_{tag}", lambda: trend(partner, True))
    step("flatten_subscriptions", subscriptions)
    step("alerts_all", alerts)
    step("messages", digest_messages)
    step("outbox", outbox)
    step("backfill_range", backfill)
    step(
        "cohort_archive",
        lambda: write_cohorts(
            cohort_archive(tables["streams"], tables["release_dates"]), f"{root}/cohorts"
        ),
    )
    result = {
        "metric": "daily run, total wall time of its steps",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "setup_sec": setup,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
