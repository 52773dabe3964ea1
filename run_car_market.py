"""Build the car market layers: spark-submit run_car_market.py CARS.csv FUEL.csv LAKE

Prints what was published, then the dashboard panels. The layer names are
schemas of the session's catalog; only a durable catalog keeps them.
"""

from __future__ import annotations

import argparse

from orefold.plans.car_market import CAR_MARKET, csv_sources, dashboard
from orefold.plans.gold import read_gold
from orefold.plans.layers import Layers, run_layers
from orefold.session import build_session


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("cars", help="car CSV, or a folder of them")
    args.add_argument("fuel", help="fuel economy CSV")
    args.add_argument("lake", help="folder the three schemas are created in")
    args.add_argument("--max-rejects", type=int, help="malformed numbers to accept as null")
    args.add_argument("--salt-buckets", type=int, default=0, help="spread hot makes")
    args.add_argument("--by-fingerprint", action="store_true", help="find exact copies without moving whole rows")
    given = args.parse_args()

    spark = build_session("car-market")
    layers = Layers(location=given.lake)
    report = run_layers(
        spark,
        CAR_MARKET,
        csv_sources(spark, given.cars, given.fuel),
        layers,
        max_rejects=given.max_rejects,
        salt_buckets=given.salt_buckets,
        by_fingerprint=given.by_fingerprint,
    )
    silver = (report.silver_dimension, report.silver, report.rejects)
    for done in (*report.bronze.values(), *silver, *report.gold.values()):
        if done:
            print(f"{done.table}: {done.rows} rows")
    print(f"exact copies removed: {report.removed_copies(CAR_MARKET)}")
    gold = {t.name: read_gold(spark, layers.gold, t) for t in CAR_MARKET.gold}
    for name, panel in dashboard(gold).items():
        print(name)
        panel.show(10, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
