"""The whole run: clean, sessionize, funnel, attribution, anomalies, report.

``Stages`` composes everything into lazy DataFrames. The ``*_stage`` functions do the same
file to file: each reads what earlier stages stored under ``out_dir`` and stores its own
tables there, so nothing is computed twice, a lost executor never sends a later stage back to
the raw text, and a failed run can be taken up at the stage that failed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickline.operators import anomaly, attribute, clean, funnel, report
from clickline.operators.scale import scale_up
from clickline.operators.sessionize import DEFAULT_GAP_SECONDS, sessionize
from clickline.sources import files, schemas


@dataclass
class Stages:
    """Every stage table as a lazy DataFrame over the raw inputs, composed when asked for."""

    raw_events: DataFrame
    raw_transactions: DataFrame
    raw_products: DataFrame
    gap_seconds: int = DEFAULT_GAP_SECONDS
    lookback_seconds: int = attribute.DEFAULT_LOOKBACK_SECONDS

    @cached_property
    def events(self) -> DataFrame:
        return clean.clean_events(self.raw_events)

    @cached_property
    def orders(self) -> DataFrame:
        return clean.clean_orders(self.raw_transactions)

    @cached_property
    def catalog(self) -> DataFrame:
        return clean.clean_catalog(self.raw_products)

    @cached_property
    def sessions(self) -> DataFrame:
        return sessionize(self.events, self.gap_seconds)

    @cached_property
    def funnel(self) -> DataFrame:
        return funnel.funnel_metrics(self.sessions, self.catalog)

    @cached_property
    def attributed(self) -> DataFrame:
        return attribute.last_touch(self.orders, attribute.touchpoints(self.sessions), self.lookback_seconds)

    @cached_property
    def anomalies(self) -> DataFrame:
        return anomaly.anomaly_report(self.funnel)

    @cached_property
    def scored(self) -> DataFrame:
        return anomaly.zscore_metrics(self.funnel)


@dataclass(frozen=True)
class Run:
    """Where a file-to-file run reads and writes.

    ``files_per_table`` lays the per-user tables out by user into about that many files;
    without it they are written as they come, which saves a shuffle.
    """

    events_csv: str
    transactions_csv: str
    products_csv: str
    out_dir: str
    files_per_table: int | None = None

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        """A stored stage table; its ids have the type they were stored with, number or text."""
        path, schema = f"{self.out_dir}/{table}", _TABLES[table]
        if ids := {"product_id", "order_id"} & set(schema.names):
            stored = files.read_table(spark, path).schema
            schema = schemas.with_text(schema, *[i for i in ids if stored[i].dataType == T.StringType()])
        return files.read_table(spark, path, schema)

    def store(self, df: DataFrame, table: str) -> None:
        """A table with one row per event or order."""
        key = None if self.files_per_table is None else "user_id"
        files.write_table(df, f"{self.out_dir}/{table}", key, self.files_per_table)

    def store_by_user(self, df: DataFrame, table: str) -> None:
        """A per-user table that one user's rows are looked up in; in ``df`` each user's rows stand together."""
        path = f"{self.out_dir}/{table}"
        if self.files_per_table is None:
            files.write_grouped_for_lookup(df, path, "user_id")
        else:
            files.write_lookup_table(df, path, "user_id", "timestamp", files=self.files_per_table)

    def store_small(self, df: DataFrame, table: str) -> None:
        """A catalog or daily table."""
        files.write_small_table(df, f"{self.out_dir}/{table}")


_TABLES = {
    "cleaned/events_clean": schemas.EVENTS_CLEAN,
    "cleaned/orders_clean": schemas.ORDERS_CLEAN,
    "cleaned/catalog_clean": schemas.CATALOG_CLEAN,
    "output/events_with_sessions": schemas.EVENTS_WITH_SESSIONS,
    "output/funnel_metrics": schemas.FUNNEL_METRICS,
    "output/attributed_orders": schemas.ATTRIBUTED_ORDERS,
    "output/anomalies": schemas.ANOMALIES,
    "output/anomaly_metrics": schemas.ANOMALY_METRICS,
    "output/anomalies_only": schemas.ANOMALY_METRICS,
}


def read_raw(spark: SparkSession, run: Run) -> tuple[list[DataFrame], list[int]]:
    """Events, transactions and products, and how many amounts in each are no numbers (they become null). Ids are numbers
    where all of them are, else text; product ids are of one type in both tables that hold them, so no id becomes null.
    What fits is found in one scan of each file."""
    paths = (run.events_csv, run.transactions_csv, run.products_csv)
    kinds = (schemas.RAW_EVENTS, schemas.RAW_TRANSACTIONS, schemas.RAW_PRODUCTS)
    others = []
    for path, kind in zip(paths, kinds, strict=True):
        numbers = {f.name: f.dataType for f in kind.fields if f.dataType != T.StringType()}
        others.append(files.misfits(files.read_csv_text(spark, path), numbers))
    text_ids = [c for c in ("product_id", "transaction_id") if any(counts.get(c) for counts in others)]
    tables = [files.read_csv(spark, path, schemas.with_text(kind, *text_ids)) for path, kind in zip(paths, kinds, strict=True)]
    return tables, [sum(counts.get(c, 0) for c in ("gross_revenue", "base_price")) for counts in others]


def preprocessing_stage(spark: SparkSession, run: Run) -> None:
    (events, orders, products), lost_amounts = read_raw(spark, run)
    run.store(clean.clean_events(events), "cleaned/events_clean")
    run.store(clean.clean_orders(orders), "cleaned/orders_clean")
    run.store_small(clean.clean_catalog(products), "cleaned/catalog_clean")
    run.store_small(clean.rejects(events, orders, products, lost_amounts), "cleaned/rejects")


def sessionization_stage(spark: SparkSession, run: Run) -> None:
    run.store_by_user(sessionize(run.load(spark, "cleaned/events_clean")), "output/events_with_sessions")


def funnel_stage(spark: SparkSession, run: Run) -> None:
    sessions = run.load(spark, "output/events_with_sessions")
    catalog = run.load(spark, "cleaned/catalog_clean")
    run.store_small(funnel.funnel_metrics(sessions, catalog), "output/funnel_metrics")


def attribution_stage(spark: SparkSession, run: Run) -> None:
    touches = attribute.touchpoints(run.load(spark, "output/events_with_sessions"))
    orders = run.load(spark, "cleaned/orders_clean")
    run.store(attribute.last_touch(orders, touches), "output/attributed_orders")


def anomaly_stage(spark: SparkSession, run: Run) -> None:
    metrics = run.load(spark, "output/funnel_metrics")
    # Sorted already: written as it comes, in order, and in one file while it is small.
    files.write_table(anomaly.anomaly_report(metrics), f"{run.out_dir}/output/anomalies")
    run.store_small(anomaly.zscore_metrics(metrics), "output/anomaly_metrics")
    flagged = anomaly.zscore_anomalies(run.load(spark, "output/anomaly_metrics"))
    run.store_small(flagged, "output/anomalies_only")


def export_stage(spark: SparkSession, run: Run) -> None:
    metrics = run.load(spark, "output/funnel_metrics")
    top = report.anomaly_export(run.load(spark, "output/anomalies_only"), limit=50)
    files.write_json_object(report.summary(metrics), f"{run.out_dir}/output/summary.json")
    files.write_json_array(report.funnel_steps(metrics), f"{run.out_dir}/output/funnel.json", most=3)
    order = [F.col("z_score").desc(), "date", "category", "device", "referrer"]
    files.write_json_array(top, f"{run.out_dir}/output/anomalies.json", most=50, order=order)


ALL_STAGES: dict[str, Callable[[SparkSession, Run], None]] = {
    "preprocessing": preprocessing_stage,
    "sessionization": sessionization_stage,
    "funnel": funnel_stage,
    "attribution": attribution_stage,
    "anomalies": anomaly_stage,
    "export": export_stage,
}


def scale_up_csv(
    spark: SparkSession, source_csv: str, target_csv: str, copies: int, files_per_table: int | None = None
) -> None:
    """Copy a raw CSV file ``copies`` times under new customer ids."""
    files.write_csv(scale_up(files.read_csv_text(spark, source_csv), copies), target_csv, files_per_table)
