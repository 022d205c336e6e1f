"""Days whose conversion departs from a trailing baseline.

All inputs are daily tables: a window group holds at most one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickline.functions.columns import exact_mean, share
from clickline.operators.funnel import category_timeline

# Labels and wording of the anomaly report.
SPIKE, DROP, NORMAL = "SPIKE", "DROP", "NORMAL"
SPIKE_TEXT = "ALERT: [Category: %s] conversion rate on %s spiked by +%.2f%% compared to the 7-day baseline of %.4f"
DROP_TEXT = "ALERT: [Category: %s] conversion rate on %s dropped by %.2f%% compared to the 7-day baseline of %.4f"
UNKNOWN_CATEGORY = "unknown"


def daily_category(metrics: DataFrame) -> DataFrame:
    """Funnel re-aggregated to (date, category); the rate is a ratio of sums."""
    return (
        metrics.groupBy("date", "category")
        .agg(
            F.sum("total_views").alias("daily_views"),
            F.sum("total_purchases").alias("daily_purchases"),
        )
        .withColumn("daily_conversion_rate", share("daily_purchases", "daily_views"))
    )


def _previous_days(days: int, *keys: str):
    """The ``days`` calendar days before the current one; day numbers do not shift with DST."""
    return Window.partitionBy(*keys).orderBy(F.unix_date("date")).rangeBetween(-days, -1)


def trailing_baseline(daily: DataFrame, days: int = 7) -> DataFrame:
    """Mean daily rate of the previous days, 4 decimals; absent days are skipped, null when none."""
    mean = exact_mean("daily_conversion_rate").over(_previous_days(days, "category"))
    return daily.withColumn("trailing_7d_avg", F.round(mean, 4).cast("double"))


def pct_anomalies(daily: DataFrame, threshold_pct: float = 50.0, days: int = 7) -> DataFrame:
    """Days at least ``threshold_pct`` percent off their baseline; no baseline or a zero one is no anomaly."""
    base, rate = F.col("trailing_7d_avg"), F.col("daily_conversion_rate")
    change = F.when(base > 0, F.round((rate - base) / base * 100, 2)).otherwise(F.lit(0.0))
    return (
        trailing_baseline(daily, days)
        .withColumn("pct_change", change)
        .where((F.col("pct_change") <= -threshold_pct) | (F.col("pct_change") >= threshold_pct))
        .withColumn("anomaly_type", F.when(F.col("pct_change") > 0, SPIKE).otherwise(DROP))
    )


def explain(anomalies: DataFrame) -> DataFrame:
    """Anomalies plus a sentence for people; a null category reads ``unknown`` there."""
    values = (
        F.coalesce("category", F.lit(UNKNOWN_CATEGORY)),
        F.col("date").cast("string"),
        F.col("pct_change"),
        F.col("trailing_7d_avg"),
    )
    text = F.when(F.col("anomaly_type") == SPIKE, F.format_string(SPIKE_TEXT, *values)).otherwise(
        F.format_string(DROP_TEXT, *values)
    )
    return anomalies.withColumn("explanation", text)


def anomaly_report(metrics: DataFrame) -> DataFrame:
    """Funnel table to the explained percentage anomalies, by date and category."""
    return explain(pct_anomalies(daily_category(metrics))).orderBy("date", "category")


def rolling_rows(timeline: DataFrame, rows: int = 7) -> DataFrame:
    """Chart baseline: mean of a category's last ``rows`` rows by date, the current one included."""
    window = Window.partitionBy("category").orderBy("date").rowsBetween(-(rows - 1), Window.currentRow)
    return timeline.withColumn("7d_baseline", F.avg("conversion_rate").over(window))


def category_date_slice(metrics: DataFrame, category: str, start: str, end: str) -> DataFrame:
    """A category's timeline between two dates, both included; the baseline sees earlier days too."""
    return rolling_rows(category_timeline(metrics, category)).where(F.col("date").between(start, end))


def anomaly_overlay(
    metrics: DataFrame,
    anomalies: DataFrame,
    category: str,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """A category's anomalies with the chart values of their day; split by ``anomaly_type``."""
    timeline = rolling_rows(category_timeline(metrics, category))
    points = anomalies.where(F.col("category") == category)
    if start is not None and end is not None:
        points = points.where(F.col("date").between(start, end))
    return points.join(timeline, ["category", "date"])


def zscore_metrics(
    metrics: DataFrame, days: int = 7, min_days: int = 3, threshold: float = 2.0
) -> DataFrame:
    """Funnel rows with rolling mean, deviation, z-score and flag per (category, device, referrer).

    The window is the previous ``days`` calendar days. No z-score with fewer than ``min_days``
    of them or when they do not vary.
    """
    rate = F.col("overall_conversion_rate")
    window = _previous_days(days, "category", "device", "referrer")
    scored = metrics.withColumns(
        {
            "_days": F.count(rate).over(window),
            "rolling_avg_conversion": exact_mean("overall_conversion_rate").over(window),
            "rolling_std": F.stddev_samp(rate).over(window),
        }
    )
    # Rates carry 4 decimals, so a deviation this small is float noise around zero.
    mean = F.col("rolling_avg_conversion").cast("double")
    usable = (F.col("_days") >= min_days) & (F.col("rolling_std") > 1e-9)
    z = F.when(usable, F.round((rate - mean) / F.col("rolling_std"), 4))
    flag = F.when(F.col("z_score") >= threshold, SPIKE).when(F.col("z_score") <= -threshold, DROP).otherwise(NORMAL)
    return (
        scored.withColumn("z_score", z)
        .withColumn("anomaly_flag", flag)
        .withColumn("rolling_avg_conversion", F.round("rolling_avg_conversion", 4).cast("double"))
        .withColumn("rolling_std", F.round("rolling_std", 4))
        .drop("_days")
    )


def zscore_anomalies(scored: DataFrame) -> DataFrame:
    """The flagged rows of ``zscore_metrics``."""
    return scored.where(F.col("anomaly_flag") != NORMAL)


def anomaly_points(flagged: DataFrame) -> DataFrame:
    """(date, rate) of every flagged row, as charts plot them."""
    return flagged.select("date", "overall_conversion_rate")
