"""Statistical outliers: z-scores per product category, and quartile fences on discounts.

Two passes over the fact: one for the statistics, one that scores every row for all rules at
once. The per-category statistics are staged, so the join back is a broadcast join while
they are small and a skew-split shuffled join when they are not; a window over the category
would put each category into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.numbers import percent
from tallyline.schemas import ANOMALIES
from tallyline.settings import AnomalySettings
from tallyline.sources.tables import stage_table

GROUP = "product_category"
DISCOUNT_OUTLIER = "DISCOUNT_OUTLIER"
ZSCORE_PLACES = 4


def category_stats(core: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample deviation per category; a deviation of zero becomes NULL."""
    aggs = []
    for c in columns:
        value = F.col(c).cast("double")
        aggs += [
            F.avg(value).alias(f"_{c}_mean"),
            F.nullif(F.stddev_samp(value), F.lit(0.0)).alias(f"_{c}_sd"),
        ]
    return core.groupBy(F.col(GROUP).alias("_group")).agg(*aggs)


def quartiles(core: DataFrame, column: str, approx: bool = False) -> DataFrame:
    """One row with q1 and q3.

    Exact by default: linear interpolation over the value counts, which are combined on the
    map side and by value before they meet. A two-place percentage has at most 10,001 of
    them. ``approx`` is for columns with many distinct values, such as money.
    """
    value = F.col(column).cast("double")
    probs = F.array(F.lit(0.25), F.lit(0.75))
    if approx:
        row = core.agg(F.percentile_approx(value, probs, 100_000).alias("q"))
    else:
        counts = core.groupBy(value.alias("_v")).agg(F.count("*").alias("_n"))
        row = counts.filter("_v IS NOT NULL").agg(
            F.percentile(F.col("_v"), probs, F.col("_n")).alias("q")
        )
    return row.select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))


def fences(core: DataFrame, column: str, multiplier: float, approx: bool = False) -> DataFrame:
    """One row with the lower and upper fence."""
    q1, q3 = F.col("q1"), F.col("q3")
    reach = (q3 - q1) * multiplier
    return quartiles(core, column, approx).select(
        (q1 - reach).alias("lower"), (q3 + reach).alias("upper")
    )


def with_zscores(core: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``_<column>_z``: 0 where the group has no deviation."""
    stats = stage_table(category_stats(core, columns), "category-stats")
    joined = core.join(stats, F.col(GROUP) == F.col("_group"), "left")
    z = {
        f"_{c}_z": F.coalesce(
            (F.col(c).cast("double") - F.col(f"_{c}_mean")) / F.col(f"_{c}_sd"), F.lit(0.0)
        )
        for c in columns
    }
    return joined.withColumns(z).drop(*stats.columns)


def _outside(column: str, limits: DataFrame) -> Column:
    """Beyond the fences, which reach the tasks as two scalars."""
    value = F.col(column).cast("double")
    lower, upper = limits.select("lower").scalar(), limits.select("upper").scalar()
    return (value < lower) | (value > upper)


def _z_type(column: str) -> Column:
    up = column.upper()
    return F.when(F.col(f"_{column}_z") > 0, f"HIGH_{up}").otherwise(f"LOW_{up}")


def _finding(kind: Column, z_of: str | None) -> Column:
    """One finding: its type and the z-score, in the column it belongs to."""
    null = F.lit(None).cast("double")

    def score(name: str) -> Column:
        return F.round(F.col(f"_{name}_z"), ZSCORE_PLACES) if z_of == name else null

    return F.struct(
        score("revenue").alias("revenue_zscore"),
        score("cost").alias("cost_zscore"),
        kind.alias("anomaly_type"),
    )


def _project(df: DataFrame, found: Column | None = None) -> DataFrame:
    if found is not None:
        df = df.withColumn("_found", found).select("*", "_found.*")
    return df.select(*ANOMALIES.fieldNames())


def detect_zscore(core: DataFrame, column: str, threshold: float = 2.5) -> DataFrame:
    """Rows whose z-score in their category is beyond ``threshold`` either way."""
    scored = with_zscores(core, [column]).filter(F.abs(f"_{column}_z") > threshold)
    return _project(scored, _finding(_z_type(column), column))


def detect_iqr(
    core: DataFrame, column: str = "discount_pct", multiplier: float = 1.5, approx: bool = False
) -> DataFrame:
    """Rows outside ``[q1 - k*iqr, q3 + k*iqr]`` of the whole column."""
    limits = fences(core, column, multiplier, approx)
    flagged = core.filter(_outside(column, limits))
    return _project(flagged, _finding(F.lit(DISCOUNT_OUTLIER), None))


def detect_all(
    core: DataFrame, settings: AnomalySettings = AnomalySettings(), approx: bool = False
) -> DataFrame:
    """All rules, one finding per transaction.

    The finding with the largest revenue z-score wins; without one, the order is the order
    of ``settings.columns`` and then the discount rule. A row settles its own findings
    before the shuffle, so only flagged rows are shuffled to settle repeated ids.
    """
    scored = with_zscores(core, settings.columns)
    limits = fences(core, settings.iqr_column, settings.iqr_multiplier, approx)
    rules = [
        (F.abs(f"_{c}_z") > settings.zscore_threshold, _finding(_z_type(c), c))
        for c in settings.columns
    ]
    rules.append(
        (_outside(settings.iqr_column, limits), _finding(F.lit(DISCOUNT_OUTLIER), None))
    )
    candidates = F.array(*(
        F.when(
            test,
            F.struct(
                F.negate(F.coalesce(F.abs(found["revenue_zscore"]), F.lit(0.0))).alias("_worst"),
                F.lit(place).alias("_place"),
                found.alias("_found"),
            ),
        )
        for place, (test, found) in enumerate(rules)
    ))
    best = F.array_min(F.array_compact(candidates))
    flagged = (
        scored.withColumn("_best", best)
        .filter(F.col("_best").isNotNull())
        .select("*", "_best.*")
        .select("*", "_found.*")
    )
    w = Window.partitionBy("transaction_id").orderBy(
        "_worst", "_place", "txn_date", "product_name", "revenue", "cost"
    )
    chosen = flagged.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    return _project(chosen)


def empty_anomalies(like: DataFrame) -> DataFrame:
    """No findings, with the right columns."""
    return like.sparkSession.createDataFrame([], ANOMALIES)


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("anomaly_type").agg(
        F.count("*").alias("anomaly_count"), F.sum("revenue").alias("total_revenue")
    )


def anomaly_rate(core: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Share of flagged transactions, in percent."""
    found = anomalies.agg(F.count("*").alias("n")).scalar()
    return (
        core.agg(F.count("*").alias("total_transactions"))
        .withColumn("anomalous_transactions", found)
        .withColumn(
            "anomaly_rate_pct",
            percent(F.col("anomalous_transactions"), F.col("total_transactions"), 4),
        )
    )
