"""Schema, range, uniqueness and distribution checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.functions.columns import float_columns, nan_to_null, numeric_columns
from parcelwise.operators.joins import shared_columns, tag_and_union
from parcelwise.operators.ordering import running_sum
from parcelwise.operators.quantiles import quantile_values
from parcelwise.scale import MAX_GROUP_ROWS, join_keys, lookup_side, written
from parcelwise.schemas import (
    REQUEST_RANGES,
    REQUEST_REQUIRED,
    SALE_RULES,
    SERVICE_POSITIVE,
    SERVICE_RANGES,
    SERVICE_REQUIRED,
    ZIPCODE_PATTERN,
    Rule,
)

FAMILIES = {
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "string": (T.StringType,),
}


def _result(expectation: str, column: str, unexpected: Column, total: Column) -> Column:
    share = F.coalesce(F.try_divide(unexpected.cast("double") * 100, total), F.lit(0.0))
    return F.struct(
        F.lit(expectation).alias("expectation"),
        F.lit(column).alias("column"),
        (unexpected == 0).alias("success"),
        unexpected.cast("long").alias("unexpected_count"),
        share.alias("unexpected_percent"),
    )


def schema_checks(df: DataFrame, rules: Sequence[Rule] = SALE_RULES) -> list[tuple[str, str, bool]]:
    """(check, column, passed) for required columns and type families, from the schema alone."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    found = [("required_column", r.column, r.column in fields) for r in rules if r.required]
    found += [
        ("column_type", r.column, isinstance(fields[r.column], FAMILIES[r.family]))
        for r in rules
        if r.column in fields
    ]
    return found


def missing(df: DataFrame, column: str) -> Column:
    col = F.col(column)
    return (col.isNull() | F.isnan(col)) if column in float_columns(df) else col.isNull()


def outside(df: DataFrame, rule: Rule) -> Column:
    """True where a present value lies outside the bounds of the rule."""
    col = F.col(rule.column)
    return ~missing(df, rule.column) & ~col.between(rule.low, rule.high)


def range_checks(df: DataFrame, rules: Sequence[Rule] = SALE_RULES) -> DataFrame:
    """Number of out-of-range values per rule, all rules in one aggregation."""
    active = [r for r in rules if r.low is not None and r.column in df.columns]
    counts = [F.count_if(outside(df, r)).alias(r.column) for r in active]
    row = df.agg(F.count(F.lit(1)).alias("__n"), *counts)
    return row.select(F.inline(F.array(*[_result("range", r.column, F.col(r.column), F.col("__n")) for r in active])))


def pattern_checks(df: DataFrame, rules: Sequence[Rule] = SALE_RULES) -> DataFrame:
    active = [r for r in rules if r.pattern and r.column in df.columns]
    counts = [F.count_if(~F.col(r.column).rlike(r.pattern)).alias(r.column) for r in active]
    row = df.agg(F.count(F.lit(1)).alias("__n"), *counts)
    return row.select(F.inline(F.array(*[_result("pattern", r.column, F.col(r.column), F.col("__n")) for r in active])))


def not_null_checks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(missing(df, c)).alias(c) for c in cols])
    return row.select(F.inline(F.array(*[_result("not_null", c, F.col(c), F.col("__n")) for c in cols])))


def unique_checks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Occurrences beyond the first per key column; counted per value before anything is shuffled."""
    parts = []
    for c in cols:
        counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        row = counts.agg(
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")
        )
        parts.append(row.select(F.inline(F.array(_result("unique", c, F.col("extra"), F.col("total"))))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def expectation_suite(df: DataFrame, rules: Sequence[Rule] = SALE_RULES) -> DataFrame:
    """Existence, range, uniqueness and not-null expectations over the required columns."""
    required = [r for r in rules if r.required and r.pattern is None]
    present = [r for r in required if r.column in df.columns]
    total = F.col("__n")
    ranged = [r for r in present if r.low is not None]
    row = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(outside(df, r)).alias(f"range_{r.column}") for r in ranged],
        *[F.count_if(missing(df, r.column)).alias(f"null_{r.column}") for r in present],
    )
    absent = F.lit(0).cast("long")
    entries = [
        _result("exists", r.column, F.lit(0 if r in present else 1).cast("long"), absent) for r in required
    ]
    entries += [_result("range", r.column, F.col(f"range_{r.column}"), total) for r in ranged]
    entries += [_result("not_null", r.column, F.col(f"null_{r.column}"), total) for r in present]
    results = row.select(F.inline(F.array(*entries)))
    unique = [r.column for r in present if r.unique]
    return results.unionByName(unique_checks(df, unique)) if unique else results


def suite_summary(results: DataFrame) -> DataFrame:
    failed = F.count_if(~F.col("success"))
    return results.agg(
        F.bool_and("success").alias("success"),
        (F.avg(F.col("success").cast("double")) * 100).alias("success_percent"),
        F.count(F.lit(1)).alias("evaluated_expectations"),
        failed.alias("failed_expectations"),
    )


def missing_shares(df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Missing fraction per column; with a threshold, only the columns above it."""
    row = df.agg(*[F.avg(missing(df, c).cast("double")).alias(c) for c in df.columns])
    shares = row.unpivot([], df.columns, "column", "missing_share")
    return shares if threshold is None else shares.filter(F.col("missing_share") > threshold)


def outliers_iqr(
    df: DataFrame, row_key: Sequence[str], cols: Sequence[str], multiplier: float = 1.5, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Long rows (key, column, value, low, high) for values outside the quartile fences."""
    df = nan_to_null(df, cols)
    found = quantile_values(df, cols, [0.25, 0.75], max_rows=max_rows)
    fences = {}
    for c, (q1, q3) in found.items():
        if q1 is not None:
            fences[c] = (q1 - multiplier * (q3 - q1), q3 + multiplier * (q3 - q1))
    return _outlier_rows(df, row_key, fences)


def outliers_zscore(df: DataFrame, row_key: Sequence[str], cols: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Values further than `limit` population deviations from the mean; a constant column has none."""
    df = nan_to_null(df, cols)
    aggs = [a for c in cols for a in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]
    row = df.agg(*aggs).first()
    fences = {}
    for c in cols:
        mean, std = row[f"m_{c}"], row[f"s_{c}"]
        if std:
            fences[c] = (mean - limit * std, mean + limit * std)
    return _outlier_rows(df, row_key, fences)


def _outlier_rows(df: DataFrame, row_key: Sequence[str], fences: dict[str, tuple[float, float]]) -> DataFrame:
    entries = [
        F.when(
            (F.col(c) < low) | (F.col(c) > high),
            F.struct(
                F.lit(c).alias("column"),
                F.col(c).cast("double").alias("value"),
                F.lit(low).alias("low"),
                F.lit(high).alias("high"),
            ),
        )
        for c, (low, high) in fences.items()
    ]
    return df.select(*row_key, F.inline(F.array_compact(F.array(*entries))))


def request_reasons(
    ranges: dict[str, tuple[float, float]] = REQUEST_RANGES, required: Sequence[str] = REQUEST_REQUIRED
) -> Column:
    """Array of the reasons a request is refused; empty for a valid one."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"Missing required field: {c}")) for c in required]
    checks += [
        F.when(~F.col(c).between(low, high), F.lit(f"{c} must be between {low} and {high}"))
        for c, (low, high) in ranges.items()
    ]
    return F.array_compact(F.array(*checks))


def service_reasons() -> Column:
    """Reasons of the second request rule set, with positions and a zipcode pattern.

    Only the required fields have to be there; NaN counts as absent."""
    def told(c: str, bad: Column, text: str) -> Column:
        return F.when(bad, F.lit(f"{c} {text}"))

    checks = [told(c, F.col(c).isNull(), "is required") for c in SERVICE_REQUIRED]
    for c, (low, high) in SERVICE_RANGES.items():
        outside = F.col(c) > high if low is None else ~F.col(c).between(low, high)
        checks.append(told(c, outside, "is out of range"))
    checks += [told(c, F.col(c) <= 0, "is not above 0") for c in SERVICE_POSITIVE]
    checks.append(told("zipcode", ~F.col("zipcode").rlike(ZIPCODE_PATTERN), "is no zipcode"))
    return F.array_compact(F.array(*checks))


def validate_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with `reasons`)."""
    checked = df.withColumn("reasons", request_reasons())
    return checked.filter(F.size("reasons") == 0).drop("reasons"), checked.filter(F.size("reasons") > 0)


def ks_two_sample(
    current: DataFrame, reference: DataFrame, cols: Sequence[str], max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Largest distance of the two empirical distributions per shared column, with its p-value.

    Values are counted per column and side first, so repeated values cost one row. Running totals
    over the counts are taken in range-partitioned blocks when a column has many distinct values."""
    cols = shared_columns(current, reference, cols)
    both = tag_and_union(current, reference, cols)
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    long = both.select("is_reference", F.inline(entries)).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = long.groupBy("column", "value").agg(
        F.count_if(~F.col("is_reference")).alias("n_current"), F.count_if("is_reference").alias("n_reference")
    )
    counts = written(counts, "value-counts")
    running = running_sum(
        counts, ["column"], ["value"], {"c_current": "n_current", "c_reference": "n_reference"}, max_rows=max_rows
    )
    totals = counts.groupBy("column").agg(
        F.sum("n_current").alias("t_current"), F.sum("n_reference").alias("t_reference")
    )
    gap = F.abs(
        F.try_divide(F.col("c_current").cast("double"), F.col("t_current"))
        - F.try_divide(F.col("c_reference").cast("double"), F.col("t_reference"))
    )
    result = join_keys(running, lookup_side(totals), ["column"]).groupBy("column").agg(
        F.max(gap).alias("ks_statistic"),
        F.max("t_current").alias("n_current"),
        F.max("t_reference").alias("n_reference"),
    )
    return result.withColumn("p_value", ks_p_value())


def ks_p_value(terms: int = 100) -> Column:
    """Asymptotic p-value: the Kolmogorov series 2 * sum((-1)^(k-1) * exp(-2 k^2 x^2))."""
    n, m = F.col("n_current").cast("double"), F.col("n_reference").cast("double")
    x = F.sqrt(n * m / (n + m)) * F.col("ks_statistic")
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x),
    )
    # Below this the alternating series has not converged and the p-value is 1 to many digits.
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.greatest(2.0 * series, F.lit(0.0)), F.lit(1.0)))


def chi_square_drift(current: DataFrame, reference: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Chi-square statistic of the category-by-side table per column, with degrees of freedom."""
    both = tag_and_union(current, reference, cols)
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    long = both.select("is_reference", F.inline(entries)).filter(F.col("value").isNotNull())
    cells = long.groupBy("column", "value").agg(
        F.count_if(~F.col("is_reference")).alias("a"), F.count_if("is_reference").alias("b")
    )
    totals = cells.groupBy("column").agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    joined = join_keys(cells, lookup_side(totals), ["column"])
    row, total = F.col("a") + F.col("b"), F.col("ta") + F.col("tb")
    ea, eb = row * F.col("ta") / total, row * F.col("tb") / total
    part = F.coalesce(F.try_divide(F.pow(F.col("a") - ea, 2), ea), F.lit(0.0)) + F.coalesce(
        F.try_divide(F.pow(F.col("b") - eb, 2), eb), F.lit(0.0)
    )
    return joined.groupBy("column").agg(
        F.sum(part).alias("chi_square"), (F.count(F.lit(1)) - 1).alias("degrees_of_freedom")
    )


def validation_report(
    df: DataFrame,
    row_key: Sequence[str],
    reference: DataFrame | None = None,
    rules: Sequence[Rule] = SALE_RULES,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Every check as rows (check, column, value, passed); missing, outliers and drift inform only.

    Range violations and missing shares of all columns come from one aggregation."""
    cols = [c for c in numeric_columns(df) if c not in row_key]
    unknown = F.lit(None).cast("boolean")

    def entry(check: str, column: str, value: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            value.cast("double").alias("value"),
            passed.alias("passed"),
        )

    def informed(check: str, table: DataFrame, value: str) -> DataFrame:
        return table.select(
            F.lit(check).alias("check"), "column", F.col(value).cast("double").alias("value"), unknown.alias("passed")
        )

    ranged = [r for r in rules if r.low is not None and r.column in df.columns]
    flat = df.agg(
        *[F.count_if(outside(df, r)).alias(f"range_{r.column}") for r in ranged],
        *[F.avg(missing(df, c).cast("double")).alias(f"missing_{c}") for c in df.columns],
    )
    entries = [entry(check, c, F.lit(0 if ok else 1), F.lit(ok)) for check, c, ok in schema_checks(df, rules)]
    entries += [
        entry("range", r.column, F.col(f"range_{r.column}"), F.col(f"range_{r.column}") == 0) for r in ranged
    ]
    entries += [entry("missing_share", c, F.col(f"missing_{c}"), unknown) for c in df.columns]
    report = flat.select(F.inline(F.array(*entries)))
    unique = [r.column for r in rules if r.unique and r.column in df.columns]
    if unique:
        repeated = unique_checks(df, unique)
        report = report.unionByName(
            repeated.select(
                F.col("expectation").alias("check"),
                "column",
                F.col("unexpected_count").cast("double").alias("value"),
                F.col("success").alias("passed"),
            )
        )
    outliers = outliers_iqr(df, row_key, cols, max_rows=max_rows).groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    report = report.unionByName(informed("outliers", outliers, "n"))
    if reference is not None:
        drift = ks_two_sample(df, reference, cols, max_rows)
        report = report.unionByName(informed("drift", drift, "ks_statistic"))
    return report


def overall_valid(report: DataFrame) -> DataFrame:
    return report.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("overall_valid"))
