"""Data quality checks on the events table, one row per day and check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.config import EventRoles
from eventlake.functions.days import with_missing_days, with_previous_day
from eventlake.functions.numbers import percent, percent_text, ratio

# Check outcomes, and the columns that must be filled.
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
REQUIRED = ("event_id", "event_type", "user_id", "product_id", "event_timestamp")


@dataclass(frozen=True)
class Rules:
    """Limits in percent: below the first passes, below the second warns."""

    null_rate: tuple[float, float] = (1.0, 5.0)
    duplicate_rate: tuple[float, float] = (0.1, 1.0)
    volume_change: float = 50.0
    orphan_rate: tuple[float, float] = (0.1, 1.0)


class QualityGateError(RuntimeError):
    """Raised when a check of the day has failed."""


def quality_profile(
    events: DataFrame, roles: EventRoles = EventRoles(), arrival: str | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """All figures the checks need, one row per day.

    With the column of the day on which a row arrived, a row without a time is reported under that
    day, and a time is out of range if it lies on another day than its arrival.

    Event ids are counted in a branch of their own: it shuffles ids only, where
    a distinct count next to the other aggregates would send them all along with
    every id. With a product table, events of products that it lacks are counted: events per product and
    day are counted first, so the table meets distinct ids and not events.
    """
    kind = F.col("event_type")
    bought = kind == roles.purchase
    expected = F.col("event_date")
    if arrival:
        # a row that came before arrivals were kept has none
        expected = F.coalesce(arrival, "event_date")
        events = events.withColumn("_expected", expected).withColumn("event_date", F.coalesce("event_date", "_expected"))
        expected = F.col("_expected")
    figures = events.groupBy("event_date").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in REQUIRED],
        F.min("price").alias("min_price"),
        F.count_if(~kind.isin(*roles.valid)).alias("invalid_types"),
        F.count_if(F.to_date("event_timestamp") != expected).alias("out_of_range"),
        F.count_if(bought).alias("purchases"),
        F.count_if(bought & F.col("total_amount").isNull()).alias("purchases_without_amount"),
    )
    ids = (
        events.groupBy("event_date", "event_id").agg(F.count("*").alias("copies"))
        .groupBy("event_date").agg(F.sum(F.col("copies") - 1).alias("duplicates"))
    )
    found = figures.join(ids.filter(F.col("event_date").isNotNull()), "event_date")
    if products is None:
        return found
    sold = events.filter(F.col("product_id").isNotNull()).groupBy("event_date", "product_id").agg(F.count("*").alias("sold"))
    known = products.select("product_id").filter(F.col("product_id").isNotNull()).distinct()
    orphans = sold.join(known, "product_id", "left_anti").groupBy("event_date").agg(
        F.sum("sold").alias("orphans"), F.count("*").alias("orphan_products")
    )
    return found.join(orphans, "event_date", "left").fillna(0, ["orphans", "orphan_products"])


def _graded(rate: Column, limits: tuple[float, float]) -> Column:
    return F.when(rate < limits[0], PASS).when(rate < limits[1], WARN).otherwise(FAIL)


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _check(
    name: str, family: str, status: Column, expected: str, actual: Column, details: Column,
    applies: Column,
) -> Column:
    row = F.struct(
        F.lit(name).alias("check_name"),
        F.lit(family).alias("check_type"),
        status.alias("status"),
        F.lit(expected).alias("expected_value"),
        actual.cast("string").alias("actual_value"),
        details.alias("details"),
    )
    return F.when(applies, row)


def _checks(rules: Rules, with_products: bool = False) -> list[Column]:
    n, previous = F.col("n"), F.col("previous_n")
    has_rows = n > 0
    checks = [
        _check(
            "has_data", "completeness", F.when(has_rows, PASS).otherwise(FAIL), "> 0", n,
            F.when(has_rows, _text("Found ", n, " records"))
            .otherwise(_text("No data found for ", F.col("check_date"))),
            F.lit(True),
        )
    ]
    for column in REQUIRED:
        nulls = F.col(f"null_{column}")
        checks.append(_check(
            f"{column}_null_rate", "completeness", _graded(ratio(nulls, n) * 100, rules.null_rate),
            f"< {rules.null_rate[0]:g}%", percent_text(nulls, n, 2),
            _text(nulls, " nulls out of ", n), has_rows,
        ))
    price = F.col("min_price")
    checks.append(_check(
        "price_positive", "accuracy", F.when(price >= 0, PASS).otherwise(FAIL), ">= 0", price,
        _text("Min price: ", price), has_rows & price.isNotNull(),
    ))
    for name, column, bad, expected, words in (
        ("valid_event_types", "invalid_types", FAIL, "0 invalid", " records with invalid event_type"),
        ("timestamp_in_range", "out_of_range", WARN, "0 out of range", " records outside target date"),
    ):
        found = F.col(column)
        checks.append(_check(
            name, "accuracy", F.when(found == 0, PASS).otherwise(bad), expected, found,
            _text(found, words), has_rows,
        ))
    copies = F.col("duplicates")
    checks.append(_check(
        "duplicate_events", "consistency", _graded(ratio(copies, n) * 100, rules.duplicate_rate),
        f"< {rules.duplicate_rate[0]:g}%", percent_text(copies, n, 2),
        _text(copies, " duplicate event_ids"), has_rows,
    ))
    missing, purchases = F.col("purchases_without_amount"), F.col("purchases")
    checks.append(_check(
        "purchase_has_amount", "consistency", F.when(missing == 0, PASS).otherwise(FAIL),
        "0 missing", missing, _text(missing, "/", purchases, " purchases missing amount"),
        has_rows & (purchases > 0),
    ))
    if with_products:
        orphans = F.col("orphans")
        checks.append(_check(
            "known_products", "consistency", _graded(ratio(orphans, n) * 100, rules.orphan_rate),
            f"< {rules.orphan_rate[0]:g}%", percent_text(orphans, n, 2),
            _text(orphans, " events of ", F.col("orphan_products"), " unknown products"), has_rows,
        ))
    change = n - previous
    checks.append(_check(
        "volume_change", "freshness",
        F.when(F.abs(ratio(change, previous) * 100) < rules.volume_change, PASS).otherwise(WARN),
        f"< {rules.volume_change:g}% change", percent_text(change, previous, 1),
        _text("Today: ", n, ", Yesterday: ", previous), F.coalesce(previous > 0, F.lit(False)),
    ))
    return checks


def quality_checks(
    events: DataFrame,
    day: str | None = None,
    rules: Rules = Rules(),
    roles: EventRoles = EventRoles(),
    table_name: str = "events",
    arrival: str | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """Checks of one day, or of every calendar day from the first to the last.

    A check that does not apply (no purchases, no day before, no product table) has no row.
    """
    if day is None:
        days = with_missing_days(quality_profile(events, roles, arrival, products), "event_date")
    else:
        target = F.lit(day).cast("date")
        before = F.date_sub(target, 1)
        read = F.col("event_date").between(before, target)
        if arrival:
            read = read | (F.col("event_date").isNull() & F.col(arrival).between(before, target))
        figures = quality_profile(events.filter(read), roles, arrival, products)
        asked = events.sparkSession.range(1).select(F.explode(F.array(before, target)).alias("event_date"))
        days = asked.join(figures, "event_date", "left")
    counted = days.withColumn("n", F.coalesce("n", F.lit(0)))
    judged = with_previous_day(counted, "event_date", ["n"]).withColumnRenamed("event_date", "check_date")
    if day is not None:
        judged = judged.filter(F.col("check_date") == F.lit(day).cast("date"))
    each = judged.select("check_date", F.explode(F.array_compact(F.array(*_checks(rules, products is not None)))).alias("c"))
    return each.select("check_date", F.lit(table_name).alias("table_name"), "c.*")


def quality_report(checks: DataFrame) -> DataFrame:
    """Checks per status, with their share of all checks of the day."""
    counted = checks.groupBy("check_date").agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in (PASS, WARN, FAIL)],
    )
    return counted.withColumns({
        f"{s.lower()}_pct": percent(F.col(s.lower()), F.col("total"), 1).cast("double")
        for s in (PASS, WARN, FAIL)
    })


def quality_gate(checks: DataFrame) -> None:
    """Stop the caller when any check failed; the message counts all and names the first twenty."""
    failed = checks.filter(F.col("status") == FAIL)
    count = failed.count()
    if count:
        named = failed.orderBy("table_name", "check_name").select("table_name", "check_name", "details").take(20)
        lines = [f"{r.table_name}.{r.check_name}: {r.details}" for r in named]
        lines += [f"and {count - len(named)} more"] if count > len(named) else []
        raise QualityGateError(f"{count} checks failed: {'; '.join(lines)}")
