"""Figures about stored records.

Frames hold exact counts and sums; ratios are left unrounded there. The reports at the end collect those
few rows and round on the driver, half to even on the exact value, as reports always did.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOKEN_FIELDS = ("prompt_tokens", "completion_tokens", "total_tokens")
GROUPS = {"judge_type": "judge_type", "judge_backend": "judge_backend", "judge_status": "judge_status", "finish_reason": "generation_finish_reason"}
MATH_BACKENDS = ("math_verify", "math_rule")


def named(column: str) -> Column:
    """Null and empty values under one name."""
    return F.coalesce(F.when(F.col(column) != "", F.col(column)), F.lit("none"))


def correct() -> Column:
    return F.col("is_correct").eqNullSafe(True)


def fallback_reason() -> Column:
    reason = F.get_json_object("judge_detail", "$.verify_fallback_reason")
    return F.when(reason != "", reason)


def breakdown(records: DataFrame) -> DataFrame:
    """(facet, value, n, n_correct, n_false): all of the report's counts in one pass and one small shuffle.

    Every record is told apart once by its few categories; only those combinations are spread over the facets.
    """
    cells = records.select(
        *[named(c).alias(k) for k, c in GROUPS.items()], fallback_reason().alias("fallback_reason"), F.when(correct(), "true").when(F.col("is_correct").eqNullSafe(False), "false").otherwise("none").alias("correct")
    )
    cells = cells.groupBy(*cells.columns).agg(F.count(F.lit(1)).alias("n"))
    facets = [*GROUPS, "fallback_reason", "correct"]
    spread = cells.select("n", "correct", F.explode(F.array(F.struct(F.lit("total").alias("facet"), F.lit("all").alias("value")), *[F.struct(F.lit(f).alias("facet"), F.col(f).alias("value")) for f in facets])).alias("x"))
    yes, no = (F.coalesce(F.sum(F.when(F.col("correct") == v, F.col("n"))), F.lit(0)) for v in ("true", "false"))
    return spread.where("x.value is not null").groupBy(F.col("x.facet").alias("facet"), F.col("x.value").alias("value")).agg(F.sum("n").alias("n"), yes.alias("n_correct"), no.alias("n_false"))


def overall(records: DataFrame) -> DataFrame:
    """One row: total, n_true, n_false, n_none and accuracy over the verdicts that are not null."""
    row = records.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(correct()).alias("n_true"),
        F.count_if(F.col("is_correct").eqNullSafe(False)).alias("n_false"),
        F.count_if(F.col("is_correct").isNull()).alias("n_none"),
    )
    return row.withColumn("accuracy", percent(F.col("n_true"), F.col("n_true") + F.col("n_false")))


def percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(F.lit(100.0) * part, whole), F.lit(0.0))


def counts_by(records: DataFrame, column: str) -> DataFrame:
    return records.groupBy(named(column).alias(column)).agg(F.count(F.lit(1)).alias("n"))


def backend_accuracy(records: DataFrame) -> DataFrame:
    """Accuracy by judge backend, over all its records, those without a verdict included."""
    by = records.groupBy(named("judge_backend").alias("judge_backend")).agg(F.count_if(correct()).alias("n_correct"), F.count(F.lit(1)).alias("total"))
    return by.withColumn("accuracy", percent(F.col("n_correct"), F.col("total")))


def overlong(records: DataFrame) -> DataFrame:
    """Records cut off by length, and how many of them are correct."""
    long = F.col("generation_finish_reason").eqNullSafe("length")
    row = records.agg(F.count(F.lit(1)).alias("total"), F.count_if(long).alias("overlong_total"), F.count_if(long & correct()).alias("overlong_correct"))
    return row.select("overlong_total", percent(F.col("overlong_total"), F.col("total")).alias("overlong_ratio"), "overlong_correct", percent(F.col("overlong_correct"), F.col("overlong_total")).alias("overlong_accuracy"))


def math_backends(records: DataFrame) -> DataFrame:
    row = records.agg(*[F.count_if(F.col("judge_backend").eqNullSafe(b)).alias(f"{b}_total") for b in MATH_BACKENDS])
    total = F.col("math_verify_total") + F.col("math_rule_total")
    return row.select(total.alias("math_total"), "math_verify_total", "math_rule_total", *[percent(F.col(f"{b}_total"), total).alias(f"{b}_ratio") for b in MATH_BACKENDS])


def fallback_reasons(records: DataFrame) -> DataFrame:
    return records.groupBy(fallback_reason().alias("reason")).agg(F.count(F.lit(1)).alias("n")).where("reason is not null")


def token_value(column: str) -> Column:
    """A whole number, or null for what can't be read as one."""
    return F.col(column).try_cast("long")


def token_sums(records: DataFrame, only_correct: bool = False, fields: tuple[str, ...] = TOKEN_FIELDS, by: tuple[str, ...] = ()) -> DataFrame:
    """One row, or one for each value of the columns by: record_count, counted_records and, for each field, how many
    values it has and their sum.

    Counts and sums of parts add up to those of the whole, so increments can be merged.
    """
    counted = correct() if only_correct else F.lit(True)
    values = {f: F.when(counted, token_value(f)) for f in fields}
    return records.groupBy(*by).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(counted).alias("counted_records"),
        *[F.count(v).alias(f"{f}_count") for f, v in values.items()],
        *[F.coalesce(F.sum(v), F.lit(0)).alias(f"{f}_sum") for f, v in values.items()],
    )


def merge_token_sums(parts: DataFrame) -> DataFrame:
    return parts.agg(*[F.sum(c).alias(c) for c in parts.columns])


def with_averages(sums: DataFrame, fields: tuple[str, ...] = TOKEN_FIELDS) -> DataFrame:
    return sums.withColumns({f"{f}_avg": F.try_divide(F.col(f"{f}_sum").cast("double"), F.col(f"{f}_count")) for f in fields})


def last_latencies(requests: DataFrame, window: int = 5000) -> DataFrame:
    """The last ``window`` requests by finished (ties by request_id): a bounded report by its own definition."""
    return requests.orderBy(F.col("finished").desc(), F.col("request_id").desc()).limit(window)


def latency_percentiles(requests: DataFrame, window: int = 5000, percents: tuple[int, ...] = (50, 95, 99)) -> DataFrame:
    """Count, mean and nearest-rank percentiles (ranks rounded half to even) of the last latencies."""
    last = last_latencies(requests, window).agg(F.sort_array(F.collect_list("latency")).alias("v"))
    n = F.size("v")
    at = lambda p: F.try_element_at("v", (F.bround(F.lit(p) / F.lit(100.0) * (n - 1)) + 1).cast("int"))
    mean = F.try_divide(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), n)
    return last.select(n.cast("long").alias("n"), F.coalesce(mean, F.lit(0.0)).alias("avg_latency"), *[F.when(n > 0, at(p)).otherwise(0.0).alias(f"p{p}_latency") for p in percents])


def sliding_latency(requests: DataFrame, by: str, window: int = 5000) -> DataFrame:
    """The mean over each request and those before it, at most ``window``, for each value of by."""
    w = Window.partitionBy(by).orderBy("finished", "request_id").rowsBetween(-(window - 1), 0)
    return requests.withColumns({"window_count": F.count("latency").over(w), "window_avg": F.avg("latency").over(w)})


def port_counts(requests: DataFrame) -> DataFrame:
    return requests.groupBy("port").agg(F.count_if("ok").alias("success"), F.count_if(~F.col("ok")).alias("failed"))


def assigned_port(request_id: Column, ports: list[int]) -> Column:
    """Ports in turn."""
    return F.element_at(F.array(*map(F.lit, ports)), (F.pmod(request_id, F.lit(len(ports))) + 1).cast("int"))


def summary(records: DataFrame) -> dict[str, Any]:
    """The report over all records; a few dozen rows of counts reach the driver."""
    rows = breakdown(records).collect()
    facet = lambda f: {r["value"]: r["n"] for r in rows if r["facet"] == f}
    long = next((r for r in rows if r["facet"] == "finish_reason" and r["value"] == "length"), None)
    pct = lambda a, b: round(100.0 * a / b, 4) if b else 0.0
    verdicts, total = facet("correct"), sum(facet("total").values())
    true, backends = verdicts.get("true", 0), facet("judge_backend")
    checked, ruled = (backends.get(b, 0) for b in MATH_BACKENDS)
    n_long, good_long = (long["n"], long["n_correct"]) if long else (0, 0)
    return {
        "total_records": total,
        **{f"{k}_counts" if k != "finish_reason" else "generation_finish_reason_counts": facet(k) for k in GROUPS},
        "correct_counts": verdicts,
        "overall_accuracy": pct(true, true + verdicts.get("false", 0)),
        "overlong_summary": {"overlong_total": n_long, "overlong_ratio": pct(n_long, total), "overlong_correct": good_long, "overlong_accuracy": pct(good_long, n_long)},
        "backend_accuracy": {r["value"]: {"correct": r["n_correct"], "total": r["n"], "accuracy": pct(r["n_correct"], r["n"])} for r in rows if r["facet"] == "judge_backend"},
        "math_backend_summary": {
            "math_total": checked + ruled,
            "math_verify_total": checked,
            "math_rule_total": ruled,
            "math_verify_ratio": pct(checked, checked + ruled),
            "math_rule_ratio": pct(ruled, checked + ruled),
        },
        "math_verify_fallback_reasons": facet("fallback_reason"),
    }


def average_tokens(records: DataFrame, only_correct: bool = False) -> dict[str, Any]:
    row = token_sums(records, only_correct).first()
    count, total = ({f: row[f"{f}_{k}"] for f in TOKEN_FIELDS} for k in ("count", "sum"))
    return {
        "record_count": row["record_count"],
        "counted_records": row["counted_records"],
        "non_null_counts": count,
        "sums": total,
        "averages": {f: round(total[f] / count[f], 4) if count[f] else None for f in TOKEN_FIELDS},
    }
