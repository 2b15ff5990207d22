"""What a cluster is busy with: running and pending tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetaudit.functions import scalars as S

# Health-check actions hidden by default, and the widths texts are cut to.
NOISY_ACTIONS = ("cluster:monitor/", "indices:monitor/", "internal:")
DESCRIPTION_WIDTH = 80
SOURCE_WIDTH = 90


def running_tasks(
    tasks: DataFrame, show_all: bool = False, action_filter: str | None = None, scope: Sequence[str] = ()
) -> DataFrame:
    action = F.coalesce("action", F.lit(""))
    wanted = tasks
    if not show_all:
        wanted = wanted.filter(~S.starts_with_any(action, NOISY_ACTIONS))
    if action_filter:
        wanted = wanted.filter(F.contains(action, F.lit(action_filter)))
    millis = F.call_function("div", F.coalesce("running_time_in_nanos", F.lit(0)), F.lit(1_000_000))
    return wanted.select(
        *scope,
        "task_id",
        "node",
        action.alias("action"),
        S.duration_text(millis).alias("running_time"),
        millis.alias("running_ms"),
        F.col("parent_task_id").alias("parent_task"),
        S.ellipsis(F.coalesce("description", F.lit("")), DESCRIPTION_WIDTH).alias("description"),
    )


def longest_running_first(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("running_ms"), "task_id")


def pending_tasks(tasks: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return tasks.select(
        *scope,
        "insert_order",
        "priority",
        S.first_present(F.col("time_in_queue"), S.duration_text(F.col("time_in_queue_millis"))).alias("time_in_queue"),
        F.coalesce("time_in_queue_millis", F.lit(0)).alias("queue_ms"),
        S.ellipsis(F.coalesce("source", F.lit("")), SOURCE_WIDTH).alias("source"),
    )


def longest_waiting_first(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("queue_ms"), "insert_order")
