"""Aggregations. All are hash aggregates with map-side partial
aggregation, so a hot key is combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adspark.functions.text import truncate_with_ellipsis

#: Positions whose issues make one piece of text of ``feed_result_by_message`` with a ``limit``.
ISSUES_A_BIN = 256


def row_count(df: DataFrame, *, by=("_file",)) -> DataFrame:
    """A-01: rows per group (per file by default)."""
    return df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.count(F.lit(1)).alias("row_count"))


def distinct_stage(df: DataFrame) -> DataFrame:
    """A-06: exact duplicate rows removed before a merge."""
    return df.dropDuplicates()


def distinct_listing(df: DataFrame, *, sku: str = "seller-sku") -> DataFrame:
    """A-07: the set of live SKUs (non-blank)."""
    c = F.col(f"`{sku}`")
    return df.select(c.alias(sku)).filter(c.isNotNull() & (F.trim(c) != "")).distinct()


def feed_result_by_message(issues: DataFrame, *, group=("batch_id",), message: str = "messageId",
                           pos="pos", severity: str = "severity",
                           attribute: str = "attributeName", text: str = "message",
                           limit: int | None = None) -> DataFrame:
    """A-02: one row per message with issues: ``SUCCESS`` unless an issue has severity ``ERROR``;
    the error text joins ``attribute: message`` of the ERROR issues by ``'; '`` in issue order
    (``pos``; a list such as ``("feed_id", "pos")`` orders across documents), with
    ``Unknown attribute`` / ``No message`` defaults; blank on success.

    With ``limit`` a text above that many characters ends in ``...`` (``truncate_with_ellipsis``) and
    no group is collected whole, however many issues a message has (``_bounded_results``)."""
    order = [pos] if isinstance(pos, str) else list(pos)
    is_err = F.coalesce(F.col(severity) == "ERROR", F.lit(False))
    piece = F.concat(F.coalesce(F.col(attribute), F.lit("Unknown attribute")), F.lit(": "),
                     F.coalesce(F.col(text), F.lit("No message")))
    if limit is not None:
        return _bounded_results(issues, [*group, message], order, is_err, piece, limit)
    keys = [F.col(c) for c in group] + [F.col(message)]
    agg = issues.groupBy(*keys).agg(
        F.max(is_err.cast("int")).alias("_err"),
        F.sort_array(F.collect_list(F.when(is_err, F.struct(F.struct(*[F.col(o) for o in order]).alias("p"),
                                                            piece.alias("t"))))).alias("_parts"),
    )
    return agg.select(
        *group, message,
        F.when(F.col("_err") == 1, F.lit("ERROR")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.when(F.col("_err") == 1, F.array_join(F.col("_parts.t"), "; ")).otherwise(F.lit("")).alias("errorMessage"),
    )


def _bounded_results(issues: DataFrame, keys: list[str], order: list[str], is_err: Column, piece: Column, limit: int) -> DataFrame:
    """Issues are first joined to one text per bin of ``ISSUES_A_BIN`` positions (the last column of
    ``order``, a number that is unique within the others; NULL is a bin of its own), cut beyond
    ``limit``. Running lengths over a message's bins tell which bins begin within the limit; only
    those are collected, twice the limit at most. Bins that begin later cannot change the text."""
    *before, last = order
    names = [f"_o{i}" for i in range(len(before))] + ["_bin"]
    bins = issues.groupBy(*keys, *[F.col(b).alias(n) for b, n in zip(before, names, strict=False)], F.floor(F.col(last) / ISSUES_A_BIN).alias("_bin")).agg(
        F.max(is_err).alias("_err"),
        F.sort_array(F.collect_list(F.when(is_err, F.struct(F.col(last).alias("p"), F.substring(piece, 1, limit + 1).alias("t"))))).alias("_parts"))
    bins = bins.withColumn("_text", F.when(F.size("_parts") > 0, F.substring(F.array_join("_parts.t", "; "), 1, limit + 1))).drop("_parts")
    earlier = Window.partitionBy(*keys).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("_text") + 2).over(earlier), F.lit(0))
    kept = F.when((F.col("_begin") <= limit + 2) & F.col("_text").isNotNull(), F.struct(*names, "_text"))
    out = bins.withColumn("_begin", begin).groupBy(*keys).agg(F.max("_err").alias("_err"), F.sort_array(F.collect_list(kept)).alias("_texts"))
    return out.select(
        *keys, F.when(F.col("_err"), F.lit("ERROR")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.when(F.col("_err"), truncate_with_ellipsis(F.array_join("_texts._text", "; "), limit)).otherwise(F.lit("")).alias("errorMessage"))


def feed_summary(summaries: DataFrame, *, by=("seller_id", "batch_id"), processed: str = "messagesProcessed",
                 accepted: str = "messagesAccepted", invalid: str = "messagesInvalid") -> DataFrame:
    """A-03: totals over the feeds of a batch; ``completed`` when nothing failed, else
    ``completed_with_errors``."""
    out = summaries.groupBy(*by).agg(
        F.sum(F.coalesce(F.col(processed), F.lit(0))).cast("bigint").alias("total_messages"),
        F.sum(F.coalesce(F.col(accepted), F.lit(0))).cast("bigint").alias("successful_messages"),
        F.sum(F.coalesce(F.col(invalid), F.lit(0))).cast("bigint").alias("failed_messages"),
    )
    return out.withColumn("status", F.when(F.col("failed_messages") == 0, F.lit("completed"))
                          .otherwise(F.lit("completed_with_errors")))


def change_stats(annotated: DataFrame, *, by=()) -> DataFrame:
    """A-04: total, kept, filtered out, kept-and-changed (new or other hash), unchanged kept.

    ``annotated`` is the output of ``annotate_changes`` (every product with its ``reason``)."""
    kept = F.col("reason") != "unchanged"
    agg = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(kept).alias("kept"),
        F.count_if(~kept).alias("filtered_out"),
        F.count_if(kept & F.col("is_changed")).alias("changed"),
        F.count_if(kept & ~F.col("is_changed")).alias("unchanged_kept"),
    ]
    return annotated.groupBy(*by).agg(*agg) if by else annotated.agg(*agg)


def run_outcomes(results: DataFrame, *, status: str = "status") -> DataFrame:
    """A-05: sellers total / completed / error / no data; ``completed_with_errors`` counts in none
    of the last three."""
    s = F.col(status)
    return results.agg(
        F.count(F.lit(1)).alias("sellers_total"),
        F.count_if(s == "completed").alias("completed"),
        F.count_if(s == "error").alias("error"),
        F.count_if(s == "no_data").alias("no_data"),
    )
