"""Batch jobs over conversation and message tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import texts
from shiftloom.functions.times import interval
from shiftloom.operators.ordered import row_numbers


def message_order(messages: DataFrame) -> DataFrame:
    """Position of each message in its conversation, by creation time.

    Messages without a time come first; those without a conversation are one of their
    own. Rows are numbered by conversation and time bucket, so a conversation may hold any
    share of all messages.
    """
    return row_numbers(messages, ["thread_id"], "created_at", "turn", "position")


def titles(messages: DataFrame) -> DataFrame:
    """Title of each conversation from its first user message."""
    first = F.min_by("text", F.struct("created_at", "turn"))
    return (
        messages.where(F.col("role") == "user")
        .groupBy("thread_id")
        .agg(first.alias("text"))
        .select("thread_id", texts.clip_title(F.col("text")).alias("title"))
    )


def thread_index(threads: DataFrame, user: str | None = None) -> DataFrame:
    """Active conversations, of one user or of each user, newest first."""
    kept = threads.where("active") if user is None else threads.where(F.col("active") & (F.col("user_name") == user))
    return kept.select("user_name", "thread_id", "title", "created_at").orderBy(
        "user_name", F.desc("created_at"), "thread_id"
    )


def image_list(images: Column) -> Column:
    """Links held as a JSON array; missing or bad JSON is an empty list."""
    parsed = F.from_json(images, "array<string>", {"mode": "PERMISSIVE"})
    return F.coalesce(F.filter(parsed, lambda x: x.isNotNull()), F.array().cast("array<string>"))


def thread_history(messages: DataFrame, hide_system: bool = True) -> DataFrame:
    """Transcript in order, images parsed, without the hidden system messages."""
    kept = messages.where(~texts.is_system_message(F.col("text"))) if hide_system else messages
    return kept.select("thread_id", "turn", "created_at", "role", "text", image_list(F.col("images")).alias("images")).orderBy(
        "thread_id", "created_at", "turn"
    )


def retention(threads: DataFrame, messages: DataFrame, now: Column, days: int = 30) -> tuple[DataFrame, DataFrame]:
    """Conversations and messages that stay when those older than ``days`` go.

    A message whose conversation goes, goes with it.
    """
    expired = threads.where(F.col("created_at") < now - interval(days, "day")).select("thread_id")
    return threads.join(expired, "thread_id", "left_anti"), messages.join(expired, "thread_id", "left_anti")


def new_threads(existing: DataFrame, messages: DataFrame, user_name: Column) -> DataFrame:
    """Conversations to insert: those of the new messages that are not stored yet.

    A conversation without a user message has an empty title.
    """
    begun = messages.groupBy("thread_id").agg(F.min("created_at").alias("created_at"))
    return (
        begun.join(existing.select("thread_id"), "thread_id", "left_anti")
        .join(titles(messages), "thread_id", "left")
        .select("thread_id", user_name.alias("user_name"), F.coalesce("title", F.lit("")).alias("title"), "created_at", F.lit(True).alias("active"))
    )


def intent(messages: DataFrame) -> DataFrame:
    text = F.col("text")
    return messages.withColumns(
        {
            "greeting": texts.is_greeting(text),
            "asks_kpi": texts.asks_kpi(text),
            "realtime": texts.asks_realtime(text),
            "looks_like_sql": texts.looks_like_sql(text),
            "bad_object": texts.reports_bad_object(text),
        }
    )


def plot_links(messages: DataFrame) -> DataFrame:
    """Chart links of each message, each path once in order of first mention, captions, and the text without them."""
    text = F.col("text")
    links = F.transform(
        texts.plot_links(text),
        lambda link: F.struct(texts.plot_path(link).alias("path"), texts.plot_caption(text, link, texts.plot_path(link)).alias("caption")),
    )
    once = F.filter(
        "_links",
        lambda link, i: F.array_position(F.transform("_links", lambda other: other["path"]), link["path"]) == i + 1,
    )
    return (
        messages.withColumn("_links", links)
        .withColumn("_links", once)
        .withColumns(
            {
                "paths": F.transform("_links", lambda link: link["path"]),
                "captions": F.transform("_links", lambda link: link["caption"]),
                "clean_text": texts.without_plot_links(text),
            }
        )
        .drop("_links")
    )
