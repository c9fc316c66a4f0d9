"""Batch plans of the reference's jobs, built lazily from the test tables.

Each function returns a DataFrame; nothing is collected. The jobs meet
through typed frames here (no JSON round trip between them); the streaming
jobs in :mod:`tidemark.streaming.jobs` meet through topics instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.bounce import user_jump
from tidemark.operators.dim import config_state, parse_changes, parse_config_changes, route
from tidemark.operators.keyword import keyword_counts
from tidemark.operators.parse import parse_log
from tidemark.operators.split import TOPICS, fan_out, page_records
from tidemark.operators.unique import unique_visitor
from tidemark.operators.visitor import visitor_flag_repair
from tidemark.sources.fixtures import change_log, config_changelog, raw_log

ZONE = "UTC"


def parsed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_log(raw_log(spark, sf_dir))


def repaired_log(spark: SparkSession, sf_dir: str, zone: str = ZONE) -> DataFrame:
    return visitor_flag_repair(parsed_log(spark, sf_dir), zone)


def routed_log(spark: SparkSession, sf_dir: str, zone: str = ZONE, topics=TOPICS) -> DataFrame:
    """Log split job: ``(topic, seq, mid, value)`` for all six topics, or some."""
    return fan_out(repaired_log(spark, sf_dir, zone), topics)


def page_log(spark: SparkSession, sf_dir: str, repaired: bool = True,
             zone: str = ZONE) -> DataFrame:
    """The page topic, typed. ``repaired=False`` skips the flag repair for
    consumers that never read ``is_new`` (saves its aggregate and join)."""
    base = repaired_log(spark, sf_dir, zone) if repaired else parsed_log(spark, sf_dir)
    return page_records(base)


def unique_visitors(spark: SparkSession, sf_dir: str, zone: str = ZONE, keep=None) -> DataFrame:
    return unique_visitor(page_log(spark, sf_dir, True, zone), zone, keep)


def user_jumps(spark: SparkSession, sf_dir: str, within_ms: int = 10_000,
               zone: str = ZONE) -> DataFrame:
    return user_jump(page_log(spark, sf_dir, True, zone), within_ms)


def keyword_page_view_window(spark: SparkSession, sf_dir: str,
                             duration: str = "10 seconds", zone: str = ZONE,
                             with_ts: bool = True) -> DataFrame:
    return keyword_counts(page_log(spark, sf_dir, False, zone), duration, zone, with_ts)


# --- dimension routing -------------------------------------------------------

def dim_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_changes(change_log(spark, sf_dir))


def dim_config(spark: SparkSession, retire_renamed: bool = False) -> DataFrame:
    return config_state(parse_config_changes(config_changelog(spark)), retire_renamed)


def dim_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(dim_changes(spark, sf_dir), dim_config(spark))
