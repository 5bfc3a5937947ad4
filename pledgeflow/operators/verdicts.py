"""Judged batches: the batch's rows plus ``reason``, NULL on rows that pass."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow.session import working_folder


class Outcome(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNull()).drop("reason")


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNotNull())


def held(judged: DataFrame) -> DataFrame:
    """A judged batch stored in the shared folder, so that whatever reads it does not judge again."""
    folder = working_folder(judged.sparkSession, "judged")
    judged.write.parquet(folder)
    return judged.sparkSession.read.schema(judged.schema).parquet(folder)


def apply_policy(judged: DataFrame, strict: bool = False, stored: bool = False) -> Outcome:
    """Split a judged batch into accepted and rejected rows.

    By default bad rows are set aside and the rest goes on. With ``strict`` one
    bad row refuses the whole batch; that needs the answer now, so the judged batch is stored
    in the shared folder and both outcomes are read from there: the rules run once. ``stored`` says that it
    is read from stored files already (see ``held``).
    """
    if strict and not stored:
        judged = held(judged)
    bad = rejected(judged)
    good = accepted(judged)
    if strict and not bad.isEmpty():
        return Outcome(good.filter(F.lit(False)), bad)
    return Outcome(good, bad)


def write_judged(judged: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store both outcomes in one pass, as ``path/verdict=accepted|rejected``."""
    verdict = F.when(F.col("reason").isNull(), "accepted").otherwise("rejected")
    judged.withColumn("verdict", verdict).write.mode(mode).partitionBy("verdict").parquet(path)
