"""Raw records to written tables: unique accepted rows, day totals, features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark import spec
from tidemark.operators.accepted import derive_columns, unique_rows
from tidemark.operators.features import add_schedule_features
from tidemark.operators.history import Histories, attach_history, histories
from tidemark.operators.quality import quality_report
from tidemark.operators.splits import add_split
from tidemark.operators.staging import stage
from tidemark.sources.shared import save_shared


@dataclass(frozen=True)
class Prepared:
    quality: DataFrame
    histories: Histories
    featured: DataFrame


def prepare(raw: DataFrame, config: spec.RunConfig) -> Prepared:
    """The raw records are read and parsed once; every later step reads written Parquet columns.

    Staged rows, unique rows, day totals, histories and features go to the shared folder. Rows are
    shuffled once to remove copies, and once more for each entity whose history is too large to be
    broadcast. Staged rows stay beside the unique ones because the audit counts them.
    """
    columns = [*spec.IDENTITY, *spec.COPY_ORDER, "rejection_reason"]
    staged = save_shared(stage(raw, config.bounds).select(*columns), "staged")
    unique = save_shared(unique_rows(staged, written=True), "unique")
    quality = save_shared(quality_report(staged, unique), "quality")
    accepted = derive_columns(unique)
    found = histories(accepted, spec.ENTITIES, config.smoothing, save=save_shared)
    featured = add_schedule_features(attach_history(accepted, found, config.smoothing))
    featured = save_shared(add_split(featured, config.bounds), "featured", by=["split"])
    return Prepared(quality=quality, histories=found, featured=featured)
