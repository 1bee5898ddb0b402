"""Job settings and the shared folder that written tables live in."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from somnolake.sources.csv import FREE_TEXT_SOURCES

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster, or below its warehouse."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so never overwritten."""
    return f"{shared_folder(spark)}/somnolake/{name}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class WarehouseConfig:
    """Where to read from, where to write to, and which corrections are wanted.

    The defaults reproduce the documented results; each correction is opt-in.
    """

    source_dir: str
    root: str
    prefix: str = ""
    # source name -> file name, for files not called "<source>.csv"
    files: Mapping[str, str] = field(default_factory=dict)
    # "raise" stops with the error; "stop_quiet" logs it and skips the later steps
    on_error: str = "raise"
    # join each observation to at most one row per patient key
    dedup: bool = False
    # write midpoint keys as "22" rather than "22.0", so that they meet numeric keys
    numeric_midpoint: bool = False
    # sources read with line breaks inside quotes; quotes must enclose whole fields
    multi_line: Collection[str] = FREE_TEXT_SOURCES
    # silver tables whose raw rows are taken once where they repeat in every column
    drop_repeats: Collection[str] = ()
    # silver table -> column -> closed range; other rows go to "<table>_rejected"
    ranges: Mapping[str, Mapping[str, tuple[float, float]]] = field(default_factory=dict)
    # joined rows that one task should write at most; keys with more are cut into pieces
    rows_a_task: int = 5_000_000
    # also load "hypertension_imputed", with a mark on each value that the load fills
    imputed_flags: bool = False
    # versions of a table that a load leaves, the new one included; None deletes nothing
    keep_versions: int | None = None

    def __post_init__(self) -> None:
        if self.on_error not in ("raise", "stop_quiet"):
            raise ValueError(f"on_error must be 'raise' or 'stop_quiet', not {self.on_error!r}")
        if self.keep_versions is not None and self.keep_versions < 1:
            raise ValueError(f"keep_versions must be 1 or more, not {self.keep_versions}")

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def source_path(self, name: str) -> str:
        return f"{self.source_dir}/{self.files.get(name, name + '.csv')}"
