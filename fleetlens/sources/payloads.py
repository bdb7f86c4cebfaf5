"""Payload documents: one nested JSON object per account, region, day and interval."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.casting import cast_text, joined_list
from fleetlens.schemas import TABLES

# Sections of a document; the first twelve must be present.
REQUIRED_SECTIONS = (
    "account config service cost security inventory marketplace trusted_advisor health application resilience_hub logs"
).split()
SECTIONS = (
    *REQUIRED_SECTIONS,
    *"service_resources compute_optimizer ri_sp_savings config_inventory support_tickets alarms canaries error_logs "
    "db_insights incidents".split(),
)
PATH_PATTERN = r"([^/]+)/([^/]+)/(\d{4}-\d{2}-\d{2})_([^/]+)\.json$"

#: Order in which documents and their records apply.
ORDER = ("_date", "_path", "_pos")


def parse_payloads(raw: DataFrame, sections: Iterable[str] = SECTIONS) -> DataFrame:
    """Columns of a document from its ``value`` text and ``file_path``.

    Each section stays raw JSON text here, so a load parses only the sections
    it needs and one malformed section does not spoil the others.  ``sections``
    names those to be columns; ``account`` always is one.  A generator hands the
    parsed text on: no filter or column after it makes Spark parse it again.
    """
    sections = tuple(dict.fromkeys(("account", *sections)))
    kinds = ", ".join(f"`{s}` string" for s in sections)
    part = lambda i: F.regexp_extract("file_path", PATH_PATTERN, i)
    once = F.array(F.struct(F.json_object_keys("value").alias("_keys"), F.from_json("value", kinds).alias("_doc")))
    return (
        raw.select("file_path", F.explode(once).alias("_once"))
        .select(
            F.col("file_path").alias("_path"),
            part(1).alias("path_account"),
            part(2).alias("path_region"),
            F.try_to_timestamp(part(3)).cast("date").alias("_date"),
            part(4).alias("path_interval"),
            F.col("_once._keys").alias("_keys"),
            *[F.col(f"_once._doc.{s}").alias(s) for s in sections],
        )
        .withColumn("_account", F.get_json_object("account", "$.account_id"))
        .withColumn("_region", F.coalesce(F.get_json_object("account", "$.region"), F.lit("")))
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Every pending document under ``path``; one row per file.

    Path fields come from the files' own metadata.  A column that is not asked
    for is not parsed out of the text, but each file is read whole.
    """
    raw = (
        spark.read.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .load(path)
    )
    return parse_payloads(raw.select("value", F.col("_metadata.file_path").alias("file_path")))


def write_payloads(documents: DataFrame, root: str) -> int:
    """One file per row of ``documents`` (file_path below ``root``, value); returns how many.

    Tasks write the files where they hold the rows.  A file appears under its
    name only when it is whole: it is written under a hidden name first, which
    scans and streams pass over.  A repeated task writes the same files again, so
    nothing doubles.  Any store that Arrow's file systems know will do.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(root)
        made: set[str] = set()
        for batch in batches:
            for path, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                place = posixpath.join(base, path)
                folder, name = posixpath.split(place)
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                draft = posixpath.join(folder, f".{name}.{uuid.uuid4().hex}")
                with store.open_output_stream(draft) as out:
                    out.write((value or "").encode())
                store.move(draft, place)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["files"])

    written = documents.select("file_path", "value").mapInArrow(write, "files long")
    return written.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]


def validate_payloads(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); a rejected document carries the reason.

    Valid documents hold all required sections, empty or not, and name their
    account: a document without one is not charged to another account.
    """
    missing = F.array_except(F.array(*[F.lit(s) for s in REQUIRED_SECTIONS]), F.col("_keys"))
    reason = (
        F.when(F.col("_keys").isNull(), "not a JSON object")
        .when(F.size(missing) > 0, F.concat(F.lit("missing sections: "), F.array_join(missing, ", ")))
        .when(F.col("_account").isNull(), "no account")
    )
    judged = payloads.withColumn("_reason", reason)
    valid = judged.filter(F.col("_reason").isNull()).drop("_reason")
    return valid, judged.filter(F.col("_reason").isNotNull())


_CARRY = ("_path", "_date", "_account", "_region")


def _ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{name}`: {kind}" for name, kind in fields.items())


def explode_section(payloads: DataFrame, path: str, fields: dict[str, str]) -> DataFrame:
    """Records of a section as rows, with the account's natural key and their position.

    ``path`` is a section or ``section.part``.  ``fields`` gives the type of
    each wanted field; a section that is one object counts as one record.
    """
    section, _, part = path.partition(".")
    text = F.get_json_object(section, f"$.{part}") if part else F.col(section)
    records = F.from_json(text, f"array<struct<{_ddl(fields)}>>")
    rows = payloads.filter(F.col(section).isNotNull()).select(*_CARRY, F.posexplode(records).alias("_pos", "_record"))
    # a section that should hold an object but is empty or of another shape yields nothing
    return rows.filter(F.col("_record").isNotNull()).select(*_CARRY, "_pos", "_record.*")


def explode_children(records: DataFrame, column: str, keep: dict[str, str]) -> DataFrame:
    """Nested array of each record as rows; ``keep`` maps parent columns to output names.

    The child's place inside the parent extends the record position.
    """
    child = records.select(
        "_path",
        "_date",
        "_account",
        "_region",
        F.col("_pos").alias("_parent_pos"),
        *[F.col(src).alias(out) for src, out in keep.items()],
        F.posexplode(column).alias("_child_pos", "_child"),
    )
    carried = ["_path", "_date", "_account", "_region", *keep.values()]
    return child.filter(F.col("_child").isNotNull()).select(
        *carried, F.struct("_parent_pos", "_child_pos").alias("_pos"), "_child.*"
    )


def text_fields(*names: str, **nested: str) -> dict[str, str]:
    return {**dict.fromkeys(names, "string"), **nested}


#: Not filled from a record's own fields.
_GENERATED = frozenset(
    "id account_id created_at updated_at cost_report_id security_id log_id config_report_id alarm_id canary_id".split()
)


def loaded_columns(table: str) -> list[str]:
    """Columns a record may fill."""
    return [c for c in TABLES[table].columns if c not in _GENERATED]


def project_cast(
    records: DataFrame,
    table: str,
    renames: dict[str, str] | None = None,
    constants: dict[str, object] | None = None,
    columns: list[str] | None = None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Whitelisted columns cast by name; everything else in the record is dropped.

    ``renames`` maps a table column to the record field it comes from,
    ``constants`` fixes a column, ``extra`` passes helper columns through.
    """
    renames, constants, extra = renames or {}, constants or {}, extra or {}
    spec = TABLES[table].columns
    out = []
    for name in columns or loaded_columns(table):
        dtype = spec[name]
        if name in constants:
            out.append(F.lit(constants[name]).cast(dtype).alias(name))
            continue
        source = renames.get(name, name)
        if source not in records.columns:
            continue
        col = F.col(source)
        if name == "usage_types":
            col = joined_list(col)
        out.append(cast_text(col, dtype).alias(name))
    return records.select(*_CARRY, "_pos", *out, *[c.alias(n) for n, c in extra.items()])
