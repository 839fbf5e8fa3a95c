"""File sources and sinks.

Every path is a folder the cluster can see (for intermediate tables: a folder
under ``spark.checkpoint.dir``, see ``tessera.session.scratch_path``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera.functions.fmt import fmt

LABELLED_SCHEMA = "text string, label string"

# The dataset card (Markdown) pieces, in output order.
CARD_HEAD = "# Classifier Training Data\n\n## Overview\n- Total: {total}\n- Generated: {generated}\n"
CARD_LINE = "- **{label}:** {n}\n"
CARD_TAIL = '\n## Format\n```json\n{"text": "user request", "label": "category"}\n```\n'


# ------------------------------------------------------------------ A1 / A2
def read_labelled(spark: SparkSession, path: str, schema: str = LABELLED_SCHEMA, missing_ok: bool = True) -> DataFrame:
    """A1: JSONL with a fixed schema; every line must parse (FAILFAST). A missing
    path means "no existing data" -> empty table."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        if missing_ok and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def write_labelled(df: DataFrame, path: str) -> None:
    """A2: full replace. Write to a path other than the input (Spark reads lazily)."""
    df.select("text", "label").write.mode("overwrite").json(path)


# ------------------------------------------------------------------ A3 / A4
ARTEFACT_FILES = ("meta.json", "index.html", "style.css")


def write_catalogue(df: DataFrame, root: str, partition_col: str = "category") -> None:
    """A4, Spark-native: one row per artefact (spec id, meta, html, css) in a
    parquet table partitioned by category — no per-artefact small files."""
    df.select(partition_col, "spec_id", "meta", "html", "css").write.mode("overwrite").partitionBy(partition_col).parquet(root)


def read_catalogue(spark: SparkSession, root: str, partition_col: str = "category") -> DataFrame:
    t = spark.read.parquet(root)
    return t.withColumn("path", F.concat_ws("/", partition_col, "spec_id"))


def write_catalogue_tree(df: DataFrame, root: str, folder_cols=("category", "spec_id")) -> DataFrame:
    """A4, interchange layout: ``root/<category>/<spec id>/{meta.json,index.html,
    style.css}`` written by the tasks themselves (the folder comes from the spec,
    not from meta). Absent content -> no file. Returns (folder, n_files) rows."""
    from tessera.sources.archive import _resolve  # same URI handling as archives

    cols = [*folder_cols, "meta", "html", "css"]

    def write(batches):
        import pandas as pd

        fs, base = _resolve(root)
        out = []
        for pdf in batches:
            for row in pdf[cols].itertuples(index=False):
                folder = "/".join(str(getattr(row, c)) for c in folder_cols)
                fs.create_dir(f"{base}/{folder}", recursive=True)
                n = 0
                for name, content in zip(ARTEFACT_FILES, (row.meta, row.html, row.css)):
                    if content is not None:
                        with fs.open_output_stream(f"{base}/{folder}/{name}") as f:
                            f.write(content.encode("utf-8"))
                        n += 1
                out.append((folder, n))
        yield pd.DataFrame(out, columns=["folder", "n_files"])

    return df.select(*cols).mapInPandas(write, "folder string, n_files long")


FOLDERS_A_TASK = 500  # folders that one task lists and reads


def scan_catalogue_tree(spark: SparkSession, root: str, files: dict[str, str] | None = None) -> DataFrame:
    """A3: every ``meta.json`` under ``root`` (any depth) with the sibling
    ``index.html`` / ``style.css`` of its folder; ``path`` is the folder relative
    to the root. Folders without meta.json are not artefacts; names that start with ``_`` or ``.`` are not read. ``files`` maps other
    columns to other file names.

    Tasks list the folders, level by level, and read an artefact's files where they list it, so that the driver holds no
    listing. The artefacts are those of the time of the call, in a written table."""
    from tessera.session import scratch_path
    from tessera.sources.archive import _resolve

    files = files or dict(zip(("meta", "html", "css"), ARTEFACT_FILES))
    out = scratch_path(spark, "scan")
    fields = ", ".join(f"{c} binary" for c in files)

    def visit(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs

        fs, base = _resolve(root)
        schema = pa.schema([("folder", pa.string()), ("path", pa.string()), *((c, pa.binary()) for c in files)])

        def content(path):
            with fs.open_input_stream(path) as f:
                return f.read()

        rows, size = [], 0
        for folder in (x for batch in batches for x in batch.column(0).to_pylist()):
            at = f"{base}/{folder}".rstrip("/")
            found = {i.base_name: i.type for i in fs.get_file_info(pafs.FileSelector(at))}
            if folder and found.get(files["meta"]) == pafs.FileType.File:
                got = {c: content(f"{at}/{name}") if found.get(name) == pafs.FileType.File else None for c, name in files.items()}
                rows.append({"folder": None, "path": folder, **got})
                size += sum(len(x) for x in got.values() if x is not None)
            for name, kind in found.items():
                if kind == pafs.FileType.Directory and not name.startswith(("_", ".")):
                    rows.append({"folder": f"{folder}/{name}".lstrip("/"), "path": None})
                if len(rows) >= 1000 or size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    level, folders, n = 0, spark.range(1).select(F.lit("").alias("folder")), 1
    while n:
        dealt = folders.repartition(-(-n // FOLDERS_A_TASK), "folder")
        dealt.mapInArrow(visit, f"folder string, path string, {fields}").write.parquet(f"{out}/level={level}")
        folders = spark.read.parquet(f"{out}/level={level}").where("folder IS NOT NULL").select("folder")
        level, n = level + 1, folders.count()
    seen = spark.read.schema(f"path string, {fields}").parquet(*[f"{out}/level={i}" for i in range(level)])
    return seen.where("path IS NOT NULL").select("path", *[F.col(c).cast("string").alias(c) for c in files])


# ------------------------------------------------------------------ A7 / A8
def append_log(df: DataFrame, path: str) -> None:
    """Append-only log table (progress ids, failures with a timestamp)."""
    df.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def completed_ids(spark: SparkSession, path: str) -> DataFrame:
    """``{"completed": [...]}`` as a table; default empty."""
    return read_log(spark, path, "id string").distinct()


def failure_rows(df: DataFrame, id_col: str = "id", error_col: str = "error") -> DataFrame:
    """Rows with an error, stamped with the write time."""
    return df.where(F.col(error_col).isNotNull()).select(id_col, error_col, F.current_timestamp().alias("timestamp"))


# ------------------------------------------------------------------ A9 / A10
def write_lists(df: DataFrame, path: str, order: list[str]) -> None:
    """A9 for lists of any length: one JSON line per item, sorted over the part files (range-partitioned, so no list meets
    in one row, task or the driver)."""
    df.orderBy(*order).write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A one-row report (already aggregated) as a single JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def dataset_card(labelled: DataFrame, generated: str) -> DataFrame:
    """A10: Markdown card — total, generation stamp, label counts sorted by label,
    and the format example. One row, built from per-label counts (k rows)."""
    counts = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    lines = counts.agg(
        F.sum("n").alias("total"),
        F.array_sort(F.collect_list(F.struct("label", "n"))).alias("c"),
    )
    body = F.array_join(F.transform("c", lambda x: fmt(CARD_LINE, label=x["label"], n=F.format_number(x["n"], 0))), "")
    head = fmt(CARD_HEAD, total=F.format_number(F.coalesce("total", F.lit(0)), 0), generated=generated)
    card = F.concat(head, body, F.lit(CARD_TAIL))
    return lines.select(card.alias("card"))
