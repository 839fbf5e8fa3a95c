"""Committed artefacts: folders written by tasks, progress and failures by run, metas edited in place.

A file appears under its name by one rename, and ``meta.json`` comes last: a folder without it is no artefact
(A3 skips it), so that file is the commit marker of a spec. A task that is run again, or twice at once, finds the marker or
replaces files by equal ones. Logs are folders ``run=<name>``, overwritten by a repeated run of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import files as FS

# File names per kind of artefact; the meta last.
TEMPLATE_FILES = {"html": "index.html", "css": "style.css", "meta": "meta.json"}
EFFECT_FILES = {"css": "effect.css", "meta": "meta.json"}
INDENT = 2


def set_member(meta: str, name: str, value) -> Column:
    """The JSON object ``meta`` with member ``name`` set to ``value``: other members, their order and their values stay, a
    new member comes last; indented as a meta file. Null for null and for text that is no JSON object."""

    @F.pandas_udf("string")
    def edit(column):
        import json

        def one(text):
            try:
                data = json.loads(text)
            except (TypeError, ValueError):
                return None
            if not isinstance(data, dict):
                return None
            data[name] = value
            return json.dumps(data, indent=INDENT)

        return column.map(one)

    return edit(F.col(meta))


def _put(fs, folder: str, name: str, content: str) -> None:
    """Write under a name of its own, then rename: readers see the whole file or none."""
    import uuid

    attempt = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(attempt) as out:
        out.write(content.encode("utf-8"))
    fs.move(attempt, f"{folder}/{name}")


def commit_tree(df: DataFrame, root: str, group: str, files: dict[str, str] = TEMPLATE_FILES, replace: bool = False) -> DataFrame:
    """A4 by the tasks: ``root/<group>/<spec_id>/`` with one file per column of ``files`` (null content: no file), the meta
    indented. A spec whose meta file exists stays as it is unless ``replace``. Rows (id, folder, written); run it by
    writing them."""
    from tessera.sources.archive import _resolve

    def write(batches):
        import json

        import pyarrow as pa
        from pyarrow import fs as pafs

        fs, base = _resolve(root)
        for batch in batches:
            ids, folders, written = [], [], []
            for row in batch.to_pylist():
                folder = f"{row['_group']}/{row['spec_id']}"
                marker = f"{base}/{folder}/{files['meta']}"
                todo = replace or fs.get_file_info(marker).type == pafs.FileType.NotFound
                if todo:
                    fs.create_dir(f"{base}/{folder}", recursive=True)
                    for column, name in files.items():
                        content = row[column]
                        if content is not None:
                            _put(fs, f"{base}/{folder}", name, json.dumps(json.loads(content), indent=INDENT) if column == "meta" else content)
                ids.append(row["spec_id"])
                folders.append(folder)
                written.append(todo)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(folders, pa.string()), pa.array(written, pa.bool_())], ["id", "folder", "written"])

    return df.select(F.col(group).alias("_group"), "spec_id", *files).mapInArrow(write, "id string, folder string, written boolean")


def replace_metas(df: DataFrame, root: str) -> DataFrame:
    """Replace ``root/<path>/meta.json`` by ``new_meta`` (path, new_meta), each by one rename. Rows (path); run it by writing
    them. ``df`` must be a written table, not a plan that still reads the tree."""
    from tessera.sources.archive import _resolve

    def write(batches):
        import pyarrow as pa

        fs, base = _resolve(root)
        for batch in batches:
            for row in batch.to_pylist():
                _put(fs, f"{base}/{row['path']}", TEMPLATE_FILES["meta"], row["new_meta"])
            yield pa.RecordBatch.from_arrays([batch.column("path")], ["path"])

    return df.select("path", "new_meta").mapInArrow(write, "path string")


def write_run(df: DataFrame, log: str, run: str) -> None:
    """The rows of one run; a repeated run of that name replaces them."""
    df.write.mode("overwrite").parquet(f"{log}/run={run}")


def read_runs(spark: SparkSession, log: str, schema: str) -> DataFrame:
    """All runs of a log, with ``run``; no log yet: no rows."""
    return FS.read_log(spark, log, f"{schema}, run string")


def ingest(spark: SparkSession, parsed, responses: DataFrame, root: str, run: str, group: str, files: dict[str, str], max_attempts: int, gave_up) -> DataFrame:
    """G5 with its sinks. ``responses`` (spec_id, ``group``, attempt, raw) hold the attempts at every spec.

    Specs in the progress log are left out (C1, A7). ``parsed`` maps the rest to (spec_id, ``group``, attempt, the columns
    of ``files``, err); of each spec the first attempt without err within ``max_attempts`` is committed to the tree (A4)
    and then logged as progress; a spec without one goes to the failure log with ``gave_up(last error)`` and the time
    (A8). A valid attempt's content travels once to its spec; invalid content never does.

    Returns the run's verdicts (spec_id, status, attempt_used, error), read back. A second run of the same responses
    saves nothing and meets only the failed specs again. Repeated rows of an attempt count once; a null ``spec_id``
    names no folder and is left out; null or empty ``raw`` is invalid JSON."""
    done = read_runs(spark, f"{root}/_progress", "id string").select(F.col("id").alias("spec_id")).distinct()
    todo = responses.where((F.col("attempt") <= max_attempts) & F.col("spec_id").isNotNull()).join(done, "spec_id", "left_anti")
    ok = F.when(F.col("err").isNull(), F.col("attempt"))
    best = parsed(todo).groupBy("spec_id").agg(
        F.min(ok).cast("long").alias("attempt_used"),
        F.max_by("err", F.when(F.col("err").isNotNull(), F.col("attempt"))).alias("_last"),
        F.min_by(F.when(F.col("err").isNull(), F.struct(F.col(group).alias("_to"), *files)), ok).alias("_got"),
    )
    verdicts = f"{root}/_verdicts/run={run}"
    best.select(
        "spec_id",
        F.when(F.col("attempt_used").isNull(), "failed").otherwise("saved").alias("status"),
        "attempt_used",
        F.when(F.col("attempt_used").isNull(), gave_up(F.col("_last"))).alias("error"),
        "_got.*",
    ).write.mode("overwrite").parquet(verdicts)
    judged = spark.read.parquet(verdicts)
    write_run(commit_tree(judged.where("status = 'saved'"), root, "_to", files), f"{root}/_progress", run)
    write_run(FS.failure_rows(judged.withColumnRenamed("spec_id", "id")), f"{root}/_failures", run)
    return judged.select("spec_id", "status", "attempt_used", "error")
