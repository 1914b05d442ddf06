"""Single files on any file system that Hadoop knows, and runs that appear all at once."""

from __future__ import annotations

import json

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from tenure.errors import DataQualityError
from tenure.operators.staging import staging_folder

MANIFEST = "current.json"
#: Bytes that are copied at a time.
BUFFER = 1 << 20


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """(file system, path) of a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another one in one step: readers see the old one or the new one."""
    jvm = spark._jvm
    system, to = file_system(spark, target)
    to = system.makeQualified(to)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark._sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(system.makeQualified(file_system(spark, source)[1]), to, how)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A short text as one file, in place of a former one."""
    system, draft = file_system(spark, f"{path}.draft")
    out = system.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    replace_file(spark, f"{path}.draft", path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A short text file, None where there is none."""
    system, target = file_system(spark, path)
    if not system.exists(target):
        return None
    source = system.open(target)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def write_document(lines: DataFrame, path: str) -> None:
    """Write (section, position, value) lines, in that order, as one text file.

    Spark sorts them and writes sorted parts next to the other intermediates. The parts are then
    copied one after the other through a buffer, so a document of any length takes constant
    memory, and the file appears under its name when it is complete.
    """
    spark = lines.sparkSession
    parts = f"{staging_folder(spark)}/document-{spark._jvm.java.util.UUID.randomUUID().toString()}"
    lines.orderBy("section", "position").select("value").write.text(parts)
    system, folder = file_system(spark, parts)
    try:
        names = sorted(s.getPath().toString() for s in system.listStatus(folder) if s.getPath().getName().startswith("part-"))
        target_system, draft = file_system(spark, f"{path}.draft")
        out = target_system.create(draft, True)
        try:
            for name in names:
                source = system.open(spark._jvm.org.apache.hadoop.fs.Path(name))
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, BUFFER, False)
                finally:
                    source.close()
        finally:
            out.close()
    finally:
        system.delete(folder, True)
    replace_file(spark, f"{path}.draft", path)


# --- runs ------------------------------------------------------------------------------------


def new_run(output_path: str, run_id: str) -> str:
    """Folder of a run that is not published yet."""
    return f"{output_path}/runs/{run_id}"


def publish(spark: SparkSession, output_path: str, run_id: str) -> None:
    """Make a complete run the current one, by one rename of the manifest.

    The run before it is kept, so that readers who opened it can go on; the one before that is
    removed. A run that was killed leaves its folder and changes nothing else.
    """
    manifest = f"{output_path}/{MANIFEST}"
    former = json.loads(read_text(spark, manifest) or "{}")
    write_text(spark, json.dumps({"run": run_id, "former": former.get("run")}, indent=2), manifest)
    if former.get("former"):
        system, old = file_system(spark, new_run(output_path, former["former"]))
        system.delete(old, True)


def current_run(spark: SparkSession, output_path: str) -> str:
    """Folder of the published run: silver, loaded, warnings and report that belong together."""
    manifest = read_text(spark, f"{output_path}/{MANIFEST}")
    if manifest is None:
        raise DataQualityError(f"No run has been published in {output_path}")
    return new_run(output_path, json.loads(manifest)["run"])
