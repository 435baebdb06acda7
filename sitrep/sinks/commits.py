"""Folders whose contents change in one step: an append log and a published version.

Rows are written to a folder of their own first and count only once a small file names that
folder. That file appears by a rename, so readers see all rows of a run or none, and an
attempt that dies leaves nothing but an unnamed folder.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sitrep.operators import audit

COMMIT = "run string, folder string, rows bigint"


def _file_context(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    uri = place.getFileSystem(conf).makeQualified(place).toUri()
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, conf), place


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def name_in_one_step(spark: SparkSession, path: str, content: dict, replace: bool = False) -> bool:
    """Make a small JSON file appear whole; false if it is there already and not to be replaced."""
    jvm = spark._jvm
    folder, name = path.rsplit("/", 1)
    context, final = _file_context(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{folder}/_{uuid.uuid4().hex}.draft")
    system = draft.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(draft, False)
    out.write(bytearray(json.dumps(content, ensure_ascii=False).encode()))
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE if replace else kind.NONE
    try:
        context.rename(draft, final, options)
    except Exception as error:
        system.delete(draft, False)
        if not replace and exists(spark, path):
            return False
        raise error
    return True


def _write(df: DataFrame, folder: str, kind: str) -> int:
    counted, seen = audit.observed(df, f"rows-{uuid.uuid4().hex}")
    writer = counted.write.mode("errorifexists")
    if kind == "json":
        # Spark's own format ends at milliseconds.
        writer = writer.options(ignoreNullFields="false", timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    writer.format(kind).save(folder)
    return seen.get["n"]


def append_once(df: DataFrame, path: str, run: str, kind: str = "json") -> int:
    """Add the rows of a run to the log at ``path``; the rows added, 0 if the run is in it already.

    A run that is repeated, after its end or after an attempt that died anywhere on the
    way, adds its rows once. Of two attempts at the same time the first to end counts.
    """
    spark = df.sparkSession
    commit = f"{path}/commits/{quote(run, safe='')}.json"
    if exists(spark, commit):
        return 0
    folder = f"rows/{quote(run, safe='')}-{uuid.uuid4().hex}"
    rows = _write(df, f"{path}/{folder}", kind)
    return rows if name_in_one_step(spark, commit, {"run": run, "folder": folder, "rows": rows}) else 0


def runs(spark: SparkSession, path: str) -> DataFrame:
    """``run, folder, rows`` of every run in the log; none for a log that does not exist."""
    try:
        return spark.read.schema(COMMIT).option("mode", "FAILFAST").json(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def read_log(spark: SparkSession, path: str, schema: str | T.StructType, kind: str = "json") -> DataFrame:
    """Rows of all runs in the log. The driver holds one folder name a run."""
    folders = [f"{path}/{r['folder']}" for r in runs(spark, path).select("folder").collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if kind == "json":
        reader = reader.option("mode", "FAILFAST")
    return reader.format(kind).load(folders)


def publish(df: DataFrame, target: str, kind: str = "text") -> str:
    """Write ``df`` as the new version of ``target`` and switch to it; the version's path.

    Readers that ask :func:`published` see the old version until the new one is whole, and
    keep it if the write fails. Old versions stay where they are for those still reading.
    """
    version = f"versions/{uuid.uuid4().hex}"
    df.write.format(kind).mode("errorifexists").save(f"{target}/{version}")
    name_in_one_step(df.sparkSession, f"{target}/current.json", {"version": version}, replace=True)
    return f"{target}/{version}"


def published(spark: SparkSession, target: str) -> str:
    """Path of the version that counts; a target never published is an error."""
    if not exists(spark, f"{target}/current.json"):
        raise FileNotFoundError(target)
    return f"{target}/{spark.read.json(f'{target}/current.json').first()['version']}"
