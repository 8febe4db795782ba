"""Changed inputs, manifests, freshness, fingerprints and provenance of file tables."""

from __future__ import annotations

import platform
import sys

import pyspark
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def changed_files(files: DataFrame, manifest: DataFrame, version: int, rebuild: bool = False) -> DataFrame:
    """Files that the manifest doesn't have with their length, time (to a microsecond) and version; all of them on a rebuild.

    Where both tables have a column ``sha256``, a file whose time alone differs counts as unchanged if its digest is the
    manifest's.
    """
    if rebuild:
        return files
    hashed = "sha256" in files.columns and "sha256" in manifest.columns
    digest = [F.col("sha256").alias("_h")] if hashed else []
    known = manifest.where(F.col("version") == version).select(F.col("path").alias("_p"), F.col("length").alias("_l"), F.col("mtime").alias("_m"), *digest).distinct()
    on_time = F.abs(F.unix_micros(files["mtime"].cast("timestamp")) - F.unix_micros(F.col("_m").cast("timestamp"))) <= 1
    on_time = on_time | (files["sha256"] == F.col("_h")) if hashed else on_time
    same = (files["path"] == F.col("_p")) & (files["length"] == F.col("_l")) & on_time
    return files.join(known, same, "left_anti")


def with_digests(files: DataFrame, manifest: DataFrame, contents: DataFrame) -> DataFrame:
    """Files with ``sha256``: the manifest's where length and time are its own, else taken anew from ``contents`` (path, content)."""
    known = manifest.select("path", "length", "mtime", "sha256").dropDuplicates(["path", "length", "mtime"])
    out = files.drop("sha256").join(known, ["path", "length", "mtime"], "left")
    fresh = contents.join(out.where("sha256 is null").select("path"), "path", "left_semi").select("path", F.sha2("content", 256).alias("_fresh"))
    return out.join(fresh, "path", "left").withColumn("sha256", F.coalesce("sha256", "_fresh")).drop("_fresh")


def reuse_unchanged(previous: DataFrame, fresh: DataFrame, changed: DataFrame, key: str = "path") -> DataFrame:
    """Earlier output of unchanged files with the new output of the others."""
    return previous.join(changed.select(key).distinct(), key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def publish_manifest(manifest: DataFrame, entries: DataFrame, key: str = "path", at: str = "published_at") -> DataFrame:
    """One entry for each key: the latest published, an entry's columns breaking ties."""
    rows = manifest.unionByName(entries, allowMissingColumns=True)
    rest = [c for c in rows.columns if c not in (key, at)]
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(at), *rest))).where("_r = 1").drop("_r")


def versions(spark: SparkSession, root: str) -> tuple[int, int]:
    """(the newest complete version of a snapshot table, the highest number in use), 0 without one. A version is a folder
    ``v=number`` under the root, complete once it has the mark that Spark's writers put there last."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    number = lambda p: int(p.getName().removeprefix("v="))
    found = [f.getPath() for f in (store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "v=*")) or [])]
    whole = [p for p in found if store.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max(map(number, whole), default=0), max(map(number, found), default=0)


def _folder(root: str, version: int) -> str:
    return f"{root}/v={version:020d}"


def commit_snapshot(table: DataFrame, root: str) -> int:
    """``table`` as the root's next version; its number. Readers see the version before until this one is complete. Of writers at
    the same time one finds the number taken and fails; what a failed writer leaves is never read."""
    version = versions(table.sparkSession, root)[1] + 1
    table.write.mode("errorifexists").parquet(_folder(root, version))
    return version


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest complete version, None without one; later commits don't touch what was returned."""
    version = versions(spark, root)[0]
    return spark.read.parquet(_folder(root, version)) if version else None


def commit_manifest(entries: DataFrame, root: str, key: str = "path", at: str = "published_at") -> int:
    """``publish_manifest`` on the newest snapshot, committed as the next one."""
    current = read_snapshot(entries.sparkSession, root)
    return commit_snapshot(publish_manifest(entries.limit(0) if current is None else current, entries, key, at), root)


def outputs_fresh(inputs: DataFrame, outputs: DataFrame, key: str, wanted: int, at: str = "mtime") -> DataFrame:
    """``is_fresh``: all ``wanted`` outputs exist and none is older than the input."""
    own = outputs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias("_oldest"))
    fresh = (F.coalesce(F.col("_n"), F.lit(0)) >= wanted) & (F.col("_oldest") >= F.col(at))
    return inputs.join(own, key, "left").withColumn("is_fresh", F.coalesce(fresh, F.lit(False))).drop("_n", "_oldest")


def tree_fingerprint(files: DataFrame, length: str = "length", mtime: str = "mtime") -> DataFrame:
    """``count:latest time:total length`` of a file table, ``empty`` for none."""
    agg = files.agg(F.count(F.lit(1)).alias("n"), F.max(F.unix_micros(F.col(mtime).cast("timestamp"))).alias("m"), F.sum(length).alias("s"))
    return agg.select(F.when(F.col("n") == 0, "empty").otherwise(F.concat_ws(":", *[F.col(c).cast("string") for c in "nms"])).alias("fingerprint"))


def provenance(files: DataFrame, run_id: str, created_at: Column, parameters: dict[str, str]) -> DataFrame:
    """One row for each input (path, sha256, length, mtime) with the run, its parameters and versions; hashes of all inputs."""
    literal = lambda d: F.create_map(*[F.lit(str(x)) for kv in d.items() for x in kv]) if d else F.create_map().cast("map<string,string>")
    versions = {"python": sys.version.split()[0], "pyspark": pyspark.__version__, "platform": platform.platform()}
    return files.select(F.lit(run_id).alias("run_id"), created_at.alias("created_at"), "path", F.sha2("content", 256).alias("sha256"), "length", "mtime", literal(parameters).alias("parameters"), literal(versions).alias("packages"))


def key_collisions(files: DataFrame, stem: Column) -> DataFrame:
    """Stems that several paths share, and the path that would win (the last)."""
    return files.groupBy(stem.alias("stem")).agg(F.count(F.lit(1)).alias("n"), F.max("path").alias("wins")).where("n > 1")
