"""Publishing a result: canonical text, routing, redaction, versions with a manifest, and a check of what was written."""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def canonical_json(df: DataFrame) -> Column:
    """A row as JSON with its columns in name order and nulls written, the same for equal rows."""
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})


def content_hash(df: DataFrame) -> str:
    """A digest of the set of rows with their multiplicities, whatever their order or partitioning."""
    text = canonical_json(df)
    digest = df.select(F.xxhash64(text).alias("a"), F.hash(text).cast("long").alias("b")).agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.bit_xor("a"), F.sum(F.col("b").cast("decimal(38,0)"))).first()
    return "-".join(str(x) for x in digest)


def routed(df: DataFrame, source: str, public: Sequence[str]) -> DataFrame:
    """df with source_class: public for named sources, private for every other, unknown and null ones too."""
    return df.withColumn("source_class", F.when(F.col(source).isin(*public), "public").otherwise("private"))


def layer_path(source_class: Column, layer: str, source: Column, board: Column) -> Column:
    """Where a layer file lies under a root: class, layer, source, board; signs that a path can't hold are percent-encoded."""
    safe = lambda c: F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    return F.concat_ws("/", source_class, F.lit(layer), safe(source), safe(board))


def _coded(secret: str) -> set[str]:
    """base64 of a secret wherever it starts in a longer text: whole, and what is fixed of it behind one and two other bytes."""
    raw = secret.encode()
    whole = base64.b64encode(raw).decode()
    inner = (base64.b64encode(b" " * k + raw).decode().rstrip("=")[k + 1 : -1] for k in (1, 2))
    return {whole, whole.rstrip("=")} | {x for x in inner if len(x) >= 8}


def redact(c: Column, secrets: Sequence[str], shown: str = "***") -> Column:
    """c without any of secrets, plain or in base64, longest first."""
    known = {s for secret in secrets if secret for s in (secret, *_coded(secret))}
    for secret in sorted(known, key=len, reverse=True):
        c = F.replace(c, F.lit(secret), F.lit(shown))
    return c


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest version's manifest at path, or None."""
    fs, where = _fs(spark, f"{path}/MANIFEST")
    if not fs.exists(where):
        return None
    return json.loads(spark.read.text(f"{path}/MANIFEST", wholetext=True).first()["value"])


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> dict:
    """Write df as a new version under path and name it in the manifest; gives the manifest.

    Nothing is written where the content is that of the newest version. A version is read back and compared with what was
    to be written before the manifest, replaced by a rename, names it: readers see the old version or the whole new one.
    """
    spark, before = df.sparkSession, manifest(df.sparkSession, path)
    digest = content_hash(df)
    if before and before["digest"] == digest:
        return before
    number = (before or {"version": 0})["version"] + 1
    target = f"{path}/v{number:06}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    back = spark.read.schema(df.schema).parquet(target).select(*df.columns)
    if content_hash(back) != digest:
        raise RuntimeError(f"{target} does not hold what was written")
    entry = {"version": number, "digest": digest, "path": target}
    fs, new = _fs(spark, f"{path}/MANIFEST.new")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    _, final = _fs(spark, f"{path}/MANIFEST")
    fs.delete(final, False)
    fs.rename(new, final)
    return entry


def newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest version at path."""
    entry = manifest(spark, path)
    if entry is None:
        raise FileNotFoundError(path)
    return spark.read.parquet(entry["path"])
