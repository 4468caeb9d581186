"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of every word contract: space and the five ASCII controls.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
# Largest Arrow batch handed to a Python task, so that very long texts do
# not pile up to thousands of rows in one batch.
BATCH_BYTES = "16m"


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: a checkpoint folder and a bound
    on the bytes of an Arrow batch.

    The checkpoint folder is the one the cluster names in
    ``spark.checkpoint.dir``; a folder of our own is made only where that is
    unset and Spark runs on one machine (tests). Executors of a cluster would
    not see each other's folders, so there an unset folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(docs: DataFrame, name: str = "text") -> Column:
    """The text column with null read as empty."""
    return F.coalesce(docs[name].cast("string"), F.lit(""))


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds`` (null id: the text is empty)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def hex_sha256(data: bytes) -> str:
    import hashlib

    return hashlib.sha256(data).hexdigest()


def worker_cache(name: str, make):
    """A value kept for the life of a Python worker, shared by its tasks."""
    import sys
    import types

    store = sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level vocabularies: printable Latin-1 stands for itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def in_batches(rows: Iterator[tuple], schema: pa.Schema, max_bytes: int = 8 << 20, size_of=None) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded bytes from rows as tuples."""
    kept, held = [], 0
    for row in rows:
        kept.append(row)
        held += 64 + (size_of(row) if size_of else 0)
        if held >= max_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)
            kept, held = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df`` written as Parquet below the shared checkpoint folder and read again.

    Cuts lineage like ``checkpoint()``, in a columnar, compressed form. The
    folder belongs to the session's checkpoints and goes with them.
    """
    import uuid

    spark = df.sparkSession
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
