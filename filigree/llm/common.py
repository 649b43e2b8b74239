"""What the operators share: staged tables, the crc split, text helpers and Arrow batches."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLDS, HELD_OUT = 5, 0


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies on this cluster's machines."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def stage(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors."""
    return cut_lineage(df)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once for each application.

    The archive is built in the driver's temporary folder and handed out by the driver, as
    ``--py-files`` does; executors never read that folder.
    """
    sc = spark.sparkContext
    if getattr(sc, "_filigree_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = tempfile.mkdtemp(prefix="filigree-")
    sc.addPyFile(shutil.make_archive(f"{target}/filigree", "zip", package.parent, package.name))
    sc._filigree_shipped = True


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character untouched; ``lower`` alone would also fold accented letters."""
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def held_out(doc_id: Column) -> Column:
    """True for the rows no model may learn labels from; a row without an id is held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS == HELD_OUT, F.lit(True))


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """A column name that ``df`` does not have for each stem."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        while (stem := f"_{stem}").lower() in taken:
            pass
        out.append(stem)
        taken.add(stem.lower())
    return out


def bounded_sample(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """At most ``rows`` rows, the same ones on every run; only for fitting a model."""
    return df.orderBy(F.xxhash64(*by), *by).limit(rows)


def slices(batches: Iterator[pa.RecordBatch], bytes_each: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``bytes_each``; a single longer row is a piece of its own.

    Keeps what Python holds at a time small whatever the length of the texts.
    """
    for batch in batches:
        rows, size = batch.num_rows, max(1, batch.nbytes)
        step = max(1, rows * bytes_each // size)
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [b"" if x is None else x for x in batch.column(name).cast(pa.binary()).to_pylist()]


def str_texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column as strings; null counts as empty."""
    return ["" if x is None else x for x in batch.column(name).to_pylist()]


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and how many each text has; null has none."""
    cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, owner = cut.flatten(), pc.list_parent_indices(cut)
    real = pc.not_equal(words, "")
    sizes = np.bincount(owner.filter(real).to_numpy(zero_copy_only=False), minlength=len(texts))
    return words.filter(real), sizes
