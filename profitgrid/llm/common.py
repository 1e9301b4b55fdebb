"""What several operators share: reading tables, storage between jobs, batches of Arrow rows."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profitgrid.session import stored_once


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def stored(df: DataFrame) -> DataFrame:
    """Rows that several later steps read, written once to the shared folder (see ``stored_once``)."""
    return stored_once(df)


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def whole_text(column: str = "text") -> Column:
    """A text, empty where it is NULL."""
    return F.coalesce(F.col(column), F.lit(""))


def _folding() -> bytes:
    """Byte -> itself, lower case for A-Z, a space for bytes that separate words."""
    kept = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    lower = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
    return bytes(b if b in kept else lower.get(b, 0x20) for b in range(256))


FOLDING = _folding()


def folded_words(raw: bytes | None) -> list[bytes]:
    """Runs of digits, letters a-z and signs beyond ASCII in a UTF-8 text, A-Z in lower case."""
    return raw.translate(FOLDING).split() if raw else []


def raw_texts(batch: pa.RecordBatch, text: str = "text") -> list[bytes | None]:
    """The texts of a batch in UTF-8."""
    return batch.column(text).cast(pa.large_binary()).to_pylist()


def per_row(
    df: DataFrame, text: str, schema: str, make: Callable[[], Callable[[str], tuple]], keep_text: bool = False
) -> DataFrame:
    """Add the columns of ``schema``, computed from ``text`` alone, row by row inside Arrow batches.

    ``make`` runs once per task and returns the function of one text (NULL counts as empty). Unless
    ``keep_text``, the text stays behind in Python: what comes back are the other columns and the new ones,
    which replace columns of the same name.
    """
    prepare(df.sparkSession)
    names = [f.split()[0] for f in schema.split(", ")]
    new = {n.lower() for n in names}
    kept = [f for f in df.schema.fields if (keep_text or f.name != text) and f.name.lower() not in new]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in small(batches):
            rows = [function(t or "") for t in batch.column(text).to_pylist()]
            columns = [batch.column(f.name) for f in kept]
            made = [pa.array(c) for c in zip(*rows, strict=True)] if rows else [pa.array([]) for _ in names]
            yield pa.RecordBatch.from_arrays(columns + made, names=[f.name for f in kept] + names)

    before = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return df.mapInArrow(run, f"{before}, {schema}" if before else schema)


def small(batches: Iterable[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``. Spark's batches have at most 64 MB, in the form of Arrow;
    what Python makes of them is several times as large."""
    for batch in batches:
        for at in range(0, max(1, len(batch)), rows):
            yield batch.slice(at, rows)


def read_small(spark: SparkSession) -> None:
    """Parquet in batches of 256 rows. A reader holds the texts of a batch in one array, which it doubles when it
    is full, so with Spark's 4,096 rows long texts take most of an executor. As with ``prepare``, a session with
    a setting of its own keeps it, and the setting stays."""
    if spark.conf.get(READ_ROWS) == "4096":
        spark.conf.set(READ_ROWS, "256")


def prepare(spark: SparkSession) -> None:
    """Before Python runs in tasks: small Arrow batches, and this package on every executor.

    Spark's default is 10,000 rows a batch, at most 64 MB, held several times over in an executor while a worker
    reads it. A session that has the default gets 2,000 rows; one with a setting of its own keeps it. Results are
    computed after this returns, so the setting stays.

    Where the package is not on the path of every Python that the session starts (a folder of PYTHONPATH or
    the working folder), Spark sends it along. Executors fetch the archive when they first need it, and new
    ones later, so the driver keeps it until it ends.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "2000")
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if str(root) in known or getattr(context, "_profitgrid_sent", False):
        return
    folder = tempfile.mkdtemp(prefix="profitgrid-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/profitgrid.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted((root / "profitgrid").rglob("*.py")):
            file.write(source, source.relative_to(root))
    context.addPyFile(archive)
    context._profitgrid_sent = True
