"""Small helpers shared by the operators of this subpackage.

Conventions that hold for every operator here:
* a null ``doc_id`` counts as larger than any number (``NO_ID`` while it travels);
* a null text counts as empty;
* inputs are narrowed to the columns an operator uses, so other columns of any name
  never clash with its own.
"""

from __future__ import annotations

import io
import os
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import discard, mounted, open_output, read_shared, scratch_path, stored  # noqa: F401  (re-exported)

NO_ID = 2**63 - 1


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package's modules, once per Spark application, so that
    tasks import them (and keep what they remember) wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_riskloom_shipped", False):
        return spark
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    uri = scratch_path(spark, "riskloom") + ".zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(uri)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(uri)
    sc._riskloom_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long, NO_ID for null) and ``text`` (never null)."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def real_id(col: str = "doc_id"):
    return F.when(F.col(col) != NO_ID, F.col(col)).alias(col)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets, without copying rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = column.cast(pa.large_string())
    ends = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
    if wide.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(wide) + 1, np.int64)
    data = np.frombuffer(wide.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    return data, ends - ends[0]


def slices(offsets: np.ndarray, limit: int):
    """Ranges [a, b) of consecutive rows with about ``limit`` bytes; a longer row is alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (public-domain constants), elementwise on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PRIME = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_PRIME, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
    done, step = 1, base
    while done < n:
        k = min(done, n - done)
        out[done:done + k] = out[:k] * np.uint64(step)
        done, step = done + k, step * step % 2**64
    return out


class WordHasher:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a run of texts.

    A word's hash is the difference of two prefix sums of byte * prime^position, moved
    back to position 0 by the inverse power; so a whole block is a few array passes.
    """

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def __call__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        """Hashes, first and end byte of each word, and the number of words per text."""
        n = len(data)
        if not n:
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets) - 1, np.int64)
        if len(self.up) < n:
            size = 1 << max(16, int(n - 1).bit_length())
            self.up, self.down = _powers(_PRIME, size), _powers(_INVERSE, size)
        word = ~_BLANK[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < n)]
        first[edge] |= word[edge]
        last[edge - 1] |= word[edge - 1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        code = (_LOWER[data] if lower else data).astype(np.uint64)
        code += np.uint64(1)
        code *= self.up[:n]
        np.cumsum(code, out=code)
        total = code[end - 1]
        before = np.where(begin > 0, code[begin - 1], np.uint64(0))
        h = mix64((total - before) * self.down[begin] + (end - begin).astype(np.uint64))
        counts = np.diff(np.searchsorted(begin, offsets))
        return h, begin, end, counts


def run_index(counts: np.ndarray) -> np.ndarray:
    """Row number of each element when row i owns ``counts[i]`` consecutive elements."""
    return np.repeat(np.arange(len(counts)), counts)
