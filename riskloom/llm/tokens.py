"""Operator 2: token ids as flat binary files, read back by memory mapping.

Each range of ascending doc_id is one task, which writes three flat little-endian files:
``.ids`` (token ids, uint16 where the vocabulary fits, else uint32), ``.offsets`` (uint64, one more than documents, counted from
the file's first id) and ``.docs`` (int64 doc_id, NO_ID for null). The tasks return one
manifest row per file set; the manifest's prefix sums are the files' bases in the whole
sequence. File names hold the task attempt, so a retried or lost task leaves no
half-written file in the manifest.

Null doc_ids come last; rows that share a doc_id are ordered by text; a null or empty
text is its end id alone; an empty table has an empty manifest.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import NO_ID, id_text, open_output, read_shared, scratch_path, ship, stored
from riskloom.llm.encode import encoder

MANIFEST = "part int, path string, width int, n_docs long, n_ids long"
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                  ("ids", pa.binary())])


def _mapped(uri: str, dtype: str) -> np.ndarray:
    return np.frombuffer(read_shared(uri), dtype)


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int,
                      out_dir: str | None = None) -> DataFrame:
    """Write the files of ``docs`` and return the manifest with each file's ``base``."""
    spark = ship(docs.sparkSession)
    out_dir = out_dir or scratch_path(spark, "token-files")
    run = uuid.uuid4().hex

    def write(batches):
        ctx = TaskContext.get()
        path = f"{out_dir}/{run}-{ctx.partitionId():06d}-{ctx.taskAttemptId()}"
        enc = encoder(tokenizer_path)
        width = 2 if max(enc.tok.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()
        files = None
        n_docs = n_ids = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if files is None:
                files = [open_output(f"{path}.{k}") for k in ("ids", "offsets", "docs")]
                files[1].write(np.zeros(1, "<u8").tobytes())
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [x + end for x in enc.encode(part.column("text").to_pylist())]
                size = np.array([len(x) // 4 for x in ids], "<u8")
                files[0].write(np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}").tobytes())
                files[1].write((np.uint64(n_ids) + np.cumsum(size)).tobytes())
                files[2].write(part.column("doc_id").to_numpy().astype("<i8").tobytes())
                n_docs += part.num_rows
                n_ids += int(size.sum())
        if files is not None:
            for f in files:
                f.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([ctx.partitionId()], pa.int32()), "path": [path],
                 "width": pa.array([width], pa.int32()),
                 "n_docs": [n_docs], "n_ids": [n_ids]})

    ordered = id_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = stored(ordered.mapInArrow(write, MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, block_ids: int = 1 << 20) -> DataFrame:
    """One row per document from its files: doc_id, start (base plus the file's offset),
    n_tokens and the ids as little-endian uint32 bytes. One task maps one file set and
    sends about ``block_ids`` ids at a time."""
    ship(manifest.sparkSession)
    n = manifest.count()

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = _mapped(row["path"] + ".ids", f"<u{row['width']}")
                offsets = _mapped(row["path"] + ".offsets", "<u8").astype(np.int64)
                doc = _mapped(row["path"] + ".docs", "<i8")
                a = 0
                while a < len(doc):
                    b = int(np.searchsorted(offsets, offsets[a] + block_ids))
                    b = min(max(b, a + 1), len(doc))
                    keys = np.asarray(doc[a:b])
                    cut = ((offsets[a:b + 1] - offsets[a]) * 4).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys, pa.int64(), mask=keys == NO_ID),
                        pa.array(offsets[a:b] + row["base"]),
                        pa.array(np.diff(offsets[a:b + 1])),
                        pa.Array.from_buffers(pa.binary(), b - a, [
                            None, pa.py_buffer(cut.tobytes()),
                            pa.py_buffer(ids[offsets[a]:offsets[b]].astype("<u4").tobytes())]),
                    ], schema=DOCS)
                    a = b

    spread = manifest.repartitionByRange(max(n, 1), "part") if n else manifest
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
