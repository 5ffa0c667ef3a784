"""Token ids as flat unsigned integer files with 64-bit document offsets, read by memory map.

A folder holds, for each partition ``p`` in ascending order of the document id:

- ``p.ids``: the ids of its documents end to end, little-endian, 16 bits wide if the
  vocabulary fits and 32 bits otherwise;
- ``p.offsets``: 64-bit offsets into it, one more than there are documents;
- ``p.docs``: the 64-bit document ids, null ids first (as 0);

and ``manifest``, a Parquet table with a row for each partition: its number of documents,
of null ids among them, and of ids, and its base, the number of ids in all partitions
before it. The ids of document ``i`` of a partition lie at ``base + offsets[i]`` of the whole
corpus. A local folder is read by memory map, another store by ranges of bounded size.

Tasks open the files themselves, so the folder must lie in a store of ``STORES``; any other
raises before work begins.

Defined results: a null text is empty; an empty text has the end id alone; repeated rows
are written as often as they occur, those of one id in order of their text; an empty
table gives an empty manifest; other columns are passed over.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parityscope.llm.text_bytes import Texts, slices
from parityscope.llm.tokens import ENCODE_BYTES, ChunkEncoder

#: Ids read from a file at a time.
_READ_IDS = 1 << 20
#: Schemes of the stores that tasks can open, and what the same store is called there.
STORES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The store that holds a path; with the scheme left out, the local one."""
    scheme, found, rest = path.partition(":")
    if not found or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme not in STORES:
        raise ValueError(f"token files can't be written to {path}; stores are {sorted(STORES)}")
    return pafs.FileSystem.from_uri(f"{STORES[scheme]}:{rest}")


def _writer(folder: str, tokenizer_path: str, end_id: int, width: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _file_system(folder)
        part = TaskContext.get().partitionId()
        encoder = ChunkEncoder(tokenizer_path)
        offsets, docs, total, n_null = [np.zeros(1, np.int64)], [], 0, 0
        attempt = uuid.uuid4().hex
        with store.open_output_stream(f"{root}/{attempt}.ids") as ids_file:
            for batch in batches:
                for piece in slices(batch, "text", ENCODE_BYTES):
                    ids, ends = encoder.encode(Texts.of(piece.column("text")), end_id)
                    ids_file.write(ids.astype(width).tobytes())
                    offsets.append(ends[1:] + total)
                    total += len(ids)
                    n_null += piece.column("doc_id").null_count
                    docs.append(piece.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        n_docs = sum(map(len, docs))
        for kind, arrays in (("offsets", offsets), ("docs", docs)):
            with store.open_output_stream(f"{root}/{attempt}.{kind}") as file:
                for values in arrays:
                    file.write(values.astype("<i8").tobytes())
        for kind in ("ids", "offsets", "docs"):  # whole files only ever get the final name
            store.move(f"{root}/{attempt}.{kind}", f"{root}/{part:08d}.{kind}")
        found = {"part": part, "n_docs": n_docs, "n_null": n_null, "n_ids": total}
        yield pa.RecordBatch.from_pydict({name: pa.array([value], pa.int64()) for name, value in found.items()})

    return write


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Encode every whole text, append ``end_id``, write the files; return the manifest.

    The only shuffle deals the texts by ranges of the id; each task then writes the
    files of its range. A task that runs again writes the same files again.
    """
    spark = docs.sparkSession
    store, root = _file_system(folder)
    store.create_dir(root, recursive=True)
    largest = max(Tokenizer.from_file(tokenizer_path).get_vocab_size() - 1, end_id)
    width = "<u2" if largest < 2**16 else "<u4"
    counts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(_writer(folder, tokenizer_path, end_id, width), "part long, n_docs long, n_null long, n_ids long")
    )
    # A row for each partition, so the prefix sums of one window are small.
    counts.write.parquet(f"{folder}/counts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.parquet(f"{folder}/counts").select(
        "part", "n_docs", "n_null", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"), F.lit(width).alias("width")
    )
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


class _File:
    """Numbers of a file, by memory map or, in a store without, by ranges."""

    def __init__(self, store: pafs.FileSystem, path: str, dtype: str, n: int) -> None:
        self._dtype, self._map, self._file = np.dtype(dtype), None, None
        if n and isinstance(store, pafs.LocalFileSystem):
            self._map = np.memmap(path, dtype, "r", shape=(n,))
        elif n:
            self._file = store.open_input_file(path)

    def __getitem__(self, part: slice) -> np.ndarray:
        if self._map is not None:
            return self._map[part]
        n = (part.stop - part.start) * self._dtype.itemsize
        return np.frombuffer(self._file.read_at(n, part.start * self._dtype.itemsize) if n else b"", self._dtype)


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                name, n = f"{root}/{row['part']:08d}", row["n_docs"]
                offsets = _File(store, f"{name}.offsets", "<i8", n + 1)[0 : n + 1]
                docs = _File(store, f"{name}.docs", "<i8", n)
                ids = _File(store, f"{name}.ids", row["width"], row["n_ids"])
                a = 0
                while a < n:
                    b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _READ_IDS, side="right")) - 1)
                    held = np.ascontiguousarray(ids[int(offsets[a]) : int(offsets[b])]).astype("<u4")
                    ends = (offsets[a : b + 1] - offsets[a]) * 4
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(docs[a:b], pa.int64(), mask=np.arange(a, b) < row["n_null"]),
                            "start": pa.array(offsets[a:b] + row["base"], pa.int64()),
                            "n_tokens": pa.array(np.diff(offsets[a : b + 1]), pa.int64()),
                            "ids": pa.LargeBinaryArray.from_buffers(
                                pa.large_binary(), b - a, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(held)]
                            ).cast(pa.binary()),
                        }
                    )
                    a = b

    return read


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each document: its id, the place of its first id, their number, and the
    ids as little-endian 32-bit integers. One task reads the files of one partition."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    n = max(1, manifest.count())
    return manifest.repartition(n).mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids binary")
