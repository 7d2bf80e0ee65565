"""Token-ID output: flat unsigned integer files with 64-bit document offsets, memory-mapped.

``write_token_files`` range-partitions documents by id, sorts each partition and writes it as shards of
at most ``SHARD_TOKENS`` ids (more for a single longer document) and ``SHARD_DOCS`` documents, so that
files and what a task holds stay small whatever the corpus. A shard is three files in a folder that
all executors share:

* ``<name>.bin``: ids of all its documents in a row, unsigned little-endian, 16 bits wide if the
  vocabulary allows and else 32;
* ``<name>.idx``: n + 1 little-endian signed 64-bit offsets, in ids, from the shard's start;
* ``<name>.doc``: n signed 64-bit document ids, then n bytes that are 1 where the id is null.

A shard's base (ids before it in the whole corpus) is the prefix sum of the earlier shards' counts;
the manifest holds it. Names are made anew by each attempt of a task, and the manifest, which Spark
commits, lists those of the attempt that counts: a retried or speculative task disturbs no file.

Defined results: null text is empty and holds just the end id; null ids come first; equal ids stay
separate rows, in the order of their texts' hashes; an empty table gives no shards.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mesaquery.llm.common import scratch
from mesaquery.llm.tokens import few_rows, texts_of, vocabulary_of, word_ids


#: Ids and documents of a shard.
SHARD_TOKENS, SHARD_DOCS = 1 << 26, 1 << 20


def filesystem(uri: str):
    """pyarrow's file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, shard_tokens: int = SHARD_TOKENS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Write shards below ``folder``; the manifest: part, shard, name, n_docs, n_tokens, base, width."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = 2 if max(vocabulary_of(tokenizer_file), end_id + 1) <= 1 << 16 else 4
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    # The tie breaker also splits an id that very many rows share.
    dealt = rows.repartitionByRange(parts, F.col("doc_id"), F.col("tie")).sortWithinPartitions("doc_id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), word_ids(tokenizer_file)
        fs, path = filesystem(folder)
        shard, number = None, 0
        for batch in few_rows(batches):
            flat, stops = encoder.encode(texts_of(batch.column("text")))
            n = len(stops) - 1
            with_end = np.full(len(flat) + n, end_id, f"<u{width}")
            ends = stops[1:] + np.arange(1, n + 1)
            keep = np.ones(len(with_end), bool)
            keep[ends - 1] = False
            with_end[keep] = flat
            ids, nulls = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            first = 0
            while first < n:
                if shard is None:
                    shard = _Shard(fs, path, f"shard-{part:05d}-{number:05d}-{uuid.uuid4().hex[:12]}")
                    number += 1
                begin = ends[first - 1] if first else 0
                # As many documents as there's room for, and one at least where the shard is empty.
                last = min(n, first + shard_docs - shard.n_docs, max(int(np.searchsorted(ends, begin + shard_tokens - shard.n_tokens, "right")), first + (shard.n_docs == 0)))
                if last > first:
                    shard.add(with_end[begin : ends[last - 1]], ends[first:last] - begin, ids[first:last], nulls[first:last])
                    first = last
                if first < n:
                    yield shard.closed(part, number)
                    shard = None
        if shard is not None:
            yield shard.closed(part, number)

    listed = scratch(spark, "token-manifest")
    dealt.mapInArrow(write, "part int, shard int, name string, n_docs long, n_tokens long").write.parquet(listed)
    # One row for each shard: the only rows that a single task ever sees together.
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.parquet(listed).withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).withColumn("width", F.lit(width))


class _Shard:
    """A shard that is being written."""

    def __init__(self, fs, path: str, name: str):
        fs.create_dir(path, recursive=True)
        self.name, self.n_docs, self.n_tokens = name, 0, 0
        self.open = lambda x: fs.open_output_stream(f"{path}/{name}.{x}")
        self.bin, self.idx = self.open("bin"), self.open("idx")
        self.idx.write(np.zeros(1, "<i8").tobytes())
        self.ids: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []

    def add(self, tokens: np.ndarray, ends: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        self.bin.write(tokens.tobytes())
        self.idx.write((ends + self.n_tokens).astype("<i8").tobytes())
        self.ids.append(ids.astype("<i8"))
        self.nulls.append(nulls.astype(np.uint8))
        self.n_docs, self.n_tokens = self.n_docs + len(ids), self.n_tokens + len(tokens)

    def closed(self, part: int, number: int) -> pa.RecordBatch:
        """Close the files; the manifest's row."""
        self.bin.close()
        self.idx.close()
        with self.open("doc") as doc:
            doc.write(np.concatenate(self.ids).tobytes() + np.concatenate(self.nulls).tobytes())
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "shard": pa.array([number], pa.int32()), "name": [self.name], "n_docs": [self.n_docs], "n_tokens": [self.n_tokens]})


class TokenFiles:
    """One shard; ``shard[i]`` has document i's ids. Local files are memory-mapped, of others only what is asked for is read."""

    def __init__(self, folder: str, name: str, width: int):
        fs, path = filesystem(folder)
        local = type(fs).__name__ == "LocalFileSystem"
        open_ = lambda x: pa.memory_map(f"{path}/{name}.{x}") if local else fs.open_input_file(f"{path}/{name}.{x}")
        self.bin, self.kind = open_("bin"), np.dtype(f"<u{width}")
        self.offsets, doc = (np.frombuffer(open_(x).read_buffer(), kind) for x, kind in (("idx", "<i8"), ("doc", np.uint8)))
        n = len(self.offsets) - 1
        self.doc_ids, self.doc_null = doc[: 8 * n].view("<i8"), doc[8 * n :].astype(bool)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of the documents from ``first`` up to ``last``."""
        a, b = (int(self.offsets[i]) * self.kind.itemsize for i in (first, last))
        self.bin.seek(a)
        return np.frombuffer(self.bin.read_buffer(b - a), self.kind)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ids(i, i + 1)


def read_token_files(manifest: DataFrame, folder: str, rows: int = 1024) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                file = TokenFiles(folder, shard["name"], shard["width"])
                for a in range(0, len(file), rows):
                    b = min(a + rows, len(file))
                    ids, at = file.ids(a, b).astype("<u4"), file.offsets[a : b + 1] - file.offsets[a]
                    crc = [zlib.crc32(ids[x:y].tobytes()) for x, y in zip(at, at[1:], strict=False)]
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array(file.doc_ids[a:b], mask=file.doc_null[a:b]), "start": pa.array(file.offsets[a:b] + shard["base"]), "n_tokens": pa.array(np.diff(file.offsets[a : b + 1])), "ids_crc32": pa.array(crc, pa.int64())})

    n = max(1, manifest.count())
    return manifest.repartition(n, "part", "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files_query(spark: SparkSession, docs: DataFrame, tokenizer_file: str, end_id: int = 2) -> DataFrame:
    folder = scratch(spark, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer_file, end_id), folder)
