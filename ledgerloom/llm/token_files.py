"""Token ids of whole documents in ORC files, in ascending order of document id.

Integers are run-length encoded by the format; the files have row indexes, and Bloom filters on the
document id, so a look-up reads the stripes that can hold its ids and the footers of the rest. Stripes are read
in parallel. Texts, not ids, are moved to get the order: they are smaller and encoded only afterwards.

A row of a file: ``part`` (number of the file in id order), ``doc_id``, ``start_in_part`` (ids before it in its
file), ``n_tokens``, ``ids`` (end id included).

Defined results: null or empty text has the end id only; null ids come first; rows that repeat are kept,
each with its own start (rows with one id stand in order of their texts). An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import END_ID, TOKENIZER_FILE, encoder, in_slices, new_folder, text_or_empty

STRIPE_BYTES = 32 << 20
INDEX_STRIDE = 5_000


def _file_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("doc_id", id_type), T.StructField("start_in_part", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
    ])


def _encoded(tokenizer: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in in_slices(whole, "text", 1 << 20):
                coded = [ids + end for ids in encoder(tokenizer).encode(batch.column("text").to_pylist())]
                n = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
                ends = np.cumsum(n)
                ids = pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), batch.column("doc_id"), pa.array(start + ends - n), pa.array(n), lists],
                    ["part", "doc_id", "start_in_part", "n_tokens", "ids"],
                )
                start += int(ends[-1])

    return encode


def write_tokens(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER_FILE, end_id: int = END_ID) -> None:
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    coded = rows.mapInArrow(_encoded(tokenizer, end_id), _file_schema(docs.schema["doc_id"].dataType))
    (
        coded.write.option("orc.create.index", "true").option("orc.row.index.stride", INDEX_STRIDE)
        .option("orc.stripe.size", STRIPE_BYTES).option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01").option("compression", "zstd").orc(folder)
    )


def read_tokens(spark: SparkSession, folder: str, id_type: T.DataType | None = None) -> DataFrame:
    """The files' rows; filters on doc_id reach the stripes' indexes and Bloom filters."""
    return spark.read.schema(_file_schema(id_type or T.LongType())).orc(folder)


def part_starts(tokens: DataFrame) -> DataFrame:
    """Ids before each file, from one narrow column: one row a file."""
    sums = tokens.groupBy("part").agg(F.sum("n_tokens").alias("words"))
    before = F.sum("words").over(W.orderBy("part")) - F.col("words")
    return sums.select(F.col("part").alias("of_part"), before.alias("before"))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        at = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        view = memoryview(values.tobytes())
        crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("doc_id"), batch.column("start_in_part"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
            ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"],
        )


def token_digest(tokens: DataFrame) -> DataFrame:
    """Each document of the files: doc_id, start, n_tokens, ids_crc32."""
    id_type = tokens.schema["doc_id"].dataType.simpleString()
    rows = tokens.mapInArrow(_summed, f"part int, doc_id {id_type}, start_in_part long, n_tokens long, ids_crc32 long")
    return rows.join(part_starts(tokens), F.col("part") == F.col("of_part")).select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32"
    )


def written_and_read(docs: DataFrame) -> DataFrame:
    """Write the documents' tokens below the shared folder and describe what the files hold."""
    folder = new_folder(docs.sparkSession, "tokens")
    write_tokens(docs, folder)
    return token_digest(read_tokens(docs.sparkSession, folder, docs.schema["doc_id"].dataType))
