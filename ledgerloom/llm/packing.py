"""Best-fit packing of token sequences by minimum bin slack.

Documents are encoded and cut (only those longer than a sequence; the first piece takes the rest), and the
pieces of each length are counted: at most ``capacity`` counts, whatever the corpus. Sequences are planned on these
counts: the longest piece left opens a sequence, and a subset-sum over the other lengths that are left,
on bitsets, finds the fullest combination. A combination is repeated while its lengths last, which is what
repeating the search would give, so the plan has few combinations. Pieces then look up their place by
length and rank among the pieces of their length; ranks are two-level counts, so a length that a third of
all pieces have is spread over many tasks.

Defined results: null or empty text is one piece with the end id; rows that repeat are packed each on its own;
null ids are kept; an empty table gives an empty result. Reruns agree but for which of equal rows takes which place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import END_ID, TOKENIZER_FILE, cut, encoder, in_slices, text_or_empty

CAPACITY = 1024


def _cut_pieces(tokenizer: str, end_id: int, capacity: int):
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_slices(whole, "text", 1 << 20):
                row, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(encoder(tokenizer).encode(batch.column("text").to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    at, k = 0, 0
                    while at < n:
                        size = (n - at) % capacity or capacity
                        row.append(i), piece.append(k), start.append(at), length.append(size)
                        crc.append(zlib.crc32(ids[4 * at:4 * (at + size)]))
                        at, k = at + size, k + 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return pieces


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER_FILE, end_id: int = END_ID) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        _cut_pieces(tokenizer, end_id, capacity), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    )


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths (each at most as often as it is left) with the largest sum up to room; longer ones first."""
    reach, within, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            more = reach | (reach << length) & within
            if more == reach:
                break
            steps.append((length, reach))
            reach = more
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> total & 1:
            taken.append(length)
            total -= length
    return taken


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Slots in order of (length, rank): from rank ``first`` of ``length`` on, pieces go to sequence base + rank at offset."""
    left = {length: n for length, n in counts.items() if n > 0}
    used = dict.fromkeys(left, 0)
    slots, sequence = [], 0
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        pattern = [longest, *fullest({k: n for k, n in rest.items() if n}, capacity - longest)]
        times = {length: pattern.count(length) for length in pattern}
        repeats = min(left[length] // n for length, n in times.items())
        offset = 0
        for length in pattern:
            slots.append((length, used[length], sequence - used[length], offset))
            used[length] += repeats
            offset += length
        for length, n in times.items():
            left[length] -= n * repeats
            if not left[length]:
                del left[length]
        sequence += repeats
    table = np.array(sorted(slots), np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 44) + table[:, 1], "base": table[:, 2], "offset": table[:, 3]}


def _placed(slots: dict[str, np.ndarray]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            key = (batch.column("length").to_numpy() << 44) + rank
            at = np.searchsorted(slots["key"], key, side="right") - 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(slots["base"][at] + rank), pa.array(slots["offset"][at])],
                [*names, "sequence_id", "offset"],
            )

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) with their sequence_id and offset."""
    pieces = cut(pieces)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    slots = plan(counts, capacity)
    ranges = F.array(*[F.lit(max(1, int(counts.get(length, 0) ** 0.5))) for length in range(1, capacity + 1)])
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.element_at(ranges, F.col("length").cast("int")).cast("long"))
    rows = pieces.withColumn("part", part)
    sums = rows.groupBy(F.col("length").alias("l"), F.col("part").alias("p")).agg(F.count("*").alias("n"))
    sums = sums.select("l", "p", (F.sum("n").over(W.partitionBy("l").orderBy("p")) - F.col("n")).alias("before"))
    order = W.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    rows = rows.withColumn("inside", F.row_number().over(order))
    rows = rows.join(sums, (F.col("length") == F.col("l")) & (F.col("part") == F.col("p")))
    rows = rows.withColumn("rank", (F.col("before") + F.col("inside") - 1).cast("long"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"
    return rows.select(*names, "rank").mapInArrow(_placed(slots), schema)


def packed_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    return pack(token_pieces(docs, capacity), capacity)
