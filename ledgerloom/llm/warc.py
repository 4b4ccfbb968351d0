"""WARC files, and a Merkle audit of their replicas.

Writing: each task writes its pages, in order, as records of gzipped WARC files. A file ends before the record that would
take it over FILE_BYTES (of html and address), so what an auditing task unpacks is bounded by that or by one longer record.
Auditing: every record of a replica is hashed with its place (file, position, byte range in the uncompressed file), and
ranges of FAN neighbours are hashed together, level by level, to one root for each file and one for
the replica. Roots are compared first, and only branches that differ are followed down to the records.

Defined results: null html is an empty record, a null address has no header line; records that one replica lacks
differ; replicas without files are equal. Rows that repeat are records of their own. A file cut off in the
middle of a record, or not a WARC file, holds one record of what is left from there on. An empty table gives no records.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import cut, new_folder, stored
from ledgerloom.operators.rank import positioned

FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"  # of records whose pages have no date of their own; the same on every run
FAN = 16
END = "\r\n\r\n"


def record_text(html: Column, date: str = DATE) -> Column:
    """A resource record without its closing line ends; page_id and url are columns of the row."""
    html = F.coalesce(html, F.lit(""))
    address = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), address, F.lit("\r\n")), F.lit("")),
        F.lit(f"WARC-Date: {date}\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit(END), html,
    )


def _numbered(file_bytes: int):
    """Pages with their place in the task and the number of their file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = file = held = 0
        for batch in batches:
            sizes = sum(
                pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("url", "html")
            )
            files = np.empty(len(batch), np.int32)
            for i, size in enumerate(sizes.tolist()):
                if held and held + size > file_bytes:
                    file, held = file + 1, 0
                held += size
                files[i] = file
            places = np.arange(place, place + len(batch))
            place += len(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places), pa.array(files)], [*batch.schema.names, "place", "chunk"])

    return run


def write_replicas(pages: DataFrame, folder: str, htmls: list[Column]) -> None:
    """One replica for each html column, all with the same records in the same files: folder/replica=K."""
    bodies = F.posexplode(F.array(*[record_text(html) for html in htmls])).alias("replica", "value")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    schema = T.StructType([*rows.schema, T.StructField("place", T.LongType()), T.StructField("chunk", T.IntegerType())])
    rows = rows.mapInArrow(_numbered(FILE_BYTES), schema).select("place", "chunk", bodies)
    rows = rows.sortWithinPartitions("replica", "chunk", "place").select("replica", "chunk", "value")
    rows.write.partitionBy("replica", "chunk").option("lineSep", END).option("compression", "gzip").text(folder)


def _records_of(data: bytes) -> Iterator[tuple[int, int, str | None, bytes]]:
    """Start, end, record id and bytes of each record."""
    at = 0
    while at < len(data):
        head_end = data.find(b"\r\n\r\n", at)
        head = data[at:head_end] if head_end >= 0 else b""
        length, name = None, None
        for line in head.split(b"\r\n"):
            key, _, value = line.partition(b":")
            if key.lower() == b"content-length" and value.strip().isdigit():
                length = int(value)
            elif key.lower() == b"warc-record-id":
                name = value.strip().decode("utf-8", "replace").removeprefix("<urn:page:").removesuffix(">")
        end = head_end + 4 + length + 4 if head.startswith(b"WARC/") and length is not None else len(data)
        if end > len(data) or data[end - 4:end] != b"\r\n\r\n":
            end = len(data)
        yield at, end, name or None, data[at:end]
        at = end


def _unpacked(content: bytes) -> bytes:
    """All members of a gzip file; what comes before damage, if it is damaged. Other content as it is."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content:
        member = zlib.decompressobj(31)
        try:
            parts.append(member.decompress(content))
        except zlib.error:
            break
        if not member.eof:
            break
        content = member.unused_data
    return b"".join(parts)


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["replica", "file", "place", "record", "start", "end", "digest"]
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"]):
            replica, _, file = path.rpartition("replica=")[2].partition("/")
            rows = [
                (int(replica), file, place, name, start, end, hashlib.sha256(body).digest())
                for place, (start, end, name, body) in enumerate(_records_of(_unpacked(content)))
            ]
            yield pd.DataFrame(rows, columns=names)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Each record of each replica below folder: replica, file, place, record (its id), start, end, digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "content").mapInPandas(
        _hashed, "replica int, file string, place long, record string, start long, end long, digest binary"
    )


def _above(nodes: DataFrame) -> DataFrame:
    """One level up: FAN neighbours hashed together with their ranges."""
    said = F.concat_ws(",", F.hex("digest"), F.col("start").cast("string"), F.col("end").cast("string")).alias("said")
    children = F.sort_array(F.collect_list(F.struct("place", said)))
    return nodes.groupBy("replica", "tree", F.floor(F.col("place") / FAN).cast("long").alias("place")).agg(
        F.unhex(F.sha2(F.concat_ws(";", children["said"]), 256)).alias("digest"), F.min("start").alias("start"), F.max("end").alias("end"),
    )


def merkle_levels(nodes: DataFrame) -> list[DataFrame]:
    """Trees over nodes (replica, tree, place, digest, start, end): levels from the nodes up to one root for each tree."""
    levels, last = [nodes], nodes.agg(F.max("place")).first()[0] or 0
    while last > 0:
        levels.append(cut(_above(levels[-1])))
        last //= FAN
    return levels


def _differing(nodes: DataFrame) -> DataFrame:
    sides = [nodes.where(F.col("replica") == k).select("tree", "place", F.col("digest").alias(f"d{k}")) for k in (0, 1)]
    return cut(sides[0].join(sides[1], ["tree", "place"], "full").where("NOT d0 <=> d1").select("tree", "place"))


def _descend(levels: list[DataFrame], found: DataFrame) -> DataFrame:
    """Nodes of the lowest level that differ, below the roots in found; other branches are not looked at."""
    for nodes in reversed(levels[:-1]):
        parents = found.select(F.col("tree").alias("of_tree"), F.col("place").alias("of_place"))
        below = (F.col("tree") == F.col("of_tree")) & (F.floor(F.col("place") / FAN).cast("long") == F.col("of_place"))
        found = _differing(nodes.join(parents, below, "left_semi"))
    return found


def differing_records(records: DataFrame) -> DataFrame:
    """Records in which replicas 0 and 1 differ: file, place."""
    names = records.select(F.col("file").alias("name")).distinct()
    files = cut(positioned(names, ["name"], "tree").withColumn("tree", F.col("tree").cast("long")))
    nodes = records.join(files, F.col("file") == F.col("name")).select("replica", "tree", "place", "digest", "start", "end")
    of_records = merkle_levels(cut(nodes))
    file_roots = of_records[-1].select("replica", F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), "digest", "start", "end")
    of_files = merkle_levels(file_roots)
    bad_files = _descend(of_files, _differing(of_files[-1]))
    bad = _descend(of_records, bad_files.select(F.col("place").alias("tree"), F.lit(0).cast("long").alias("place")))
    return bad.join(files, "tree").select(F.col("name").alias("file"), "place")


def damaged(html: Column) -> Column:
    """The text with its first character changed."""
    return F.overlay(html, F.when(F.substring(html, 1, 1) == "#", "%").otherwise("#"), F.lit(1), F.lit(1))


def fixity_audit(pages: DataFrame, damage: Column) -> DataFrame:
    """Write two replicas, the second damaged where ``damage`` holds, and audit them from their files.

    Every record of the first: page_id, n_bytes, record_sha256, intact.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    html = F.coalesce("html", F.lit(""))
    write_replicas(pages, folder, [html, F.when(damage & (html != ""), damaged(html)).otherwise(html)])
    records = stored(read_records(spark, folder), "records")
    bad = differing_records(records).select(F.col("file").alias("f"), F.col("place").alias("p"))
    whole = records.where("replica = 0").join(bad, (F.col("file") == F.col("f")) & (F.col("place") == F.col("p")), "left")
    return whole.select(
        F.col("record").cast(pages.schema["page_id"].dataType).alias("page_id"), (F.col("end") - F.col("start")).alias("n_bytes"),
        F.lower(F.hex("digest")).alias("record_sha256"), F.col("f").isNull().alias("intact"),
    )
