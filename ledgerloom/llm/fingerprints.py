"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases by its own content: runs of one symbol are joined, deterministic coin tossing gives
neighbouring symbols different small labels (the lowest bit in which a symbol differs from the one before, and its
value there, three times over), and a phrase begins at each local maximum of the labels. A phrase's name is a hash of
its symbols; the names are the symbols of the next level. Where phrases begin depends on a few symbols around only,
so equal substrings have equal phrases inside, at whatever offset they stand. The fingerprint
holds the smallest ``KEPT`` hashes of the names of LEVELS, and two fingerprints' likeness is the share of
equal ones among the smallest of both: an estimate of the texts' shared phrases.

Defined results: null text is empty; an empty text has an empty fingerprint, and two empty fingerprints have likeness 1,
an empty and another 0. Rows with one id stand in order of their texts, null ids after all others. A
table of one row is its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import in_slices, raw_bytes, stored, text_or_empty

KEPT = 64
LEVELS = (2, 3)
SLICE_BYTES = 512 << 10  # parsed at a time, so that arrays stay in the processor's cache

_BYTE_NAMES = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def _toss_table(width: int) -> np.ndarray:
    """Label for each pair (symbol before, symbol) of small symbols; equal symbols have a label of their own."""
    before, here = np.divmod(np.arange(width * width), width)
    differ = before ^ here
    place = np.bitwise_count((differ & -differ) - 1)
    return np.where(differ == 0, 15, 2 * place + (here >> np.minimum(place, 7) & 1)).astype(np.uint8)


_TOSS_BYTES, _TOSS_LABELS, _TOSS_SMALL = _toss_table(256), _toss_table(128), _toss_table(16)


def _toss_small(x: np.ndarray, starts: np.ndarray, table: np.ndarray, width: int) -> np.ndarray:
    pair = x.astype(np.uint16)
    before = np.empty_like(pair)
    before[1:] = pair[:-1]
    before[starts] = pair[starts] ^ np.uint16(1)
    return table[before * np.uint16(width) + pair] if width < 256 else table[(before.astype(np.uint32) << np.uint32(8)) + pair]


def _toss_names(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    differ = np.empty_like(x)
    differ[1:] = x[1:] ^ x[:-1]
    differ[starts] = 1
    place = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1))
    return (2 * np.minimum(place, 63) + (x >> np.minimum(place, 63).astype(np.uint64) & np.uint64(1)).astype(np.uint8)).astype(np.uint8)


def _next_level(names: np.ndarray, offsets: np.ndarray, level: int, symbols: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of one level up, and the texts' offsets among them. symbols: bytes, at the lowest level."""
    full = offsets[1:] > offsets[:-1]
    starts = offsets[:-1][full]
    # a run of one symbol becomes one symbol named by its length
    first = np.empty(len(names), bool)
    raw = names if symbols is None else symbols
    first[1:] = raw[1:] != raw[:-1]
    first[starts] = True
    if not first.all():
        at = np.flatnonzero(first)
        length = np.diff(np.append(at, len(names))).astype(np.uint64)
        names = np.where(length > 1, _mixed(names[at] + length * _STEP), names[at])
        symbols = None if symbols is None else symbols[at]
        offsets = np.concatenate([[0], np.cumsum(first)])[offsets]
        starts = offsets[:-1][full]
    if symbols is None:
        labels = _toss_small(_toss_names(names, starts), starts, _TOSS_LABELS, 128)
    else:
        labels = _toss_small(symbols, starts, _TOSS_BYTES, 256)
    labels = _toss_small(labels, starts, _TOSS_SMALL, 16)
    begins = np.empty(len(names), bool)
    begins[:-1] = labels[:-1] > labels[1:]
    begins[offsets[1:][full] - 1] = True
    begins[1:] &= labels[1:] > labels[:-1]
    begins[starts] = True
    at = np.flatnonzero(begins)
    length = np.diff(np.append(at, len(names)))
    place = np.arange(len(names)) - np.repeat(at, length)
    powers = _mixed((np.arange(length.max(initial=0)).astype(np.uint64) + np.uint64(1)) * _STEP) | np.uint64(1)
    made = np.add.reduceat(_mixed(names) * powers[place], at) if len(at) else names
    return _mixed(made + np.array([level], np.uint64) * _STEP), np.concatenate([[0], np.cumsum(begins)])[offsets]


def sketches(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The fingerprint of each text of a batch as sorted 32-bit hashes."""
    n = len(offsets) - 1
    names, at, rows, hashes = _BYTE_NAMES[data], offsets, [], []
    for level in range(1, max(LEVELS) + 1):
        names, at = _next_level(names, at, level, data if level == 1 else None)
        if level in LEVELS:
            rows.append(np.repeat(np.arange(n, dtype=np.uint64), np.diff(at)))
            hashes.append(_mixed(names ^ _STEP) >> np.uint64(32))
    keys = np.sort(np.concatenate(rows) << np.uint64(32) | np.concatenate(hashes))
    keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    ends = np.searchsorted(keys, np.arange(n + 1, dtype=np.uint64) << np.uint64(32))
    return [keys[a:min(b, a + KEPT)].astype(np.uint32) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    mine, other = set(a.tolist()), set(b.tolist())
    smallest = sorted(mine | other)[:KEPT]
    return sum(1 for x in smallest if x in mine and x in other) / len(smallest)


def edited(text: str, following: str) -> str:
    """The last third of the text's code points replaced by as many (or all) of the next document's first."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def _of_texts(texts: list[str]) -> list[np.ndarray]:
    data = [t.encode() for t in texts]
    return sketches(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64))


def _columns(rows: list[tuple], kind: int, part: int, id_type: pa.DataType) -> pa.RecordBatch:
    """rows: (id, text, its sketch, next text, next sketch) whose next document is known."""
    changed = [edited(r[1], r[3]) for r in rows]
    prints = _of_texts(changed)
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array([r[0] for r in rows], id_type),
            pa.array([len(r[1]) for r in rows], pa.int64()), pa.array([hashlib.sha256(t.encode()).digest() for t in changed], pa.binary()),
            pa.array([r[2].astype(">u4").tobytes() for r in rows], pa.binary()), pa.array([p.astype(">u4").tobytes() for p in prints], pa.binary()),
            pa.array([likeness(r[2], p) for r, p in zip(rows, prints)], pa.float64()), pa.array([likeness(r[2], r[4]) for r in rows], pa.float64()),
            pa.nulls(n, pa.string()),
        ],
        _NAMES,
    )


_NAMES = ["kind", "part", "doc_id", "n_chars", "edited_sha", "print", "edited_print", "near_edited", "near_next", "text"]
_DONE, _HEAD, _TAIL = 0, 1, 2


def _edge(kind: int, part: int, row: tuple, id_type: pa.DataType) -> pa.RecordBatch:
    """The first or last row of a part, whose neighbour is in another part."""
    values = [kind, part, row[0], None, None, None, None, None, None, row[1]]
    types = [pa.int32(), pa.int32(), id_type, pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], _NAMES)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, waiting, id_type = TaskContext.get().partitionId(), None, None
    for whole in batches:
        for batch in in_slices(whole, "text", SLICE_BYTES):
            id_type = batch.column("doc_id").type
            rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), sketches(*raw_bytes(batch.column("text")))))
            if waiting is None:
                yield _edge(_HEAD, part, rows[0], id_type)
            else:
                rows.insert(0, waiting)
            waiting = rows[-1]
            if len(rows) > 1:
                yield _columns([(*a, b[1], b[2]) for a, b in zip(rows, rows[1:])], _DONE, part, id_type)
    if waiting is not None:
        yield _edge(_TAIL, part, waiting, id_type)


def _over_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in in_slices(whole, "text", SLICE_BYTES):
            texts, following = batch.column("text").to_pylist(), batch.column("next_text").to_pylist()
            rows = zip(batch.column("doc_id").to_pylist(), texts, _of_texts(texts), following, _of_texts(following))
            yield _columns(list(rows), _DONE, -1, batch.column("doc_id").type)


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Every row: n_chars, fingerprint, that of its edited text, likeness to it and to the next document's.

    Texts are moved once, into descending order of id; only the last row of each part looks for its
    next document in another part.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"kind int, part int, doc_id {id_type}, n_chars long, edited_sha binary, print binary, edited_print binary, "
        "near_edited double, near_next double, text string"
    )
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = rows.repartitionByRange(F.desc("doc_id")).sortWithinPartitions(F.desc("doc_id"), "text")
    made = stored(rows.mapInArrow(_in_order, schema), "fingerprints")
    heads = made.where(F.col("kind") == _HEAD).select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    parts = made.where(F.col("kind") == _TAIL).select("part")
    after = F.coalesce(F.lead("part").over(W.orderBy("part")), F.min("part").over(W.partitionBy()))
    links = parts.select(F.col("part").alias("from_part"), after.alias("to_part"))  # one row a part
    tails = made.where(F.col("kind") == _TAIL).select("part", "doc_id", "text")
    tails = tails.join(links, F.col("part") == F.col("from_part")).join(heads, F.col("to_part") == F.col("next_part"))
    over = tails.select("doc_id", "text", "next_text").mapInArrow(_over_edges, schema)
    return made.where(F.col("kind") == _DONE).unionByName(over).select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha")).alias("edited_sha256"), F.lower(F.hex("print")).alias("fingerprint"),
        F.lower(F.hex("edited_print")).alias("edited_fingerprint"), "near_edited", "near_next",
    )
