"""Removal of repeated passages: every byte covered by a string of SPAN bytes that also starts anywhere else.

A suffix array of the whole corpus would sort every position. Sorted here are only suffixes that can matter:

1. *Anchors.* Each window of SPAN bytes picks the GRAM-byte string with the smallest hash inside it
   (leftmost of equals), so equal windows pick the same anchor at the same place. Consecutive windows with one anchor form
   a segment; about one byte in 170 is an anchor. Anchors that occur once in the corpus end here.
2. *Whole segments.* Where all segments of an anchor are equal, or a segment occurs more than once, every
   window in it is repeated. Sums are taken before rows meet, so copies and common passages are no hot keys.
   Equal here means equal 128-bit BLAKE2 digests of the segments' bytes: the hashes below can be made to collide.
3. *Suffix sort.* The distinct segments of an anchor are sorted by what follows the anchor and by what precedes
   it: a mergesort whose comparisons find the common extension by binary search on prefix polynomial
   hashes, then look at one byte; the bytes of a window are compared before it counts as repeated here. Neighbours in
   both orders tell the longest repeated window to either side, and the windows of a segment all
   hold its anchor, so what they cover is one run.
4. Anchors with more than GROUP distinct segments (the edges of a very common passage) are halved first. Equal windows
   hold the anchor at the same distance, so for one half of all distances they agree on the bytes next to the anchor that
   all windows of that half have: segments fall into groups by a 128-bit hash of these bytes, cut to what the half can
   reach. A group of one ends; one whose members are the same bytes is repeated as a whole; one of up to GROUP members is
   sorted as above; what is left is halved again, nine times at most.

Defined results: texts are UTF-8 bytes, null is empty; matches never cross documents; strings are judged on the
input. A text shorter than SPAN stays whole. Rows that repeat in full are each other's copies and lose
everything, as other copies do, if they have SPAN bytes. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cmp_to_key
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, in_slices, raw_bytes, stored, text_or_empty

SPAN, GRAM, GROUP = 400, 64, 1000
SLICE_BYTES = 256 << 10

_U = np.uint64
_M = (1 << 64) - 1
_RANDOM = np.random.Generator(np.random.PCG64(4))
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=_U)
_BASE = int(_RANDOM.integers(1, 1 << 62)) * 4 + 1
_PLACE_BITS = _U((1 << 31) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    made, have = np.ones(max(n, 1), _U), 1
    while have < n:
        more = min(have, n - have)
        made[have:have + more] = made[:more] * _U(pow(base, have, 1 << 64))
        have += more
    return made


class _Prefix:
    """Polynomial hashes of all prefixes of a byte array; a substring's hash is a difference, moved to place 0."""

    up = down = np.ones(0, _U)

    def __init__(self, data: np.ndarray):
        if len(_Prefix.up) < len(data) + 1:
            _Prefix.up, _Prefix.down = _powers(_BASE, len(data) + 1), _powers(pow(_BASE, -1, 1 << 64), len(data) + 1)
        self.sums = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTES[data] * _Prefix.up[:len(data)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * _Prefix.down[start]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each width neighbours: prefix minima of one block and suffix minima of the one before."""
    n = len(x) - width + 1
    blocks = np.concatenate([x, np.full(-len(x) % width, np.iinfo(_U).max, _U)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments of each text: row, first window, windows after it, anchor's distance from it, anchor hash, segment digest (two)."""
    none = np.zeros(0, np.int64)
    if len(data) < SPAN:
        return (none,) * 7
    prefix = _Prefix(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = _mixed(prefix.of(at, at + GRAM))
    picked = (_sliding_min(grams & ~_PLACE_BITS | at.astype(_U), SPAN - GRAM + 1) & _PLACE_BITS).astype(np.int64)
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(len(lengths)), np.maximum(lengths - SPAN + 1, 0))
    windows = np.maximum(lengths - SPAN + 1, 0)
    place = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows) + offsets[:-1][row]
    picked = picked[place]
    fresh = np.ones(len(place), bool)
    fresh[1:] = (picked[1:] != picked[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(fresh)
    if not len(head):
        return (none,) * 7
    more = np.diff(np.append(head, len(place))) - 1
    first, anchor = place[head], picked[head]
    left, row = anchor - first, row[head]
    return row, first - offsets[:-1][row], more, left, grams[anchor].view(np.int64), *_digests(data, first, more, left)


def _digests(data: np.ndarray, first: np.ndarray, more: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the bytes of each segment and of the place of the anchor in it, as two columns."""
    held, shape = memoryview(np.ascontiguousarray(data)), (left << 10 | more).astype("<i4").tobytes()
    made = []
    for i, (a, b) in enumerate(zip(first.tolist(), (first + more + SPAN).tolist())):
        made.append(blake2b(held[a:b], digest_size=16, salt=shape[4 * i:4 * i + 4]).digest())
    both = np.frombuffer(b"".join(made), np.int64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


_PARTS = ["anchor", "segment", "other", "first", "shape"]


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in in_slices(whole, "text", SLICE_BYTES):
            row, first, more, left, anchor, segment, other = segments(*raw_bytes(batch.column("text")))
            ends = np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (anchor, segment, other, first, left << 10 | more)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("t"), *lists], ["doc_id", "t", *_PARTS])


# --- suffix sort of the segments of one anchor ---------------------------------------------


def _agreeing(x: bytes, y: bytes) -> int:
    """Bytes that agree from the start of two strings of one length."""
    return len(x) if x == y else next(n for n, (a, b) in enumerate(zip(x, y)) if a != b)


class _Segments:
    """Segments of one anchor: text, and where the anchor stands in it."""

    def __init__(self, texts: list[bytes], lefts: list[int]):
        self.texts, self.lefts = texts, lefts
        data = b"".join(texts)
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).tolist()
        self.sums = _Prefix(np.frombuffer(data, np.uint8)).sums.tolist()
        self.down = _Prefix.down[:len(data) + 1].tolist()
        self.rights = [len(t) - left for t, left in zip(texts, lefts)]

    def _equal(self, a: int, b: int, n: int) -> bool:
        return ((self.sums[a + n] - self.sums[a]) * self.down[a] - (self.sums[b + n] - self.sums[b]) * self.down[b]) & _M == 0

    def right(self, i: int, j: int) -> int:
        """Bytes that agree from the anchor on."""
        a, b = self.starts[i] + self.lefts[i], self.starts[j] + self.lefts[j]
        low, high = 0, min(self.rights[i], self.rights[j])
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self._equal(a, b, middle) else (low, middle - 1)
        x, y = self.lefts[i], self.lefts[j]
        return _agreeing(self.texts[i][x:x + low], self.texts[j][y:y + low])

    def left(self, i: int, j: int) -> int:
        """Bytes that agree before the anchor."""
        a, b = self.starts[i] + self.lefts[i], self.starts[j] + self.lefts[j]
        low, high = 0, min(self.lefts[i], self.lefts[j])
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self._equal(a - middle, b - middle, middle) else (low, middle - 1)
        x, y = self.lefts[i], self.lefts[j]
        return _agreeing(self.texts[i][x - low:x][::-1], self.texts[j][y - low:y][::-1])

    def after(self, i: int, j: int) -> int:
        n = self.right(i, j)
        x = self.texts[i][self.lefts[i] + n:self.lefts[i] + n + 1]
        y = self.texts[j][self.lefts[j] + n:self.lefts[j] + n + 1]
        return (x > y) - (x < y)

    def before(self, i: int, j: int) -> int:
        n = self.left(i, j)
        x = self.texts[i][self.lefts[i] - n - 1] if n < self.lefts[i] else -1
        y = self.texts[j][self.lefts[j] - n - 1] if n < self.lefts[j] else -1
        return (x > y) - (x < y)


def _nearest(order: list[int], common: list[int], at: int):
    """Others in falling order of their common extension with order[at]."""
    low, high, n = at - 1, at + 1, len(order)
    down = common[low] if low >= 0 else -1
    up = common[at] if high < n else -1
    while down >= 0 or up >= 0:
        if down >= up:
            yield order[low], down
            low -= 1
            down = min(down, common[low]) if low >= 0 else -1
        else:
            yield order[high], up
            up = min(up, common[high]) if high + 1 < n else -1
            high += 1


def repeated_runs(texts: list[bytes], lefts: list[int], single: list[bool]) -> list[tuple[int, int] | None]:
    """For each single segment the run (start, end) inside it that its repeated windows cover."""
    s, ids = _Segments(texts, lefts), list(range(len(texts)))
    by_right, by_left = sorted(ids, key=cmp_to_key(s.after)), sorted(ids, key=cmp_to_key(s.before))
    rights = [s.right(a, b) for a, b in zip(by_right, by_right[1:])]
    left_runs = [s.left(a, b) for a, b in zip(by_left, by_left[1:])]
    at_right, at_left = {x: k for k, x in enumerate(by_right)}, {x: k for k, x in enumerate(by_left)}
    found: list[tuple[int, int] | None] = [None] * len(texts)
    for i in ids:
        if not single[i]:
            continue
        k = at_right[i]
        most_right = max(rights[max(k - 1, 0):k + 1], default=0)
        longest = None
        for j, left in _nearest(by_left, left_runs, at_left[i]):
            if left + most_right < SPAN:
                break
            if left + s.right(i, j) >= SPAN:
                longest = left
                break
        if longest is None:
            continue
        shortest = longest
        for j, right in _nearest(by_right, rights, k):
            if SPAN - right >= longest:
                break
            if s.left(i, j) + right >= SPAN:
                shortest = SPAN - right
                break
        found[i] = (lefts[i] - longest, lefts[i] - shortest + SPAN)
    return found


_SEGMENT = ["anchor", "segment", "other"]
_RUN = "anchor long, segment long, other long, run_start int, run_end int"
_GROUP = ["anchor", "part"]


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of anchor and part; a group has GROUP rows at most."""
    made: list[tuple] = []
    group: dict[tuple, tuple] = {}
    anchor = None

    def close() -> None:
        rows = list(group.items())
        if len(rows) > 1 and any(r[1][2] for r in rows):
            runs = repeated_runs([r[1][0] for r in rows], [r[1][1] for r in rows], [r[1][2] for r in rows])
            made.extend((anchor[0], *r[0], r[1][3] + run[0], r[1][3] + run[1]) for r, run in zip(rows, runs) if run)

    def batch() -> pa.RecordBatch:
        columns = list(zip(*made)) or [[]] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*_SEGMENT, "run_start", "run_end"])

    for rows in batches:
        columns = (rows.column(c).to_pylist() for c in (*_GROUP, "segment", "other", "times", "left", "shift", "body"))
        for *key, segment, other, times, left, shift, text in zip(*columns):
            if key != anchor:
                close()
                anchor, group = key, {}
            group[segment, other] = (text, left, times == 1, shift)
        yield batch()
        made = []
    close()
    yield batch()


_HALF = "anchor long, segment long, other long, times long, left int, shift int, body binary, low int, high int, part binary, full boolean"


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment once for each half of its distances that has a window in it.

    A row holds the bytes that windows of its half reach, ``part`` (the half, and a hash of the bytes that all
    of them have), and whether the segment has all of that reach.
    """
    names = [*_SEGMENT, "times", "left", "shift", "body", "low", "high", "part", "full"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
    for whole in batches:
        for batch in in_slices(whole, "body", SLICE_BYTES):
            rows = []
            for *segment, times, left, shift, body, low, high in zip(*(batch.column(c).to_pylist() for c in names[:9])):
                middle = (low + high) // 2
                for p, q in ((low, middle), (middle + 1, high)):
                    before, after = min(left, q), min(len(body) - left, SPAN - p)
                    if p > q or before < p or after < SPAN - q or before + after < SPAN:
                        continue
                    common = body[left - p:left + SPAN - q]
                    part = p.to_bytes(2) + q.to_bytes(2) + blake2b(common, digest_size=16).digest()
                    rows.append((
                        *segment, times, before, shift + left - before, body[left - before:left + after], p, q, part,
                        before == q and after == SPAN - p,
                    ))
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _large_runs(contexts: DataFrame) -> DataFrame:
    """Runs of single segments of anchors with more than GROUP distinct segments, by halving (see the top)."""
    rows = contexts.withColumns({"low": F.lit(0), "high": F.lit(SPAN - GRAM)})
    found = []
    for last in [False] * 9 + [True]:  # 337 distances: after nine halvings each is alone
        rows = stored(rows.mapInArrow(_halved, _HALF), "halves")
        groups = rows.groupBy(*_GROUP).agg(
            F.count("*").alias("k"), (F.bool_and("full") & (F.min("body") == F.max("body"))).alias("same")
        )
        met = stored(rows.join(cut(groups.where("k > 1")), _GROUP), "halves-met")
        whole = met.where("same AND times = 1")
        found.append(whole.select(*_SEGMENT, F.col("shift").alias("run_start"), (F.col("shift") + F.length("body")).alias("run_end")))
        few = met.where("NOT same" if last else F.expr("NOT same") & (F.col("k") <= GROUP))
        found.append(few.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(_sorted_groups, _RUN))
        rows = met.where(F.expr("NOT same") & (F.col("k") > GROUP))
        if last or rows.isEmpty():
            break
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    # all runs of a segment hold its anchor, so together they are one run
    return every.groupBy(*_SEGMENT).agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"))


_BODY = "anchor long, segment long, other long, times long, large boolean, left int, body binary"


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted segments of each text."""
    names = [*_SEGMENT, "times", "large", "left", "body"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]
    for whole in batches:
        for batch in in_slices(whole, "text", SLICE_BYTES):
            rows = []
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                data = text.encode()
                for w in wanted:
                    left, more = w["shape"] >> 10, w["shape"] & 1023
                    rows.append((*(w[c] for c in _SEGMENT), w["times"], w["large"], left, data[w["first"]:w["first"] + more + SPAN]))
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


# --- the job -------------------------------------------------------------------------------


def _text_hash() -> Column:
    return F.xxhash64(text_or_empty())


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", _text_hash().alias("t"), text_or_empty().alias("text"))


_ROW = ["doc_id", "t"]


def _of_row(frame: DataFrame, prefix: str) -> DataFrame:
    return frame.withColumnRenamed("doc_id", f"{prefix}_id").withColumnRenamed("t", f"{prefix}_t")


def _same_row(prefix: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(f"{prefix}_id")) & (F.col("t") == F.col(f"{prefix}_t"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Rows with something to remove: doc_id, t (hash of the text), spans (sorted, may overlap)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"{p} array<long>" for p in _PARTS)
    table = stored(_texts(docs).mapInArrow(_found, f"doc_id {id_type}, t long, {lists}"), "anchors")
    rows = table.select("doc_id", "t", F.explode(F.arrays_zip(*_PARTS)).alias("x")).select("doc_id", "t", "x.*")

    one = (F.min("segment") == F.max("segment")) & (F.min("other") == F.max("other"))
    counts = rows.groupBy("anchor").agg(F.count("*").alias("n"), one.alias("uniform"))
    counts = cut(counts.where("n > 1").select("anchor", "uniform"))
    repeated = stored(rows.join(counts, "anchor"), "repeated")
    mixed = repeated.where("NOT uniform")

    where = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t", "first", "shape")).alias("at")
    classes = cut(mixed.groupBy(*_SEGMENT).agg(F.count("*").alias("times"), where))
    large = cut(classes.groupBy("anchor").count().where(F.col("count") > GROUP).select("anchor", F.lit(True).alias("large")))
    wanted = classes.join(large, "anchor", "left").groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.t").alias("t")).agg(
        F.collect_list(F.struct(*_SEGMENT, "times", "at.first", "at.shape", F.expr("large IS NOT NULL").alias("large"))).alias("wanted")
    )
    bodies = _texts(docs).join(_of_row(wanted, "w"), _same_row("w")).select("text", "wanted")
    contexts = stored(bodies.mapInArrow(_bodies, _BODY), "contexts").withColumns({"shift": F.lit(0), "part": F.expr("X''")})
    # No join by anchor between the table and repartition: Spark takes the join's shuffle for both, and when it turns that join
    # into a broadcast one or splits its parts, the segments of an anchor no longer meet.
    small = contexts.where("NOT large").repartition("anchor").sortWithinPartitions(*_GROUP)
    runs = small.mapInArrow(_sorted_groups, _RUN)
    if not large.isEmpty():
        runs = runs.unionByName(_large_runs(contexts.where("large")))
    every = F.least(F.col("at.shape") % 1024 + SPAN, F.lit(1 << 30)).cast("int")
    whole = classes.where("times > 1").select(*_SEGMENT, F.lit(0).alias("run_start"), every.alias("run_end"))
    runs = cut(runs.unionByName(whole))

    length = F.col("shape") % 1024 + SPAN
    full = repeated.where("uniform").select(*_ROW, F.col("first").alias("start"), (F.col("first") + length).alias("end"))
    part = mixed.join(runs, _SEGMENT).select(
        *_ROW, (F.col("first") + F.col("run_start")).alias("start"), (F.col("first") + F.col("run_end")).alias("end")
    )
    spans = full.unionByName(part).groupBy(*_ROW)
    return spans.agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    made: list[tuple[int, int]] = []
    for span in spans or []:
        if made and span["start"] <= made[-1][1]:
            made[-1] = (made[-1][0], max(made[-1][1], span["end"]))
        else:
            made.append((span["start"], span["end"]))
    return made


def _kept(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(end for _, end in runs)]
    return b"".join(data[a:b] for a, b in zip(ends, [*(start for start, _ in runs), len(data)]))


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in in_slices(whole, "text", SLICE_BYTES):
            rows = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                data, runs = text.encode(), _merged(spans)
                kept = _kept(data, runs)
                rows.append((len(data), sum(b - a for a, b in runs), len(runs), kept, kept.decode("utf-8", "ignore")))
            n, gone, runs, kept, kept_text = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary()),
                 pa.array(kept_text, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_text"],
            )


def without_repeats(docs: DataFrame) -> DataFrame:
    """Every row: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes), kept_text (their whole characters)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = _texts(docs).join(_of_row(repeated_spans(docs), "s"), _same_row("s"), "left")
    return rows.select("doc_id", "text", "spans").mapInArrow(
        _removed, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary, kept_text string"
    )


def removal_report(docs: DataFrame) -> DataFrame:
    """:func:`without_repeats` with a digest of the remaining bytes, and the remaining text itself."""
    return without_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "kept_text"
    )
