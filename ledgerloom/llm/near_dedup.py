"""Near-duplicate detection by MinHash: documents whose word shingles agree by 75 percent or more.

1. Each text becomes its set of distinct 5-word shingles (64-bit hashes). Equal sets form a class; from here on a
   class is one node, so a text that a third of all rows have is one row.
2. A class is sketched by one-permutation hashing into BINS bins; an empty bin takes the value of the first filled
   bin in a random order of its own (optimal densification). BANDS bands of the sketch give buckets.
3. Rounds of stars: each bucket that holds several components names one member as its centre, in an order that is another
   one in each round, and a class is compared with one centre of another component, the one that most of its buckets name.
   So a round makes one pair a class at most, however many buckets or members there are. Pairs whose sizes
   rule out a link are left out; the others are checked on the full sets, both texts read again, and the components that
   they link are contracted. Rounds end when one finds no link, or after ROUNDS of them.
4. Small buckets (up to SMALL members) that still hold several components are then told in full: all pairs across components.
5. What is still open in larger buckets is settled exactly, by a prefix filter: sets that agree by PERCENT share one of
   the rarest shingles of each, so classes of different components meet by these shingles, where parities of their whole
   sets do not rule a link out (:func:`_open_pairs`).

A pair at the threshold shares no bucket with a probability of about 5 in a million; every pair that shares one is
linked, through others or by itself. Full sets are sets of 64-bit shingle hashes; equal sets are told by 128 bits of them.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a text of fewer than five words is one
shingle, a text without words (or null) has none and is alone. The row that stays is the one with the
smallest id, null ids last. ``kept`` says whether the id is that smallest one, ``stays`` which of its rows, where an id repeats
with other texts. Rows that repeat id and text are marked alike; :func:`without_near_copies` keeps
one. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, in_slices, raw_bytes, stored, text_or_empty

WORDS = 5
PERCENT = 75
BINS, BANDS = 128, 32
SMALL, ROUNDS = 40, 6
PART_LINKS = 500_000  # links that one task contracts
SLICE_BYTES = 512 << 10
SLOTS = 1 << 20  # counts of shingles, for the order of the prefix filter
HOT = 1000  # classes that one task compares with the others of a shingle
MARKS = 8  # words of 64 parities that stand for a set before its texts are read

_U = np.uint64
_RANDOM = np.random.Generator(np.random.PCG64(5))
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=_U)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES[_SPACE] = 0
_BYTES[65:91] = _BYTES[97:123]
_BASE = int(_RANDOM.integers(1, 1 << 62)) * 4 + 1
_PLACES = _RANDOM.integers(1, 1 << 63, WORDS, dtype=_U) * _U(2) + _U(1)
_PROBES = _RANDOM.integers(0, BINS, (4096, BINS))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64, by doubling."""
    made = np.ones(max(n, 1), _U)
    have = 1
    while have < n:
        more = min(have, n - have)
        made[have:have + more] = made[:more] * _U(pow(base, have, 1 << 64))
        have += more
    return made


class _PowerTable:
    """Powers of the base and of its inverse, as long as the longest batch so far needed."""

    up = down = np.ones(0, _U)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return cls.up, cls.down


def shingle_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hashes, sorted within each text, and the texts' offsets among them."""
    n, size = len(offsets) - 1, len(data)
    if not size:
        return np.zeros(0, _U), np.zeros(n + 1, np.int64)
    up, down = _PowerTable.of(size + 1)
    word = ~_SPACE[data]
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTES[data] * up[:size])])
    words = _mixed((sums[last] - sums[first]) * down[first])
    at = np.searchsorted(first, offsets)  # words before each text
    counts = np.diff(at)
    row = np.repeat(np.arange(n), counts)
    place = np.arange(len(words))
    whole = place + WORDS <= at[1:][row]
    start = np.flatnonzero(whole)
    keys = np.zeros(len(start), _U)
    for j in range(WORDS):
        keys += words[start + j] * _PLACES[j]
    rows = row[start]
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    few = [(words[at[i]:at[i + 1]] * _PLACES[:counts[i]]).sum() ^ _U(counts[i]) for i in short]
    keys = _mixed(np.concatenate([keys, np.array(few, _U)]))
    rows = np.concatenate([rows, short])
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    keys, rows = keys[fresh], rows[fresh]
    return keys, np.searchsorted(rows, np.arange(n + 1))


def sketch_bands(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bucket of each band of each non-empty set (rows) from its one-permutation sketch."""
    n = len(at) - 1
    rows = np.repeat(np.arange(n), np.diff(at))
    cell = rows * BINS + (keys >> _U(57)).astype(np.int64)
    head = np.ones(len(cell), bool)
    head[1:] = cell[1:] != cell[:-1]  # keys are sorted: the first of a bin is its smallest
    sketch, filled = np.zeros(n * BINS, _U), np.zeros(n * BINS, bool)
    sketch[cell[head]], filled[cell[head]] = keys[head], True
    empty = np.flatnonzero(~filled)
    empty = empty[(np.diff(at) > 0)[empty // BINS]]
    for probe in _PROBES:
        if not len(empty):
            break
        donor = empty - empty % BINS + probe[empty % BINS]
        found = filled[donor]
        sketch[empty[found]] = sketch[donor[found]]
        empty = empty[~found]
    sketch = _mixed(sketch).reshape(n, BANDS, BINS // BANDS)
    made = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U), (n, BANDS)).copy()
    for j in range(BINS // BANDS):
        made = _mixed(made * _U(0x9E3779B97F4A7C15) + sketch[:, :, j])
    return made


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in in_slices(whole, "text", SLICE_BYTES):
            keys, at = shingle_keys(*raw_bytes(batch.column("text")))
            n = np.diff(at)
            sums = np.concatenate([np.zeros((1, 2), _U), np.cumsum(np.stack([_mixed(keys), _mixed(keys ^ _PLACES[0])], 1), axis=0)])
            name = (sums[at[1:]] - sums[at[:-1]]).view(np.int64)
            bands = sketch_bands(keys, at).view(np.int64)
            has = n > 0
            ends = np.concatenate([[0], np.cumsum(np.where(has, BANDS, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[has].ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("t"), pa.array(n.astype(np.int64)), pa.array(name[:, 0].copy()), pa.array(name[:, 1].copy()), lists],
                ["doc_id", "t", "n_shingles", "a", "b", "bands"],
            )


def _text_hash() -> Column:
    return F.xxhash64(text_or_empty())


def sketched(docs: DataFrame) -> DataFrame:
    """Every row: doc_id, t (hash of the text), n_shingles, a and b (name of its set), bands."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", _text_hash().alias("t"), text_or_empty().alias("text"))
    return rows.mapInArrow(_sketched, f"doc_id {id_type}, t long, n_shingles long, a long, b long, bands array<long>")


# --- links ---------------------------------------------------------------------------------


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in in_slices(whole, "text_u", SLICE_BYTES):
            (u, at_u), (v, at_v) = (shingle_keys(*raw_bytes(batch.column(c))) for c in ("text_u", "text_v"))
            linked = []
            for i in range(len(batch)):
                mine, other = u[at_u[i]:at_u[i + 1]], v[at_v[i]:at_v[i + 1]]
                same = len(np.intersect1d(mine, other, assume_unique=True))
                linked.append(100 * same >= PERCENT * (len(mine) + len(other) - same))
            kept = batch.filter(pa.array(linked, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("u"), kept.column("v")], ["u", "v"])


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) of classes whose full sets agree by PERCENT or more. texts: node, text.

    Joins are by node; a node in very many pairs is split by the skew join of the engine.
    """
    u = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    v = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    node = pairs.schema["u"].dataType.simpleString()
    return pairs.join(u, "u").join(v, "v").select("u", "v", "text_u", "text_v").mapInArrow(_checked, f"u {node}, v {node}")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one part: each node once, with the smallest node it reaches here."""
    parent: dict[tuple, tuple] = {}

    def top(x: tuple) -> tuple:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        sides = [zip(*(batch.column(c).field(k).to_pylist() for k in (0, 1))) for c in ("u", "v")]
        for u, v in zip(*sides):
            u, v = top(parent.setdefault(u, u)), top(parent.setdefault(v, v))
            parent[max(u, v)] = min(u, v)

    def nodes(pairs: list[tuple]) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

    found = list(parent)
    yield pa.RecordBatch.from_arrays([nodes(found), nodes([top(x) for x in found])], ["node", "root"])


def components(links: DataFrame) -> DataFrame:
    """Each linked node and the smallest node it reaches: node, root.

    Each part of PART_LINKS links or so is contracted by itself. Where parts give a node
    different roots, these are linked, and the roots' components are found in the same way; they are far fewer.
    A node is once in a part at most, so no node is a hot key.
    """
    node = links.schema["u"].dataType.simpleString()
    parts = links.count() // PART_LINKS + 1
    forest = cut(links.select("u", "v").repartition(parts).mapInArrow(_forest, f"node {node}, root {node}"))
    least = cut(forest.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")))
    clash = least.where("low <> high").select("node", "low")
    if clash.isEmpty():
        return least.select("node", F.col("low").alias("root"))
    between = forest.join(clash, "node").where("root <> low").select(F.col("root").alias("u"), F.col("low").alias("v"))
    above = cut(components(between)).select(F.col("node").alias("low"), F.col("root").alias("above"))
    return least.join(above, "low", "left").select("node", F.coalesce("above", "low").alias("root"))


def _alike_in_size(n: str, m: str) -> Column:
    """Sets of other sizes cannot agree by PERCENT."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _placed(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Members (bucket, node, n) with their root."""
    if roots is None:
        return members.withColumn("root", F.col("node"))
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _pair(node: str, other: str) -> list[Column]:
    return [F.greatest(node, other).alias("u"), F.least(node, other).alias("v")]


def _star_pairs(members: DataFrame, roots: DataFrame | None, turn: int) -> DataFrame:
    """For each class in a bucket of several components one pair with a centre of another component."""
    placed = _placed(members, roots)
    first = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "root", "n"))
    centres = cut(placed.groupBy("bucket").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), first.alias("centre")
    ).where("low <> high").select("bucket", "centre"))
    met = placed.join(centres, "bucket").where("centre.root <> root").where(_alike_in_size("n", "centre.n"))
    named = met.groupBy("node", F.col("centre.h").alias("h"), F.col("centre.node").alias("other")).agg(F.count("*").alias("times"))
    best = named.groupBy("node").agg(F.max(F.struct("times", "h", "other")).alias("best"))
    return best.select(*_pair("node", "best.other")).distinct()


def _small_pairs(members: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All pairs across components in buckets of up to SMALL members, and the members of the larger open ones."""
    placed = _placed(members, roots)
    several = cut(placed.groupBy("bucket").agg(
        F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high")
    ).where("low <> high").select("bucket", "size"))
    open_members = cut(placed.join(several, "bucket"))
    small = open_members.where(F.col("size") <= SMALL).groupBy("bucket").agg(F.collect_list(F.struct("node", "root", "n")).alias("all"))
    both = small.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y"))
    both = both.where("x.node < y.node AND x.root <> y.root").where(_alike_in_size("x.n", "y.n"))
    return both.select(*_pair("y.node", "x.node")).distinct(), open_members.where(F.col("size") > SMALL).select("node")


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SLOTS, np.int64)
    for whole in batches:
        for batch in in_slices(whole, "text", SLICE_BYTES):
            keys, _ = shingle_keys(*raw_bytes(batch.column("text")))
            counts += np.bincount((keys % _U(SLOTS)).astype(np.int64), minlength=SLOTS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["slot", "n"])


def _marks(keys: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """64 * MARKS parities of each set: whether an odd number of its shingles falls on a place.

    A place on which two sets differ has a shingle that one of them lacks, so they differ in as many shingles at least.
    """
    place = (keys >> _U(32)) % _U(64 * MARKS)
    some, bit = np.flatnonzero(np.diff(at)), _U(1) << place % _U(64)
    made = []
    for word in range(MARKS):
        marks = np.zeros(len(at) - 1, _U)
        if len(some):
            marks[some] = np.bitwise_xor.reduceat(np.where(place // _U(64) == word, bit, _U(0)), at[:-1][some])
        made.append(marks.view(np.int64))
    return made


_MARKS = [f"mark_{word}" for word in range(MARKS)]


def _rarest(counts):
    """The shingles of each set that a set agreeing by PERCENT cannot lack all: its first in the order of counts.

    Any order does if it is one for all sets; rare first makes few candidates. counts: broadcast, by slot of the hash.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_slices(whole, "text", SLICE_BYTES):
                keys, at = shingle_keys(*raw_bytes(batch.column("text")))
                n = np.diff(at)
                row = np.repeat(np.arange(len(n)), n)
                often = counts.value[(keys % _U(SLOTS)).astype(np.int64)]
                order = np.lexsort((keys, often, row))
                place = np.arange(len(keys)) - at[:-1][row]
                least = -(-PERCENT * n // 100)
                first = np.flatnonzero((place <= (n - least)[row]) & (often[order] > 1))  # what is once is in no other set
                take = pa.array(row[first])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").take(take), batch.column("root").take(take), pa.array(keys[order][first].view(np.int64)),
                     pa.array(place[first].astype(np.int32)), pa.array(n[row[first]].astype(np.int32)),
                     *[pa.array(marks[row[first]]) for marks in _marks(keys, at)]],
                    ["node", "root", "shingle", "place", "n", *_MARKS],
                )

    return run


def _open_pairs(members: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame:
    """All pairs across components, among the members' classes, that may agree by PERCENT: u, v.

    Two sets that agree have a first common shingle in the order of :func:`_rarest`; it is among the rarest of both, and
    what follows it in each set must suffice for the rest of what they share. Sets whose parities (:func:`_marks`) differ on
    more places than sets that agree can differ in shingles are no pair: so a large group and the texts around it that it does
    not link make few pairs, not one for each two of them. Of a shingle, members of its largest
    component meet only the others. A shingle of over HOT classes is dealt by node.
    """
    node = roots.schema["node"].dataType.simpleString()
    open_nodes = members.select("node").distinct().join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sets = stored(texts.join(open_nodes, "node"), "open")
    table = np.zeros(SLOTS, np.int64)
    summed = sets.select("text").mapInArrow(_slot_counts, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table[summed.column("slot").to_numpy()] = summed.column("n").to_numpy()
    counts = sets.sparkSession.sparkContext.broadcast(table)
    firsts = stored(sets.mapInArrow(_rarest(counts), f"node {node}, root {node}, shingle long, place int, n int, " + ", ".join(f"{m} long" for m in _MARKS)), "rarest")

    by_root = firsts.groupBy("shingle", "root").agg(F.count("*").alias("k"))
    several = by_root.groupBy("shingle").agg(F.sum("k").alias("k"), F.min("root").alias("low"), F.max("root").alias("high"), F.max_by("root", "k").alias("main"))
    several = several.where("low <> high").select("shingle", "main", F.ceil(F.col("k") / HOT).cast("int").alias("parts"))
    met = cut(firsts.join(several, "shingle"))
    one = met.where("root <> main").withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    other = met.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    x, y = one.alias("x"), other.alias("y")
    new = F.expr("x.root <> y.root AND (y.root = y.main OR x.node < y.node)")
    enough = F.expr(f"{100 + PERCENT}L * least(x.n - x.place, y.n - y.place) >= {PERCENT}L * (x.n + y.n)")
    same = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.part") == F.col("y.part"))
    apart = " + ".join(f"bit_count(x.{m} ^ y.{m})" for m in _MARKS)
    near = F.expr(f"{100 + PERCENT}L * (x.n + y.n - ({apart})) >= {2 * PERCENT}L * (x.n + y.n)")
    pairs = x.join(y, same & new & enough & near)
    return pairs.select(F.greatest("x.node", "y.node").alias("u"), F.least("x.node", "y.node").alias("v")).distinct()


def _classes(rows: DataFrame) -> DataFrame:
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("t")))
    filled = rows.where("n_shingles > 0")
    return filled.groupBy(F.struct("a", "b").alias("node")).agg(
        best.alias("best"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n")
    )


def near_copies(docs: DataFrame) -> DataFrame:
    """Every row: doc_id, n_shingles, component_id, kept, t (hash of its text), stays (the row that stays)."""
    rows = stored(sketched(docs), "sketches")
    classes = cut(_classes(rows).select("node", "best", "bands", "n"))
    buckets = classes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket")
    members = stored(buckets.join(shared, "bucket", "left_semi"), "buckets")

    wanted = members.select("node").distinct().join(classes.select("node", "best"), "node")
    source = docs.select(F.col("doc_id").alias("id"), _text_hash().alias("h"), text_or_empty().alias("text"))
    texts = source.join(wanted, F.col("id").eqNullSafe(F.col("best.doc_id")) & (F.col("h") == F.col("best.t"))).select("node", "text")
    texts = stored(texts.dropDuplicates(["node"]), "texts")  # rows may repeat

    roots, tried = None, None

    def settled(pairs: DataFrame) -> bool:
        """Check the pairs that were not tried before and contract what they link; False if they link nothing."""
        nonlocal roots, tried
        if tried is not None:
            pairs = pairs.join(tried, ["u", "v"], "left_anti")
        # a written table: the optimizer knows its size, and few pairs are sent to the texts rather than the texts to them
        pairs = stored(pairs, "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = cut(confirmed(pairs, texts))
        if found.isEmpty():
            return False
        if roots is not None:
            found = found.unionByName(roots.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
        roots = cut(components(found))
        return True

    for turn in range(ROUNDS):
        if not settled(_star_pairs(members, roots, turn)):
            break
    if roots is None:
        roots = cut(classes.where("false").select("node", F.col("node").alias("root")))
    pairs, _ = _small_pairs(members, roots)
    settled(pairs)
    _, still_open = _small_pairs(members, roots)
    if not still_open.isEmpty():
        settled(_open_pairs(still_open, roots, texts))

    named = classes.select("node", "best").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = named.groupBy("root").agg(F.min("best").alias("stays"))
    named = named.join(kept, "root").select("node", "stays")
    filled = rows.where("n_shingles > 0").join(named, (F.col("a") == F.col("node.a")) & (F.col("b") == F.col("node.b")))
    own, least = F.col("doc_id"), F.col("stays.doc_id")
    filled = filled.select(
        "doc_id", "n_shingles", least.alias("component_id"), own.eqNullSafe(least).alias("kept"), "t",
        (own.eqNullSafe(least) & (F.col("t") == F.col("stays.t"))).alias("stays"),
    )
    alone = rows.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "t", F.lit(True).alias("stays")
    )
    return filled.unionByName(alone)


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each group, with its columns as they were."""
    kept = near_copies(docs).where("stays").select(F.col("doc_id").alias("kept_id"), F.col("t").alias("kept_t")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("doc_id").alias("row_id"), _text_hash().alias("row_t"))
    stay = rows.join(kept, F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_t") == F.col("kept_t")), "left_semi")
    return stay.dropDuplicates(["row_id", "row_t"]).select("row.*")
