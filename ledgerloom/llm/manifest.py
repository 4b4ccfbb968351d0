"""Merkle manifest of a dataset: a tree of documents for each source, a tree of sources, and a proof for each row.

A leaf stands at the rank of its document id in its source. Ranks come from bitmaps, not from sorting documents: ids are
cut into ranges of 32,768, the ids of a source and range form one bitmap, merged from those of all map tasks. A bitmap is
kept in the smallest of three forms (list of ids, list of runs, bits) with a directory of counts for every 512 ids;
running totals over the bitmaps, which are few beside the documents, say how many ids stand before each. The rank of
an id is that total, the count of its block and the ids before it inside the block.

Above the leaves a node has a place too, so 16 children meet by the number of their parent, each in its slot of
an array; a level is one grouping by (source, place of the parent), and a source with a third of all rows is spread over
its parents. Going down again, a parent hands each child the digests left and right of it: a proof for the leaf
is the path to the root, and folding a leaf along it gives a root to compare.

Defined results: null ids come first, equal ids stand in order of their digests, rows that repeat take a place each.
Null values are written ``-``, empty ones ``0:``. One document alone is its subroot, one source alone its root. A
shown text is the text that a reader meets; where it differs from the recorded one, its leaf does not fold to the root.
Other columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored
from ledgerloom.operators.rank import positioned, with_running_total

FANOUT = 16
RANGE_BITS = 15
BLOCK = 512


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column) -> Column:
    return digest(*[_field(F.col(f"`{c}`")) for c in ("doc_id", "source", "lang", "n_chars")], _field(text))


# --- places of leaves: rank in bitmaps ---------------------------------------------------------------

def packed(bitmap: bytes) -> tuple[str, bytes, bytes]:
    """Form, content and directory of a bitmap: ids, runs (first, last) or bits, whichever is smallest."""
    bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little")
    ids = np.flatnonzero(bits).astype("<u2")
    breaks = np.flatnonzero(np.diff(ids.astype(np.int32)) != 1)
    runs = np.column_stack([ids[np.concatenate([[0], breaks + 1])], ids[np.concatenate([breaks, [len(ids) - 1]])]])
    forms = {"ids": ids.tobytes(), "runs": runs.astype("<u2").tobytes(), "bits": bitmap}
    form = min(forms, key=lambda f: len(forms[f]))
    counts = np.add.reduceat(bits.astype(np.int64), np.arange(0, len(bits), BLOCK))
    directory = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u2")
    return form, forms[form], directory.tobytes() if form == "bits" else b""


def ranks(form: str, content: bytes, directory: bytes, lows: np.ndarray) -> np.ndarray:
    """How many ids of the bitmap are below each of the given ones."""
    if form == "ids":
        return np.searchsorted(np.frombuffer(content, "<u2"), lows).astype(np.int64)
    if form == "runs":
        runs = np.frombuffer(content, "<u2").reshape(-1, 2).astype(np.int64)
        sizes = runs[:, 1] - runs[:, 0] + 1
        before = np.concatenate([[0], np.cumsum(sizes)])
        run = np.searchsorted(runs[:, 0], lows, side="right") - 1
        inside = np.clip(lows - runs[np.maximum(run, 0), 0], 0, sizes[np.maximum(run, 0)])
        return np.where(run < 0, 0, before[np.maximum(run, 0)] + inside)
    words = np.frombuffer(content, np.uint8)
    block = lows // BLOCK
    whole = np.frombuffer(directory, "<u2")[block].astype(np.int64)
    width = BLOCK // 8
    bits = np.unpackbits(words.reshape(-1, width)[block], axis=1, bitorder="little")
    return whole + (bits * (np.arange(BLOCK) < (lows % BLOCK)[:, None])).sum(axis=1)


def _pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        forms = [packed(b) for b in frame["bitmap"]]
        yield frame.drop(columns="bitmap").assign(
            form=[f[0] for f in forms], content=[f[1] for f in forms], directory=[f[2] for f in forms]
        )


def bitmaps(ids: DataFrame) -> DataFrame:
    """source, high, n_ids, n_rows, form, content, directory, more of distinct (source, high, low, n).

    ``more`` holds the ids with several rows, and how many more than one: at most 32,768 of a range.
    """
    position = F.col("low").cast("long")
    # the buffer of a bitmap is 4 KB; tasks build one for each (source, range) they meet and merge them by it
    merged = ids.groupBy("source", "high").agg(
        F.bitmap_construct_agg(position).alias("bitmap"), F.sum("n").alias("n_rows"),
        F.sort_array(F.collect_list(F.when(F.col("n") > 1, F.struct("low", (F.col("n") - 1).alias("more"))))).alias("more"),
    )
    counted = merged.withColumn("n_ids", F.bitmap_count("bitmap"))
    kept = counted.select("source", "high", "n_ids", "n_rows", "more", "bitmap")
    schema = "source string, high long, n_ids long, n_rows long, more array<struct<low:int,more:long>>, form string, content binary, directory binary"
    return kept.mapInPandas(_pack, schema)


def members(form: str, content: bytes) -> np.ndarray:
    """The ids of a bitmap."""
    if form == "ids":
        return np.frombuffer(content, "<u2").astype(np.int64)
    if form == "runs":
        return np.concatenate([np.arange(a, b + 1) for a, b in np.frombuffer(content, "<u2").reshape(-1, 2).astype(np.int64)])
    return np.flatnonzero(np.unpackbits(np.frombuffer(content, np.uint8), bitorder="little")).astype(np.int64)


def _rank(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples(index=False):
            lows = members(row.form, row.content)
            place = row.before + ranks(row.form, row.content, row.directory, lows)
            if len(row.more):
                extra = np.concatenate([[0], np.cumsum([m["more"] for m in row.more])]).astype(np.int64)
                place = place + extra[np.searchsorted(np.array([m["low"] for m in row.more]), lows)]
            yield pd.DataFrame({"s": row.source, "h": row.high, "l": lows, "place": place, "n_source": row.n_source})


def _places(ids: DataFrame) -> DataFrame:
    """s, h, l, place, n_source: the first place of each id in its source, and how many rows the source has."""
    index = stored(bitmaps(ids), "manifest-bitmaps")
    totals = with_running_total(index.select("source", "high", "n_rows"), ["source", "high"], "n_rows", "running")
    starts = totals.groupBy(F.col("source").alias("of")).agg(
        F.min(F.col("running") - F.col("n_rows")).alias("first"), F.sum("n_rows").alias("n_source")
    )
    offsets = totals.join(starts, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias("s"), F.col("high").alias("h"), "n_source",
        (F.col("running") - F.col("n_rows") - F.col("first")).alias("before"),
    )
    whole = index.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("high") == F.col("h")))
    return whole.select("source", "high", "more", "form", "content", "directory", "before", "n_source").mapInPandas(
        _rank, "s string, h long, l int, place long, n_source long"
    )


SAME_ID = "source <=> s AND high = h AND low = l"


def _among_equal_ids(leaves: DataFrame) -> DataFrame:
    """Leaves of ids with several digests, with ``within``: how many rows of the id stand before."""
    running = with_running_total(leaves, ["source", "high", "low", "leaf", "shown"], "copies", "running")
    before = F.col("running") - F.col("copies")
    starts = running.groupBy(F.col("source").alias("s"), F.col("high").alias("h"), F.col("low").alias("l")).agg(F.min(before).alias("first"))
    return running.join(starts, F.expr(SAME_ID)).select(*leaves.columns, (before - F.col("first")).alias("within"))


def placed_leaves(docs: DataFrame, shown: Column | None = None) -> DataFrame:
    """source, place, n (rows of the source), doc_id, leaf, shown (null: as the leaf) of every row; places from 0."""
    text = F.col("text").cast("string")
    leaf, seen = leaf_of(text), leaf_of(text if shown is None else shown)
    rows = docs.select(
        F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.shiftright(F.col("doc_id").cast("long"), RANGE_BITS), F.lit(-(1 << 60))).alias("high"),  # null ids first
        F.coalesce(F.col("doc_id").cast("long").bitwiseAND((1 << RANGE_BITS) - 1), F.lit(0)).cast("int").alias("low"),
        leaf.alias("leaf"), (F.lit(None).cast("string") if shown is None else seen).alias("seen"),
    ).withColumn("shown", F.nullif("seen", "leaf")).drop("seen")
    leaves = stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")), "manifest-leaves")
    ids = leaves.groupBy("source", "high", "low").agg(F.sum("copies").alias("n"), F.count("*").alias("kinds"))
    placed = leaves.join(_places(ids.drop("kinds")), F.expr(SAME_ID)).drop("s", "h", "l")
    several = ids.where("kinds > 1").select(F.col("source").alias("s"), F.col("high").alias("h"), F.col("low").alias("l"))
    if several.isEmpty():
        placed = placed.withColumn("within", F.lit(0).cast("long"))
    else:
        apart = _among_equal_ids(placed.join(several, F.expr(SAME_ID), "left_semi"))
        placed = placed.join(several, F.expr(SAME_ID), "left_anti").withColumn("within", F.lit(0).cast("long")).unionByName(apart)
    turn = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return placed.withColumn("turn", turn).select(
        "source", (F.col("place") + F.col("within") + F.col("turn")).alias("place"), F.col("n_source").alias("n"), "doc_id",
        "leaf", "shown",
    )


# --- trees ----------------------------------------------------------------------------------------------

def _reduced(nodes: DataFrame, kept: list[str]) -> DataFrame:
    """Runs of 16 consecutive nodes: tree, place, n (of the level above), items in slot order, digest."""
    item = F.struct((F.col("place") % FANOUT).alias("slot"), "digest", *kept)
    runs = nodes.groupBy(
        "tree", F.floor(F.col("place") / FANOUT).alias("above"), F.ceil(F.col("n") / FANOUT).alias("n_above")
    ).agg(F.sort_array(F.collect_list(item)).alias("items"))  # 16 at most
    return runs.select(
        "tree", F.col("above").alias("place"), F.col("n_above").alias("n"), "items",
        F.sha2(F.array_join("items.digest", "").cast("binary"), 256).alias("digest"),
    )


def _grown(nodes: DataFrame, kept: list[str], most: int) -> tuple[list[DataFrame], DataFrame]:
    """All levels of runs, and the top node of each tree (tree, digest, level); nodes: tree, place, n, digest, kept.

    ``most`` is the number of nodes of the largest tree, which tells how many levels there are.
    """
    levels, tops, level = [], [nodes.where("n = 1").select("tree", "digest", F.lit(0).alias("level"))], 0
    while most > 1:
        runs = stored(_reduced(nodes.where("n > 1"), kept if level == 0 else []), "manifest-level")
        levels.append(runs)
        nodes, most, level = runs.drop("items"), -(-most // FANOUT), level + 1
        tops.append(nodes.where("n = 1").select("tree", "digest", F.lit(level).alias("level")))
    top = tops[0]
    for other in tops[1:]:
        top = top.unionByName(other)
    return levels, top


STEP = "array<struct<left:string,right:string>>"


def _handed_down(levels: list[DataFrame], tops: DataFrame, passed: list[str], kept: list[str]) -> DataFrame:
    """Nodes of level 0 with their path to the top: what stands left and right of them, level by level.

    tops: tree, digest, level, path (from the top on), and the columns passed on to all below.
    """
    paths = tops.where(F.col("level") == len(levels)).select("tree", F.lit(0).cast("long").alias("place"), "path", *passed)
    for level in range(len(levels) - 1, -1, -1):
        runs = levels[level]
        above = paths.select(F.col("tree").alias("t"), F.col("place").alias("p"), "path", *passed)
        met = runs.join(above, F.col("tree").eqNullSafe(F.col("t")) & (F.col("place") == F.col("p")))
        carried = "".join(f", x.{c} AS {c}" for c in (kept if level == 0 else []))
        children = F.expr(f"""
            transform(items, (x, i) -> struct(
              place * {FANOUT} + x.slot AS place, x.digest AS digest,
              array_join(slice(items.digest, 1, i), '') AS left,
              array_join(slice(items.digest, i + 2, {FANOUT}), '') AS right{carried}))""")
        below = met.select("tree", "path", *passed, F.explode(children).alias("child"))
        extra = ["digest", *kept] if level == 0 else []
        paths = below.select(
            "tree", "child.place", F.expr("concat(array(struct(child.left, child.right)), path)").cast(STEP).alias("path"),
            *passed, *[F.col(f"child.{c}").alias(c) for c in extra],
        )
        if level:
            starts = tops.where(F.col("level") == level)
            paths = paths.unionByName(starts.select("tree", F.lit(0).cast("long").alias("place"), "path", *passed))
    return paths


def manifest(docs: DataFrame, shown: Column | None = None) -> DataFrame:
    """Every row: doc_id, leaf, subroot, root, proof (path to the root), folded_root (of the shown text), verified."""
    leaves = stored(placed_leaves(docs, shown), "manifest-places")
    nodes = leaves.select(F.col("source").alias("tree"), "place", "n", F.col("leaf").alias("digest"), "doc_id", "shown")
    most = nodes.agg(F.max("n")).first()[0] or 0
    kept = ["doc_id", "shown"]
    levels, subroots = _grown(nodes, kept, most)
    subroots = stored(subroots, "manifest-subroots")

    ordered = positioned(subroots, [F.col("tree").asc_nulls_first()], "number")
    n_sources = subroots.count()
    top_nodes = ordered.select(
        F.lit("").alias("tree"), (F.col("number") - 1).alias("place"), F.lit(n_sources).cast("long").alias("n"),
        "digest", F.col("tree").alias("source"), F.col("level").alias("source_level"),
    )
    top_kept = ["source", "source_level"]
    top_levels, roots = _grown(top_nodes, top_kept, n_sources)
    nothing = F.expr(f"cast(array() AS {STEP})")
    roots = roots.select("tree", "digest", "level", F.col("digest").alias("root"), nothing.alias("path"))
    if top_levels:
        below_root = _handed_down(top_levels, roots, ["root"], top_kept)
    else:  # one source: its subroot is the root
        below_root = top_nodes.select("source", "source_level", "digest", F.col("digest").alias("root"), nothing.alias("path"))
    tops = stored(below_root.select(
        F.col("source").alias("tree"), "digest", F.col("source_level").alias("level"), F.col("digest").alias("subroot"), "root", "path"
    ), "manifest-sources")

    alone = nodes.where("n = 1").select(F.col("tree").alias("t"), "digest", *kept).join(
        tops.drop("digest"), F.col("t").eqNullSafe(F.col("tree")))
    rows = alone.select("path", "digest", *kept, "subroot", "root")
    if levels:
        rows = rows.unionByName(_handed_down(levels, tops, ["subroot", "root"], kept).select("path", "digest", *kept, "subroot", "root"))
    folded = F.expr(
        "aggregate(path, coalesce(shown, digest), (d, s) -> sha2(cast(concat(s.left, d, s.right) AS binary), 256))"
    )
    return rows.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_report(docs: DataFrame, shown: Column | None = None) -> DataFrame:
    """:func:`manifest` with the digest of each proof in its place."""
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return manifest(docs, shown).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof.cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified"
    )


def lowered_text(when: Column) -> Column:
    """Tampering: the text with A-Z in lower case where the condition holds; nulls stay."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text = F.col("text").cast("string")
    return F.when(when, F.translate(text, upper, lower)).otherwise(text)
