"""Merkle manifests against trees built in plain Python."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import manifest
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, place):
    found = []
    for nodes in levels[:-1]:
        first = place // 16 * 16
        run = nodes[first:first + 16]
        found.append((run[:place - first], run[place - first + 1:]))
        place //= 16
    return found


def expected(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    by = {}
    for r in rows:
        text = r[4]
        if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
            text = lowered(text)
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), leaf((*r[:4], text)), r[0]))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[2] for x in sorted(by[s], key=lambda x: x[:4])]) for s in sources}
    top = levels_of([trees[s][-1][0] for s in sources])
    found = []
    for number, source in enumerate(sources):
        for place, (_, _, own, shown, doc_id) in enumerate(sorted(by[source], key=lambda x: x[:4])):
            way = path(trees[source], place) + path(top, number)
            for left, right in way:
                shown = digest(*left, shown, *right)
            proof = digest(*[s for left, right in way for s in left + right])
            found.append((doc_id, own, trees[source][-1][0], top[-1][0], proof, shown, shown == top[-1][0]))
    return sorted(found, key=repr)


def report(docs):
    shown = manifest.lowered_text(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    return sorted([tuple(r) for r in manifest.manifest_report(docs, shown).collect()], key=repr)


@pytest.mark.parametrize("ids", [
    [0], [32767], [5, 6, 7, 8, 1000], list(range(32768)), list(range(0, 32768, 2)), list(range(100, 9000)),
    sorted(np.random.default_rng(1).choice(32768, 700, replace=False).tolist()),
    sorted(np.random.default_rng(2).choice(32768, 20000, replace=False).tolist()),
])
def test_ranks(ids):
    bits = np.zeros(32768, np.uint8)
    bits[ids] = 1
    form, content, directory = manifest.packed(np.packbits(bits, bitorder="little").tobytes())
    assert len(content) <= 4096 and manifest.members(form, content).tolist() == ids
    asked = np.arange(32768)
    assert manifest.ranks(form, content, directory, asked).tolist() == np.searchsorted(ids, asked).tolist()


def test_forms():
    def form(ids):
        bits = np.zeros(32768, np.uint8)
        bits[ids] = 1
        return manifest.packed(np.packbits(bits, bitorder="little").tobytes())[0]

    assert [form([3, 900]), form(range(32768)), form(range(0, 32768, 3))] == ["ids", "runs", "bits"]


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    assert sorted([tuple(r) for r in QUERIES["op12_manifest"](spark, SF).collect()], key=repr) == expected([tuple(r) for r in rows])


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows + [(-7, "A b", "en", "a"), (-(1 << 62), "C", "en", "a"), (1 << 62, "D", None, ""), (0, "É", "fr", "é")])
    assert report(docs) == expected(rows_of(docs))


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [1, 256, 257], [3] * 18])
def test_shapes_of_trees(docs_of, sizes):
    docs = docs_of([(i * 1009, f"Text {i}", "en", f"s{k}") for k, size in enumerate(sizes) for i in range(size)])
    assert report(docs) == expected(rows_of(docs))


def test_repeated_rows_and_ids(docs_of):
    rows = [(7, "Same", "en", "a")] * 300 + [(7, f"Other {i}", "en", "a") for i in range(40)]
    rows += [(i, f"T{i}", "en", "a") for i in range(50)] + [(9, "T9", "en", "a")] * 20 + [(None, f"N{i % 3}", "en", None) for i in range(30)]
    docs = docs_of(rows).repartition(6)
    assert report(docs) == expected(rows_of(docs))


def test_very_long_text(docs_of):
    docs = docs_of([(1, "Aé" * 700_000, "en", "a"), (20, "b", "en", "a")])
    assert report(docs) == expected(rows_of(docs))


def test_untampered_rows_verify(docs_of, odd_rows):
    found = manifest.manifest(docs_of(odd_rows)).collect()
    assert len(found) == len(odd_rows) and all(r.verified for r in found)


def test_empty_table(docs_of):
    assert report(docs_of([])) == []
