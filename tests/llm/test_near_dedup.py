from collections import defaultdict

import numpy as np
import pytest

from ledgerloom.llm import near_dedup


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def expected(rows):
    """Smallest id reachable over links of 75 percent and more, by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and 100 * same >= 75 * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[top(i)].append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return sorted(((rows[i][0], len(sets[i]), least[top(i)]) for i in range(len(rows))), key=repr)


def near_rows(n=60, seed=3):
    """Texts in chains of small edits: neighbours agree, the ends of a chain do not."""
    random = np.random.default_rng(seed)
    rows, words = [], []
    for i in range(n):
        if i % 6 == 0:
            words = [f"w{x}" for x in random.integers(0, 5000, 60)]
        else:
            words = list(words)
            for _ in range(int(random.integers(1, 3))):
                words[int(random.integers(0, 60))] = f"v{random.integers(0, 5000)}"
        rows.append((n - i, " ".join(words)))
    return rows


def found(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=repr)


def test_components_agree_with_all_pairs(docs_of):
    rows = near_rows()
    assert found(near_dedup.near_copies(docs_of(rows))) == expected(rows)


def test_large_buckets_find_chains_too(docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    rows = near_rows(seed=8)
    assert found(near_dedup.near_copies(docs_of(rows))) == expected(rows)


def family_of_pairs(n, seed=5):
    """Copies of one text that agree by under 75 percent, except in pairs that share few words of their own."""
    random = np.random.default_rng(seed)
    base = [f"b{x}" for x in range(84)]
    rows = []
    for i in range(n):
        both = [f"p{i}x{x}" for x in range(6)]
        rows += [" ".join(base + both + [f"o{i}y{k}z{x}" for x in range(14)]) for k in (0, 1)]
    order = random.permutation(len(rows)).tolist()
    return [(i, rows[j]) for i, j in enumerate(order)]


def test_links_of_single_members_in_large_buckets(docs_of):
    """Buckets of several hundred classes whose only links lead to one other member each."""
    rows = family_of_pairs(300)
    want = expected(rows)
    assert len({c for _, _, c in want}) == 300
    assert found(near_dedup.near_copies(docs_of(rows))) == want


def test_open_pairs_hold_every_agreeing_pair(spark, docs_of, monkeypatch):
    """Across components, with hot shingles dealt over several tasks."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(near_dedup, "HOT", 7)
    rows = family_of_pairs(15) + [(100 + i, t) for i, t in near_rows(40, seed=11)] + [(200, "a few words")]
    node = F.struct(F.col("doc_id").alias("a"), F.lit(0).cast("long").alias("b")).alias("node")
    texts = docs_of(rows).select(node, "text")
    roots = texts.select("node", F.struct(F.expr("node.a div 4").alias("a"), F.lit(-1).cast("long").alias("b")).alias("root"))
    got = {(r.u.a, r.v.a) for r in near_dedup._open_pairs(texts.select(F.lit(1).alias("bucket"), "node"), roots, texts).collect()}
    sets = {i: shingles(t) for i, t in rows}
    for u in sets:
        for v in sets:
            same = len(sets[u] & sets[v])
            if u > v and u // 4 != v // 4 and 100 * same >= 75 * len(sets[u] | sets[v]):
                assert (u, v) in got
    assert all(u > v and u // 4 != v // 4 for u, v in got)


def test_texts_around_a_large_group_make_few_pairs(spark, docs_of):
    """Rare shingles in common, but not 75 percent: the parities tell, before pairs are made."""
    from pyspark.sql import functions as F

    words = [f"w{i}" for i in range(200)]
    common, one, other = words[:30], words[30:50], words[50:70]
    rows = [(i, 0, [*common, *one, f"u{i}"]) for i in range(30)] + [(100 + i, 1, [*common, *other, f"v{i}"]) for i in range(30)]
    rows += [(200 + i, 2, [*one, f"x{i}"]) for i in range(70)] + [(300 + i, 3, [*other, f"y{i}"]) for i in range(70)]
    rows += [(400, 4, [*common, *one, "u400"])]
    node = lambda c: F.struct(F.col(c).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    frame = spark.createDataFrame([(i, r, " ".join(t)) for i, r, t in rows], "i long, r long, text string")
    texts, roots = frame.select(node("i").alias("node"), "text"), frame.select(node("i").alias("node"), node("r").alias("root"))
    got = [(r.u.a, r.v.a) for r in near_dedup._open_pairs(texts.select("node"), roots, texts).collect()]
    assert sorted(got) == [(400, i) for i in range(30)]


@pytest.mark.parametrize("n", [0, 1, 7, 600])
def test_parities_differ_on_no_more_places_than_sets_in_shingles(n):
    random = np.random.default_rng(n)
    both, one, two = (np.unique(random.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2)) for k in (n, 5, 9))
    sets = [np.sort(np.concatenate([both, one])), both, np.sort(np.concatenate([both, two])), both[:0]]
    marks = np.stack(near_dedup._marks(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])), 1)
    apart = lambda a, b: sum(bin(int(x) & (1 << 64) - 1).count("1") for x in marks[a] ^ marks[b])
    for a in range(4):
        for b in range(4):
            assert apart(a, b) <= len(np.setxor1d(sets[a], sets[b])) and (a != b or apart(a, b) == 0)
    assert (marks[3] == 0).all() and apart(0, 2) > 0


def test_odd_rows(docs_of, odd_rows):
    rows = [r[:2] for r in odd_rows]
    want = [(i, n, i if n == 0 else c) for i, n, c in expected(rows)]
    assert found(near_dedup.near_copies(docs_of(odd_rows))) == sorted(want, key=repr)
    stay = near_dedup.without_near_copies(docs_of(odd_rows))
    assert stay.columns == docs_of(odd_rows).columns
    ids = sorted((r.doc_id for r in stay.collect()), key=repr)
    assert ids.count(8) == 1 and 7 not in ids and 6 in ids and 2 not in ids


def test_repeated_rows_are_compared_once(docs_of, monkeypatch):
    """Two texts, each in hundreds of equal rows, are one pair of texts."""
    read = []
    real = near_dedup.confirmed
    monkeypatch.setattr(near_dedup, "confirmed", lambda pairs, texts: read.append((pairs.count(), texts.count())) or real(pairs, texts))
    words = [f"w{x}" for x in range(60)]
    one, two = " ".join(words), " ".join([*words[:-1], "other"])
    rows = [(5, one)] * 500 + [(6, two)] * 500 + [(7, "nothing of the kind in these six words")]
    assert found(near_dedup.near_copies(docs_of(rows).repartition(5))) == sorted(
        [(5, 56, 5)] * 500 + [(6, 56, 5)] * 500 + [(7, 4, 7)], key=repr)
    assert read[0] == (1, 2)
    assert near_dedup.without_near_copies(docs_of(rows)).count() == 2


def test_kept_says_whether_the_id_is_the_smallest(docs_of):
    """An id that repeats with different near texts is kept in all its rows; one of them stays."""
    words = [f"w{x}" for x in range(60)]
    rows = [(5, " ".join(words)), (5, " ".join([*words[:-1], "other"])), (6, " ".join([*words[:-1], "third"]))]
    got = near_dedup.near_copies(docs_of(rows)).collect()
    assert all(r.component_id == 5 and r.kept == (r.doc_id == 5) for r in got)
    assert sum(r.stays for r in got) == 1 and near_dedup.without_near_copies(docs_of(rows)).count() == 1


def test_a_class_is_in_one_pair_a_round(docs_of, monkeypatch):
    """A family of copies that differ in a word each: pairs stay near the number of texts, whatever the buckets."""
    pairs = []
    real = near_dedup.confirmed
    monkeypatch.setattr(near_dedup, "confirmed", lambda p, texts: pairs.append(p.count()) or real(p, texts))
    words = [f"w{x}" for x in range(80)]
    rows = [(i, " ".join([*words[:i % 80], f"o{i}", *words[i % 80 + 1:]])) for i in range(300)]
    got = near_dedup.near_copies(docs_of(rows)).collect()
    assert {r.component_id for r in got} == {0} and sum(pairs) <= 2 * len(rows)


def test_empty_table(docs_of):
    assert near_dedup.near_copies(docs_of([])).collect() == []
    assert near_dedup.without_near_copies(docs_of([])).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 40, 700])
def test_sketch_bins_agree_as_often_as_sets(n):
    """Bands of equal sets are equal, of disjoint sets not."""
    random = np.random.default_rng(n)
    keys = np.sort(random.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2))
    one, two = keys[:n], np.sort(keys[n:])
    bands = near_dedup.sketch_bands(np.concatenate([one, one, two]), np.array([0, n, 2 * n, 3 * n]))
    assert (bands[0] == bands[1]).all() and not (bands[0] == bands[2]).any()


def test_components_over_many_parts(spark, monkeypatch):
    """A long chain, a hub and a few pairs, dealt over parts that do not know each other's links."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(near_dedup, "PART_LINKS", 30)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000 + i, 6000 + i) for i in range(20)] + [(299, 1150)]
    frame = spark.createDataFrame(links, "x long, y long").repartition(17)
    frame = frame.select(*[F.struct(F.col(c).alias("a"), F.lit(0).cast("long").alias("b")).alias(n) for c, n in (("x", "u"), ("y", "v"))])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.node.a: r.root.a for r in near_dedup.components(frame).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {x: 0 for x in [*range(301), *range(1000, 1200)]} | {y: 5000 + i for i in range(20) for y in (5000 + i, 6000 + i)}
    assert got == want
