import pytest

from ledgerloom.llm import mixing


def by_source(frame):
    made = {}
    for r in frame.collect():
        total, target, _ = made.get(r.source, (0, 0, 0))
        made[r.source] = (total + r.taken, r.target, r.source_size)
    return made


def words(n, salt):
    return " ".join(f"{salt}{i}" for i in range(n))


def test_targets_are_weighted_and_capped(docs_of):
    rows = [(i, words(10, f"x{i}"), "en", source) for i, source in enumerate(["a"] * 60 + ["b"] * 30 + ["c"] * 5 + [None] * 5)]
    got = by_source(mixing.mix(docs_of(rows)))
    # weights 1, 2, 3, 1: c stops at 3 x 50; the rest of 1000 is shared 1 : 2 : 1, where null stops at 150 as well
    assert {k: v[1] for k, v in got.items()} == pytest.approx({"c": 150, None: 150, "a": 700 / 3, "b": 1400 / 3})
    for total, target, _ in got.values():
        assert abs(total - target) <= 20
    assert sum(v[0] for v in got.values()) <= 1000


def test_reruns_and_partitions_agree(docs_of, spark):
    rows = [(i, words(i % 17, f"x{i}"), "en", "abcde"[i % 5]) for i in range(300)]
    one = sorted((r.doc_id, r.taken) for r in mixing.mix(docs_of(rows)).collect())
    two = sorted((r.doc_id, r.taken) for r in mixing.mix(docs_of(rows[::-1]).repartition(7)).collect())
    assert one == two and all(t <= 3 * (i % 17) for i, t in one)


def test_odd_rows(docs_of, odd_rows):
    got = mixing.mix(docs_of(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in got)
    mixed = mixing.mixed_documents(docs_of(odd_rows))
    assert mixed.columns == docs_of(odd_rows).columns
    taken = sum(len((r.text or "").split()) for r in mixed.collect())
    assert abs(taken - sum(r.taken for r in got)) <= 10


def test_repeated_rows_are_written_as_often_as_taken(docs_of):
    """The budget ends inside groups of repeated rows, one of which stands in two sources."""
    rows = [(1, words(10, "x"), "en", "a")] * 37 + [(1, words(10, "x"), "en", "b")] * 23 + [(2, words(10, "y"), "en", None)] * 11
    docs = docs_of(rows).repartition(5)
    want = {k: v[0] for k, v in by_source(mixing.mix(docs)).items()}
    assert any(want[s] // 10 % n for s, n in (("a", 37), ("b", 23), (None, 11)))
    got = {}
    for r in mixing.mixed_documents(docs).collect():
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    assert got == want


def test_empty_table(docs_of):
    assert mixing.mix(docs_of([])).collect() == []
    assert mixing.mixed_documents(docs_of([])).collect() == []


def test_no_words_at_all(docs_of):
    assert [r.taken for r in mixing.mix(docs_of([(1, "", "en", "a"), (2, None, "en", "b")])).collect()] == [0, 0]


def test_the_mix_is_written_in_order(docs_of):
    """Any prefix of the output has the sources near their target shares."""
    rows = [(i, " ".join(["w"] * (5 + i % 7)), "en", "abc"[i % 3]) for i in range(900)]
    docs = docs_of(rows).repartition(6)
    targets = {r.source: r.target for r in mixing.mix(docs).collect()}
    out = [(r.source, len(r.text.split())) for r in mixing.mixed_documents(docs).collect()]
    whole = sum(n for _, n in out)
    for share in (0.1, 0.3, 0.5, 0.8, 1.0):
        seen = {s: 0 for s in targets}
        for source, n in out:
            if sum(seen.values()) >= share * whole:
                break
            seen[source] += n
        for source, target in targets.items():
            assert abs(seen[source] / sum(seen.values()) - target / sum(targets.values())) < 0.03
