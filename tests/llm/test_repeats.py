import hashlib
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import repeats

SPAN = 400


def window(data, i):
    return hashlib.blake2b(data[i:i + SPAN], digest_size=16).digest()


def report(docs):
    found = repeats.removal_report(docs).collect()
    for r in found:
        assert len(r.kept_text.encode()) <= r.n_bytes - r.n_removed
    return sorted((tuple(r)[:5] for r in found), key=repr)


def expected(rows):
    data = [(text or "").encode() for _, text in rows]
    windows = Counter(window(d, i) for d in data for i in range(len(d) - SPAN + 1))
    made = []
    for (doc_id, _), d in zip(rows, data):
        mark = bytearray(len(d))
        for i in range(len(d) - SPAN + 1):
            if windows[window(d, i)] > 1:
                mark[i:i + SPAN] = b"\1" * SPAN
        spans = sum(1 for i in range(len(d)) if mark[i] and not (i and mark[i - 1]))
        kept = bytes(b for b, m in zip(d, mark) if not m)
        made.append((doc_id, len(d), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(made, key=repr)


def text(random, n):
    return "".join(chr(97 + x) for x in random.integers(0, 26, n))


def passages(seed):
    random = np.random.default_rng(seed)
    shared = [text(random, 900), text(random, 420), text(random, 399), "To " * 300]
    rows = []
    for i in range(24):
        part = shared[int(random.integers(0, 4))]
        cut = int(random.integers(0, 200))
        rows.append((i, text(random, int(random.integers(0, 500))) + part[cut:] + text(random, int(random.integers(0, 300))) + "é"))
    return rows


@pytest.mark.parametrize(("seed", "group"), [(1, 1000), (2, 1000), (2, 2), (3, 1), (4, 5)])
def test_removed_bytes_agree_with_all_windows(docs_of, monkeypatch, seed, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = passages(seed)
    assert report(docs_of(rows)) == expected(rows)


def test_odd_rows(docs_of, odd_rows):
    rows = [r[:2] for r in odd_rows]
    rows += [(20, "ab" * 700), (21, "ab" * 700), (21, "ab" * 700), (22, "x" * 401), (None, "ab" * 200)]
    assert report(docs_of(rows)) == expected(rows)


def test_exactly_one_window(docs_of):
    random = np.random.default_rng(9)
    a, b = text(random, 400), text(random, 399)
    rows = [(1, "x" + a + "y"), (2, "z" + a), (3, b + "1"), (4, b + "2")]
    assert report(docs_of(rows)) == expected(rows)


@pytest.mark.parametrize("group", [2, 30])
def test_a_very_common_passage_is_halved(docs_of, monkeypatch, group):
    """Sixty documents share a passage with other text at both ends, some of which pairs of documents share as well."""
    monkeypatch.setattr(repeats, "GROUP", group)
    random = np.random.default_rng(11)
    passage, side = text(random, 700), text(random, 350)
    rows = []
    for i in range(60):
        near = side[-int(random.integers(1, 350)):] if i % 3 else ""
        far = side[:int(random.integers(1, 350))] if i % 5 == 0 else ""
        rows.append((i, text(random, int(random.integers(0, 90))) + near + passage[i % 7:700 - i % 4] + far + text(random, int(random.integers(0, 400)))))
    assert report(docs_of(rows)) == expected(rows)


def test_halving_makes_few_rows(docs_of, monkeypatch):
    """Rows of a round are at most two for each segment still open, not one for each window."""
    monkeypatch.setattr(repeats, "GROUP", 10)
    made = []
    stored = repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda frame, name: made.append((name, stored(frame, name))) or made[-1][1])
    random = np.random.default_rng(5)
    passage = text(random, 600)
    rows = [(i, text(random, 300) + passage + text(random, 300)) for i in range(120)]
    assert report(docs_of(rows)) == expected(rows)
    sizes = [frame.count() for name, frame in made if name == "halves"]
    segments = next(frame for name, frame in made if name == "contexts").count()
    assert 2 < len(sizes) <= 10 and max(sizes) <= 2 * segments and sum(sizes) < 12 * segments


def test_a_text_of_more_than_a_megabyte(docs_of):
    random = np.random.default_rng(6)
    long = text(random, 1_100_000)
    rows = [(1, long), (2, "x" * 50 + long[500_000:500_900] + "y"), (3, "")]
    assert report(docs_of(rows)) == expected(rows)


def test_empty_table(docs_of):
    assert repeats.removal_report(docs_of([])).collect() == []


def _alike(levels, base, letters, gap):
    """Two strings of one length whose prefix polynomial hashes agree: Thue-Morse strings over blocks of two letters."""
    bits = 64 - sum(gap + 2 + k for k in range(levels))  # what the blocks have to add
    seen = {}
    for x in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#%&()*+,-./:;<=>?@[]^_{|}~":
        for y in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#%&()*+,-./:;<=>?@[]^_{|}~":
            key = (letters[ord(x)] + letters[ord(y)] * base) % (1 << bits)
            if key in seen:
                turns = [bin(i).count("1") % 2 for i in range(1 << levels)]
                a, b = seen[key], x + y
                return "".join((a, b)[t] for t in turns), "".join((b, a)[t] for t in turns)
            seen[key] = x + y
    raise AssertionError("no blocks")


def _rare_gram(random, n=4000):
    """Of n strings of GRAM letters the one that windows choose as their anchor."""
    made = [text(random, repeats.GRAM) for _ in range(n)]
    data = np.frombuffer("".join(made).encode(), np.uint8)
    at = np.arange(n) * repeats.GRAM
    return made[int(np.argmin(repeats._mixed(repeats._Prefix(data).of(at, at + repeats.GRAM))))]


def test_hashes_that_collide_do_not_decide(docs_of):
    """Texts of one window, alike in all but a stretch of 256 bytes of one polynomial hash."""
    letters = [int(x) for x in repeats._BYTES]
    one, two = _alike(7, repeats._BASE, letters, 1)
    prefix = [repeats._Prefix(np.frombuffer(x.encode(), np.uint8)).sums[-1] for x in (one, two)]
    assert one != two and prefix[0] == prefix[1]
    random = np.random.default_rng(12)
    gram, tail = _rare_gram(random), text(random, 80)
    rows = [(1, gram + one + tail), (2, gram + two + tail)]
    assert report(docs_of(rows)) == expected(rows)
    assert all(r[2] == 0 for r in report(docs_of(rows)))
    # the same among sorted segments: windows that only hashes hold for equal hide none that are
    before = text(random, 300)
    rows = [(1, "1" + before + gram + one + tail + "2"), (2, "3" + before + gram + two + tail + "4"), (3, "5" + before + gram + one[:60] + "6")]
    assert report(docs_of(rows)) == expected(rows)


def test_segments_of_an_anchor_meet_whatever_joins_spark_picks(docs_of, spark, monkeypatch):
    """Joins planned as sorted ones and turned into broadcasts while they run, over several parts, as on large tables."""
    as_large = {
        "spark.sql.adaptive.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "5", "spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "16k",
    }
    before = {key: spark.conf.get(key, None) for key in as_large}
    monkeypatch.setattr(repeats, "GROUP", 5)  # one passage is very common, the others come twice
    random = np.random.default_rng(14)
    common = text(random, 500)
    rows = [(100 + i, text(random, 300) + common + text(random, 300)) for i in range(12)]
    for i in range(40):
        shared = text(random, 430)
        rows += [(j * 40 + i, text(random, 300) + shared + text(random, 300)) for j in range(2)]
    try:
        for key, value in as_large.items():
            spark.conf.set(key, value)
        found = report(docs_of(rows))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert found == expected(rows) and all(r[2] >= 430 for r in found)
