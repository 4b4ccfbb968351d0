import hashlib

import numpy as np
import pytest

from ledgerloom.llm import fingerprints


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    made = []
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        k = len(text) // 3
        changed = text[:len(text) - k] + following[:k]
        one, two, three = fingerprints._of_texts([text]) + fingerprints._of_texts([changed]) + fingerprints._of_texts([following])
        made.append((
            doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), one.astype(">u4").tobytes().hex(),
            two.astype(">u4").tobytes().hex(), fingerprints.likeness(one, two), fingerprints.likeness(one, three),
        ))
    return sorted(made, key=repr)


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_report(docs_of, odd_rows, spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = [r[:2] for r in odd_rows]
        got = [tuple(r) for r in fingerprints.fingerprint_report(docs_of(odd_rows)).collect()]
        assert sorted(got, key=repr) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_empty_and_single(docs_of):
    assert fingerprints.fingerprint_report(docs_of([])).collect() == []
    one = fingerprints.fingerprint_report(docs_of([(1, "one text of its own")])).collect()[0]
    assert one.near_next == 1.0


def test_shared_text_is_found_at_any_offset():
    random = np.random.default_rng(1)
    words = ["".join(chr(97 + x) for x in random.integers(0, 26, random.integers(2, 9))) for _ in range(3000)]
    text = " ".join(words[:1500])
    moved, other, half = "prefix of another length " + text, " ".join(words[1500:]), " ".join(words[:750] + words[2250:])
    one, two, three, four = fingerprints._of_texts([text, moved, other, half])
    assert fingerprints.likeness(one, two) > 0.9
    assert fingerprints.likeness(one, three) < 0.1
    assert 0.15 < fingerprints.likeness(one, four) < 0.55
    assert fingerprints.likeness(one, one) == 1


def test_a_text_has_one_fingerprint_in_any_batch():
    texts = ["", "a", "aaaa", "to to to to", "über", "x" * 5000, "the end"]
    together = fingerprints._of_texts(texts)
    assert all((a == fingerprints._of_texts([t])[0]).all() for t, a in zip(texts, together))
    assert all(len(a) for a in together[1:]) and not len(together[0])
