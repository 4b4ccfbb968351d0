import hashlib
import re
from collections import defaultdict

from ledgerloom.llm import exact_dedup


def normal(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def test_report_and_rows_that_stay(docs_of, odd_rows):
    groups = defaultdict(list)
    for r in odd_rows:
        groups[normal(r[1])].append(r)
    want = []
    for body, rows in groups.items():
        best = min(rows, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        for r in rows:
            kept = r[0] == best[0] and len(r[1] or "") == len(best[1] or "")
            want.append((r[0], best[0], len(rows), kept, hashlib.sha256(body.encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.copy_report(docs_of(odd_rows)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    stay = exact_dedup.without_copies(docs_of(odd_rows))
    assert stay.columns == docs_of(odd_rows).columns
    kept = [normal(r.text) for r in stay.collect()]
    assert sorted(kept) == sorted(groups)
    assert {r.doc_id for r in stay.collect() if r.doc_id} == {2, 5, 6, 7, 8, 9, 10} and all(r.kept == "kept" for r in stay.collect())


def test_longest_original_stays(docs_of):
    rows = exact_dedup.copy_report(docs_of([(3, "a b"), (2, "ab"), (1, "ab"), (4, "a\n b ")])).collect()
    assert {r.keep_id for r in rows} == {4} and [r.doc_id for r in rows if r.kept] == [4]


def test_a_hash_collision_joins_no_texts(docs_of, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup, "_hash", lambda normal: F.lit(bytes(16)))
    rows = exact_dedup.copy_report(docs_of([(1, "a"), (2, "b"), (3, "b ")])).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in rows) == [(1, 1, 1), (2, 3, 2), (3, 3, 2)]


def test_empty_table(docs_of):
    assert exact_dedup.copy_report(docs_of([])).collect() == []
    assert exact_dedup.without_copies(docs_of([])).collect() == []
