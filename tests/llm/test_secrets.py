"""Secret scans against Python's regexes on every text."""

import hashlib
import random
import re

import pytest

from ledgerloom.llm import secrets
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def spans(text, rules):
    found = []
    for place, rule in enumerate(rules):
        pattern = "[0-9a-f]+" if rule.kind == "hex" else rule.pattern
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), place, m.end()))
    return sorted(found)


def expected(rows, rules=secrets.RULES):
    def written(found):
        return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in found)

    result = []
    for doc_id, text in rows:
        every = spans(text, rules)
        base = [s for s in every if s[1] < 3]
        counts = [sum(s[1] == k for s in base) for k in range(3)]
        result.append((doc_id, *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every)))
    return sorted(result, key=repr)


def report(docs, **options):
    return sorted([tuple(r) for r in secrets.secret_report(docs, **options).collect()], key=repr)


def test_queries_of_regexes():
    def query(pattern):
        return sorted("".join(sorted(c)) if len(c) == 1 else "+".join(sorted(c)) for c in secrets.trigram_query(pattern))

    assert query("abcd") == ["abc+bcd"]
    assert query("(?i:ABC|bcd)x*") == ["abc", "bcd"]
    assert query("ab[cd]") == ["abc", "abd"]
    assert query("[0-9a-f]{32,}") == query("ab.*cd") == query("(abc)?") == query("(abc)*") == [""]
    assert query("(abc)+") == ["abc"]
    assert query("abc.{3}xyz") == ["abc+xyz"]
    assert query("ab(cd?|e)f") == ["abc+bcd+cdf", "abc+bcf", "abe+bef"]
    assert query("AKIA[A-Z0-9]+") == ["aki+kia"]
    assert query("a(?=bcd)bc") == ["abc"]
    assert [rule.kind for rule in secrets.RULES if secrets.trigram_query(rule.pattern) == secrets.TRUE] == ["hex"]


def test_clauses_are_necessary():
    draw = random.Random(4)
    letters = ["token", "SECRET", "api_key", "apikey", "=", ":", " ", '"', "AKIA", "Z9", "://", "@", "a", "ghp_", "xoxb-", "Passwd", "é"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(1, 12))) for _ in range(3000)]
    for rule in secrets.RULES:
        query = secrets.trigram_query(rule.pattern)
        for text in texts:
            if re.search(rule.pattern, text, re.ASCII):
                assert any(all(t in text.lower() for t in clause) for clause in query), (rule.kind, text)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted([tuple(r) for r in QUERIES["op13_secrets"](spark, SF).collect()], key=repr) == expected(rows)


HOSTILE = [
    "password=abcdefgh", "PassWord : 'abcdefgh'", "token=token:abcdefghij", "token==abcdefg", "secret = = abcdefghij",
    "api_key:\"A/b+c=d.e-f_\"", "apikey=12345678é9", "api key=12345678", "to\u212aen=abcdefgh", "pa\u017f\u017fword=abcdefgh",
    "AKIA" + "A" * 11, "AKIA" + "A" * 12, "xAKIAAKIA" + "Z" * 12 + "_", "akia" + "A" * 20, "AKIA", "é😀AKIA" + "0" * 20,
    "0" * 31, "f" * 32, "g" + "a" * 40 + "G" + "b" * 33, "F" * 40, "é" * 5 + "deadbeef" * 4 + "\n" + "cafe" * 9,
    "secret=" + "a" * 40, "token:\t12345678", "token  :  12345678", "token\n=12345678", "passwdsecret=abcdefgh",
    "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----x", "ghp_" + "a1" * 18, "xoxb-" + "1" * 10,
    "https://u:p@host token=x://a:b@c", "://:@", "", " ", "\0token=\0\0", "$1 \\ token=$1abcdefgh",
]


def test_hostile_texts(docs_of):
    rows = [(i, text, "en", "a") for i, text in enumerate(HOSTILE)]
    assert report(docs_of(rows)) == expected([r[:2] for r in rows])


def test_odd_rows(docs_of, odd_rows):
    rows = odd_rows + [(11, "token=abcdefgh", "en", "a")] * 5 + [(None, "token=abcdefgh", "en", "a")] * 2
    assert report(docs_of(rows)) == expected([r[:2] for r in rows])
    assert report(docs_of(rows), added=()) == expected([r[:2] for r in rows], secrets.BASE)


@pytest.mark.parametrize("n", [255, 256, 257, 5000])
def test_many_matches_in_a_long_text(docs_of, n):
    text = "".join(f"é token={i:08d} {'ab' * 20} " for i in range(n)) + "x " * 1000
    assert report(docs_of([(1, text, "en", "a")])) == expected([(1, text)])


def test_only_candidates_of_the_index_are_verified(docs_of):
    docs = docs_of([(1, "token=abcdefgh", "en", "a"), (2, "a broken toke n", "en", "a"), (3, "nothing", "en", "a"), (4, "taken oke ken tok", "en", "a")])
    found = {(r.doc_key, tuple(sorted(secrets.RULES[k].kind for k in r.rules))) for r in secrets.candidates(docs).collect()}
    assert found == {(1, ("assign",)), (2, ("assign",)), (4, ("assign",))}


def test_main_path_is_native(spark):
    plan = QUERIES["op13_secrets"](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


def test_empty_table(docs_of):
    assert report(docs_of([])) == []
