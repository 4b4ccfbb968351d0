"""Token files and packing against whole-text encoding."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import common, packing, token_files
from ledgerloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


TEXTS = [
    "", " ", "  ", "\n", "\n\n", "a", " a", "a ", "a  b", "a\n b", "a \nb", "a\n\nb  \n c", "don't we'll I'm", "x  y", "x  y", "\ty\t \t",
    "\0 a\0\nb", "\x1c a \x85 b", "é è\nü  ß", "<|endoftext|> a<|endoftext|>", "THE*** end!!\n12 345", "中文 字\n漢", "🙂 🙂\n🙂", "\r\n a\r\nb",
]


def test_pieces_give_the_ids_of_whole_texts(plain):
    encoder = common.Encoder(public_tokenizers.path("byte_bpe_50k.json"), most=8)
    random = np.random.default_rng(1)
    alphabet = list("ab  \n\n\t.'é1  \x1c\x85") + ["<|endoftext|>", "'s"]
    texts = TEXTS + ["".join(random.choice(alphabet, 30)) for _ in range(400)]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == plain(text)[:-1], repr(text)


def digest_expected(rows, plain):
    made, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = plain(text)
        made.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    return sorted(made, key=repr)


def test_token_files(docs_of, odd_rows, plain):
    rows = [r[:2] for r in odd_rows] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    got = token_files.written_and_read(docs_of(rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == digest_expected(rows, plain)


def test_token_files_hold_ids_and_answer_look_ups(docs_of, spark, plain):
    folder = common.new_folder(spark, "tokens-test")
    token_files.write_tokens(docs_of([(i, f"text {i} of all") for i in range(50)]).repartition(3), folder)
    row = token_files.read_tokens(spark, folder).where("doc_id = 17").collect()
    assert [r.ids for r in row] == [plain("text 17 of all")]


def test_empty_table(docs_of):
    assert token_files.written_and_read(docs_of([])).collect() == []
    assert packing.packed_documents(docs_of([])).collect() == []


def check_packing(rows, got, plain, capacity):
    wanted = Counter((doc_id, tuple(plain(text))) for doc_id, text in rows)
    sequences, pieces = defaultdict(list), Counter()
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    expected = Counter()
    for (doc_id, ids), times in wanted.items():
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc_id, k, a, b - a, crc(ids[a:b])] += times
    assert pieces == expected
    return len(sequences)


def test_packing(docs_of, odd_rows, plain):
    rows = [r[:2] for r in odd_rows] + [(100 + i, f"word{i} " * (i * 7 % 90)) for i in range(120)]
    got = packing.packed_documents(docs_of(rows)).collect()
    total = sum(len(plain(text)) for _, text in rows)
    assert check_packing(rows, got, plain, 1024) <= -(-total // 1024) + 1
    small = packing.packed_documents(docs_of(rows), capacity=64).collect()
    check_packing(rows, small, plain, 64)


def test_fullest_is_the_best_subset():
    random = np.random.default_rng(2)
    for _ in range(200):
        lengths = random.integers(1, 30, 8).tolist()
        room = int(random.integers(1, 60))
        sums = {0}
        for x in lengths:
            sums |= {s + x for s in sums}
        taken = packing.fullest(dict(Counter(lengths)), room)
        assert sum(taken) == max(s for s in sums if s <= room)
        assert not Counter(taken) - Counter(lengths)


def test_plan_places_every_piece_once():
    counts = {1024: 3, 700: 5, 324: 4, 100: 30, 7: 11}
    slots = packing.plan(counts)
    for length, n in counts.items():
        places = set()
        for rank in range(n):
            at = np.searchsorted(slots["key"], (length << 44) + rank, side="right") - 1
            assert slots["key"][at] >> 44 == length
            places.add((slots["base"][at] + rank, slots["offset"][at]))
        assert len(places) == n


def scanned(frame):
    """Rows that the scan of a plan handed on."""
    plan = frame._jdf.queryExecution().executedPlan()
    frame.collect()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_look_ups_skip_stripes_and_row_groups(spark):
    """Ids are multiples of 10: a group of rows that cannot hold an id is skipped, by its range or its Bloom filter."""
    docs = spark.range(0, 300_000, 10).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    folder = common.new_folder(spark, "tokens-test")
    token_files.write_tokens(docs, folder)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.orc.enableVectorizedReader", "false")
    try:
        tokens = token_files.read_tokens(spark, folder).select("doc_id", "n_tokens")
        assert scanned(tokens) == 30_000
        here = tokens.where("doc_id = 123450")
        assert here.count() == 1 and 1 <= scanned(here) <= token_files.INDEX_STRIDE
        absent = [tokens.where(f"doc_id = {i}") for i in (123_451, 7_773, 250_009)]  # in the range of some file, in none of them
        # by their ranges alone each would read a row group; a Bloom filter errs once in a hundred
        assert sum(scanned(a) for a in absent) <= token_files.INDEX_STRIDE
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.orc.enableVectorizedReader")


SF = "/root/testdata/sf0.001"


def given(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_token_query_agrees_with_whole_texts(spark, plain):
    got = QUERIES["op2_token_files"](spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=repr) == digest_expected(given(spark), plain)


def test_packing_query_agrees_with_whole_texts(spark, plain):
    check_packing(given(spark), QUERIES["op10_packing"](spark, SF).collect(), plain, 1024)
