"""Language identification by hierarchical discrimination.

A text is first given to a language family, then one-versus-one linear support vector machines tell
the languages of that family apart. Features are relative frequencies of hashed byte n-grams of
the lower-cased text, so a text's score is the mean weight of its n-grams: one look-up table for each machine.

Training takes a bounded sample: for each language ``per_language`` distinct texts by the hash of their
id and text (``TRAIN_PER_LANGUAGE``, documented bound), and ``TRAIN_IN_ALL`` texts of all languages together, the first of
each language before the second. Languages are counted first and rows cut by their hash to some multiple of what is
wanted, so a language with a third of all rows sends no more to one task than others do. Features of the sample are
computed on Spark and summed up to one vector a text; one task trains. Prediction covers every row and whole texts.

As a stage (:func:`identified_documents`) the model decides: a text goes if it has no letter, or if it has enough letters to
be judged (``JUDGED_LETTERS``) and the model is undecided at both levels, with less than 0.6 for its own answer at each
(``LEAST_SCORE``, their product). Texts that mix languages stay. What stays without a label gets the predicted one.

Defined results: null text and text without a letter give ``und`` with score 0; with no labelled text at all every
text gives ``und``, and the documents kept are those with letters, unlabelled; with one language every text with letters gets it. Labels outside FAMILY form the
family ``other``. Repeated rows get equal predictions; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import in_slices, raw_bytes

TRAIN_PER_LANGUAGE = 500
TRAIN_IN_ALL = 20_000  # vectors of 16 KB in the one task that trains
SPARE = 4  # rows that the cut by hash leaves for each one wanted
LEAST_SCORE, JUDGED_LETTERS = 0.36, 40
BITS = 12
UNKNOWN = "und"

#: Families of the languages the sample may name.
FAMILY = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "pl": "slavic", "cs": "slavic", "uk": "slavic", "bg": "slavic", "sr": "slavic",
}


def gram_slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 2-, 3- and 4-grams that begin at each byte of the lower-cased texts (3 rows of slots), and the texts' offsets.

    Where a text ends before the n-gram does, the slot is one past the table.
    """
    data, offsets = raw_bytes(pc.utf8_lower(pc.fill_null(texts, "")))
    size = len(data)
    padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
    filled = np.diff(offsets) > 0
    ends = offsets[1:][filled]
    slots = np.empty((3, size), np.uint16)
    key = padded[:size].copy()
    for row, n in enumerate((2, 3, 4)):
        key = key * np.uint32(257) + padded[n - 1:size + n - 1]
        slots[row] = (key * np.uint32(2654435761) ^ np.uint32(n * 0x3779B1)) >> np.uint32(32 - BITS)
        for back in range(1, n):
            slots[row, (ends - back)[ends - back >= offsets[:-1][filled]]] = 1 << BITS
    return slots, offsets


def frequencies(texts: pa.Array) -> np.ndarray:
    """One dense vector of relative frequencies for each text."""
    slots, offsets = gram_slots(texts)
    width = (1 << BITS) + 1
    row = np.repeat(np.arange(len(texts)) * width, np.diff(offsets))
    counts = sum(np.bincount(row + slots[k], minlength=len(texts) * width) for k in range(3))
    made = counts.reshape(len(texts), width)[:, :-1].astype(np.float32)
    return made / np.maximum(made.sum(1, keepdims=True), 1)


def linear_svm(x: np.ndarray, y: np.ndarray, rounds: int = 120, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the squared hinge loss; y is -1 or 1, classes weigh alike."""
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w, bias = np.zeros(x.shape[1], np.float32), np.float32(0)
    ahead, ahead_bias, pace = w, bias, 1.0
    norms = float(np.einsum("ij,ij->i", x, x).max()) + 1
    step = np.float32(1.0 / (2 * norms + penalty))
    for _ in range(rounds):  # accelerated gradient steps
        pull = share * y * np.maximum(0, 1 - y * (x @ ahead + ahead_bias))
        new = ahead - step * (np.float32(penalty) * ahead - 2 * (x.T @ pull))
        new_bias = ahead_bias - step * (np.float32(penalty) * ahead_bias - 2 * pull.sum())
        pace_next = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        push = np.float32((pace - 1) / pace_next)
        ahead, ahead_bias = new + push * (new - w), new_bias + push * (new_bias - bias)
        w, bias, pace = new, new_bias, pace_next
    return w, float(bias)


def train(vectors: np.ndarray, labels: list[str]) -> dict:
    """A machine for each pair of families, and for each pair of languages of one family."""
    spread = vectors.std(0) + 1e-6 if len(vectors) else np.ones(vectors.shape[1], np.float32)
    middle = vectors.mean(0) if len(vectors) else spread
    scaled = vectors - middle
    scaled /= spread * np.float32(np.sqrt(vectors.shape[1]))
    family = np.array([FAMILY.get(x, "other") for x in labels])
    labels = np.array(labels)

    def machine(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
        rows = np.flatnonzero(a | b)
        w, bias = linear_svm(scaled[rows], np.where(a[rows], 1, -1).astype(np.float32))
        w = w / spread / np.float32(np.sqrt(vectors.shape[1]))
        return w.astype(np.float32), bias - float(w @ middle)

    families = sorted(set(family.tolist()))
    languages = {f: sorted(set(labels[family == f].tolist())) for f in families}
    tasks = [(a, b, *machine(family == a, family == b)) for a, b in combinations(families, 2)]
    inner = {f: [(a, b, *machine(labels == a, labels == b)) for a, b in combinations(languages[f], 2)] for f in families}
    return {"families": families, "languages": languages, "between": tasks, "within": inner}


def _votes(names: list[str], machines: list, margins: dict) -> tuple[np.ndarray, np.ndarray]:
    """The class with the most won duels (sum of squashed margins), and how sure its duels are (0 to 1)."""
    n = len(next(iter(margins.values()))) if margins else 0
    sums = {name: np.zeros(n) for name in names}
    for a, b, *_ in machines:
        win = 1 / (1 + np.exp(-np.clip(3 * margins[a, b], -40, 40)))
        sums[a] += win
        sums[b] += 1 - win
    table = np.stack([sums[name] for name in names]) / max(len(names) - 1, 1)
    return table.argmax(0), table.max(0)


def predict(model: dict, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    n = len(texts)
    lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    if not model["families"]:
        return [UNKNOWN] * n, np.zeros(n)
    machines = [*model["between"], *(m for f in model["families"] for m in model["within"][f])]
    slots, offsets = gram_slots(texts)
    lengths = np.diff(offsets)
    full = np.flatnonzero(lengths)
    total = np.maximum(3 * lengths[full] - np.minimum(lengths[full], 1) - np.minimum(lengths[full], 2) - np.minimum(lengths[full], 3), 1)
    margins = {}
    for a, b, weights, bias in machines:
        mean = np.zeros(n)
        if len(full):
            table = np.append(weights, np.float32(0))
            each = table[slots[0]]
            each += table[slots[1]]
            each += table[slots[2]]
            mean[full] = np.add.reduceat(each, offsets[full], dtype=np.float64) / total
        margins[a, b] = mean + bias
    family, sure = _votes(model["families"], model["between"], margins) if model["between"] else (np.zeros(n, int), np.ones(n))
    found, score = np.full(n, UNKNOWN, object), np.zeros(n)
    for i, name in enumerate(model["families"]):
        names, duels = model["languages"][name], model["within"][name]
        here = np.flatnonzero((family == i) & lettered)
        if duels:
            best, inner = _votes(names, duels, {pair: margins[pair][here] for pair in ((a, b) for a, b, *_ in duels)})
        else:
            best, inner = np.zeros(len(here), int), np.ones(len(here))
        found[here] = np.array(names, object)[best]
        score[here] = sure[here] * inner
    return found.tolist(), score


# --- on Spark ------------------------------------------------------------------------------


def held_out() -> Column:
    """Documents kept for testing: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in in_slices(whole, "text", 1 << 20):
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                made = [v.astype("<f4").tobytes() for v in frequencies(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(made, pa.binary())], ["lang", "vector"])


def _trained(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.assign(raw=frame["vector"]).sort_values(["lang", "raw"])
    vectors = np.frombuffer(b"".join(frame["vector"]), "<f4").reshape(len(frame), 1 << BITS)
    return pd.DataFrame({"model": [pickle.dumps(train(vectors, frame["lang"].tolist()))]})


def learn(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> dict:
    """A model from the labelled documents that are not held out; at most per_language texts of each language.

    Rows that repeat id, language and text count once; ids may be null or repeat.
    """
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("doc_id", "lang", "text", F.xxhash64("text").alias("t"))
    # identifiers first, texts for the chosen ones only
    distinct = rows.select("doc_id", "lang", "t").distinct().withColumn("h", F.xxhash64("doc_id", "t", "lang"))
    counts = distinct.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "of").limit(TRAIN_IN_ALL)
    share = F.least(F.lit(1.0), F.lit(float(SPARE * per_language)) / F.col("n"))
    near = distinct.join(F.broadcast(counts), F.col("lang") == F.col("of")).where(  # TRAIN_IN_ALL rows at most
        F.col("h").cast("double") <= (share * 2 - 1) * float(1 << 63)
    )
    order = F.row_number().over(W.partitionBy("lang").orderBy("h", "doc_id", "t"))
    picked = near.withColumn("place", order).where(F.col("place") <= per_language)
    picked = picked.orderBy("place", "lang").limit(TRAIN_IN_ALL)
    picked = picked.select(F.col("doc_id").alias("picked_id"), F.col("lang").alias("picked_lang"), F.col("t").alias("picked_t"))
    same = F.col("doc_id").eqNullSafe(F.col("picked_id")) & (F.col("lang") == F.col("picked_lang")) & (F.col("t") == F.col("picked_t"))
    chosen = rows.join(picked, same, "left_semi").dropDuplicates(["doc_id", "lang", "t"])
    vectors = chosen.select("lang", "text").mapInArrow(_vectors, "lang string, vector binary")
    model = vectors.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(
        lambda frame: _trained(frame[["lang", "vector"]]), "model binary"
    )
    row = model.first()
    return pickle.loads(row["model"]) if row else {"families": [], "languages": {}, "between": [], "within": {}}


def _labelled(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_slices(whole, "text", 512 << 10):
                lang, score = predict(model, batch.column("text"))
                kept = [batch.column(i) for i in range(batch.num_columns - 1)]
                names = batch.schema.names[:-1]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(lang, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """Every row: doc_id, held_out, lang_pred, score."""
    model = model or learn(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(
        _labelled(model), f"doc_id {id_type}, held_out boolean, lang_pred string, score double"
    )


def _in_a_language(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_slices(whole, "text", 512 << 10):
                text = batch.column("text")
                lettered = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
                if model["families"]:
                    lang, score = predict(model, text)
                    doubtful = np.flatnonzero(lettered & (score < LEAST_SCORE))
                    letters = pc.count_substring_regex(text.take(pa.array(doubtful)), r"\p{L}").to_numpy(zero_copy_only=False)
                    lettered = lettered.copy()
                    lettered[doubtful[letters >= JUDGED_LETTERS]] = False
                    at = batch.schema.get_field_index("lang")
                    named = pc.coalesce(batch.column(at), pa.array(lang, pa.string()).cast(batch.schema.field(at).type))
                    batch = batch.set_column(at, batch.schema.field(at), named)
                yield batch.filter(pa.array(lettered))

    return run


def identified_documents(docs: DataFrame) -> DataFrame:
    """Rows whose text is in one of the languages, with their columns; a null lang is filled in. Where nothing was learned: rows with letters."""
    return docs.mapInArrow(_in_a_language(learn(docs)), docs.schema)
