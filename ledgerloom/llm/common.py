"""Shared helpers: text normalisation, cutting lineage, the tokenizer, Arrow columns."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
WORD = "[^\\x20\\x09-\\x0D]+"

TOKENIZER_FILE = "byte_bpe_50k.json"
END_ID = 2


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without_spaces(text: Column) -> Column:
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in spark.checkpoint.dir; one of our own only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    set_before = spark.sparkContext.getCheckpointDir()
    if set_before:
        return set_before
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a shared folder in spark.checkpoint.dir")
    return "file://" + tempfile.mkdtemp(prefix="run-")


def cut(frame: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder; later steps read them from there."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table below the shared folder, read back: for wide or packed rows."""
    folder = new_folder(frame.sparkSession, name)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the n + 1 offsets of its values (null: empty)."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def in_slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20):
    """Parts of a batch whose texts have about most_bytes together (one row at least)."""
    _, offsets = raw_bytes(batch.column(column))
    start = 0
    while start < len(batch):
        end = int(np.searchsorted(offsets, offsets[start] + most_bytes, side="right")) - 1
        end = min(max(end, start + 1), len(batch))
        yield batch.slice(start, end - start)
        start = end


# --- tokenizer -----------------------------------------------------------------------------

_AFTER_SPACE = re.compile(r"\s[ \n]")
_PIECES = re.compile(r"(?<=\S)(?=[ \n])")


class Encoder:
    """Token ids of whole texts with the tokenizers library, each distinct piece encoded once.

    The byte-level vocabulary never joins what stands before a blank or line feed that follows a
    non-space with what comes after, so a text is cut there, and its ids are those of its pieces in order.
    Pieces repeat (they are words), so most are found in a table. The table keeps the first ``most``
    pieces seen in this process, later ones for their batch only; results do not depend on it.
    """

    def __init__(self, path: str, most: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.most = most
        vocabulary = self.tokenizer.get_vocab()
        self.blank_first = np.zeros(max(vocabulary.values()) + 1, bool)
        self.blank_first[[i for token, i in vocabulary.items() if token[0] == "Ġ"]] = True
        self.line_feed = np.zeros_like(self.blank_first)
        self.line_feed[vocabulary["Ċ"]] = True

    @staticmethod
    def pieces(text: str) -> list[str]:
        if "\0" in text or _AFTER_SPACE.search(text):
            return _PIECES.split(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")

    def _one_by_one(self, pieces: list[str]) -> None:
        for piece, coded in zip(pieces, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)):
            self.known[piece] = np.array(coded.ids, dtype="<u4").tobytes()

    def _together(self, pieces: list[str], first: np.ndarray) -> None:
        """Pieces that each begin with the only blank (line feed) in them, encoded as one text."""
        if not pieces:
            return
        coded = self.tokenizer.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0]
        ids = np.array(coded.ids, dtype="<u4")
        begins = np.flatnonzero(first[ids])
        if len(begins) != len(pieces) or begins[0] != 0:
            self._one_by_one(pieces)
            return
        data, at = ids.tobytes(), [*(begins * 4).tolist(), len(ids) * 4]
        self.known.update(zip(pieces, [data[a:b] for a, b in zip(at, at[1:])]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut_texts = [self.pieces(text) for text in texts]
        new = list(set().union(*cut_texts).difference(self.known))
        blank, line, other = [], [], []
        for piece in new:
            plain = len(piece) > 1 and not piece[1].isspace()
            if plain and piece[0] == " " and piece.count(" ") == 1:
                blank.append(piece)
            elif plain and piece[0] == "\n" and piece.count("\n") == 1 and " " not in piece:
                line.append(piece)
            else:
                other.append(piece)
        self._together(blank, self.blank_first)
        self._together(line, self.line_feed)
        self._one_by_one(other)
        look_up = self.known.__getitem__
        coded = [b"".join(map(look_up, pieces)) for pieces in cut_texts]
        if len(self.known) > self.most:
            for piece in new:
                del self.known[piece]
        return coded


_encoders: dict[str, Encoder] = {}


def encoder(name: str = TOKENIZER_FILE) -> Encoder:
    """One encoder for each Python worker; name: a file of public_tokenizers, or a path."""
    if name not in _encoders:
        import public_tokenizers

        _encoders[name] = Encoder(name if os.path.isabs(name) else public_tokenizers.path(name))
    return _encoders[name]
