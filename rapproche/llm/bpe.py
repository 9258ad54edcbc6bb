"""Byte-pair encoding and decoding with the vocabulary file of a public tokenizer.

A word's symbols form a doubly linked list; a priority queue holds the ranks of its adjacent pairs. The lowest rank is
merged first, and entries whose symbols have changed since are skipped. Decoding concatenates vocabulary strings, with
the blank that the file's missing decoder puts between tokens.

Letters and numbers are those of Python's Unicode table; signs newer than it count as other signs.

Null text is encoded as empty: no ids, empty decoded text. Null ids and repeated rows are rows like others; other
columns are passed on, and columns named like the results are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the tokenizer file's normalizer and splitter.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
WHITE = "\t\n\v\f\r \x85\xa0  -     　"
SEPARATORS = re.compile("[\x1c-\x1f]")  # str.split() parts at these, the file's rule does not

#: Bytes, roughly, of words that a worker keeps with their ids in each of two generations: a full one becomes the old one,
#: whose words move up when they occur again. Longer chunks are not kept. Both change nothing but time and memory.
STORE_BYTES = 32 << 20
STORED_LENGTH = 48
#: Broadcast bound of the vocabulary file.
MOST_BYTES = 64 << 20


def pieces(text: str) -> Iterator[str]:
    """Parts of a blank-free text: a contraction, a run of letters, one number sign, or a run of other signs."""
    kinds = [k if (k := unicodedata.category(c)[0]) in "LN" else "" for c in text]
    at = 0
    while at < len(text):
        end = at + next((len(c) for c in CONTRACTIONS if text.startswith(c, at)), 1)
        if end == at + 1 and kinds[at] != "N":
            while end < len(text) and kinds[end] == kinds[at]:
                end += 1
        yield text[at:end]
        at = end


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte: itself where it is printable Latin-1, else one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@dataclass(frozen=True)
class BpeModel:
    """A vocabulary file's content, small enough to send to every task."""

    vocab: dict[str, int]
    merges: list[tuple[str, str]]
    special: dict[str, int]
    suffix: str
    digest: str

    @classmethod
    def load(cls, path: str) -> BpeModel:
        with open(path, "rb") as file:
            content = file.read(MOST_BYTES + 1)
        if len(content) > MOST_BYTES:
            raise ValueError(f"the vocabulary file holds more than {MOST_BYTES} bytes")
        data = json.loads(content)
        model = data["model"]
        return cls(
            model["vocab"],
            [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]],
            {t["content"]: t["id"] for t in data["added_tokens"]},
            model["end_of_word_suffix"] or "",
            hashlib.sha256(content).hexdigest(),
        )

    def strings(self) -> list[str]:
        """Token string by id."""
        every = self.vocab | self.special
        out = [""] * (max(every.values(), default=-1) + 1)
        for token, i in every.items():
            out[i] = token
        return out


class Encoder:
    """Encodes texts in a task. The store maps a blank-free chunk of normalized text to its ids."""

    def __init__(self, model: BpeModel):
        vocab = model.vocab
        self.vocab, self.suffix, self.special = vocab, model.suffix, model.special
        self.ranks = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(model.merges)}
        self.signs = byte_signs()
        self.white = re.compile(f"[{WHITE}]+")
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(model.special, key=len, reverse=True))) + ")")
        self.store: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}
        self.held = 0

    def word(self, piece: str) -> list[int]:
        """Ids of one piece: the pair of lowest rank, leftmost first, is merged until no pair has a rank."""
        signs = [self.signs[b] for b in piece.encode()]
        signs[-1] += self.suffix
        symbol = [self.vocab[s] for s in signs if s in self.vocab]
        n, ranks = len(symbol), self.ranks
        if n < 2:
            return symbol
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [
            (found[0], i, symbol[i], symbol[i + 1])
            for i in range(n - 1)
            if (found := ranks.get((symbol[i], symbol[i + 1])))
        ]
        heapq.heapify(queue)
        while queue:
            _, left, a, b = heapq.heappop(queue)
            right = after[left]
            if symbol[left] != a or right < 0 or symbol[right] != b:
                continue  # stale: a neighbour was merged since
            merged = symbol[left] = ranks[a, b][1]
            symbol[right] = -1
            right = after[left] = after[right]
            if right >= 0:
                before[right] = left
                if found := ranks.get((merged, symbol[right])):
                    heapq.heappush(queue, (found[0], left, merged, symbol[right]))
            other = before[left]
            if other >= 0 and (found := ranks.get((symbol[other], merged))):
                heapq.heappush(queue, (found[0], other, symbol[other], merged))
        return [s for s in symbol if s >= 0]

    def chunk(self, text: str) -> list[int]:
        """Ids of a chunk that the store does not hold."""
        if (found := self.older.get(text)) is not None:
            return self.keep(text, found)
        if text.isalpha():  # letters alone are one piece
            return self.keep(text, self.word(text))
        letters = text.rstrip(".,;:!?")
        parts = (letters, text[len(letters) :]) if letters.isalpha() else pieces(text)
        ids: list[int] = []
        for piece in parts:
            found = self.store.get(piece)  # a piece on its own is a chunk too
            if found is None:
                found = self.older.get(piece)
                found = self.keep(piece, self.word(piece) if found is None else found)
            ids += found
        return self.keep(text, ids)

    def keep(self, text: str, ids: list[int]) -> list[int]:
        if len(text) > STORED_LENGTH:
            return ids
        if self.held >= STORE_BYTES:
            self.store, self.older, self.held = {}, self.store, 0
        self.store[text] = ids
        self.held += 200 + len(text) + 8 * len(ids)  # entry, string and list
        return ids

    def plain(self, text: str, ids: list[int]) -> None:
        """Adds the ids of a text without special tokens."""
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # lower case is taken sign by sign, without the final form
            text = text.replace("Σ", "σ")
        chunks = (self.white.split(text.lower())) if SEPARATORS.search(text) else text.lower().split()
        for c in chunks:
            found = self.store.get(c)
            ids += self.chunk(c) if found is None else found

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        if "<|" not in text and all(s.startswith("<|") for s in self.special):
            self.plain(text, ids)
            return ids
        for part in self.marks.split(text) if self.special else [text]:
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                self.plain(part, ids)
        return ids


#: The encoder of a worker process, which serves many tasks.
_held: dict[str, Encoder] = {}


def _encoder(model: BpeModel) -> Encoder:
    if model.digest not in _held:
        _held.clear()
        _held[model.digest] = Encoder(model)
    return _held[model.digest]


def _with_columns(df: DataFrame, *made: tuple, without: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with more columns (name, type, source, start), in one pass: ``start()`` gives a function of the source column.

    A source may be a column made before. Columns ``without`` serve as sources and are not returned.
    """
    df = df.drop(*[name for name, *_ in made])
    added = [T.StructField(name, T._parse_datatype_string(kind)) for name, kind, *_ in made]
    schema = T.StructType([f for f in [*df.schema.fields, *added] if f.name not in without])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = [(name, source, start()) for name, _, source, start in made]
        for batch in batches:
            for first in range(0, max(batch.num_rows, 1), 500):  # long texts: small batches
                part = batch.slice(first, 500)
                names, columns = list(part.schema.names), list(part.columns)
                for name, source, make in steps:
                    columns.append(make(columns[names.index(source)]))
                    names.append(name)
                kept = [i for i, name in enumerate(names) if name not in without]
                yield pa.RecordBatch.from_arrays([columns[i] for i in kept], names=[names[i] for i in kept])

    return df.mapInArrow(run, schema)


def _encoding(spark: SparkSession, model: BpeModel, text: str, ids: str) -> tuple:
    sent = spark.sparkContext.broadcast(model)

    def start():
        encoder = _encoder(sent.value)

        def column(texts: pa.Array) -> pa.Array:
            offsets, flat = [0], []
            for value in texts:
                flat += encoder.encode(value.as_py() or "")
                offsets.append(len(flat))
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))

        return column

    return ids, "array<int>", text, start


def _decoding(spark: SparkSession, model: BpeModel, ids: str, text: str) -> tuple:
    sent = spark.sparkContext.broadcast(model.strings())

    def start():
        strings = pa.array(sent.value)

        def column(rows: pa.Array) -> pa.Array:
            rows = rows.fill_null([]) if rows.null_count else rows
            tokens = strings.take(rows.flatten())
            offsets = pa.compute.subtract(rows.offsets, rows.offsets[0])
            return pa.compute.binary_join(pa.ListArray.from_arrays(offsets, tokens), " ")

        return column

    return text, "string", ids, start


def encode(docs: DataFrame, model: BpeModel, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text in column ``ids``."""
    return _with_columns(docs, _encoding(docs.sparkSession, model, text, ids))


def decode(docs: DataFrame, model: BpeModel, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the vocabulary strings of ``ids``, special tokens included, in column ``text``."""
    return _with_columns(docs, _decoding(docs.sparkSession, model, ids, text))


def digests(docs: DataFrame, model: BpeModel, *keep: str) -> DataFrame:
    """Columns ``keep``, number of tokens, and SHA-256 of the ids and of the decoded text, encoded and decoded in one pass."""
    spark = docs.sparkSession
    steps = _encoding(spark, model, "text", "ids"), _decoding(spark, model, "ids", "decoded")
    coded = _with_columns(docs.select(*keep, "text"), *steps, without=("text",))
    return coded.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
