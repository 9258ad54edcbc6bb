"""Alignment of the tokens that two tokenizers cut from the same text, and counts of the token pairs that overlap.

Tokens are placed by the bytes they stand for. Per batch, ``pandas.merge_asof`` keyed by document finds for every token
the token of the other side that covers its first byte; the union of both directions is every overlapping pair, once.
Byte offsets where tokens of both sides end cut the text into groups. Pairs are counted over the whole corpus, and the
counts joined back: broadcast if their counted number allows, else by a join that splits the frequent pairs.

Side A is a byte-level BPE file, side B a sentencepiece file that sets a blank before the text; A gets that blank too.
Long texts are encoded in parts of some ``PART`` characters, cut before a single blank between two ASCII letters, where
neither side joins anything; the parts' tokens are those of the whole text. A text without such a place stays whole.

Null and empty texts have no tokens, nor have texts that either side does not give back byte by byte (a sign that
sentencepiece folds, or U+2581). Rows without id and repeated rows are rows like others. Other columns are passed on;
columns named like the results are replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapproche.llm.batches import arrow_rows
from rapproche.llm.bpe import MOST_BYTES, byte_signs
from rapproche.llm.words import slices
from rapproche.operators.skew import SkewLimits, lookup_join
from rapproche.session import stage

#: Splitting rule of byte-level files, a fixed value of their pre-tokenizer.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PART = 1 << 16
PLACE = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
#: Bytes of text worked on at once.
SLICE_BYTES = 1 << 20
#: Bytes that a row of the pair counts takes when broadcast.
PAIR_BYTES = 32

RESULTS = ("n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times")


def _content(path: str) -> bytes:
    with open(path, "rb") as file:
        content = file.read(MOST_BYTES + 1)
    if len(content) > MOST_BYTES:
        raise ValueError(f"{path} holds more than {MOST_BYTES} bytes")
    return content


@dataclass(frozen=True)
class Tokenizers:
    """Contents of the two files, small enough to send to every task."""

    byte_level: bytes
    piece: bytes

    @classmethod
    def load(cls, byte_level: str, piece: str) -> Tokenizers:
        return cls(_content(byte_level), _content(piece))

    @property
    def digest(self) -> str:
        return hashlib.sha256(self.byte_level + self.piece).hexdigest()


class ByteLevel:
    """Side A: ids of texts and the bytes of each id."""

    def __init__(self, content: bytes):
        import tiktoken

        model = json.loads(content)
        vocab = model["model"]["vocab"]
        byte_of = {sign: b for b, sign in enumerate(byte_signs())}
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        own = {bytes(byte_of[s] for s in token): i for token, i in vocab.items() if token not in special}
        self.strings: list[bytes] = [b""] * (max([*own.values(), *special.values()]) + 1)
        for token, i in chain(own.items(), ((t.encode(), i) for t, i in special.items())):
            self.strings[i] = token
        self.content = content
        self.coder = tiktoken.Encoding(hashlib.sha256(content).hexdigest(), pat_str=PATTERN, mergeable_ranks=own, special_tokens={})
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["model"]["merges"]]
        self.ranked = merged == sorted(merged)  # else ids are no ranks
        self._library = None

    @property
    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.content.decode())
            self._library.encode_special_tokens = True
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.one(t) for t in texts]

    def one(self, text: str) -> np.ndarray:
        if self.ranked:
            try:
                return self.coder.encode_to_numpy(text, disallowed_special=())
            except (RuntimeError, ValueError):  # its pattern matcher gives up on some very long runs
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


class Pieces:
    """Side B."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_proto=content)
        signs = [self.coder.id_to_piece(i) for i in range(self.coder.get_piece_size())]
        self.strings = [
            bytes([int(s[1:-1], 16)]) if self.coder.is_byte(i) else s.replace("▁", " ").encode()
            for i, s in enumerate(signs)
        ]
        self.within_words = not any("▁" in s.lstrip("▁") for s in signs)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.uint32) for ids in self.coder.encode(texts, num_threads=1)]


class Aligner:
    """Both sides in a task."""

    def __init__(self, files: Tokenizers):
        self.a, self.b = ByteLevel(files.byte_level), Pieces(files.piece)
        self.bytes = [pa.array(s.strings, pa.binary()) for s in (self.a, self.b)]
        self.sizes = [np.array([len(t) for t in s.strings]) for s in (self.a, self.b)]
        self.decimal = [pa.array([str(i) for i in range(len(s.strings))]) for s in (self.a, self.b)]

    def parts(self, text: str) -> list[str]:
        if len(text) <= PART or not self.b.within_words:
            return [text]
        out, first = [], 0
        while len(text) - first > PART and (place := PLACE.search(text, first + PART)):
            out.append(text[first : place.start()])
            first = place.end()
        return [*out, text[first:]]

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and text numbers of both sides; texts that either side does not give back have none."""
        parts = [self.parts(t) if t else [] for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        flat = list(chain.from_iterable(parts))
        given = [" " + p for p in flat]
        length = np.bincount(owner, [len(g.encode()) for g in given], len(texts)).astype(np.int64)
        whole = "".join(given).encode()
        sides, good = [], length > 0
        for k, ids in enumerate((self.a.encode(given), self.b.encode(flat))):
            doc = np.repeat(owner, [len(x) for x in ids])
            ids = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int64)
            own = np.bincount(doc, self.sizes[k][ids], len(texts)).astype(np.int64)
            good &= own == length
            joined = b"".join(self.bytes[k].take(pa.array(ids)).to_pylist()) if not (own == length).all() else _data(self.bytes[k], ids)
            if joined != whole:
                ends, mine = np.cumsum(length), np.cumsum(own)
                for i in np.flatnonzero(good):
                    good[i] = joined[mine[i] - own[i] : mine[i]] == whole[ends[i] - length[i] : ends[i]]
            sides.append((ids, doc))
        return [(ids[good[doc]], doc[good[doc]]) for ids, doc in sides]

    def align(self, texts: list[str]) -> list[pa.Array]:
        """The columns ``RESULTS`` of some texts."""
        n = len(texts)
        (a, doc_a), (b, doc_b) = self.tokens(texts)
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        start_a, start_b = end_a - self.sizes[0][a], end_b - self.sizes[1][b]
        frames = [
            pd.DataFrame({"at": at, "doc": doc, "token": np.arange(len(at))})
            for at, doc in ((start_a, doc_a), (start_b, doc_b))
        ]
        over_a = pd.merge_asof(frames[0][["at", "doc"]], frames[1], on="at", by="doc")["token"].to_numpy(np.int64)
        over_b = pd.merge_asof(frames[1][["at", "doc"]], frames[0], on="at", by="doc")["token"].to_numpy(np.int64)
        new = start_a[over_b] != start_b  # equal starts are in the first direction already
        left = np.concatenate([a, a[over_b[new]]])
        right = np.concatenate([b[over_a], b[new]])
        owner = np.concatenate([doc_a, doc_b[new]])
        code = left * len(self.sizes[1]) + right
        order = np.lexsort((code, owner))
        code, of = code[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (of[1:] != of[:-1])])[: len(code)])
        times = np.diff(np.append(first, len(code)))

        at = np.searchsorted(end_b, end_a)
        both = end_b[at] == end_a if len(end_b) else np.zeros(0, bool)
        cuts_a, cuts_b = np.flatnonzero(both) + 1, at[both] + 1
        names = [
            pc.binary_join(_lists(np.append(0, cuts), decimal.take(pa.array(ids))), ",")
            for ids, cuts, decimal in ((a, cuts_a, self.decimal[0]), (b, cuts_b, self.decimal[1]))
        ]
        n_groups = np.bincount(doc_a[both], minlength=n)
        joined = pc.binary_join_element_wise(*names, "|")
        groups = pc.binary_join(_lists(np.append(0, np.cumsum(n_groups)), joined), ";")
        offsets = np.append(0, np.cumsum(np.bincount(of[first], minlength=n)))
        counts = [np.bincount(doc_a, minlength=n), np.bincount(doc_b, minlength=n), n_groups, np.bincount(owner, minlength=n)]
        return [
            *[pa.array(c.astype(np.int64)) for c in counts], groups,
            _lists(offsets, pa.array(code[first])), _lists(offsets, pa.array(times.astype(np.int32))),
        ]


def _data(strings: pa.Array, ids: np.ndarray) -> bytes:
    """All strings of ``ids``, joined."""
    taken = strings.take(pa.array(ids))
    return taken.buffers()[2].to_pybytes()[: int(np.frombuffer(taken.buffers()[1], np.int32)[len(taken)])] if len(taken) else b""


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


_held: dict[str, Aligner] = {}


def _aligner(files: Tokenizers) -> Aligner:
    """The aligner of a worker process, which serves many tasks."""
    if files.digest not in _held:
        _held.clear()
        _held[files.digest] = Aligner(files)
    return _held[files.digest]


def align(docs: DataFrame, files: Tokenizers, text: str = "text") -> DataFrame:
    """``docs`` with numbers of tokens, groups and links, the ``groups`` (``a1,a2|b1;a3|b2,b3``), and the linked pairs.

    ``pairs`` holds the distinct linked pairs as A id times the size of B's vocabulary plus B id, ``times`` how many
    links of the document each one has.
    """
    docs = docs.drop(*RESULTS)
    sent = docs.sparkSession.sparkContext.broadcast(files)
    place = docs.columns.index(text)
    kinds = [T.LongType()] * 4 + [T.StringType(), T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(r, k) for r, k in zip(RESULTS, kinds, strict=True)]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(sent.value)
        for batch in batches:
            texts = batch.column(place)
            for first, last in slices(texts, SLICE_BYTES):
                part = batch.slice(first, last - first)
                found = aligner.align([t or "" for t in part.column(place).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, *found], names=[*batch.schema.names, *RESULTS])

    return docs.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(_pair, _count, _best): links that hold each pair, and whether no pair of the same B id has more."""
    links = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    counts = stage(
        links.groupBy(F.col("link.pairs").alias("_pair")).agg(F.sum("link.times").alias("_count")), "pair-counts"
    )
    b = F.pmod("_pair", F.lit(size_b))
    most = counts.groupBy(b.alias("_b")).agg(F.max("_count").alias("_most"))  # one row per id of B
    return counts.join(most, b == F.col("_b")).select("_pair", "_count", (F.col("_count") == F.col("_most")).alias("_best"))


def score_links(aligned: DataFrame, row: str, size_b: int, limits: SkewLimits = SkewLimits()) -> DataFrame:
    """(_row, n_best, count_sum) of each row with links; ``row`` names a column of ``aligned`` without repeats."""
    counts = stage(pair_counts(aligned, size_b), "pair-scores")
    links = aligned.select(F.col(row).alias("_row"), F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("_row", F.col("link.pairs").alias("pair"), F.col("link.times").cast("long").alias("times"))
    scored = lookup_join(links, counts, "pair", "_pair", PAIR_BYTES, limits=limits)
    return scored.groupBy("_row").agg(
        F.sum(F.when(F.col("_best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("_count")).alias("count_sum"),
    )


def digests(docs: DataFrame, files: Tokenizers, limits: SkewLimits = SkewLimits()) -> DataFrame:
    """Counts, link scores and the digest of the groups, a row per document."""
    size_b = len(Pieces(files.piece).strings)
    with arrow_rows(docs.sparkSession, 500):
        found = align(docs.select("doc_id", "text"), files)
        digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
        kept = found.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", *RESULTS[:4], digest, "pairs", "times"
        )
        aligned = stage(kept, "aligned")
    scores = score_links(aligned, "row", size_b, limits)
    joined = aligned.drop("pairs", "times").join(scores, F.col("row") == F.col("_row"), "left")
    return joined.select(
        "doc_id", *RESULTS[:4],
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups_sha256",
    )
