"""Encoding of a corpus with a public byte-level vocabulary; long texts by tree concatenation.

A text beyond ``PIECE_CHARS`` is cut into pieces that are encoded in parallel, wherever in the text they end, also in
the middle of a word or of a run without any break. The encodings are then joined in pairs, as a tree. At each join
the text around it is taken apart again from the last sure break of the left side, until a break coincides with one of
the right side. A word that both sides share is encoded again in a window of tokens around the join, which grows until
its first and last token are those that the sides have there; by the nature of byte-pair merges, each token of
such a sequence then still fits its neighbours, so the sequence is the one that the whole word has.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.session import cut, wide

#: Characters of a piece; texts up to that length are one piece. Pieces of a text that one task joins at a time.
PIECE_CHARS, FAN_IN = 20_000, 64
VOCABULARY = "byte_bpe_50k.tiktoken"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed public vocabularies keep a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """A byte-level BPE vocabulary read from a file of ranks; text that looks like a special token is ordinary text."""

    def __init__(self, path: str, pattern: str | None = None):
        import tiktoken

        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.words = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> list[int]:
        return self.encoding.encode_ordinary(text) if text else []

    def bytes_of(self, ids) -> bytes:
        return b"".join(self.tokens[i] for i in ids)

    def word(self, text: bytes) -> list[int]:
        """The ids of one word, which the pattern doesn't take apart."""
        return self.encoding._encode_single_piece(text)

    def piece(self, text: str) -> Piece:
        ids, counts = [], []
        for m in self.words.finditer(text):
            word = self.word(m[0].encode())
            ids.extend(word)
            counts.append(len(word))
        return Piece(ids, counts)

    def joined_word(self, left: list[int], right: list[int]) -> list[int]:
        """The ids of a word of which both halves are encoded, by a growing window around the join."""
        reach = 1
        while True:
            a, b = left[-reach:], right[:reach]
            window = self.word(self.bytes_of(a + b))
            starts = len(a) == len(left) or window[0] == a[0]
            ends = len(b) == len(right) or window[-1] == b[-1]
            if starts and ends:
                return left[: len(left) - len(a)] + window + right[len(b) :]
            reach *= 2

    def join(self, a: Piece, b: Piece) -> Piece:
        """The encoding of the text of ``a`` followed by that of ``b``."""
        if not a.counts or not b.counts:
            return b if not a.counts else a
        # Only the last word of a, or the last two where white space looks ahead, can change with what follows.
        keep = max(0, len(a.counts) - 2)
        start = len(a.ids) - sum(a.counts[keep:])
        tail_ids, tail_counts = a.ids[start:], a.counts[keep:]
        tail = self.bytes_of(tail_ids)
        taken = 4
        while True:
            whole = taken >= len(b.counts)
            head_counts = b.counts[:taken]
            head_ids = b.ids[: sum(head_counts)]
            text = tail + self.bytes_of(head_ids)
            words = [m[0].encode() for m in self.words.finditer(text.decode())]
            breaks = np.cumsum([0, *map(len, words)])
            there = {0: (0, 0)}  # breaks of a's tail and of b's head: byte -> (words, tokens) before it
            at = tokens = 0
            for i, n in enumerate(tail_counts, 1):
                at += len(self.bytes_of(tail_ids[tokens : tokens + n]))
                tokens += n
                there[at] = (i, tokens)
            ahead, at, tokens = {len(tail): (0, 0)}, len(tail), 0
            for i, n in enumerate(head_counts, 1):
                at += len(self.bytes_of(head_ids[tokens : tokens + n]))
                tokens += n
                ahead[at] = (i, tokens)
            sure = len(words) if whole else max(0, len(words) - 2)
            meet = next((i for i in range(sure + 1) if breaks[i] >= len(tail) and breaks[i] in ahead), None)
            if meet is not None:
                break
            taken *= 2
        ids, counts = a.ids[:start], a.counts[:keep]
        for word, lo, hi in zip(words[:meet], breaks, breaks[1:]):
            if hi <= len(tail) and lo in there and hi in there and there[hi][0] == there[lo][0] + 1:
                new = tail_ids[there[lo][1] : there[hi][1]]
            elif lo in there and hi in ahead and lo < len(tail) < hi:
                new = self.joined_word(tail_ids[there[lo][1] :], head_ids[: ahead[hi][1]]) if self._one(there, lo, len(tail)) and ahead[hi][0] == 1 else self.word(word)
            else:
                new = self.word(word)
            ids = ids + new
            counts = counts + [len(new)]
        words_b, tokens_b = ahead[int(breaks[meet])]
        return Piece(ids + b.ids[tokens_b:], counts + b.counts[words_b:])

    @staticmethod
    def _one(there: dict, lo: int, end: int) -> bool:
        return there[end][0] == there[lo][0] + 1

    def join_all(self, pieces: list[Piece]) -> Piece:
        """Pairs of neighbours first, then pairs of those, so that no text is copied more than log(n) times."""
        while len(pieces) > 1:
            pieces = [reduce(self.join, pieces[i : i + 2]) for i in range(0, len(pieces), 2)]
        return pieces[0] if pieces else Piece([], [])


class Piece:
    """The ids of a text, and how many of them each of its words has."""

    def __init__(self, ids: list[int], counts: list[int]):
        self.ids, self.counts = ids, counts


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _is_long(text: str, piece_chars: int):
    return F.length(text) > piece_chars


def encode_corpus(documents: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None, piece_chars: int = PIECE_CHARS, counts: bool = False, fan_in: int = FAN_IN) -> DataFrame:
    """(id, ids): the token ids of each document's whole text, without special tokens; [] for an empty or null text.

    Each row has its result, also rows that repeat an id or have none. ``path`` names the file of ranks, the same on
    every machine. With ``counts`` the result is (id, n_tokens). The pieces of a text are joined in a tree, ``fan_in`` of them in
    a task, and what comes of these in other tasks, so no task has to join a whole long text.
    """
    path = path or vocabulary_path()
    kind = documents.schema[id_col].dataType.simpleString()
    slim = documents.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    schema = f"id {kind}, " + ("n_tokens int" if counts else "ids array<int>")

    def result(keys: pa.Array, ids: list[list[int]]) -> pa.RecordBatch:
        values = pa.array([len(x) for x in ids], pa.int32()) if counts else pa.array(ids, pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([keys, values], ["id", "n_tokens" if counts else "ids"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            yield result(batch.column(0), [e.encode(t) for t in batch.column(1).to_pylist()])

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column(1).to_pylist()):
                parts = [t[k : k + piece_chars] for k in range(0, len(t), piece_chars)]
                key = batch.column(0).slice(i, 1).take(pa.array([0] * len(parts)))
                row = batch.column(2).slice(i, 1).take(pa.array([0] * len(parts)))
                yield pa.RecordBatch.from_arrays([key, row, pa.array(range(len(parts)), pa.int32()), pa.array(parts)], ["id", "row", "piece", "text"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            done = [e.piece(t) for t in batch.column(3).to_pylist()]
            arrays = [pa.array([getattr(p, f) for p in done], pa.list_(pa.int32())) for f in ("ids", "counts")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], ["id", "row", "piece", "ids", "counts"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Neighbours of a block, which come one after the other, as one piece; its number is that of the block."""
        e, now, key, held = encoder(path), None, None, []

        def out() -> pa.RecordBatch:
            one = e.join_all(held)
            numbers = [pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int32())]
            return pa.RecordBatch.from_arrays([key, *numbers, *(pa.array([x], pa.list_(pa.int32())) for x in (one.ids, one.counts))], ["id", "row", "piece", "ids", "counts"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(1, 5)]
            for i, (row, at, ids, counts_) in enumerate(zip(*columns)):
                if (row, at // fan_in) != now:
                    if now is not None:
                        yield out()
                    now, key, held = (row, at // fan_in), batch.column(0).slice(i, 1), []
                held.append(Piece(ids, counts_))
        if now is not None:
            yield out()

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield result(batch.column(0), batch.column(3).to_pylist())

    short = slim.filter(F.coalesce(~_is_long("text", piece_chars), F.lit(True))).mapInArrow(whole, schema)
    long = slim.filter(_is_long("text", piece_chars)).withColumn("row", F.monotonically_increasing_id())
    parts = long.mapInArrow(cut_up, f"id {kind}, row bigint, piece int, text string")
    cells = f"id {kind}, row bigint, piece int, ids array<int>, counts array<int>"
    level = cut(wide(parts, "row", "piece").mapInArrow(pieces, cells), "pieces")
    most = level.agg(F.coalesce(F.max("piece"), F.lit(0)).alias("most")).collect()[0].most
    while most > 0:
        block = F.floor(F.col("piece") / fan_in)
        level = wide(level.withColumn("block", block), "row", "block").sortWithinPartitions("row", "piece").drop("block").mapInArrow(joined, cells)
        most //= fan_in
    return short.unionByName(level.mapInArrow(finished, schema)).withColumnRenamed("id", id_col)


def token_counts(documents: DataFrame, keep: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """(columns ``keep``, n_tokens): how many tokens each document's text has, beside other columns of its row."""
    rows = documents.select(F.struct(*keep).alias("id"), F.col(text).alias("text"))
    return encode_corpus(rows, "id", "text", path, counts=True).select("id.*", "n_tokens")


def decoded_sizes(encoded: DataFrame, id_col: str, path: str | None = None) -> DataFrame:
    """(id, n_bytes): how many bytes the ids of each row stand for."""
    path = path or vocabulary_path()

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = {i: len(t) for i, t in encoder(path).tokens.items()}
        for batch in batches:
            found = [sum(map(of.__getitem__, ids)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], [id_col, "n_bytes"])

    return encoded.select(id_col, "ids").mapInArrow(sizes, f"{id_col} {encoded.schema[id_col].dataType.simpleString()}, n_bytes bigint")
