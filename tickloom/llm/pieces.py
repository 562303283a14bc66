"""Encoding and decoding with a SentencePiece vocabulary as a weighted transducer.

Three transducers are compiled from the vocabulary: the normaliser (a space
before the text, spaces as a mark), the lexicon (arcs that read the characters
of a piece and write its number) and the byte fallback (arcs for characters
without a piece).  A fourth, over pairs of pieces, weighs 0 where the merge
order of the vocabulary leaves the two side by side and infinity where it does
not.  Composed with a text they form a lattice over (position, last piece);
the tropical shortest path through it is the encoding.  Every beginning of a
text has exactly one path of finite weight, so one state a position is enough,
and the lattice can be cut wherever no piece spans.

Pairs are weighed when they first occur, by merging the characters of the two.

Decoding writes the characters of the pieces and the bytes of the fallback.

Defined results: NULL and empty texts have no pieces; text that holds the
space mark itself decodes to a space; repeated rows are encoded each; other
columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from array import array
from functools import cached_property
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from tickloom.llm.common import free_name, per_text, prepare

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
REMEMBERED = 300_000  # chunks whose path a task remembers
SHORT = 64  # characters of a chunk that is worth remembering
PIECE = ""  # the arc that ends a piece
OTHER = -1  # stands before the first piece and for a character without a piece


class Vocabulary:
    """Pieces, merge scores and byte numbers; small (bounded by the model) and sent to every task."""

    def __init__(self, pieces: dict[str, int], scores: dict[str, float], byte_ids: list[int]):
        self.pieces, self.scores, self.byte_ids = pieces, scores, byte_ids

    @cached_property
    def transducer(self) -> "Transducer":
        """Compiled once per Python worker, with the paths and weights that its tasks have met."""
        return Transducer(self)

    @staticmethod
    def read(path: str = MODEL) -> "Vocabulary":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, scores, byte_ids = {}, {}, [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[piece], scores[piece] = i, model.get_score(i)
        return Vocabulary(pieces, scores, byte_ids)


class Transducer:
    def __init__(self, vocabulary: Vocabulary):
        self.lexicon, self.scores = vocabulary.pieces, vocabulary.scores
        self.byte_ids = vocabulary.byte_ids
        self.arcs: dict = {}  # from each beginning of a piece by its next character
        for piece, i in self.lexicon.items():
            node = self.arcs
            for c in piece:
                node = node.setdefault(c, {})
            node[PIECE] = i
        self.names = {i: p for p, i in self.lexicon.items()}
        self.weights: dict[tuple[int, int], float] = {}
        self.paths: dict[str, bytes] = {}
        self.written = {i: p.replace(MARK, " ").encode() for p, i in self.lexicon.items()}
        self.written |= {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
        inside = "".join(self.lexicon)
        alone = "".join(c for c in map(chr, range(32)) if c not in inside)  # figures of no piece
        split = all(MARK not in p.lstrip(MARK) for p in self.lexicon)  # no piece goes on past a space
        no = re.escape(alone)
        self.chunks = re.compile(
            (rf"{MARK}*[^{MARK}{no}]+|{MARK}+" + (f"|[{no}]" if no else "")) if split else r"(?s:.+)")

    def normalise(self, text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def merge(self, text: str) -> list[str]:
        """The vocabulary's merges: best score first, then from the left."""
        parts = list(text)
        while True:
            best, where = -inf, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1], -inf)
                if score > best:
                    best, where = score, i
            if where < 0:
                return parts
            parts[where:where + 2] = [parts[where] + parts[where + 1]]

    def weight(self, left: int, right: int) -> float:
        """Of right after left: 0 or infinity."""
        if left == OTHER:
            return 0.0
        key = (left, right)
        known = self.weights.get(key)
        if known is None:
            a, b = self.names[left], self.names[right]
            known = self.weights[key] = 0.0 if self.merge(a + b) == [a, b] else inf
        return known

    def shortest_path(self, chunk: str) -> list[int]:
        """Piece numbers along the tropical shortest path through the lattice of a chunk."""
        n = len(chunk)
        total, last, back = [0.0] + [inf] * n, [OTHER] * (n + 1), [0] * (n + 1)
        for i in range(n):
            node, j = self.arcs, i
            while j < n and (node := node.get(chunk[j])) is not None:
                j += 1
                # No arc weighs less than 0: a place that is reached stays as it is.
                if total[j] == inf and (piece := node.get(PIECE)) is not None and self.weight(last[i], piece) == 0:
                    total[j], last[j], back[j] = total[i], piece, i
            if total[i + 1] == inf and chunk[i] not in self.lexicon:  # byte fallback
                total[i + 1], back[i + 1] = total[i], i
            if total[i + 1] == inf:
                raise ValueError(f"no path through {chunk[:i + 1]!r}")
        out: list[int] = []
        i = n
        while i:
            j = back[i]
            out += [last[i]] if last[i] != OTHER else [self.byte_ids[b] for b in reversed(chunk[j:i].encode())]
            i = j
        return out[::-1]

    def _path(self, chunk: str) -> bytes:
        out = array("i", self.shortest_path(chunk)).tobytes()
        if len(chunk) <= SHORT:
            if len(self.paths) >= REMEMBERED:
                self.paths.clear()
            self.paths[chunk] = out
        return out

    def encode(self, text: str) -> np.ndarray:
        known, path = self.paths.get, self._path
        return np.frombuffer(b"".join([known(c) or path(c) for c in self.chunks.findall(self.normalise(text))]), np.int32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.written.__getitem__, ids)).removeprefix(b" ")


ENCODED = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())])


def _encoder(vocabulary: Vocabulary, back: bool):
    transducer = vocabulary.transducer

    def encode(texts: list[bytes | None]):
        rows = [transducer.encode((t or b"").decode("utf-8", "replace")) for t in texts]
        same = [transducer.decode(r.tolist()) == (t or b"") if back else None for r, t in zip(rows, texts)]
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
        flat = pa.array(np.concatenate(rows) if rows else [], pa.int32())
        return pa.ListArray.from_arrays(pa.array(offsets), flat, type=pa.list_(pa.field("element", pa.int32()))), same

    return encode


def encode(docs: DataFrame, name: str, path: str = MODEL, check: bool = False) -> DataFrame:
    """docs with the struct column name: ids, and with check whether they decode to the text."""
    spark = prepare(docs.sparkSession)
    sent = spark.sparkContext.broadcast(Vocabulary.read(path))
    return per_text(docs, "text", name, ENCODED, lambda: _encoder(sent.value, check))


def decode(rows: DataFrame, ids: str, name: str, path: str = MODEL) -> DataFrame:
    """rows with the text column name, decoded from the array column ids; NULL stays NULL."""
    spark = prepare(rows.sparkSession)
    sent = spark.sparkContext.broadcast(Vocabulary.read(path))

    def start():
        transducer = sent.value.transducer
        return lambda _, lists: ([None if x is None else transducer.decode(x).decode("utf-8", "replace") for x in lists],)

    empty, result = free_name(rows.columns, "none"), free_name(rows.columns, "r")
    out = per_text(rows.withColumn(empty, F.lit(None).cast("string")), empty, result,
                   T.StructType([T.StructField("text", T.StringType())]), start, also=[ids])
    return out.withColumn(name, F.col(result)["text"]).drop(empty, result)


def with_ids(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """docs and their token_ids."""
    name = free_name(docs.columns, "r")
    return encode(docs, name, path).withColumn(free_name(docs.columns, "token_ids"), F.col(name)["ids"]).drop(name)


def report(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the numbers, comma-joined), round_trip."""
    out = encode(docs.select("doc_id", "text"), "r", path, check=True)
    ids = F.col("r")["ids"]
    return out.select("doc_id", F.size(ids).cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(ids, ","), 256).alias("ids_sha256"), F.col("r")["round_trip"].alias("round_trip"))
