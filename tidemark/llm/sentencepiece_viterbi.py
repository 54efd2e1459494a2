"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

A text gets a space in front, spaces are the marks (``▁`` in the model file), and it is
cut into marked words: a run of marks and what follows it up to the next mark. The
distinct marked words of a batch are sorted, which is a depth-first walk of their
trie: a word takes over the forward scores of the prefix it shares with the word
before it and goes on from there. As no piece reaches over the start of a marked
word, the best path of a text is made of the best paths of its words.

A piece's score is the logarithm of a Zipf law over its id, as the model file holds
merge ranks and no probabilities. Characters without a piece, also a ``▁`` that
stands in a text, become their UTF-8 byte pieces, so decoding gives every text back.
"""

from __future__ import annotations

import hashlib
import importlib.util
import math
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidemark.llm.words import released

NAME = "op6_sentencepiece_viterbi"
SQL = None

MARK = "▁"
_WORD = re.compile(" *[^ ]+| +")
#: the file in the folder of public vocabularies; the path is a parameter of all functions here
MODEL = "piece_bpe_32k.model"
#: characters of encoded words that a task keeps between batches
REMEMBERED = 1_000_000


def model_path(name: str = MODEL) -> str:
    found = importlib.util.find_spec("public_tokenizers")
    return os.path.join(os.path.dirname(found.origin) if found else "/opt/tokenizers", name)


class Pieces:
    """The pieces of a model file, with spaces for marks: ids, scores and bytes.

    The byte score is below any piece's, so bytes are taken only where nothing else fits.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.byte_ids = [-1] * 256
        self.ids: dict[str, int] = {}
        self.score = [-math.log(i + 1) for i in range(n)]
        self.raw = [b""] * n
        for i in range(n):
            piece = model.id_to_piece(i).replace(MARK, " ")
            if model.is_byte(i):
                byte = int(piece[3:5], 16)
                self.byte_ids[byte] = i
                self.raw[i] = bytes([byte])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or " " in piece.lstrip(" ")):
                self.ids[piece] = i
                self.raw[i] = piece.encode()
        self.byte_score = -2 * math.log(n + 1)
        #: the pieces read from their ends: by character what goes on, id (-1: no piece) and score
        self.backward: dict = {}
        for piece, i in self.ids.items():
            level, steps = self.backward, piece[::-1]
            for k, character in enumerate(steps):
                further, known, gain = level.get(character, (None, -1, 0.0))
                if k + 1 < len(steps):
                    further = {} if further is None else further
                    level[character] = (further, known, gain)
                    level = further
                else:
                    level[character] = (further, i, self.score[i])

    def bytes_for(self, character: str) -> list[int]:
        return [self.byte_ids[b] for b in character.encode()]


class Viterbi:
    """Best paths of marked words; a sorted run of words shares the scores of common prefixes."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.memory: dict[str, bytes] = {}  # ids as 32-bit numbers
        self.kept = 0

    def _walk(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Words in order, each with its best ids.

        best[k], where[k]: score of the best path to place k, and the start and id (-1: bytes)
        of its last piece. Ties go to the longer last piece. The pieces that end at a place
        are found backwards from it, in a trie, as far as any piece goes on.
        """
        backward, byte_score = self.pieces.backward, self.pieces.byte_score
        best, where = [0.0], [(0, -1)]
        before = ""
        for word in words:
            n = len(word)
            shared = len(os.path.commonprefix([before, word]))
            del best[shared + 1 :], where[shared + 1 :]
            for end in range(shared + 1, n + 1):
                top, last = -math.inf, (end - 1, -1)
                level, start = backward, end
                while level is not None and start:
                    start -= 1
                    step = level.get(word[start])
                    if step is None:
                        break
                    level, piece, gain = step
                    if piece >= 0:
                        value = best[start] + gain
                        if value >= top:
                            top, last = value, (start, piece)
                spelled = best[end - 1] + len(word[end - 1].encode()) * byte_score
                if spelled > top:
                    top, last = spelled, (end - 1, -1)
                best.append(top)
                where.append(last)
            before = word
            ids: list[int] = []
            end = n
            while end:
                start, piece = where[end]
                if piece >= 0:
                    ids.append(piece)
                else:
                    ids.extend(reversed(self.pieces.bytes_for(word[start])))
                end = start
            yield word, ids[::-1]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; a null or empty text has none."""
        cut = [_WORD.findall(" " + text) if text else [] for text in texts]
        every = set().union(*cut)
        new = every - self.memory.keys()
        self.kept += sum(map(len, new))
        if self.kept > REMEMBERED:
            self.memory.clear()
            new = every
            self.kept = sum(map(len, new))
        for word, ids in self._walk(sorted(new)):
            self.memory[word] = array("i", ids).tobytes()
        return [np.frombuffer(b"".join([self.memory[w] for w in words]), np.int32) for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids."""
        raw = self.pieces.raw
        return b"".join([raw[i] for i in ids.tolist()]).decode()[1:]


def _chunks(texts: pa.Array, limit: int = 1 << 21) -> Iterator[list[str | None]]:
    """Texts in lists of about `limit` characters."""
    part, size = [], 0
    for at in range(0, len(texts), 100):
        for text in texts.slice(at, 100).to_pylist():
            part.append(text)
            size += len(text or "")
            if size >= limit:
                yield part
                part, size = [], 0
    if part:
        yield part


def _id_lists(coded: list[np.ndarray], texts: list[str | None]) -> pa.Array:
    """Lists of ids, null for a null text."""
    values = np.concatenate(coded) if coded else np.zeros(0, np.int32)
    ends = np.cumsum([0, *map(len, coded)])
    null = pa.array([t is None for t in texts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()), mask=null)


def encoder(path: str):
    """A column function: ids of each text (null for a null text)."""

    @F.arrow_udf(ArrayType(IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        viterbi = Viterbi(Pieces(path))
        for texts in released(batches):
            parts = [_id_lists(viterbi.encode(part), part) for part in _chunks(texts)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return encode


_CODED = StructType([StructField("tokens", ArrayType(IntegerType())), StructField("text", StringType())])


def coder(path: str):
    """A column function: ids of each text and the text they decode to, by one worker (null for null)."""

    @F.arrow_udf(_CODED)
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        viterbi = Viterbi(Pieces(path))
        for texts in released(batches):
            ids, back = [], []
            for part in _chunks(texts):
                coded = viterbi.encode(part)
                ids.append(_id_lists(coded, part))
                decoded = [None if t is None else viterbi.decode(c) for t, c in zip(part, coded, strict=True)]
                back.append(pa.array(decoded, pa.string()))
            yield pa.StructArray.from_arrays(
                [
                    pa.concat_arrays(ids) if ids else pa.array([], pa.list_(pa.int32())),
                    pa.concat_arrays(back) if back else pa.array([], pa.string()),
                ],
                names=["tokens", "text"],
            )

    return code


def decoder(path: str):
    """A column function: the text of each list of ids (null for null)."""

    @F.arrow_udf(StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        viterbi = Viterbi(Pieces(path))
        for lists in batches:
            yield pa.array(
                [None if ids is None else viterbi.decode(np.array(ids, np.int64)) for ids in lists.to_pylist()],
                pa.string(),
            )

    return decode


_DIGEST = StructType(
    [
        StructField("n_tokens", LongType()),
        StructField("n_byte_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("round_trip", BooleanType()),
    ]
)


def digester(path: str):
    """A column function: counts and hash of a text's ids, and whether they decode to the text."""

    @F.arrow_udf(_DIGEST)
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        viterbi = Viterbi(Pieces(path))
        is_byte = np.zeros(len(viterbi.pieces.raw), bool)
        is_byte[viterbi.pieces.byte_ids] = True
        for texts in released(batches):
            rows = []
            for part in _chunks(texts):
                for text, ids in zip(part, viterbi.encode(part), strict=True):
                    rows.append(
                        {
                            "n_tokens": len(ids),
                            "n_byte_tokens": int(is_byte[ids].sum()),
                            "ids_sha256": hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(),
                            "round_trip": viterbi.decode(ids) == (text or ""),
                        }
                    )
            yield pa.array(rows, pa.struct([(f.name, t) for f, t in zip(_DIGEST, _TYPES, strict=True)]))

    return digest


_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.bool_())


def encode_texts(docs: DataFrame, text: str = "text", into: str = "tokens", path: str | None = None) -> DataFrame:
    """`docs` with the ids of each text in `into`, each task on its own rows: no shuffle.

    A null text has null ids, an empty one none. Rows that repeat are encoded alike.
    """
    return docs.withColumn(into, encoder(path or model_path())(F.col(text)))


def code_texts(docs: DataFrame, text: str = "text", into: str = "tokens", path: str | None = None) -> DataFrame:
    """`docs` with the ids of each text in `into`, and the text that these decode to in place of it."""
    columns = [c for c in docs.columns if c != into]
    coded = docs.select(*columns, coder(path or model_path())(F.col(text)).alias(into))
    return coded.select(*[F.col(f"{into}.text").alias(c) if c == text else c for c in columns], f"{into}.tokens").withColumnRenamed(
        "tokens", into
    )


def decode_texts(docs: DataFrame, tokens: str = "tokens", into: str = "text", path: str | None = None) -> DataFrame:
    """`docs` with the text of each list of ids in `into`."""
    return docs.withColumn(into, decoder(path or model_path())(F.col(tokens)))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: counts and hash of its ids, and whether decoding them gives its text (null: empty)."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return docs.select("doc_id", digester(model_path())(F.col("text")).alias("d")).select("doc_id", "d.*")
