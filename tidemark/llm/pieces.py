"""SentencePiece encoding and decoding of BPE models by a streaming Viterbi search.

The lattice of a text has an edge for every piece that fits at a place.  A BPE encoding is
the one path in which every two neighbours stay apart when they are encoded together, so a
place has one surviving edge: the piece whose predecessor's survivor admits it.  (The best
sum of scores, which Viterbi seeks in unigram models, is not what a BPE model encodes to.)
Only places within the longest piece can still be continued; where the paths back from all
of them meet, everything before is final and committed, so a text without any break needs
a window of bounded size.  No piece reaches from other characters into a following space,
none holds a line feed or tab, and most marks follow a letter in no piece: all paths meet
there, and the stretches between are looked up in a bounded memory of those met before.  An
automaton finds the edges.

Defined cases: null and empty texts give no ids and decode to the empty text.  Characters
without a piece become their UTF-8 bytes.  The space mark U+2581 itself counts as a space,
as it does for the model; such a text is not ``lossless``.  Every row is encoded by itself:
repeated rows and missing ids make no difference, and extra columns are not read.  A model
that normalises texts, or that is not BPE with byte pieces, is refused.
"""

from __future__ import annotations

import hashlib
import os
import re
import string
from array import array
from collections.abc import Iterable
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, query, read

MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
SPACE = "▁"
LETTER = r"[^\W\d_]"
CHECK_EVERY = 256
MEMORY, PAIRS = 200_000, 300_000  # stretches and pairs of pieces a worker remembers


@dataclass
class Vocabulary:
    """What a model file says, of fixed size: it is sent to the tasks."""

    pieces: list[str]  # all, by id, with spaces in the place of the mark
    mergeable: dict[str, int]
    scores: list[float]
    byte_ids: list[int]


def vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a model file, on the driver."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i).replace(SPACE, " ") for i in ids]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    probe = " ﬁ ①  Å\t\n "
    if model.normalize(probe) != (SPACE + probe.replace(" ", SPACE)):
        raise ValueError("the model normalises texts")
    if not all(model.is_byte(i) for i in byte_ids) or any(model.is_unused(i) for i in ids):
        raise ValueError("the model has no byte pieces, or unused ones")
    mergeable = {pieces[i]: i for i in plain}
    if any(" " in p.lstrip(" ") or (len(p) > 1 and re.search(r"[\n\t]", p)) for p in mergeable):
        raise ValueError("pieces span spaces or line ends")
    return Vocabulary(pieces, mergeable, [model.get_score(i) for i in ids], byte_ids)


def closing_marks(pieces: Iterable[str]) -> str:
    """Punctuation that follows a letter in no piece: all paths of a text meet between the two."""
    inside = {b for piece in pieces for a, b in zip(piece, piece[1:]) if re.match(LETTER, a)}
    return "".join(mark for mark in string.punctuation if mark not in inside)


class Encoder:
    """Ids of texts, as packed 32-bit numbers."""

    def __init__(self, words: Vocabulary):
        self.ids, self.scores, self.byte_ids = words.mergeable, words.scores, words.byte_ids
        self.unknown = len(words.pieces)  # plus the character: a token without a piece
        self.text = dict(enumerate(words.pieces))
        self.widths = [len(piece) for piece in words.pieces]
        self.longest = max(map(len, self.ids))
        self.apart: dict[int, bool] = {}
        self.memory = Memory(self.stretch)
        self.automaton = ahocorasick.Automaton()
        for piece, token in self.ids.items():
            self.automaton.add_word(piece, (token, len(piece)))
        self.automaton.make_automaton()
        marks = re.escape(closing_marks(self.ids)) or "\n"
        inside = rf"(?:[^ \n\t{marks}]+|(?<!{LETTER})[{marks}]+)"
        self.stretches = re.compile(rf"(?: +|[{marks}])?{inside}+|[{marks}]| +|[\n\t]").findall

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if len(self.memory) > MEMORY:
            self.memory.clear()
        return b"".join(map(self.memory.__getitem__, self.stretches(" " + text.replace(SPACE, " "))))

    def piece(self, token: int) -> str:
        return chr(token - self.unknown) if token >= self.unknown else self.text[token]

    def merge(self, text: str) -> list[str]:
        """The encoding of a short text by its definition: join the neighbours whose join has
        the best score, the first of equals, as long as there are any."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best[0]):
                    best = (self.scores[found], i)
            if best is None:
                return parts
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    def admits(self, before: int, token: int) -> bool:
        """Whether two tokens stay apart; before -1, whether the token stays whole."""
        key = (before + 1) << 21 | token
        if (known := self.apart.get(key)) is None:
            if len(self.apart) > PAIRS:
                self.apart.clear()
            parts = [self.piece(t) for t in (before, token) if t >= 0]
            known = self.apart[key] = self.merge("".join(parts)) == parts
        return known

    def stretch(self, text: str) -> bytes:
        apart = self.apart.get
        unknown, out = self.unknown, array("i")
        # survivors: the token that ends at base, base + 1, ... on the path to there.
        base, survivors, check = 0, [-1], CHECK_EVERY
        # Pieces come by their end, and of those with one end the longest first.
        for end, (token, width) in self.automaton.iter(text):
            place = end + 1 - base
            if place < len(survivors) or width > place:
                continue
            while len(survivors) < place:
                survivors.append(unknown + ord(text[base + len(survivors) - 1]))
            before = survivors[place - width]
            known = apart((before + 1) << 21 | token)
            if known is None:
                known = self.admits(before, token)
            if known:
                survivors.append(token)
                if len(survivors) > check:
                    meet = self.meeting(survivors)
                    self.commit(survivors, meet, out)
                    base, survivors = base + meet, survivors[meet:]
                    check = len(survivors) + CHECK_EVERY
        while base + len(survivors) <= len(text):
            survivors.append(unknown + ord(text[base + len(survivors) - 1]))
        self.commit(survivors, len(survivors) - 1, out)
        return out.tobytes()

    def meeting(self, survivors: list[int]) -> int:
        """The last place that the paths back from all places that can be continued share."""
        places = set(range(max(0, len(survivors) - self.longest), len(survivors)))
        while len(places) > 1:
            last = max(places)
            places.remove(last)
            token = survivors[last]
            places.add(last - (1 if token >= self.unknown else self.widths[token]))
        return places.pop()

    def commit(self, survivors: list[int], end: int, out: array) -> None:
        """Add the ids of the path to ``end``."""
        unknown, widths, path = self.unknown, self.widths, []
        while end > 0:
            token = survivors[end]
            if token < unknown:
                path.append(token)
                end -= widths[token]
            else:
                path.extend(self.byte_ids[b] for b in reversed(chr(token - unknown).encode()))
                end -= 1
        path.reverse()
        out.extend(path)


class Memory(dict):
    def __init__(self, compute):
        self.compute = compute

    def __missing__(self, key: str) -> bytes:
        value = self[key] = self.compute(key)
        return value


class Decoder:
    def __init__(self, words: Vocabulary):
        self.bytes = [b""] * len(words.pieces)
        for piece, i in words.mergeable.items():
            self.bytes[i] = piece.encode()
        for value, i in enumerate(words.byte_ids):
            self.bytes[i] = bytes([value])

    def __call__(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text, without the space that the model puts first."""
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).removeprefix(b" ")


_TOOLS: dict[str, tuple[Encoder, Decoder]] = {}


def tools(words: Vocabulary) -> tuple[Encoder, Decoder]:
    """An encoder and a decoder that the tasks of a worker process share."""
    name = hashlib.sha256("\n".join(words.pieces).encode()).hexdigest()
    if name not in _TOOLS:
        _TOOLS.clear()
        _TOOLS[name] = Encoder(words), Decoder(words)
    return _TOOLS[name]


def lists(packed: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32)))


def encode(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), model: str = MODEL) -> DataFrame:
    """The columns ``keep`` and, of each text, ``ids``, their number, and the check of the way
    back: the SHA-256 of the decoded text and whether it is the text again."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(model))

    def run(*columns):
        encoder, decoder = tools(shared.value)
        for start in range(0, len(columns[-1]), 1024):
            part = [c.slice(start, 1024) for c in columns]
            texts = [text or "" for text in part[-1].to_pylist()]
            packed = [encoder(text) for text in texts]
            back = [decoder(np.frombuffer(p, dtype=np.int32)) for p in packed]
            yield [
                *part[:-1], lists(packed), pa.array([len(p) // 4 for p in packed], type=pa.int64()),
                [hashlib.sha256(b).hexdigest() for b in back],
                [b == text.encode() for b, text in zip(back, texts)],
            ]

    kinds = [docs.schema[name].dataType.simpleString().replace("bigint", "long") for name in keep]
    kept = ", ".join(f"k{i} {kind}" for i, kind in enumerate(kinds))
    found = map_columns(
        docs, run, f"{kept}, ids array<int>, n_ids long, decoded_sha256 string, lossless boolean",
        *(F.col(name) for name in keep), F.col("text"),
    )
    return found.withColumnsRenamed({f"k{i}": name for i, name in enumerate(keep)})


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and the text of its ``ids``; bytes that are no UTF-8 become U+FFFD."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary(model))

    def run(ids, rows):
        decoder = tools(shared.value)[1]
        texts = [decoder(np.array(row or [], dtype=np.int32)) for row in rows.to_pylist()]
        yield [ids, [text.decode("utf-8", "replace") for text in texts]]

    return map_columns(encoded, run, "doc_id long, text string", F.col("doc_id").cast("long"), F.col("ids"))


@query("op3_sentencepiece")
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents"))
