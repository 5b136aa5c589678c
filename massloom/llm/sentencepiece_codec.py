"""SentencePiece encoding and decoding for merge-type vocabularies.

A text becomes symbols, one per character, with a leading word mark and word
marks for blanks. An agenda holds every pair of neighbouring symbols that forms
a piece, ordered by score and then by place; the best pair is merged, its new
neighbours join the agenda, until none is left. Symbols without a piece fall
back to bytes.

No piece mixes letters, digits and other characters, or has a word mark behind
another character (a vocabulary is refused otherwise), so no merge crosses such
a border: each run between two borders is a word, is encoded by itself, and
short ones are remembered. Every word encoded anew is decoded from its ids and,
in one call per Arrow batch, checked against the sentencepiece library.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm.shared import map_batches, whole_text

MARK = "▁"
#: Words up to this many characters are remembered, up to this many of them in a worker.
WORD_CHARS, WORDS = 64, 300_000


class Codec(dict):
    """Ids (little-endian bytes) of each word; made when first asked for."""

    def __init__(self, model: bytes) -> None:
        super().__init__()
        self.library = library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
        self.bytes = {int(n[3:5], 16): i for i, n in enumerate(self.names) if library.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        usable = [
            i
            for i in range(len(self.names))
            if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))
        ]
        self.ids = {self.names[i]: i for i in usable}
        # Places in the order of scores; the agenda holds them with the place in the word in one number.
        scores = sorted({-library.get_score(i) for i in usable})
        place = {score: at for at, score in enumerate(scores)}
        self.order = {self.names[i]: place[-library.get_score(i)] << 32 for i in usable}
        self.word = word_pattern(self.ids)
        if any(self.word.findall(n) != [n] or ("\n" in n and n != "\n") for n in self.ids):
            raise ValueError("this vocabulary has pieces that cross words")
        if len(self.bytes) != 256:
            raise ValueError("this vocabulary has no byte fallback")
        self.ends = array("I", [library.bos_id()]), array("I", [library.eos_id()])
        self.line = len(library.encode("\n"))
        self.unchecked: list[tuple[str, array]] = []

    def merge(self, word: str) -> array:
        """Ids of one word by the agenda."""
        order = self.order
        symbols: list[str] = list(word)
        size = len(symbols)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        agenda = [
            order[pair] | at for at, pair in enumerate(map(str.__add__, symbols, symbols[1:])) if pair in order
        ]
        heapq.heapify(agenda)
        while agenda:
            entry = heapq.heappop(agenda)
            left = entry & 0xFFFFFFFF
            right = after[left]
            # A symbol merged since then is empty or longer, so that its pair no longer stands.
            if right >= size or not symbols[left]:
                continue
            pair = symbols[left] + symbols[right]
            if order.get(pair, -1) | left != entry:
                continue
            symbols[left], symbols[right] = pair, ""
            right = after[left] = after[right]
            if right < size:
                before[right] = left
                if (new := pair + symbols[right]) in order:
                    heapq.heappush(agenda, order[new] | left)
            earlier = before[left]
            if earlier >= 0 and (new := symbols[earlier] + pair) in order:
                heapq.heappush(agenda, order[new] | earlier)
        ids = array("I")
        for symbol in symbols:
            if symbol in self.ids:
                ids.append(self.ids[symbol])
            elif symbol:
                ids.extend([self.bytes[b] for b in symbol.encode()])
        return ids

    def join(self, ids: Iterable[int]) -> str:
        """Text of ids, without begin and end, with blanks for word marks; the first one stays."""
        out: list[str] = []
        pending = bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            out.append(self.names[i].replace(MARK, " "))
        out.append(pending.decode("utf-8", "replace"))
        return "".join(out)

    def __missing__(self, word: str) -> bytes:
        ids = self.merge(word)
        self.unchecked.append((word, ids))
        made = ids.tobytes()
        if len(word) <= WORD_CHARS and len(self) < WORDS:
            self[word] = made
        return made

    def check(self) -> None:
        """Compares all that was encoded since the last call with the library, and its text with the decoded ids.

        A line break in front keeps the library's own word mark apart.
        """
        theirs = self.library.encode(["\n" + w.replace(MARK, " ") for w, _ in self.unchecked], num_threads=1)
        for (word, ids), their in zip(self.unchecked, theirs, strict=True):
            if their[self.line :] != ids.tolist() or self.join(ids) != word.replace(MARK, " "):
                raise ValueError(f"{word[:80]!r}: the library encodes {their[self.line:][:20]}, the agenda {ids.tolist()[:20]}")
        self.unchecked.clear()

    def words(self, text: str) -> list[str]:
        return self.word.findall(MARK + text.replace(" ", MARK)) if text else []

    def text_of(self, words: list[str]) -> str:
        """The decoded text of encoded words, each of which ``check`` compares with its decoded ids."""
        return "".join(words).replace(MARK, " ").removeprefix(" ")

    def encode(self, text: str) -> array:
        ids = array("I", b"".join(map(self.__getitem__, self.words(text))))
        return self.ends[0] + ids + self.ends[1]

    def decode(self, ids: Iterable[int]) -> str:
        text = self.join(i for i in ids if i not in (self.ends[0][0], self.ends[1][0]))
        return text.removeprefix(" ")



def word_pattern(pieces: Iterable[str]) -> re.Pattern[str]:
    """Marks with the letters, digits or other characters behind them; or marks alone.

    Numerals that are no decimal digits, such as a raised two, are letters to
    an expression; those in longer pieces are named as other characters here.
    """
    numerals = {c for p in pieces if len(p) > 1 for c in p if c.isalnum() and not (c.isalpha() or c.isdecimal())}
    odd = "".join(sorted(numerals))
    return re.compile(rf"{MARK}*(?:[^\W\d_{odd}]+|(?:[^{MARK}\w]|[_{odd}])+|\d+)|{MARK}+")


_codecs: dict[bytes, Codec] = {}


def codec_of(model: bytes) -> Codec:
    """One codec per worker and model; its words outlive a task."""
    key = hashlib.sha256(model).digest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(model)
    return _codecs[key]


def read_model(path: str) -> bytes:
    """The model's bytes, which travel with the tasks (a few hundred kB)."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """``docs`` with token_ids (array<int>, with begin and end) and decoded_text, as in ``digests``.

    A null or empty text gives begin and end alone and decodes to nothing.
    Repeated rows give repeated rows. A
    column of ``docs`` that has one of the two names is replaced.
    """
    names = [c for c in docs.columns if c not in ("token_ids", "decoded_text")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = codec_of(model)
        begin, end = (e.tobytes() for e in codec.ends)
        ids, decoded = [], []
        for text in batch.column("text").to_pylist():
            words = codec.words(text or "")
            ids.append(b"".join([begin, *map(codec.__getitem__, words), end]))
            decoded.append(codec.text_of(words))
        codec.check()
        edges = np.cumsum([0, *[len(i) // 4 for i in ids]], dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.frombuffer(b"".join(ids), np.int32)))
        return pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], lists, pa.array(decoded, pa.string())],
            names=[*names, "token_ids", "decoded_text"],
        )

    frame = docs.select(*[F.col(f"`{n}`") for n in names])
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in frame.schema)
    return map_batches(frame, run, f"{fields}, token_ids array<int>, decoded_text string")


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text; ids and texts stay in the task.

    The same words as in ``encode``. The check of a batch has found each word's
    decoded ids to be its text, so the decoded text is that of the words. Null
    counts as empty; repeated rows give repeated rows.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = codec_of(model)
        begin, end = (e.tobytes() for e in codec.ends)
        counts, ids_hex, text_hex = [], [], []
        for text in batch.column("text").to_pylist():
            words = codec.words(text)
            ids = b"".join([begin, *map(codec.__getitem__, words), end])
            decoded = codec.text_of(words)
            counts.append(len(ids) // 4)
            ids_hex.append(hashlib.sha256(ids).hexdigest())
            text_hex.append(hashlib.sha256(decoded.encode()).hexdigest())
        codec.check()
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hex), pa.array(text_hex)],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return map_batches(rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
