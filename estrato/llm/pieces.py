"""SentencePiece encoding and decoding: one forward pass over the trie of distinct marked words.

A text is marked words: the space mark and what follows it. No piece continues past a mark, so words
are encoded once each. The distinct words of a slice are sorted, which is a depth-first walk over
their trie: the forward states of the prefix a word shares with the one before it are kept, and only
the rest is computed. Unigram models take the best sum of scores (Viterbi). For models of merges the
forward state of a prefix is the last piece of its encoding, which is the one piece ending there
that the encoding before it can be followed by; whether two pieces can stand next to each other is
settled by merging the two alone, once per pair. Both give exactly the library's ids.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.llm.common import sliced

MARK = "▁"
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
UNIGRAM, MERGES = 1, 2
UNKNOWN_PENALTY = 10.0
SHIFT = 22
LETTERS = 1 << 21
"""States from here on are single letters that are no piece; START stands before a word."""
START = LETTERS - 1
KEPT_WORDS = 200_000
"""Encoded words that a task keeps: when there are as many, those not used since the last turn go."""
KEPT_PAIRS = 300_000
JOINED = 64
"""Letters up to which a forward state holds its joined encoding; longer words are joined once, by their last pieces, and not kept."""
SLICE_BYTES = 1 << 20

_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Pieces:
    """A model's pieces and the forward pass over words."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as schema

        proto = schema.ModelProto()
        proto.ParseFromString(model)
        self.kind = proto.trainer_spec.model_type
        rules = proto.normalizer_spec
        if self.kind not in (UNIGRAM, MERGES) or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only unigram and merge models that keep the text as it is are supported")
        self.prefix = rules.add_dummy_prefix
        self.text = [p.piece for p in proto.pieces]
        self.score = [p.score for p in proto.pieces]
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        if len(proto.pieces) >= START or any(p.type == USER for p in proto.pieces) or any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("pieces set by users or pieces with a mark inside are not supported")
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.lengths: dict[str, list[int]] = {}
        for piece in self.id:
            if len(piece) > 2:
                own = self.lengths.setdefault(piece[-3:], [])  # by the last three letters
                if len(piece) not in own:
                    own.append(len(piece))
        for own in self.lengths.values():
            own.sort(reverse=True)  # of equal sums the library takes the longer last piece
        self.by_lines = self.prefix and not any("\n" in p for p in self.id)
        self.floor = min((self.score[i] for i in self.id.values()), default=0.0) - UNKNOWN_PENALTY
        self.raw = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else p.piece.replace(MARK, " ").encode() if p.type == NORMAL else b" \xe2\x81\x87 " if p.type == UNKNOWN else b"" for p in proto.pieces]
        self.codes = [np.int32(i).tobytes() for i in range(len(proto.pieces))]
        self.pairs: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces by merging: always the pair with the best score, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.id.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.score[piece] > best):
                    best, at = self.score[piece], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def state(self, letter: str) -> int:
        """Id of a single letter; letters that are no piece have numbers past all ids."""
        return self.id.get(letter, LETTERS + ord(letter))

    def shown(self, state: int) -> str:
        return "" if state == START else chr(state - LETTERS) if state >= LETTERS else self.text[state]

    def joins(self, left: int, right: int) -> bool:
        """Whether merging leaves both pieces as they are; `left` is START at the start of a word."""
        a, b = self.shown(left), self.shown(right)
        known = self.merged(a + b) == ([a, b] if a else [b])
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        self.pairs[left << SHIFT | right] = known
        return known

    def code(self, letter: int) -> bytes:
        """Ids, as int32 bytes, of a letter that is no piece."""
        if not self.bytes:
            return self.codes[self.unknown]
        return b"".join(self.codes[self.bytes[b]] for b in chr(letter - LETTERS).encode())

    def encode_sorted(self, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """(word, ids as int32 bytes) for words in ascending order; forward states are shared along common prefixes."""
        last: list[int] = [START]  # last[i]: last piece of the encoding of the first i letters
        done: list[bytes] = [b""]  # done[i]: that encoding, for the first JOINED letters
        score: list[float] = [0.0]
        before = ""
        ids, lengths, pairs, scores, codes, merges = self.id, self.lengths, self.pairs, self.score, self.codes, self.kind == MERGES
        for word in words:
            shared = min(len(before), len(word))
            if shared > JOINED:
                shared = bisect_left(range(shared), True, key=lambda n: not word.startswith(before[: n + 1]))
            while not word.startswith(before[:shared]):
                shared -= 1
            del last[shared + 1 :], done[shared + 1 :], score[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                best, size = None, 1
                if merges:  # exactly one piece fits; if no longer one does, it is the letter
                    for n in lengths.get(word[end - 3 : end], ()) if end > 2 else ():
                        if n <= end and (piece := ids.get(word[end - n : end])) is not None:
                            fits = pairs.get(last[end - n] << SHIFT | piece)
                            if fits or fits is None and self.joins(last[end - n], piece):
                                best, size = piece, n
                                break
                    else:
                        if end > 1 and (piece := ids.get(word[end - 2 : end])) is not None:
                            fits = pairs.get(last[end - 2] << SHIFT | piece)
                            if fits or fits is None and self.joins(last[end - 2], piece):
                                best, size = piece, 2
                    if best is None:
                        best = self.state(word[end - 1])
                else:
                    total = None
                    for n in (*lengths.get(word[end - 3 : end], ()), 2) if end > 2 else (2,):
                        if n <= end and (piece := ids.get(word[end - n : end])) is not None and (total is None or score[end - n] + scores[piece] > total):
                            total, best, size = score[end - n] + scores[piece], piece, n
                    letter = self.state(word[end - 1])
                    alone = score[end - 1] + (self.floor if letter >= LETTERS else scores[letter])
                    if total is None or alone > total:
                        total, best, size = alone, letter, 1
                    score.append(total)
                last.append(best)
                if end <= JOINED:
                    done.append(done[end - size] + (codes[best] if best < LETTERS else self.code(best)))
            before = word
            yield word, done[-1] if len(word) <= JOINED else self.joined(last, done)

    def joined(self, last: list[int], done: list[bytes]) -> bytes:
        """The encoding of a word of more than JOINED letters: a state's piece tells where the one before it ends."""
        parts, end = [], len(last) - 1
        while end > JOINED:
            piece = last[end]
            parts.append(self.codes[piece] if piece < LETTERS else self.code(piece))
            end -= len(self.shown(piece))
        return b"".join([done[end], *reversed(parts)])

    def keys(self, text: str) -> list[str]:
        """Keys of a text's words: the word without its mark, or with its line end, or as `marked` has it."""
        if not text:
            return []
        if self.by_lines and MARK not in text:
            apart = text.replace("\n", " \n")  # no piece has a line end, so words end there too
            if "  " not in apart and not apart.endswith(" ") and text[0] != " ":
                return apart.split(" ")
        return _WORDS.findall((MARK if self.prefix else "") + text.replace(" ", MARK))

    def marked(self, key: str) -> str:
        return key if not self.by_lines or key.startswith((MARK, "\n")) else MARK + key

    def decode(self, ids: Iterable[int]) -> str:
        out = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return out[1:] if self.prefix and out.startswith(" ") else out


@functools.lru_cache(maxsize=1)
def loaded(model: bytes) -> Pieces:
    """A worker keeps the last model, and what it knows of its pairs, from task to task."""
    return Pieces(model)


def encoder(pieces: Pieces):
    """A function from texts to (ids, number of words) per text, with words kept from call to call."""

    known: dict[str, bytes] = {}
    older: dict[str, bytes] = {}

    def encode(texts: list[str]) -> list[tuple[np.ndarray, int]]:
        nonlocal known, older
        split = [pieces.keys(x) for x in texts]
        missing: dict[str, list[str]] = {}
        for key in set(chain.from_iterable(split)) - known.keys():
            ids = older.get(key)
            if ids is None:
                missing.setdefault(pieces.marked(key), []).append(key)
            else:
                known[key] = ids
        long: list[str] = []
        for word, ids in pieces.encode_sorted(sorted(missing)):
            for key in missing[word]:
                known[key] = ids
            if len(word) > JOINED:
                long += missing[word]
        out = [(np.frombuffer(b"".join(map(known.__getitem__, w)), np.int32), len(w)) for w in split]
        for key in long:  # KEPT_WORDS counts words, not letters
            del known[key]
        if len(known) > KEPT_WORDS:  # words not used since the last turn are forgotten with the next
            known, older = {}, known
        return out

    return encode


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """The model file, by Spark's reader; a vocabulary of bounded size."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").head()[0])


def encoded_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """`docs` (any columns, text among them) with piece_ids array<int>, n_pieces, n_words and decoded string.

    piece_ids are the library's ids of the whole text without start and end marks. decoded is the text
    read back from the ids. NULL gives NULL in all four; the empty text has no pieces. The added columns
    replace columns of the same names. An empty table gives an empty result.
    """
    added = {"piece_ids": "array<int>", "n_pieces": "long", "n_words": "long", "decoded": "string"}
    docs = docs.drop(*added)
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(docs.sparkSession, model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model.value)
        encode = encoder(pieces)
        for batch in batches:
            column = batch.column("text").cast(pa.string())
            for lo, hi, texts in sliced(column, SLICE_BYTES):
                own = [x.decode() for x in texts]
                found = encode(own)
                sizes = np.array([len(ids) for ids, _ in found], np.int64)
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                empty = column.slice(lo, hi - lo).is_null().to_numpy(zero_copy_only=False)
                ids = pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(empty, False)), pa.array(np.concatenate([ids for ids, _ in found]), pa.int32()))
                part = batch.slice(lo, hi - lo)
                more = [ids, pa.array(sizes, mask=empty), pa.array(np.array([n for _, n in found], np.int64), mask=empty),
                        pa.array([None if none else pieces.decode(ids.tolist()) for none, (ids, _) in zip(empty, found)], pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, *added])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{n} {t}" for n, t in added.items()]
    return docs.mapInArrow(run, ", ".join(fields))
