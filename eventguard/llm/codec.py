"""SentencePiece encoding by Viterbi over a trie of words, and decoding.

A text gets one blank in front, blanks become the mark of the vocabulary, and the text is
cut where a piece can not reach across: before a run of marks and around line feeds. The
different words of a block of texts are sorted, which lays them out as a trie in depth-first
order: a word shares the forward scores of the characters it has in common with the word
before, and only the rest is searched. Texts are then put together from their words.

Characters outside the vocabulary, and marks that a text itself contains, are spelled with
the vocabulary's byte pieces, so decoding gives back every text exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventguard.llm.common import beside, fresh, in_chunks, utf8
from eventguard.llm.pieces import PIECE_MODEL, Vocabulary, load_vocabulary, zipf_log

_MARK = "▁"
# Words with their blanks in front; a line feed stands alone, as no piece holds one.
_WORDS = re.compile(r" +[^ \n▁]*|[^ \n▁]+|\n|▁")


@dataclass(frozen=True)
class CodecConfig:
    model: str = PIECE_MODEL
    # Different words a task remembers; beyond that it starts anew.
    words_held: int = 400_000


class Encoder:
    """Best segmentations by the sum of log probabilities; the longest last piece wins a tie."""

    def __init__(self, vocabulary: Vocabulary):
        logp = zipf_log(vocabulary)
        self.pieces = {
            piece.decode(): (float(logp[i]), i)
            for i, piece in enumerate(vocabulary.pieces) if vocabulary.spells[i]
        }
        if any(_MARK in p.lstrip(_MARK) or "\n" in p for p in self.pieces):
            raise ValueError("a piece of this vocabulary reaches across words")
        # Every ending of a piece: its score and id if it is one itself, else None. Looking back
        # from a place stops at the first string that ends no piece.
        self.endings: dict[str, tuple[float, int] | None] = {}
        for piece in self.pieces:
            for i in range(len(piece)):
                self.endings[piece[i:]] = self.pieces.get(piece[i:])
        self.byte_ids = vocabulary.byte_ids.tolist()
        floor = min(score for score, _ in self.pieces.values()) - 5.0
        self.byte_score = floor

    def _spelled(self, char: str) -> tuple[float, tuple[int, ...]]:
        ids = tuple(self.byte_ids[b] for b in char.encode())
        if min(ids) < 0:
            raise ValueError("the vocabulary has no piece for a byte")
        return self.byte_score * len(ids), ids

    def encode_words(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Piece ids of each word; the words must be sorted and differ."""
        pieces, endings = self.pieces, self.endings
        # Forward scores along the path of the trie; where each best last piece starts, its ids.
        scores, starts, lasts = [0.0], [0], [()]
        before = ""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            text = _MARK * (len(word) - len(word.lstrip(" "))) + word.lstrip(" ")
            del scores[shared + 1:], starts[shared + 1:], lasts[shared + 1:]
            for end in range(shared + 1, len(text) + 1):
                best, start, last = None, 0, ()
                for i in range(end - 1, -1, -1):
                    found = endings.get(text[i:end], 0)
                    if found:
                        score = scores[i] + found[0]
                        if best is None or score >= best:
                            best, start, last = score, i, (found[1],)
                    elif found == 0:
                        break
                if best is None or text[end - 1] not in pieces:
                    score, ids = self._spelled(text[end - 1] if word[end - 1] != " " else " ")
                    if best is None or scores[end - 1] + score > best:
                        best, start, last = scores[end - 1] + score, end - 1, ids
                scores.append(best)
                starts.append(start)
                lasts.append(last)
            way: list[tuple[int, ...]] = []
            end = len(text)
            while end > 0:
                way.append(lasts[end])
                end = starts[end]
            before = word
            yield word, [i for ids in reversed(way) for i in ids]


class BlockEncoder:
    """Encodes blocks of texts, remembering words."""

    def __init__(self, encoder: Encoder, held: int):
        self.encoder, self.held = encoder, held
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat: list[np.ndarray] = []
        self.sizes: list[int] = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All piece ids behind each other, and the number of ids of each text."""
        split = [_WORDS.findall(f" {text}") if text else [] for text in texts]
        if len(self.place) > self.held:
            self._forget()
        new = {w for words in split for w in words}.difference(self.place)
        # A mark of the text's own is spelled by its bytes.
        own = _MARK in new
        new.discard(_MARK)
        ids: list[int] = []
        for word, found in self.encoder.encode_words(sorted(new)):
            self.place[word] = len(self.sizes)
            self.sizes.append(len(found))
            ids += found
        if own:
            self.place[_MARK] = len(self.sizes)
            found = self.encoder._spelled(_MARK)[1]
            self.sizes.append(len(found))
            ids += found
        self.flat.append(np.array(ids, np.int32))
        flat = np.concatenate(self.flat)
        self.flat = [flat]
        sizes = np.array(self.sizes, np.int64)
        ends = np.cumsum(sizes)
        places = np.fromiter(
            (self.place[w] for words in split for w in words), np.int64, sum(map(len, split))
        )
        n = sizes[places]
        total = int(n.sum())
        # Where each word's ids start in `flat`, less where they start in the result.
        shift = (ends[places] - n) - (np.cumsum(n) - n)
        out = flat[np.repeat(shift, n) + np.arange(total)]
        per_text = np.add.reduceat(
            np.append(n, 0), np.minimum(np.cumsum([0, *map(len, split[:-1])]), len(n))
        ) if split else np.zeros(0, np.int64)
        per_text[[not words for words in split]] = 0
        return out, per_text


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.spelled = [
            piece.replace(_MARK.encode(), b" ") if vocabulary.spells[i] else piece
            for i, piece in enumerate(vocabulary.pieces)
        ]

    def decode(self, ids: list[int]) -> bytes:
        """The text's bytes without the blank put in front."""
        return b"".join(map(self.spelled.__getitem__, ids))[1:]


def encode_texts(
    df: DataFrame, keep: list[str], text: str = "text", names: tuple[str, str] = ("ids", "n_pieces"),
    cfg: CodecConfig = CodecConfig(),
) -> DataFrame:
    """The `keep` columns of each row with the piece ids of its text and their number.

    An empty text has no pieces. A null text has null ids and 0 pieces. A kept column that is
    called like a result gives way to it.
    """
    keep = beside(keep, *names)
    vocabulary = load_vocabulary(cfg.model)
    sent = df.sparkSession.sparkContext.broadcast(Encoder(vocabulary))
    raw, null = fresh(df.select(*keep), "raw", "no_text")
    rows = df.select(*keep, utf8(F.col(text)).alias(raw), F.col(text).isNull().alias(null))

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = BlockEncoder(sent.value, cfg.words_held)
        for part in parts:
            for chunk, texts in in_chunks(part, raw):
                ids, sizes = block.encode([t.decode() for t in texts])
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()), mask=chunk.column(null))
                yield pa.RecordBatch.from_arrays(
                    [*[chunk.column(n) for n in keep], lists, pa.array(sizes, pa.int64())],
                    names=[*keep, *names],
                )

    fields = [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in keep]
    schema = ", ".join([*fields, f"`{names[0]}` array<int>", f"`{names[1]}` long"])
    return rows.mapInArrow(encode, schema)


def decode_ids(
    df: DataFrame, keep: list[str], ids: str = "ids", name: str = "text", cfg: CodecConfig = CodecConfig()
) -> DataFrame:
    """The `keep` columns of each row with the text that its piece ids spell; null for null.

    Bytes that are no UTF-8, which ids of other origin may spell, become replacement characters.
    A kept column that is called like the result gives way to it.
    """
    keep = beside(keep, name)
    sent = df.sparkSession.sparkContext.broadcast(Decoder(load_vocabulary(cfg.model)))
    (pieces,) = fresh(df.select(*keep), "pieces")
    rows = df.select(*keep, F.col(ids).cast("array<int>").alias(pieces))

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [
                sent.value.decode(found.as_py()).decode(errors="replace")
                if found.is_valid else None
                for found in part.column(pieces)
            ]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(n) for n in keep], pa.array(texts, pa.string())], names=[*keep, name]
            )

    fields = [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in keep]
    return rows.mapInArrow(decode, ", ".join([*fields, f"`{name}` string"]))
