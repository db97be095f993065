"""Vocabularies of subword pieces, and the lattice of a word's segmentations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Where the public vocabularies lie by default; every operator takes the path as a parameter.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()


@dataclass(frozen=True)
class Vocabulary:
    """pieces[i] is what piece i spells; scores[i] its vocabulary score. byte_ids: single bytes."""

    pieces: list[bytes]
    scores: np.ndarray
    spells: np.ndarray
    byte_ids: np.ndarray
    end: int


def load_vocabulary(path: str = PIECE_MODEL) -> Vocabulary:
    """Read on the driver; tasks get the vocabulary by broadcast."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces, spells, byte_ids = [], np.zeros(n, bool), np.full(256, -1, np.int64)
    for i in range(n):
        if model.is_byte(i):
            value = int(model.id_to_piece(i)[3:-1], 16)
            byte_ids[value] = i
            pieces.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            pieces.append(b"")
        else:
            pieces.append(model.id_to_piece(i).encode())
            spells[i] = True
    scores = np.array([model.get_score(i) for i in range(n)])
    return Vocabulary(pieces, scores, spells, byte_ids, model.eos_id())


def zipf_log(vocabulary: Vocabulary) -> np.ndarray:
    """Natural log probabilities from scores that are negated merge ranks (Zipf's law).

    Single bytes and the end get the weight of the last rank.
    """
    rank = np.where(vocabulary.spells, -vocabulary.scores, -vocabulary.scores.min()) + 2.0
    usable = vocabulary.spells.copy()
    usable[vocabulary.byte_ids[vocabulary.byte_ids >= 0]] = True
    if vocabulary.end >= 0:
        usable[vocabulary.end] = True
    weight = np.where(usable, 1.0 / rank, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(weight / weight.sum())


class PieceTrie:
    """Pieces as a trie over bytes: `step[node, byte]` and the pieces that end at a node.

    A single byte is always an arc. Where a byte is a piece of its own as well, both
    spellings count: `ends` has the piece, `single` the byte's fallback.
    """

    def __init__(self, vocabulary: Vocabulary):
        rows, ends = [np.full(256, -1, np.int32)], [-1]
        for i, piece in enumerate(vocabulary.pieces):
            if not vocabulary.spells[i]:
                continue
            node = 0
            for byte in piece:
                child = rows[node][byte]
                if child < 0:
                    child = rows[node][byte] = len(rows)
                    rows.append(np.full(256, -1, np.int32))
                    ends.append(-1)
                node = child
            ends[node] = i
        self.step, self.ends = np.stack(rows), np.array(ends, np.int32)
        self.single = vocabulary.byte_ids


def word_blocks(words: list[bytes], cells: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words of similar length as byte matrices: their places, the bytes, the lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        # Words come shortest first, so the last one of a block sets its width.
        end = at + 1
        while end < len(order) and (end + 1 - at) * max(lengths[order[end]], 1) <= cells and (
            lengths[order[end]] <= 2 * lengths[order[at]] + 8
        ):
            end += 1
        places = order[at:end]
        width = max(int(lengths[places[-1]]), 1)
        raw = b"".join(words[i].ljust(width, b"\0") for i in places)
        yield places, np.frombuffer(raw, np.uint8).reshape(len(places), width), lengths[places]
        at = end


def _arcs(trie: PieceTrie, data: np.ndarray, lengths: np.ndarray, i: int):
    """Arcs that start at byte i: the rows they belong to, their width, their pieces."""
    rows = np.flatnonzero(lengths > i)
    if not len(rows):
        return
    single = trie.single[data[rows, i]]
    some = single >= 0
    yield rows[some], 1, single[some]
    node, width = np.zeros(len(rows), np.int32), 0
    while len(rows):
        node = trie.step[node, data[rows, i + width]]
        width += 1
        alive = node >= 0
        rows, node = rows[alive], node[alive]
        piece = trie.ends[node]
        found = piece >= 0
        if found.any():
            yield rows[found], width, piece[found]
        more = lengths[rows] > i + width
        rows, node = rows[more], node[more]


def forward(trie: PieceTrie, logp: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """alpha[r, j]: log of the summed probability of all spellings of the first j bytes."""
    alpha = np.full((len(data), data.shape[1] + 1), -np.inf)
    alpha[:, 0] = 0.0
    for i in range(data.shape[1]):
        for rows, width, piece in _arcs(trie, data, lengths, i):
            alpha[rows, i + width] = np.logaddexp(alpha[rows, i + width], alpha[rows, i] + logp[piece])
    return alpha


def marginals(trie: PieceTrie, logp: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Natural log of the summed probability of all segmentations, per word."""
    found = np.zeros(len(words))
    for places, data, lengths in word_blocks(words):
        alpha = forward(trie, logp, data, lengths)
        found[places] = alpha[np.arange(len(places)), lengths]
    return found


def expected_pieces(trie: PieceTrie, logp: np.ndarray, words: list[bytes], weights: np.ndarray) -> np.ndarray:
    """How often each piece is used, over all segmentations of the words by their share."""
    total = np.zeros(len(logp))
    for places, data, lengths in word_blocks(words):
        alpha = forward(trie, logp, data, lengths)
        beta = np.full_like(alpha, -np.inf)
        beta[np.arange(len(places)), lengths] = 0.0
        whole = alpha[np.arange(len(places)), lengths]
        weight = weights[places]
        for i in range(data.shape[1] - 1, -1, -1):
            for rows, width, piece in _arcs(trie, data, lengths, i):
                rest = logp[piece] + beta[rows, i + width]
                share = np.exp(alpha[rows, i] + rest - whole[rows])
                total += np.bincount(piece, np.nan_to_num(share) * weight[rows], len(total))
                beta[rows, i] = np.logaddexp(beta[rows, i], rest)
    return total
