"""An existing subword vocabulary with scores, and lattices over it."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

MARK = "▁"


@dataclass
class Pieces:
    """Ordinary pieces and byte pieces of a sentencepiece model, with their scores."""

    ids: dict[str, int]
    scores: list[float]
    byte_ids: list[int]
    _automaton: object = field(default=None, repr=False)

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            found = ahocorasick.Automaton()
            for piece, i in self.ids.items():
                found.add_word(piece, (len(piece), i))
            found.make_automaton()
            self._automaton = found
        return self._automaton

    def arcs(self, text: str) -> list[list[tuple[int, int]]]:
        """By end, the (length, id) of the pieces that end there, as Aho-Corasick finds them."""
        out: list[list[tuple[int, int]]] = [[] for _ in range(len(text))]
        for end, match in self.automaton().iter(text):
            out[end].append(match)
        return out


_kept: dict[str, Pieces] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load(path: str) -> Pieces:
    """Read the model file once in each process."""
    if path not in _kept:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids, byte_ids = {}, {}
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                ids[model.id_to_piece(i)] = i
        if len(byte_ids) != 256:
            raise ValueError("the vocabulary needs all 256 byte pieces")
        _kept[path] = Pieces(ids, [model.get_score(i) for i in range(model.get_piece_size())], [byte_ids[b] for b in range(256)])
    return _kept[path]


def prior(pieces: Pieces) -> np.ndarray:
    """Probabilities from the scores: a score that is minus the rank gives Zipf's law."""
    out = np.zeros(len(pieces.scores))
    for i in pieces.ids.values():
        out[i] = 1.0 / (10.0 - pieces.scores[i])
    out[pieces.byte_ids] = 1.0 / (10.0 - min(pieces.scores))
    return out / out.sum()


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def forward(pieces: Pieces, log_p: list[float], text: str) -> tuple[list[float], list[list[tuple[int, int]]], list[float | None]]:
    """Log-space forward recursion: alphas, arcs and, where no piece is the character, its byte fallback."""
    arcs = pieces.arcs(text)
    alpha = [-math.inf] * (len(text) + 1)
    alpha[0] = 0.0
    fallback: list[float | None] = [None] * len(text)
    for end, matches in enumerate(arcs):
        total, single = -math.inf, False
        for length, i in matches:
            single |= length == 1
            x = alpha[end + 1 - length] + log_p[i]
            total = x if total == -math.inf else _add(total, x)
        if not single:
            fallback[end] = sum(log_p[pieces.byte_ids[b]] for b in text[end].encode())
            total = _add(total, alpha[end] + fallback[end])
        alpha[end + 1] = total
    return alpha, arcs, fallback


def marginal(pieces: Pieces, log_p: list[float], text: str) -> float:
    """Log probability of the text, summed over its segmentations."""
    return forward(pieces, log_p, text)[0][-1]


def expected(pieces: Pieces, log_p: list[float], text: str, weight: float, into: dict[int, float]) -> None:
    """Add ``weight`` times the expected use of each piece in the text."""
    alpha, arcs, fallback = forward(pieces, log_p, text)
    n = len(text)
    beta = [-math.inf] * n + [0.0]
    for end in range(n - 1, -1, -1):
        after = beta[end + 1]
        if after == -math.inf:
            continue
        for length, i in arcs[end]:
            start = end + 1 - length
            x = after + log_p[i]
            share = math.exp(alpha[start] + x - alpha[n])
            if share:
                into[i] = into.get(i, 0.0) + weight * share
            beta[start] = x if beta[start] == -math.inf else _add(beta[start], x)
        if fallback[end] is not None:
            x = after + fallback[end]
            share = math.exp(alpha[end] + x - alpha[n])
            for b in text[end].encode():
                into[pieces.byte_ids[b]] = into.get(pieces.byte_ids[b], 0.0) + weight * share
            beta[end] = x if beta[end] == -math.inf else _add(beta[end], x)


def viterbi(pieces: Pieces, unknown: float, text: str) -> tuple[float, int]:
    """Best score and its number of pieces.

    On equal scores the longer last piece stays, as in tokenizers that walk
    the starts from the left and replace only what is strictly worse.  A character that
    is no piece costs ``unknown`` and counts its bytes.
    """
    scores = pieces.scores
    best, count = [0.0], [0]
    for end, matches in enumerate(pieces.arcs(text)):
        top, many, longest, single = -math.inf, 0, 0, False
        for length, i in matches:
            single |= length == 1
            x = best[end + 1 - length] + scores[i]
            if x > top or (x == top and length > longest):
                top, many, longest = x, count[end + 1 - length] + 1, length
        if not single:
            x = best[end] + unknown
            if x > top:
                top, many = x, count[end] + len(text[end].encode())
        best.append(top)
        count.append(many)
    return best[-1], count[-1]
