"""Piece vocabulary of a BPE .model file as lookup tables (parsed with the sentencepiece package).

Two adjacent symbols may merge when their joined text is a piece; the best score merges first,
the leftmost among equals. Characters that are no piece fall back to one piece per UTF-8 byte.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np

SPACE = "▁"
NEVER = np.int32(2**31 - 1)


class PieceModel:
    """Pieces, merge ranks, character pairs that occur inside pieces, and per-character fallbacks."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only BPE models with identity normalisation and kept white space are supported")
        if proto.trainer_spec.treat_whitespace_as_suffix or not norm.add_dummy_prefix:
            raise ValueError("only models that add a leading space are supported")
        kinds = type(proto.pieces[0])
        self.text = [p.piece for p in proto.pieces]
        self.eos = next((i for i, p in enumerate(proto.pieces) if p.piece == proto.trainer_spec.eos_piece), -1)
        self.unk = next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN)
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        score = np.array([p.score for p in proto.pieces], dtype=np.float64)
        normal = np.array(sorted(self.id.values()))
        distinct, inverse, times = np.unique(-score[normal], return_inverse=True, return_counts=True)
        self.rank = np.full(len(self.text), NEVER, dtype=np.int32)  # 0 merges first
        self.rank[normal] = inverse
        self.tied = np.zeros(len(self.text), bool)  # another piece has the same score
        self.tied[normal] = times[inverse] > 1
        self.fallback = bool(self.byte_id)
        #: UTF-8 bytes that each id decodes to, before the leading space goes
        self.surface = [t.replace(SPACE, " ").encode() for t in self.text]
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.CONTROL:
                self.surface[i] = b""
            elif p.type == kinds.UNKNOWN:
                self.surface[i] = proto.trainer_spec.unk_surface.encode()
        for b, i in self.byte_id.items():
            self.surface[i] = bytes([b])
        self.merges = {
            (self.id[t[:k]], self.id[t[k:]]): i for t, i in self.id.items() for k in range(1, len(t)) if t[:k] in self.id and t[k:] in self.id
        }
        self.pairs = {t[k : k + 2] for t in self.id for k in range(len(t) - 1)}
        #: no piece has a space mark after another character: a space mark starts a new unit
        self.space_starts = not any(p[1] == SPACE != p[0] for p in self.pairs)

    def char_ids(self, ch: str) -> list[int]:
        """Ids of one character that is alone: its piece, or its bytes, or unknown."""
        if ch in self.id:
            return [self.id[ch]]
        return [self.byte_id[b] for b in ch.encode()] if self.fallback else [self.unk]

    def split(self, text: str) -> list[str]:
        """Cut where no piece can reach across: the parts encode independently."""
        pairs, out, start = self.pairs, [], 0
        for k in range(1, len(text)):
            if text[k - 1 : k + 1] not in pairs:
                out.append(text[start:k])
                start = k
        if text:
            out.append(text[start:])
        return out

    def merge(self, text: str) -> list[int]:
        """Plain merging of one string of piece characters with a heap: best rank first, leftmost among equals."""
        ids: list[int] = [self.id[c] for c in text]
        n = len(ids)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(a: int) -> None:
            b = right[a] if a >= 0 else -1
            if a >= 0 and b >= 0 and (new := self.merges.get((ids[a], ids[b]))) is not None:
                heapq.heappush(heap, (int(self.rank[new]), a, ids[a], ids[b], new))

        for a in range(n):
            offer(a)
        while heap:
            _, a, x, y, new = heapq.heappop(heap)
            b = right[a] if ids[a] == x else -1
            if b < 0 or ids[b] != y:
                continue
            ids[a], ids[b] = new, -1
            right[a] = right[b]
            if right[a] >= 0:
                left[right[a]] = a
            offer(left[a])
            offer(a)
        return [i for i in ids if i >= 0]


@lru_cache(maxsize=4)
def load(path: str) -> PieceModel:
    return PieceModel(path)
