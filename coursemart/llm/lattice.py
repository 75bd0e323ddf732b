"""Segmentation lattices over a fixed piece vocabulary, for many short byte units at once.

The pieces come from an existing tokenizer file; nothing here changes or trains them. In a unit the word
marker of the vocabulary is a plain space; a character that no piece spells alone gets one arc per byte
(the vocabulary's byte pieces), so every byte string has a segmentation and spells back exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MARK = "▁"
LOST = np.int32(-1)
#: bytes of the UTF-8 character that a byte begins (0: it continues one)
CHAR_BYTES = np.array([1 if b < 0x80 else 0 if b < 0xC0 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4 for b in range(256)], dtype=np.int8)


def load_pieces(path: str) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, score, is_byte, is_control) of each piece of a sentencepiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    is_byte = np.array([sp.is_byte(i) for i in range(n)])
    control = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)])
    spelled = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if is_byte[i] else sp.id_to_piece(i).replace(MARK, " ").encode()
               for i in range(n)]
    return spelled, np.array([sp.get_score(i) for i in range(n)]), is_byte, control


def rank_weights(score: np.ndarray, is_byte: np.ndarray, control: np.ndarray) -> np.ndarray:
    """Natural-log weight of each piece from the file's scores.

    Scores that are probabilities' logarithms are taken as they are. Where the file ranks pieces (scores
    0, -1, -2, ...: the order of merges), a piece's weight falls as 1 / (rank + 2), the usual shape of
    word frequencies. Byte pieces weigh as much as ten times the last rank; control pieces have none."""
    normal = ~is_byte & ~control
    known = score[normal & (score > -1e8)]
    if len(known) and np.all(known == np.round(known)) and known.min() < -1000:
        rank = np.where(score > -1e8, -score, len(score))
        w = -np.log(rank + 2.0)
        w[is_byte] = -np.log(10.0 * len(score))
    else:
        w = score.astype(float).copy()
        w[is_byte] = (known.min() if len(known) else 0.0) - 10.0
    w[control] = -np.inf
    return w - np.log(np.exp(w[~control]).sum())


class Trie:
    """Byte transitions of the pieces' trie in two hash tables (the second for the first's collisions)."""

    def __init__(self, pieces: list[bytes], ids: np.ndarray):
        nodes, piece_at = {b"": 0}, [-1]
        edges = []
        for i in ids:
            p = pieces[i]
            for k in range(1, len(p) + 1):
                if p[:k] not in nodes:
                    nodes[p[:k]] = len(nodes)
                    piece_at.append(-1)
                    edges.append((nodes[p[:k - 1]] << 8 | p[k - 1], nodes[p[:k]]))
            piece_at[nodes[p]] = i
        self.piece_at = np.array(piece_at, dtype=np.int32)
        self.depth = max((len(pieces[i]) for i in ids), default=0)
        key = np.array([e[0] for e in edges], dtype=np.int64)
        to = np.array([e[1] for e in edges], dtype=np.int32)
        self.tables = []
        self.root = np.full(256, LOST, dtype=np.int32)
        self.root[[e[0] & 255 for e in edges if e[0] < 256]] = [e[1] for e in edges if e[0] < 256]
        bits = max(8, int(np.ceil(np.log2(max(2, len(key))))) + 3)
        while len(key):
            slot = self._slot(key, bits, len(self.tables))
            _, first = np.unique(slot, return_index=True)
            at, val = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, LOST, dtype=np.int32)
            at[slot[first]], val[slot[first]] = key[first], to[first]
            self.tables.append((bits, at, val))
            rest = np.ones(len(key), dtype=bool)
            rest[first] = False
            key, to, bits = key[rest], to[rest], max(8, bits - 3)

    @staticmethod
    def _slot(key: np.ndarray, bits: int, level: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 0x632BE59BD9B4E018 * level & (1 << 64) - 1 | 1)
        return (h >> np.uint64(64 - bits)).astype(np.int64)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node.astype(np.int64) << 8 | byte
        out = np.empty(0, dtype=np.int32)
        todo = None
        for level, (bits, at, val) in enumerate(self.tables):
            k = key if todo is None else key[todo]
            slot = self._slot(k, bits, level)
            found = at[slot]
            hit = found == k
            if todo is None:
                out = np.where(hit, val[slot], LOST)
                todo = np.flatnonzero(~hit & (found >= 0))  # a key that collided is in a later table
            else:
                out[todo[hit]] = val[slot[hit]]
                todo = todo[~hit & (found >= 0)]
            if not len(todo):
                break
        return out


@dataclass
class Lattice:
    """Arcs of many units, ordered by end place within the unit, then by end node. A unit of n bytes has
    n + 1 nodes; ``first``/``last`` are the units' first and last nodes."""
    src: np.ndarray
    dst: np.ndarray
    piece: np.ndarray
    steps: np.ndarray   # arcs of step t are steps[t-1]:steps[t]
    first: np.ndarray
    last: np.ndarray

    def _runs(self):
        for t in range(1, len(self.steps)):
            a, b = self.steps[t - 1], self.steps[t]
            if b > a:
                yield a, b

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Log total weight of all segmentations of each prefix (by node)."""
        alpha = np.full(int(self.last[-1]) + 1 if len(self.last) else 0, -np.inf)
        alpha[self.first] = 0.0
        w = weight[self.piece]
        for a, b in self._runs():
            d = self.dst[a:b]
            seg = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
            v = alpha[self.src[a:b]] + w[a:b]
            top = np.maximum.reduceat(v, seg)
            size = np.diff(np.r_[seg, b - a])
            with np.errstate(invalid="ignore"):
                total = np.add.reduceat(np.exp(v - np.repeat(top, size)), seg)
            alpha[d[seg]] = np.where(np.isfinite(top), top + np.log(total), -np.inf)
        return alpha

    def expected(self, weight: np.ndarray, unit_weight: np.ndarray, size: int) -> np.ndarray:
        """Expected uses of each piece under the segmentations' posterior, units weighted."""
        alpha = self.forward(weight)
        w = weight[self.piece]
        nodes = len(alpha)
        share = np.zeros(nodes)  # posterior weight that passes a node
        share[self.last] = unit_weight
        gamma = np.zeros(len(w))
        for a, b in reversed(list(self._runs())):
            with np.errstate(invalid="ignore"):
                g = np.exp(alpha[self.src[a:b]] + w[a:b] - alpha[self.dst[a:b]]) * share[self.dst[a:b]]
            gamma[a:b] = g
            np.add.at(share, self.src[a:b], g)
        return np.bincount(self.piece, weights=gamma, minlength=size)


class Vocabulary:
    """The pieces with the trie that finds them; picklable, a few MB."""

    def __init__(self, path: str):
        self.pieces, score, is_byte, control = load_pieces(path)
        self.weight = rank_weights(score, is_byte, control)
        normal = np.flatnonzero(~is_byte & ~control)
        self.trie = Trie(self.pieces, normal)
        self.byte_piece = np.full(256, -1, dtype=np.int32)
        for i in np.flatnonzero(is_byte):
            self.byte_piece[self.pieces[i][0]] = i
        self.lens = np.array([0 if control[i] else len(p) for i, p in enumerate(self.pieces)], dtype=np.int64)
        self.blob = np.frombuffer(b"".join(b"" if control[i] else p for i, p in enumerate(self.pieces)), dtype=np.uint8)
        self.blob_at = np.cumsum(self.lens) - self.lens
        #: neighbouring bytes that some piece holds: between any others every segmentation has a boundary
        self.joined = np.zeros((256, 256), dtype=bool)
        for i in normal:
            p = np.frombuffer(self.pieces[i], dtype=np.uint8)
            self.joined[p[:-1], p[1:]] = True
        self.joined[:, 0x80:0xC0] = True  # never inside a character

    @property
    def size(self) -> int:
        return len(self.pieces)

    def lattice(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> Lattice:
        """Lattice of the units buf[start[u]:end[u]] (each at least one byte)."""
        lens = (end - start).astype(np.int64)
        total = int(lens.sum())
        base = np.cumsum(lens) - lens
        unit = np.repeat(np.arange(len(lens)), lens)
        off = np.arange(total) - base[unit]
        data = buf[start[unit] + off]
        room = lens[unit] - off
        idx = np.arange(total)
        node = np.zeros(total, dtype=np.int32)
        char = CHAR_BYTES[data]
        covered = char == 0  # continuation bytes go with their character
        at, ln, pc = [], [], []
        for k in range(self.trie.depth):
            if k:
                ok = room[idx] > k
                idx, node = idx[ok], node[ok]
            if not len(idx):
                break
            node = self.trie.step(node, data[idx + k]) if k else self.trie.root[data]
            ok = node != LOST
            idx, node = idx[ok], node[ok]
            piece = self.trie.piece_at[node]
            has = piece >= 0
            at.append(idx[has])
            ln.append(np.full(int(has.sum()), k + 1, dtype=np.int64))
            pc.append(piece[has])
            covered[at[-1][char[at[-1]] == k + 1]] = True
        bare = np.flatnonzero(~covered)
        for k in range(4):  # every byte of a character that no piece spells alone
            i = bare[(char[bare] > k) & (room[bare] > k)] + k
            at.append(i)
            ln.append(np.ones(len(i), dtype=np.int64))
            pc.append(self.byte_piece[data[i]])
        at, ln, pc = np.concatenate(at), np.concatenate(ln), np.concatenate(pc)
        stop = off[at] + ln
        dst = at + unit[at] + ln
        longest = int(lens.max()) if len(lens) else 0
        # by end node, longest arc first (each length's arcs are sorted already, so this merges a few
        # runs), then stably by the end's place in its unit
        order = np.argsort(dst * 64 + (63 - ln), kind="stable")
        order = order[np.argsort(stop[order].astype(np.uint16 if longest < 1 << 16 else np.int64), kind="stable")]
        steps = np.searchsorted(stop[order], np.arange(longest + 1), side="right")
        u = np.arange(len(lens))
        return Lattice((at + unit[at])[order], dst[order], pc[order], steps, base + u, base + u + lens)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the pieces, one after the other."""
        n = self.lens[ids]
        out_at = np.cumsum(n) - n
        return self.blob[np.arange(int(n.sum())) - np.repeat(out_at - self.blob_at[ids], n)]


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, loaded once per process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]
