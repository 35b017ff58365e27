"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

All segmentations of a text into pieces form a lattice; a segmentation's
probability is the product of its pieces' weights over the lattice's sum.
Its log-probability plus Gumbel noise is its perturbed score, and the k best
perturbed scores are a sample of k distinct segmentations.  They are found
best first, as in A* sampling: the best score of all is drawn, then the path
that has it from the top down; each set of paths that leave a found path at
one place keeps a bound, its own best score, drawn from a Gumbel truncated at
the score of the set it was cut from; the largest bound gives the next path.
The bound left over after k paths is the threshold for the inclusion scores:
the chance that a path of this probability is among the k.

No piece crosses the start of a word or a character without a piece of its
own, so a lattice is a chain of small ones; equal units of a slice of texts
share their forward sums, and all draws are vectorised.  Randomness comes from
hashes of (seed, row key, path, place): a result does not depend on batches,
partitions or retries.  One pass without a shuffle; the vocabulary (a few MB)
travels with the tasks.

Decoding concatenates pieces and gives back every text exactly: characters
without a piece, and the word mark itself where a text has it, become bytes.
Texts are encoded as they are, without the model's normaliser.

Rows: null and empty text has one path, without pieces.  A null id is keyed by
the text's hash.  Repeated rows give the same samples.  Texts with fewer than k
segmentations give all they have.  An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

MARK, OWN_MARK = 0x2581, 0x110000
RESULT = "doc_id long, sample int, n_tokens long, log_prob double, perturbed double, inclusion double, ids binary, exact boolean"
#: Units of more characters take the slower way, one by one, as do shorter ones where weights are very uneven.
LONG = 48
_NONE = -1


def _mix1(x: int) -> int:
    return int(K.mix(np.array([x & (1 << 64) - 1], np.uint64))[0])


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1) from mixed 64-bit values."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


class Vocabulary:
    """Pieces, their weights, and a table from hashes of their characters to ids."""

    def __init__(self, pieces: list[tuple[int, str, float]], bytes_at: list[int], size: int, temperature: float = 1.0):
        self.size = size
        self.bytes_at = np.array(bytes_at, np.int64)
        ranked = all(float(s).is_integer() for _, _, s in pieces)  # a BPE model's scores are ranks
        one = {p for _, p, _ in pieces if len(p) == 1}
        pieces = [x for x in pieces if all(c in one for c in x[1])]
        self.ids = np.array([i for i, _, _ in pieces], np.int64)
        self.log = np.array([-np.log(2.0 + min(-s, size)) if ranked else s for _, _, s in pieces], np.float64) / temperature
        self.weight = np.exp(self.log)
        # the product of as many weights stays far from a double's limits
        self.long = int(min(LONG, 576 / np.abs(self.log).max(initial=1)))
        self.cut = not any(a != "▁" and b == "▁" for _, p, _ in pieces for a, b in zip(p, p[1:]))
        self.longest = max((len(p) for _, p, _ in pieces), default=1)
        self.known = np.zeros(OWN_MARK + 1, bool)
        self.known[[ord(c) for c in one]] = True
        # the table also holds proper prefixes of pieces, after the pieces: they end a search early
        whole = {p for _, p, _ in pieces}
        spans = sorted({p[:k] for p in whole for k in range(1, len(p))} - whole)
        more = {p[:k] for p in whole for k in range(1, len(p))}
        self.longer = np.array([p in more for _, p, _ in pieces] + [True] * len(spans), bool)
        self.count = len(pieces)
        keys = np.array([self.name([ord(c) for c in p]) for p in [p for _, p, _ in pieces] + spans], np.uint64)
        self.tables, left = [], np.arange(len(keys))
        for shift in (42, 21, 0):
            table = np.full(1 << 21, -1, np.int32)
            place = (keys[left] >> np.uint64(shift)).astype(np.int64) & ((1 << 21) - 1)
            table[place[::-1]] = left[::-1]
            self.tables.append((shift, table))
            left = left[table[place] != left]
        if len(left):
            raise ValueError("the vocabulary is too large for its table")
        self.keys = keys
        self.bytes = [p.replace("▁", " ").encode() for _, p, _ in pieces]
        self.spell: dict[int, bytes] = dict(zip(self.ids.tolist(), self.bytes)) | {i: bytes([b]) for b, i in enumerate(bytes_at)}

    @classmethod
    def load(cls, path: str, temperature: float = 1.0) -> Vocabulary:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        raw = {int(m.id_to_piece(i)[1:-1], 16): i for i in range(n) if m.is_byte(i)}
        if len(raw) != 256:
            raise ValueError("the model has no byte fallback, so it can't encode every text exactly")
        plain = [(i, m.id_to_piece(i), m.get_score(i)) for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        return cls(plain, [raw[b] for b in range(256)], n, temperature)

    @staticmethod
    def step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (h ^ c.astype(np.uint64)) * np.uint64(0x9FB21C651E98DF25) ^ (h >> np.uint64(29))

    @classmethod
    def name(cls, cps: list[int]) -> int:
        h = np.array([0x1234567], np.uint64)
        for c in cps:
            h = cls.step(h, np.array([c], np.uint64))
        return int(K.mix(h)[0])

    def find(self, names: np.ndarray) -> np.ndarray:
        """Places in the vocabulary, or -1."""
        out = np.full(len(names), -1, np.int64)
        left = np.arange(len(names))
        for shift, table in self.tables:
            at = table[(names[left] >> np.uint64(shift)).astype(np.int64) & ((1 << 21) - 1)]
            hit = (at >= 0) & (self.keys[at] == names[left])
            out[left[hit]] = at[hit]
            left = left[(at >= 0) & ~hit]
            if not len(left):
                break
        return out

    def decode(self, ids) -> bytes:
        """The text of a path."""
        raw = b"".join(map(self.spell.__getitem__, ids))
        return raw[1:] if len(ids) else raw

    def dtype(self):
        return "<u2" if self.size <= 1 << 16 else "<u4"


class _Group:
    """Distinct units of one length: for each place the edges that end there, with their chances."""

    def __init__(self, v: Vocabulary, chars: np.ndarray):
        n, size = chars.shape
        self.size, edges = size, [[] for _ in range(size + 1)]
        sums = np.zeros((size + 1, n))
        sums[0] = 1
        for i in range(size):
            on, h = np.arange(n), np.full(n, 0x1234567, np.uint64)
            for j in range(i + 1, min(size, i + v.longest) + 1):
                h = v.step(h, chars[on, j - 1])
                place = v.find(K.mix(h))
                hit = (place >= 0) & (place < v.count)
                if hit.any():
                    units, piece = on[hit], place[hit]
                    edges[j].append((i, units, piece, v.weight[piece]))
                stay = (place >= 0) & v.longer[place]
                on, h = on[stay], h[stay]
                if not len(on):
                    break
        self.start, self.piece, self.log, self.edge, self.last = ([None] * (size + 1) for _ in range(5))
        for j in range(1, size + 1):
            mass, piece = np.zeros((n, len(edges[j]))), np.zeros((n, len(edges[j])), np.int32)
            for k, (i, units, p, w) in enumerate(edges[j]):
                mass[units, k], piece[units, k] = sums[i][units] * w, p
            sums[j] = mass.sum(1)
            self.start[j], self.piece[j] = np.array([e[0] for e in edges[j]]), piece
            mass /= sums[j][:, None]
            self.edge[j] = np.cumsum(mass, 1)
            self.last[j] = len(edges[j]) - 1 - (mass[:, ::-1] > 0).argmax(1)
            with np.errstate(divide="ignore"):
                self.log[j] = np.log(mass)

    def draw(self, unit: np.ndarray, base: np.ndarray, put) -> np.ndarray:
        """One path for each occurrence of ``unit``; ``put(occurrences, end, piece)`` gets its pieces. Log-probabilities."""
        at, log = np.full(len(unit), self.size), np.zeros(len(unit))
        for j in range(self.size, 0, -1):
            on = np.flatnonzero(at == j)
            if not len(on):
                continue
            u = unit[on]
            x = _uniform(K.mix(base[on] + np.uint64(j * 0x9E3779B97F4A7C15 % (1 << 64))))
            k = np.minimum((x[:, None] >= self.edge[j][u]).sum(1), self.last[j][u])
            put(on, j, self.piece[j][u, k])
            log[on] += self.log[j][u, k]
            at[on] = self.start[j][k]
        return log

    def one(self, u: int) -> list[list[tuple]]:
        """The edges of one unit, as _One has them."""
        out: list[list[tuple]] = [[]]
        for j in range(1, self.size + 1):
            ks = np.flatnonzero(np.isfinite(self.log[j][u]))
            out.append([(int(i), float(np.exp(x)), int(p)) for i, x, p in zip(self.start[j][ks].tolist(), self.log[j][u, ks].tolist(), self.piece[j][u, ks].tolist())])
        return out


class _One:
    """The lattice of a single unit, of any length, for draws that leave out paths already found."""

    def __init__(self, v: Vocabulary, chars: list[int], edges: list | None = None):
        self.size, self.edges = len(chars), edges or [[] for _ in range(len(chars) + 1)]
        if edges:
            return
        x = np.array(chars, np.uint64)
        h = np.full(len(x), 0x1234567, np.uint64)
        for step in range(1, min(v.longest, len(x)) + 1):
            n = len(x) - step + 1
            h = v.step(h[:n], x[step - 1 :])
            piece = v.find(K.mix(h))
            for i in np.flatnonzero((piece >= 0) & (piece < v.count)).tolist():
                self.edges[i + step].append((i, float(v.log[piece[i]]), int(piece[i])))
        # chances of the edges into each place, from sums kept in scale
        log = [0.0]
        for j in range(1, self.size + 1):
            s = [log[i] + w for i, w, _ in self.edges[j]]
            top = max(s)
            total = top + np.log(sum(np.exp(y - top) for y in s))
            log.append(total)
            self.edges[j] = [(i, float(np.exp(y - total)), p) for (i, _, p), y in zip(self.edges[j], s)]

    def draw(self, base: int) -> tuple[list, float]:
        """(end, piece) of a path from its end, and its log-probability."""
        return self._on(self.size, base, [], 0.0)

    def _on(self, j: int, base: int, path: list, log: float):
        while j:
            u = (_mix1(base + j * 0x9E3779B97F4A7C15) + 0.5) / 2**64
            for i, c, p in self.edges[j]:
                u -= c
                if u < 0:
                    break
            path = path + [(j, p)]
            log, j = log + np.log(c), i
        return path, log

    def splits(self, paths: list[list]) -> list[tuple]:
        """Where a path can leave all of ``paths``: (chance, one that goes there, steps of it, their log-probability, place, edges that none takes)."""
        out, todo = [], [(0, 1.0, 0.0, self.size, paths)]
        while todo:
            depth, reach, log, j, some = todo.pop()
            taken: dict[int, list] = {}
            for x in some:
                taken.setdefault(x[depth][1], []).append(x)
            free = [e for e in self.edges[j] if e[2] not in taken]
            if (mass := reach * sum(c for _, c, _ in free)) > 0:
                out.append((mass, some[0], depth, log, j, free))
            for i, c, q in self.edges[j]:
                if i and q in taken:
                    todo.append((depth + 1, reach * c, log + np.log(c), i, taken[q]))
        return out

    def other(self, not_this: list, base: int, *nor: list) -> tuple[list, float] | None:
        """A path other than these, with its chance in the whole lattice."""
        ways = self.splits([not_this, *nor])
        if not ways:
            return None
        u = (_mix1(base) + 0.5) / 2**64 * sum(w[0] for w in ways)
        for mass, like, depth, log, j, free in ways:
            u -= mass
            if u < 0:
                break
        u = (_mix1(base + 1) + 0.5) / 2**64 * sum(c for _, c, _ in free)
        for i, c, q in free:
            u -= c
            if u < 0:
                break
        return self._on(i, base + 2, like[:depth] + [(j, q)], log + np.log(c))


class _Slice:
    """Texts of a slice: characters, units, and the groups of equal units."""

    def __init__(self, v: Vocabulary, texts: list[str], seeds: list[int]):
        self.v, self.texts = v, texts
        sizes = np.array([len(t) + 1 if t else 0 for t in texts])
        cps = np.frombuffer("".join([" " + t if t else "" for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        cps[cps == MARK] = OWN_MARK
        cps[cps == 0x20] = MARK
        self.cps, self.rows = cps, np.concatenate([[0], np.cumsum(sizes)])
        n = len(cps)
        known = v.known[cps]
        first = np.zeros(n, bool)
        first[self.rows[:-1][sizes > 0]] = True
        first |= ~known
        first[1:] |= ~known[:-1]
        if v.cut:
            first[1:] |= (cps[1:] == MARK) & (cps[:-1] != MARK)
        self.start = np.flatnonzero(first)
        self.end = np.append(self.start[1:], n)
        self.units = np.searchsorted(self.start, self.rows)
        self.size = self.end - self.start
        self.plain = known[self.start] if n else np.zeros(0, bool)
        doc = np.repeat(np.arange(len(texts)), np.diff(self.units))
        self.base = K.mix(np.array(seeds, np.uint64))[doc] + (np.arange(len(self.start)) - self.units[doc]).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        up, down = K.WORDS.upto(n + 1)
        prefix = K._prefix(K.mix(cps.astype(np.uint64)), up[:-1])
        names = K.mix((prefix[self.end] - prefix[self.start]) * down[self.start] + self.size.astype(np.uint64))
        self.groups, self.group, self.unit = [], np.full(len(self.start), -1), np.zeros(len(self.start), np.int64)
        for size in np.unique(self.size[self.plain]).tolist():
            at = np.flatnonzero(self.plain & (self.size == size))
            _, one, unit = np.unique(names[at], return_index=True, return_inverse=True)
            if size > v.long:
                self.groups.append((at, None, None))
            else:
                self.group[at], self.unit[at] = len(self.groups), unit
                self.groups.append((at, _Group(v, cps[self.start[at[one]][:, None] + np.arange(size)]), unit))

    def one(self, t: int) -> _One:
        chars = self.cps[self.start[t] : self.end[t]].tolist()
        group = self.groups[self.group[t]][1] if self.group[t] >= 0 else None
        return _One(self.v, chars, group.one(int(self.unit[t])) if group else None)

    def path(self, slots: np.ndarray, t: int) -> list:
        """(end, piece) of a unit's path, from its end."""
        s = slots[self.start[t] : self.end[t]]
        return [(int(k) + 1, int(s[k])) for k in np.flatnonzero(s >= 0)[::-1]]

    def draw(self, number: int, on: np.ndarray, slots: np.ndarray, log: np.ndarray) -> None:
        """Fresh paths for the units in ``on``, written to ``slots`` and ``log``."""
        base = K.mix(self.base + np.uint64(number * 0xA0761D6478BD642F % (1 << 64)))
        log[on] = 0
        for at, group, unit in self.groups:
            chosen = np.flatnonzero(on[at])
            where = at[chosen]
            if not len(where):
                continue
            if group is None:
                for t in where.tolist():
                    path, log[t] = self.one(t).draw(int(base[t]))
                    slots[self.start[t] : self.end[t]] = _NONE
                    for j, p in path:
                        slots[self.start[t] + j - 1] = p
                continue
            begin = self.start[where]
            slots[begin[:, None] + np.arange(group.size)] = _NONE

            def put(o, j, piece, begin=begin):
                slots[begin[o] + j - 1] = piece

            log[where] = group.draw(unit[chosen], base[where], put)
        lone = np.flatnonzero(on & ~self.plain)
        slots[self.start[lone]] = len(self.v.ids)  # stands for the character's bytes

    def ids(self, slots: np.ndarray) -> list[np.ndarray]:
        """The token ids of each text."""
        at = np.flatnonzero(slots >= 0)
        cut = np.searchsorted(at, self.rows)
        pieces = slots[at]
        ids = np.append(self.v.ids, -1)[pieces]
        out = []
        lone = np.flatnonzero(ids < 0)
        if len(lone):
            spelt = [("▁" if c == OWN_MARK else chr(c)).encode("utf-8", "surrogatepass") for c in self.cps[at[lone]].tolist()]
            times = np.ones(len(ids), np.int64)
            times[lone] = [len(x) for x in spelt]
            ids = np.repeat(ids, times)
            ids[ids < 0] = self.v.bytes_at[np.frombuffer(b"".join(spelt), np.uint8)]
            cut = np.concatenate([[0], np.cumsum(times)])[cut]
        for a, b in zip(cut, cut[1:]):
            out.append(ids[a:b])
        return out


def _truncated(phi: np.ndarray, top, u: np.ndarray) -> np.ndarray:
    """Gumbels of location ``phi``, no larger than ``top``."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        x = top - np.log1p(-np.log(u) * np.exp(np.minimum(top - phi, 700)))
    return np.where(np.isneginf(phi), -np.inf, np.minimum(x, top))


def sample(v: Vocabulary, texts: list[str], seeds: list[int], k: int) -> list[list[tuple]]:
    """For each text, up to ``k`` of (ids, log-probability, perturbed score, inclusion score), the best perturbed first."""
    s = _Slice(v, texts, seeds)
    n, units, chars = len(texts), s.units, s.rows
    total = len(s.start)
    top = -np.log(-np.log(_uniform(K.mix(K.mix(np.array(seeds, np.uint64)) ^ np.uint64(0x5EED)))))
    slots, logs = [np.full(len(s.cps), _NONE, np.int32)], [np.zeros(total)]
    s.draw(0, np.ones(total, bool), slots[0], logs[0])
    doc = np.repeat(np.arange(n), np.diff(units))
    found = [[(0, 0, float(g))] for g in top]  # (path, first unit of its own, perturbed score)
    bounds: list[list[np.ndarray]] = []  # of each path: for each unit, the best score of those that leave it there
    fixed: list[dict] = [{} for _ in range(n)]  # places left more than once: (parent, unit) -> paths found there

    def bound(number: int, first: np.ndarray, tops: np.ndarray) -> np.ndarray:
        log = logs[number]
        # text by text: a running sum over the slice would round differently from batch to batch
        phi = np.concatenate([np.zeros(0), *(np.cumsum(log[a:b]) - log[a:b] for a, b in zip(units, units[1:]))])
        rest = -np.expm1(np.minimum(log, 0))
        with np.errstate(divide="ignore"):
            phi = phi + np.where(rest > 1e-13, np.log(np.maximum(rest, 1e-300)), -np.inf)
        u = _uniform(K.mix(s.base + np.uint64((number + 1) * 0xE7037ED1A0B428DB % (1 << 64))))
        x = _truncated(phi, tops[doc], u)
        x[np.arange(total) < first[doc]] = -np.inf
        return x

    bounds.append(bound(0, units[:-1], top))

    def best(d: int) -> tuple[float, int, int]:
        """The largest bound of a text: (score, path, unit)."""
        out = (-np.inf, 0, 0)
        a, b = int(units[d]), int(units[d + 1])
        for number, first, _ in found[d]:
            if b > a:
                x = bounds[number][max(a, first) : b]
                if len(x) and x[i := int(x.argmax())] > out[0]:
                    out = (float(x[i]), number, max(a, first) + i)
        return out

    for number in range(1, k):
        on, tops, first = np.zeros(total, bool), np.full(n, -np.inf), units[:-1].copy()
        new, log = slots[0].copy(), logs[0].copy()
        for d in range(n):
            path = None
            while path is None:
                score, parent, t = best(d)
                if score == -np.inf:
                    break
                seed = _mix1(int(s.base[t]) + number * 77)
                known = fixed[d].setdefault((parent, t), [s.path(slots[parent], t)])
                one = s.one(t)
                if (path := one.other(known[0], _mix1(seed), *known[1:])) is None:
                    bounds[parent][t] = -np.inf
            if path is None:
                continue
            a, b = int(units[d]), int(units[d + 1])
            known.append(path[0])
            # what still leaves the parent here: all paths but those found
            left = sum(w[0] for w in one.splits(known))
            ahead = float(logs[parent][a:t].sum())
            phi = np.array([ahead + np.log(left) if left > 0 else -np.inf])
            bounds[parent][t] = _truncated(phi, score, _uniform(K.mix(np.array([seed ^ 0xABCDEF], np.uint64))))[0]
            new[chars[d] : s.start[t]] = slots[parent][chars[d] : s.start[t]]
            log[a:t] = logs[parent][a:t]
            new[s.start[t] : s.end[t]] = _NONE
            for j, p in path[0]:
                new[s.start[t] + j - 1] = p
            log[t] = path[1]
            on[t + 1 : b] = True
            tops[d], first[d] = score, t + 1
            found[d].append((number, t + 1, score))
        if not np.isfinite(tops).any():
            break
        s.draw(number, on, new, log)
        slots.append(new)
        logs.append(log)
        bounds.append(bound(number, first, tops))
    lists = [s.ids(x) for x in slots]
    out = []
    for d in range(n):
        limit, rows = best(d)[0], []
        for number, _, score in found[d]:
            lp = float(logs[number][units[d] : units[d + 1]].sum())
            rows.append((lists[number][d], lp, score, 1.0 if limit == -np.inf else float(-np.expm1(-np.exp(min(lp - limit, 700))))))
        out.append(rows)
    return out


def _encoded(v: Vocabulary, k: int, seed: int, slice_bytes: int):
    def f(batches):
        for batch in batches:
            _, offs = K.text_column(batch.column(1))
            for i, j in K.row_slices(offs, slice_bytes):
                keys, texts = batch.column(0).slice(i, j - i).to_pylist(), [t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]
                seeds = [_mix1(seed * 0x9E3779B97F4A7C15 + (key if key is not None else int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "little"))) for key, t in zip(keys, texts)]
                out = {c: [] for c in ("doc_id", "sample", "n_tokens", "log_prob", "perturbed", "inclusion", "ids", "exact")}
                for key, text, rows in zip(keys, texts, sample(v, texts, seeds, k)):
                    raw = text.encode()
                    for number, (ids, lp, score, inclusion) in enumerate(rows):
                        for c, x in zip(out, (key, number, len(ids), lp, score, inclusion, ids.astype(v.dtype()).tobytes(), v.decode(ids.tolist()) == raw)):
                            out[c].append(x)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.bool_())
                yield pa.record_batch({c: pa.array(x, t) for (c, x), t in zip(out.items(), kinds)})

    return f


def encode(docs: DataFrame, v: Vocabulary, k: int = 2, seed: int = 1, id_col: str = "doc_id", text: str = "text", slice_bytes: int = 5 << 19) -> DataFrame:
    """Up to ``k`` sampled segmentations of each text, as RESULT; ids are little-endian and ``exact`` says that they decode to the text.

    ``slice_bytes`` of text are worked on at once: fewer take less memory and
    more time, and change no result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_encoded(v, k, seed, slice_bytes), RESULT)


def decode(rows: DataFrame, v: Vocabulary, ids: str = "ids") -> DataFrame:
    """``rows`` with the text of each row's ids in column ``decoded`` (null for null, � for bytes that aren't UTF-8)."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else v.decode(np.frombuffer(x, v.dtype()).tolist()).decode("utf-8", "replace") for x in column.to_pylist()], pa.string())

    return rows.withColumn("decoded", text(F.col(ids)))
