"""Byte-context trie of prediction by partial matching: escape method C, symbol exclusion, frozen statistics, several classes side by side.

A text is the bytes of its UTF-8 form with A-Z lower-cased, after `order` start bytes 0xFF and before one end byte 0xFF (a byte that UTF-8
never holds). A gram is a context of up to `order` bytes with the symbol behind it; its code holds the bytes in order. The counts of the
longest grams give those of all shorter ones, by cutting first bytes off.

With frozen statistics, what a lookup needs is known beforehand. A context's symbols are a subset of its suffix's, so what is excluded
behind an escape depends on the context alone:
  first   log10 of the escape out of a context that nothing was excluded from,
  then    log10 of the escape out of its suffix, with its own symbols excluded there,
  norm    log10 of the suffix's counts and kinds, with its own symbols excluded.
A gram has, by class, `alone` (log10 probability when its context is the longest known one) and `behind`: log10 of its count, or, negative,
for a symbol the class has not seen there, log10 probability of escaping further and finding it.
"""

from __future__ import annotations

import functools
import io
import math

import numpy as np
from pyarrow import fs

FIELDS = ("gram_keys", "gram_at", "alone", "behind", "context_keys", "context_at", "first", "then", "norm", "floor")


def mask(n: int) -> int:
    """Of the last n bytes of a code."""
    return (1 << (8 * n)) - 1


def grams(data: bytes, order: int, at: int = 0, most: int | None = None) -> np.ndarray:
    """Code of the gram at each place of a text, its end included; or at up to `most` places from `at` on."""
    n = max(0, len(data) + 1 - at if most is None else min(most, len(data) + 1 - at))
    part = data[max(0, at - order) : at + n]
    b = np.frombuffer(b"\xff" * max(0, order - at) + part + b"\xff" * (at + n > len(data)), np.uint8).astype(np.int64)
    code = b[:n].copy()
    for i in range(1, order + 1):
        code <<= 8
        code |= b[i : i + n]
    return code


def tally(codes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, and their sums of weights (a row each; counts where there are none)."""
    if weights is None:
        codes = np.sort(codes)
    else:
        by = np.argsort(codes, kind="stable")
        codes, weights = codes[by], weights[by]
    at = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
    if weights is None:
        return codes[at], np.diff(np.r_[at, len(codes)])
    return codes[at], np.add.reduceat(weights, at, axis=0) if len(at) else weights


def levels(codes: np.ndarray, which: np.ndarray, n: np.ndarray, classes: int, order: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Counts of all orders from those of the longest grams by class, for Trie.build."""
    out = {}
    for o in range(order, -1, -1):
        key, n = tally((codes & mask(o + 1)) << 8 | which, n)
        codes, which = key >> 8, key & 255
        start = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
        table = np.zeros((len(start), classes))
        table[np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(codes)])), which] = n
        out[o] = codes[start], table
    return out


def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).view(np.int64)


def _hashed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts keys into hash buckets, and each bucket's start. A bucket a key or more."""
    bits = max(1, math.ceil(math.log2(len(keys) + 2)))
    b = _bucket(keys, bits)
    at = np.zeros((1 << bits) + 1, np.int32)
    np.cumsum(np.bincount(b, minlength=1 << bits), out=at[1:])
    return np.argsort(b.astype(np.uint32 if bits <= 32 else np.int64), kind="stable"), at


def find(keys: np.ndarray, at: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Row of each wanted key, -1 where there is none."""
    b = _bucket(wanted, (len(at) - 1).bit_length() - 1)
    row, end = at[b].astype(np.int64), at[b + 1].astype(np.int64)
    out = np.full(len(wanted), -1, np.int64)
    left = np.flatnonzero(row < end)
    while len(left):
        r = row[left]
        same = keys[r] == wanted[left]
        out[left[same]] = r[same]
        left = left[~same]
        row[left] += 1
        left = left[row[left] < end[left]]
    return out


class Trie:
    """Lookup tables of all orders. Keys carry the number of their bytes in the top byte."""

    def __init__(self, order: int, tables: dict[str, np.ndarray]):
        self.order, self.tables = order, tables
        for k in FIELDS:
            setattr(self, k, tables[k])

    @classmethod
    def build(cls, levels: dict[int, tuple[np.ndarray, np.ndarray]], order: int) -> Trie:
        """From each order's distinct codes, sorted, and their counts (a row each, a column per class). Of each code its suffix has to be there.
        `levels` is used up, so that no table is held twice."""
        classes = levels[0][1].shape[1]
        log = lambda x: np.log10(np.where(x > 0, x, 1.0))
        gram_keys, alone, behind, context_keys, first, then, norm = ([] for _ in range(7))
        below = floor = None
        for o in range(order + 1):
            g, n = levels.pop(o)
            c, start = np.unique(g >> 8, return_index=True)
            at = np.repeat(np.arange(len(c)), np.diff(np.r_[start, len(g)]))
            total = np.add.reduceat(n, start, axis=0) if len(c) else np.zeros((0, classes))
            kinds = np.add.reduceat((n > 0).astype(float), start, axis=0) if len(c) else np.zeros((0, classes))
            escape = np.where(kinds > 0, log(kinds) - log(total + kinds), 0.0)
            if o == 0:
                left = 256 - (kinds[0] if len(c) else np.zeros(classes))
                floor = -np.log10(np.maximum(1, left))
                onward, size = np.zeros_like(total), np.zeros_like(total)
                unseen = np.broadcast_to(floor, n.shape)
            else:
                pg, pn, pc, ptotal, pkinds, pbehind = below
                up, parent = np.searchsorted(pg, g & mask(o)), np.searchsorted(pc, c & mask(o - 1))
                taken = np.add.reduceat(np.where(n > 0, pn[up], 0.0), start, axis=0) if len(c) else total
                kinds_left = pkinds[parent] - kinds
                rest = ptotal[parent] - taken + kinds_left
                size = log(rest)
                onward = np.where(kinds_left > 0, log(kinds_left) - size, 0.0)
                unseen = np.where(pbehind[up] >= 0, pbehind[up] - size[at], pbehind[up] + onward[at])
            own = np.where(n > 0, log(n), unseen)
            del unseen
            gram_keys.append(g | (o + 1) << 56)
            behind.append(own.astype(np.float32))
            alone.append(np.where(n > 0, own - log(total + kinds)[at], escape[at] + own).astype(np.float32))
            context_keys.append(c | o << 56)
            first.append(escape)
            then.append(onward)
            norm.append(size)
            below = g, n, c, total, kinds, own
        t = {"floor": floor}
        for keys, where, tables in ((gram_keys, "gram", {"alone": alone, "behind": behind}), (context_keys, "context", {"first": first, "then": then, "norm": norm})):
            k = np.concatenate(keys)
            by, t[f"{where}_at"] = _hashed(k)
            t[f"{where}_keys"] = k[by]
            del k
            for name, x in tables.items():
                t[name] = np.concatenate(x).astype(np.float32, copy=False)[by]
                x.clear()
        return cls(order, t)

    def logs(self, codes: np.ndarray, unknown: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of each gram's symbol behind its context: a row each, a column per class.

        `unknown`: a mask to fill. Grams whose longest context is not in the tables are marked there, and have zeros.
        """
        out = np.zeros((len(codes), len(self.floor)))
        left, last = np.arange(len(codes)), np.full(len(codes), -1, np.int64)
        for o in range(self.order, -1, -1):
            if not len(left):
                return out
            key = codes[left] & mask(o + 1)
            g = find(self.gram_keys, self.gram_at, key | (o + 1) << 56)
            hit, from_ = g >= 0, last[left]
            at, g, deep = left[hit], g[hit], from_[hit]
            new = deep < 0
            out[at[new]] += self.alone[g[new]]
            at, g, deep = at[~new], g[~new], deep[~new]
            w = self.behind[g]
            out[at] += np.where(w >= 0, w - self.norm[deep], w + self.then[deep])
            left, key, deep = left[~hit], key[~hit], from_[~hit]
            c = find(self.context_keys, self.context_at, key >> 8 | o << 56)
            known = c >= 0
            if unknown is not None and o == self.order:
                unknown[left[~known]] = True
                left, c, deep, known = left[known], c[known], deep[known], known[known]
            started = deep >= 0
            fresh = known & ~started
            out[left[fresh]] += self.first[c[fresh]]
            out[left[started]] += self.then[deep[started]]
            last[left] = np.where(known, c, -1)
        out[left] += self.floor
        return out

    def totals(self, texts: list[bytes], at_once: int = 1 << 19, unknown: list | None = None) -> np.ndarray:
        """log10 probability of each text under each class. Memory is bounded by `at_once` places, however long a text is.

        `unknown`: a list to fill with (numbers of texts, codes) of the places whose longest context is not in the tables; they do not count.
        """
        out = np.zeros((len(texts), len(self.floor)))
        held, whose, size = [], [], 0

        def settle():
            codes = np.concatenate(held)
            mask = None if unknown is None else np.zeros(len(codes), bool)
            sums = np.add.reduceat(self.logs(codes, mask), np.cumsum([0, *map(len, held[:-1])]), axis=0)
            np.add.at(out, whose, sums)
            if mask is not None:
                unknown.append((np.repeat(whose, list(map(len, held)))[mask], codes[mask]))

        for i, text in enumerate(texts):
            for at in range(0, len(text) + 1, at_once):
                held.append(grams(text, self.order, at, at_once))
                whose.append(i)
                size += len(held[-1])
                if size >= at_once:
                    settle()
                    held, whose, size = [], [], 0
        if held:
            settle()
        return out

    def save(self, folder: str) -> str:
        """Write the tables below a folder of any store; returns it."""
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        for k in FIELDS:
            with store.open_output_stream(f"{path}/{k}.npy") as f:
                np.lib.format.write_array(f, np.ascontiguousarray(self.tables[k]), allow_pickle=False)
        with store.open_output_stream(f"{path}/order") as f:
            f.write(str(self.order).encode())
        return folder


@functools.lru_cache(maxsize=1)
def load(*folders: str) -> tuple[Trie, ...]:
    """Saved tries: mapped into memory, and so shared by a machine's workers, where the store is a file system; else read. A worker lets go of
    the ones before."""
    return tuple(_load(folder) for folder in folders)


def _load(folder: str) -> Trie:
    store, path = fs.FileSystem.from_uri(folder)
    tables = {}
    for k in FIELDS:
        if isinstance(store, fs.LocalFileSystem):
            tables[k] = np.load(f"{path}/{k}.npy", mmap_mode="r")
        else:
            with store.open_input_file(f"{path}/{k}.npy") as f:
                tables[k] = np.load(io.BytesIO(f.read()))
    with store.open_input_stream(f"{path}/order") as f:
        return Trie(int(f.read()), tables)
