"""Tokenizer access inside tasks: texts are encoded in pieces cut at white space, each distinct piece once."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np

from .common import by_bytes, per_process

# Unicode white space; Python's class also holds four control characters that tokenizers count as signs.
_GAP, _SOLID = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
_CUT = re.compile(f"(?<={_SOLID}){_GAP}")
# Pieces that may be encoded side by side: a blank and then Latin letters or ASCII signs but those of special tokens.
_PLAIN = re.compile(r"[ \n][!-;=?-{}~À-ɏ]+\Z")
# Characters per call; longest piece remembered, in bytes; most pieces remembered by a process (about 150 MB).
CALL_CHARS, PIECE_BYTES, MEMO_PIECES = 1 << 20, 23, 1_500_000


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_safely(text: str, size: int = CALL_CHARS) -> Iterator[str]:
    """Parts of about ``size`` characters, cut where white space begins, as no token spans that place.

    A part grows until such a place is found: text without white space is never cut.
    """
    lo = 0
    while len(text) - lo > size:
        found = _CUT.search(text, lo + size)
        if not found:
            break
        yield text[lo:found.start()]
        lo = found.start()
    yield text[lo:]


def _piece_starts(b: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Places where a run of ASCII blanks follows something that is no white space, and the texts' beginnings."""
    blank = (b == 32) | ((b >= 9) & (b <= 13))
    wide = np.zeros(len(b), bool)  # last bytes of white space beyond ASCII
    if len(b) > 2:
        wide[1:] = (b[:-1] == 0xC2) & ((b[1:] == 0xA0) | (b[1:] == 0x85))
        z, y, x = b[2:], b[1:-1], b[:-2]
        general = (x == 0xE2) & (y == 0x80) & ((z >= 0x80) & (z <= 0x8A) | (z == 0xA8) | (z == 0xA9) | (z == 0xAF))
        wide[2:] |= general | (x == 0xE2) & (y == 0x81) & (z == 0x9F) | (x == 0xE1) & (y == 0x9A) & (z == 0x80) | (x == 0xE3) & (y == 0x80) & (z == 0x80)
    start = np.zeros(len(b), bool)
    start[1:] = blank[1:] & ~(blank | wide)[:-1]
    start[firsts] = True
    return np.flatnonzero(start)


def gathered(pool: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The given ranges of ``pool`` one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    step = np.ones(total, np.int64)
    full = np.flatnonzero(lengths)
    if not total:
        return pool[:0]
    begin = ends[full] - lengths[full]
    step[begin[0]] = offsets[full[0]]
    step[begin[1:]] = offsets[full[1:]] - (offsets[full[:-1]] + lengths[full[:-1]] - 1)
    return pool[np.cumsum(step)]


class _Memo:
    """Ids of short pieces in a hash table of arrays; keys are the pieces' bytes and length, so nothing is confused."""

    def __init__(self, most: int = MEMO_PIECES):
        # A group of texts brings at most one new piece for two characters.
        self.most, self.bits = most, (3 * (most + CALL_CHARS // 2) // 2).bit_length()
        size = 1 << self.bits
        self.keys = np.zeros((size, 3), np.uint64)
        self.at, self.n = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        self.clear()

    def clear(self) -> None:
        self.at[:] = -1
        self.held, self.used, self.pool = 0, 0, np.zeros(1 << 16, np.uint32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = (keys[:, 0] * np.uint64(0x9E3779B97F4A7C15)) ^ (keys[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (keys[:, 2] * np.uint64(0x165667B19E3779F9))
        h ^= h >> np.uint64(29)
        return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key, -1 if it isn't held."""
        out, todo, slot, mask = np.full(len(keys), -1, np.int64), np.arange(len(keys)), self._slot(keys), (1 << self.bits) - 1
        while len(todo):
            held = self.keys[slot]
            mine = keys[todo]
            filled = self.at[slot] >= 0
            same = filled & (held[:, 0] == mine[:, 0]) & (held[:, 1] == mine[:, 1]) & (held[:, 2] == mine[:, 2])
            out[todo[same]] = slot[same]
            on = filled & ~same
            todo, slot = todo[on], (slot[on] + 1) & mask
        return out

    def add(self, keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Distinct keys that aren't held."""
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[:self.used], np.zeros(max(len(ids), self.used) + (1 << 16), np.uint32)])
        self.pool[self.used:self.used + len(ids)] = ids
        at = self.used + np.cumsum(lengths) - lengths
        todo, slot, mask = np.arange(len(keys)), self._slot(keys), (1 << self.bits) - 1
        while len(todo):
            free = np.flatnonzero(self.at[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            s, k = slot[won], todo[won]
            self.keys[s], self.at[s], self.n[s] = keys[k], at[k], lengths[k]
            rest = np.ones(len(todo), bool)
            rest[won] = False
            todo, slot = todo[rest], (slot[rest] + 1) & mask
        self.held += len(keys)
        self.used += len(ids)


class Encoder:
    """A tokenizer of the ``tokenizers`` library with a bounded memory of encoded pieces.

    White space begins a new pre-token in both supported kinds (byte-level and word-end BPE), so that the ids of a
    text are those of its pieces one after the other. A full memory is emptied.
    """

    def __init__(self, path: str, most: int = MEMO_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already fill the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo = _Memo(most)

    def _run(self, pieces: list[str]) -> list[list[int]]:
        """Ids of every piece. Plain ones are encoded side by side, which the library does faster than one by one."""
        out: list[list[int]] = [[]] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if _PLAIN.match(p)]
        others = sorted(set(range(len(pieces))).difference(plain))
        for lo, hi in by_bytes([pieces[i] for i in plain], 1 << 15):
            part = plain[lo:hi]
            e = self.tokenizer.encode("".join(pieces[i] for i in part), add_special_tokens=False)
            begins = np.cumsum([0, *[len(pieces[i]) for i in part]])
            owner = np.searchsorted(begins, [o[0] for o in e.offsets], "right") - 1
            cuts, ids = np.searchsorted(owner, np.arange(len(part) + 1)).tolist(), e.ids
            for k, i in enumerate(part):
                out[i] = ids[cuts[k]:cuts[k + 1]]
        for lo, hi in by_bytes([pieces[i] for i in others], CALL_CHARS):
            part = others[lo:hi]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([pieces[i] for i in part], add_special_tokens=False)):
                out[i] = e.ids
        return out

    def _parts(self, texts: list[str], ids: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """For groups of texts or parts: their owners, numbers of ids, and the ids."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            for part in split_safely(text):
                if part:
                    parts.append(part)
                    owner.append(i)
        owners = np.array(owner, np.int64)
        for lo, hi in by_bytes(parts, CALL_CHARS):
            yield owners[lo:hi], *self._group(parts[lo:hi], ids)

    def _group(self, texts: list[str], ids: bool) -> tuple[np.ndarray, np.ndarray | None]:
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        firsts = np.cumsum([0, *map(len, raw)])
        buffer = b"".join(raw)
        b = np.frombuffer(buffer, np.uint8)
        starts = _piece_starts(b, firsts[:-1])
        lengths = np.diff(starts, append=len(b))
        lanes = np.ndarray((len(b),), "<u8", buffer + b"\0" * 8, strides=(1,))
        keys = np.zeros((len(starts), 3), np.uint64)
        for j in range(3):
            left = np.clip(lengths - 8 * j, 0, 8)
            here = np.flatnonzero(left)
            bits = (left[here] * 8).astype(np.uint64)
            keys[here, j] = lanes[starts[here] + 8 * j] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - bits))
        short = lengths <= PIECE_BYTES
        keys[:, 2] |= np.where(short, lengths, 0).astype(np.uint64) << np.uint64(56)
        if self.memo.held > self.memo.most:
            self.memo.clear()
        slot = np.full(len(starts), -1, np.int64)
        s = np.flatnonzero(short)
        slot[s] = self.memo.find(keys[s])
        lost = s[slot[s] < 0]
        if len(lost):
            # One of each lost piece is encoded and remembered.
            order = np.lexsort(keys[lost].T)
            k = keys[lost][order]
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]).any(axis=1)
            one = lost[order[new]]
            found = self._run([buffer[i:i + n].decode("utf-8", "surrogatepass") for i, n in zip(starts[one].tolist(), lengths[one].tolist())])
            self.memo.add(keys[one], np.array([x for f in found for x in f], np.uint32), np.array([len(f) for f in found], np.int64))
            slot[lost] = self.memo.find(keys[lost])
        long = np.flatnonzero(~short)
        rare = self._run([buffer[i:i + n].decode("utf-8", "surrogatepass") for i, n in zip(starts[long].tolist(), lengths[long].tolist())])
        n = np.zeros(len(starts), np.int64)
        n[s] = self.memo.n[slot[s]]
        n[long] = [len(r) for r in rare]
        of_text = np.searchsorted(starts, firsts[:-1])
        counts = np.add.reduceat(n, of_text) if len(n) else n
        if not ids:
            return counts, None
        at = np.zeros(len(starts), np.int64)
        at[s] = self.memo.at[slot[s]]
        at[long] = self.memo.used + np.cumsum(n[long]) - n[long]
        pool = np.concatenate([self.memo.pool[:self.memo.used], np.array([x for r in rare for x in r], np.uint32)]) if len(long) else self.memo.pool
        return counts, gathered(pool, at, n)

    def count(self, texts: list[str]) -> np.ndarray:
        """Numbers of ids; no ids are put together."""
        out = np.zeros(len(texts), np.int64)
        for owners, counts, _ in self._parts(texts, ids=False):
            np.add.at(out, owners, counts)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        out, all_ids = np.zeros(len(texts), np.int64), [np.zeros(0, np.uint32)]
        for owners, counts, ids in self._parts(texts, ids=True):
            np.add.at(out, owners, counts)
            all_ids.append(ids)
        return np.concatenate(all_ids), out


def encoder(path: str) -> Encoder:
    """The process's encoder for a tokenizer file."""
    return per_process(("encoder", path), lambda: Encoder(path))
