"""Whole-text encoding with a tokenizer file, many texts at a time."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
from tokenizers import Tokenizer

#: Words of texts that ``Merges`` doesn't know kept in a worker; when there are more, none.
WORDS = 200_000
#: Characters and texts encoded at once (one longer text alone).
GROUP, GROUP_TEXTS = 1_000_000, 10_000
#: Slots for pieces met before, as a power of two, ids held for them, and the bytes of the longest such piece.
SLOTS, POOL, LONG = 21, 1 << 24, 32
#: str.split() parts words at these, the tokenizer's own white space does not include them.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Characters that ``Merges`` knows: ASCII white space, printable ASCII and the Latin letters of two bytes that no normal form changes.
_KNOWN = re.compile("[\\t-\\r -~À-ÖØ-öø-ÿ]*")
#: What a tokenizer must do before its merges for ``Merges`` to stand for it (fixed values of word-end BPE files).
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PROBES = ["a", "The", "ÀÉÎÕÜ", "àßçñöøÿ", "hello", "Straße", "niño", "zzqxv", "naïve", "ÆØÅ", 'end.,"', "it's", "'sx", "we'LL", "x'r", "''t", "a1b22", "%%%", "don't!!", "o'd'm"]

_encoders: dict[str, "Encoder"] = {}


class Merges:
    """Byte-pair merges of many pieces of text at once, in numpy.

    All pieces are one array of symbols, linked to their neighbours in a piece. A round
    makes the first merge of least rank in every piece that has one left; only the two pairs at
    each merged symbol are looked up again, in a hash table of two possible slots for a pair.
    """

    NONE = np.int64(1) << np.int64(62)
    FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
    SLOTS = 18

    def __init__(self, described: dict) -> None:
        model, vocab = described["model"], described["model"]["vocab"]
        suffix = model["end_of_word_suffix"]
        letter = _byte_letters()
        self.inner = np.array([vocab[letter[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letter[b] + suffix] for b in range(256)], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint64)
        self.table = self._slots(keys)
        kind = np.full(256, 3, np.uint8)  # 0 white space, 1 letter, 2 digit, 3 other
        kind[[9, 10, 11, 12, 13, 32]] = 0
        kind[ord("a") : ord("z") + 1] = 1
        kind[128:] = 1
        kind[ord("0") : ord("9") + 1] = 2
        self.kind = kind

    @staticmethod
    def suits(described: dict) -> bool:
        model, before = described["model"], described["pre_tokenizer"] or {}
        parts = before.get("pretokenizers", [])
        return (model["type"] == "BPE" and bool(model.get("end_of_word_suffix")) and not model.get("dropout") and len(model["vocab"]) < 1 << 16
                and described["normalizer"] == _NORMALIZER and [p["type"] for p in parts] == ["Split", "ByteLevel"]
                and parts[0]["pattern"] == {"Regex": _PATTERN} and parts[0]["invert"] and parts[0]["behavior"] == "Removed" and not parts[1]["add_prefix_space"])

    def _at(self, keys: np.ndarray, which: int) -> np.ndarray:
        return (keys * self.FACTORS[which]) >> np.uint64(64 - self.SLOTS)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """Each pair in one of its two slots, as pair << 16 | rank (cuckoo hashing)."""
        table = [None] * (1 << self.SLOTS)
        places = list(zip(self._at(keys, 0).tolist(), self._at(keys, 1).tolist()))
        for rank in range(len(keys)):
            now, at = rank, places[rank][0]
            for _ in range(500):
                now, table[at] = table[at], now
                if now is None:
                    break
                one, two = places[now]
                at = two if at == one else one
            else:
                raise ValueError("the pairs of this vocabulary find no slots")
        out = np.full(1 << self.SLOTS, -1, np.int64)
        for at, rank in enumerate(table):
            if rank is not None:
                out[at] = int(keys[rank]) << 16 | rank
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 16 | right
        hashed = key.view(np.uint64)
        one, two = self.table[self._at(hashed, 0)], self.table[self._at(hashed, 1)]
        found = np.where(one >> 16 == key, one, np.where(two >> 16 == key, two, -1))
        return np.where(found >= 0, found & 0xFFFF, self.NONE >> 32)

    def pieces(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of lower-cased text that are in pieces, and where each piece starts among these and among all."""
        kind = self.kind[data]
        first = np.empty(len(data), bool)
        first[:1] = True
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        self._contractions(data, kind, first)
        inside = kind != 0
        first &= inside
        return data[inside], np.flatnonzero(first[inside]), np.flatnonzero(first)

    def encode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that lie one after another in ``data``, and how many each has."""
        last = np.zeros(len(data), bool)
        last[starts[1:] - 1] = True
        last[-1:] = True
        symbols, alive = self._merge(np.where(last, self.last[data], self.inner[data]), starts, last)
        return symbols[alive], np.add.reduceat(alive, starts, dtype=np.int64)

    @staticmethod
    def _contractions(data: np.ndarray, kind: np.ndarray, first: np.ndarray) -> None:
        """An apostrophe that stands alone before s, t, m, d, re, ve or ll takes these into its piece."""
        at = np.flatnonzero((data[:-2] == 39) & (kind[1:-1] == 1) & first[:-2])
        if not len(at):
            return
        one, two = data[at + 1], data[at + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for chosen, size in ((short, 2), (long, 3)):
            first[at[chosen] + 1] = False
            behind = at[chosen] + size
            first[behind[kind[behind] == 1]] = True

    def _merge(self, symbols: np.ndarray, starts: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(symbols)
        symbols = np.append(symbols, 0xFFFF)  # behind all: stands for no neighbour
        after = np.arange(1, n + 2)
        after[:n][last] = n
        before = np.arange(-1, n)
        before[starts] = n
        before[n] = n
        alive = np.ones(n + 1, bool)
        alive[n] = False
        order = np.full(n + 1, self.NONE, np.int64)
        rank = self._ranks(symbols[:n], symbols[after[:n]])
        order[:n] = rank << 32 | np.arange(n)
        ends = np.append(starts[1:], n)
        while len(starts):
            # pieces one behind another: even places of the bounds are pieces, odd ones what lies between them
            bounds = np.column_stack([starts, ends]).ravel()
            least = np.minimum.reduceat(order, bounds)[::2]
            some = least < self.NONE
            starts, ends, least = starts[some], ends[some], least[some]
            at, rank = least & 0xFFFFFFFF, least >> 32
            gone = after[at]
            alive[gone] = False
            order[gone] = self.NONE
            behind = after[gone]
            symbols[at] = self.made[rank]
            after[at] = behind
            before[behind] = at
            ahead = before[at]
            order[at] = self._ranks(symbols[at], symbols[behind]) << 32 | at
            order[ahead] = self._ranks(symbols[ahead], symbols[at]) << 32 | ahead
            order[n] = self.NONE
        return symbols[:n], alive[:n]


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Seen:
    """Ids of pieces met before, of at most ``LONG`` bytes; a table of fixed size.

    A piece has one slot by a 64-bit hash, and a later piece may take it, which only costs the merges of the former
    again. The bytes of a piece are held, too, and a piece that is met is compared with them.
    """

    def __init__(self) -> None:
        numbers = np.random.default_rng(20_011)
        self.numbers = numbers.integers(0, 1 << 64, (LONG << 8,), np.uint64, endpoint=False)
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(1 << SLOTS, np.uint64)
        self.at = np.zeros(1 << SLOTS, np.int64)
        self.size = np.zeros(1 << SLOTS, np.uint8)
        self.ids = np.zeros(POOL, np.uint16)
        self.used = 0
        self.text_at = np.zeros(1 << SLOTS, np.int64)
        self.length = np.zeros(1 << SLOTS, np.uint8)
        self.text = np.zeros(POOL, np.uint8)
        self.text_used = 0

    def hashes(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        place = np.arange(len(data)) - np.repeat(starts, sizes)
        np.minimum(place, LONG - 1, out=place)
        return np.add.reduceat(self.numbers[place << 8 | data], starts) | np.uint64(1)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - SLOTS)).astype(np.int64)

    def holds(self, hashes: np.ndarray, slots: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which pieces are those of their slots, by all their bytes."""
        held = (self.key[slots] == hashes) & (self.length[slots] == sizes) & (sizes <= LONG)
        at = np.flatnonzero(held)
        held[at] = _same_bytes(data, starts[at], self.text, self.text_at[slots[at]], sizes[at])
        return held

    def put(self, ids: np.ndarray) -> int:
        """Hold more ids; returns where they start."""
        at, self.used = self.used, self.used + len(ids)
        if self.used > len(self.ids):
            self.ids = np.resize(self.ids, max(self.used, len(self.ids) + POOL // 4))
        self.ids[at : self.used] = ids
        return at

    def name(self, hashes: np.ndarray, at: np.ndarray, sizes: np.ndarray, text: np.ndarray, lengths: np.ndarray) -> None:
        """Give pieces of held ids and of these bytes their slots; of two with one slot, one gets it."""
        slots, one = np.unique(self.slots(hashes), return_index=True)
        self.key[slots], self.at[slots], self.size[slots] = hashes[one], at[one], sizes[one]
        start, self.text_used = self.text_used, self.text_used + len(text)
        if self.text_used > len(self.text):
            self.text = np.resize(self.text, max(self.text_used, len(self.text) + POOL // 4))
        self.text[start : self.text_used] = text
        self.text_at[slots], self.length[slots] = (start + np.cumsum(lengths) - lengths)[one], lengths[one]

    def full(self) -> bool:
        return max(self.used, self.text_used) > POOL


def _same_bytes(one: np.ndarray, at: np.ndarray, two: np.ndarray, other: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the ``sizes`` bytes (one at least) from each place of one array are those from a place of another."""
    if not len(sizes):
        return np.zeros(0, bool)
    return np.logical_and.reduceat(one[_ragged(at, sizes)] == two[_ragged(other, sizes)], np.cumsum(sizes) - sizes)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each size, one after another."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Encoder:
    """Encodes texts into ids, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    If the file describes the steps that ``Merges`` stands for and probes agree, texts of the characters
    that it knows are cut into pieces a group at a time, in numpy. Pieces met before are looked
    up, the others merged together. Other texts go to the tokenizer: by words that are kept, where it drops
    white space and cuts nothing across it (``by_word``), else whole.
    """

    def __init__(self, path: str, by_word: bool = True) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.by_word = by_word
        self.words: dict[str, bytes] = {}
        self.seen, self.merges = Seen(), None
        if by_word:
            with open(path, encoding="utf-8") as file:
                described = json.load(file)
            if Merges.suits(described):
                self.merges = Merges(described)
                if any(found.tobytes() != self._whole(probe) for probe, found in zip(_PROBES, self._known(_PROBES))):
                    self.merges = None

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _by_word(self, text: str) -> bytes:
        words = text.split()
        # a mark may act on the space before it
        if not self.by_word or _ODD_SPACE.search(text) or "<|" in text or any(not w[0].isascii() and unicodedata.category(w[0])[0] == "M" for w in words):
            return self._whole(text)
        out = []
        for word in words:
            ids = self.words.get(word)
            if ids is None:
                if len(self.words) >= WORDS:
                    self.words.clear()
                ids = self.words[word] = self._whole(word)
            out.append(ids)
        return b"".join(out)

    def _known(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts of known characters."""
        parts = [t.lower().encode() for t in texts]
        ends = np.cumsum([len(p) + 1 for p in parts])
        data, starts, where = self.merges.pieces(np.frombuffer(b"\n".join(parts) + b"\n", np.uint8))
        if not len(starts):
            return [np.zeros(0, np.uint32)] * len(texts)
        sizes = np.diff(starts, append=len(data))
        hashes = self.seen.hashes(data, starts, sizes)
        slots = self.seen.slots(hashes)
        new = np.flatnonzero(~self.seen.holds(hashes, slots, data, starts, sizes))
        n_ids, at = self.seen.size[slots].astype(np.int64), self.seen.at[slots]
        if len(new):
            # each long piece for itself, of the others one of each hash
            long = sizes[new] > LONG
            mark = np.where(long, new.astype(np.uint64) << np.uint64(1), hashes[new])  # hashes are odd
            _, one, back = np.unique(mark, return_index=True, return_inverse=True)
            like = new[one[back]]
            other = sizes[like] != sizes[new]
            other[~other] = ~_same_bytes(data, starts[new[~other]], data, starts[like[~other]], sizes[new[~other]])
            if other.any():  # two texts of one hash: each for itself, without a slot
                long |= other
                mark = np.where(long, new.astype(np.uint64) << np.uint64(1), hashes[new])
                _, one, back = np.unique(mark, return_index=True, return_inverse=True)
            chosen, short = new[one], ~long[one]
            text = data[_ragged(starts[chosen], sizes[chosen])]
            ids, found = self.merges.encode(text, np.cumsum(sizes[chosen]) - sizes[chosen])
            places = self.seen.put(ids) + np.cumsum(found) - found
            n_ids[new], at[new] = found[back], places[back]
            kept = chosen[short]
            self.seen.name(hashes[kept], places[short], found[short], text if short.all() else data[_ragged(starts[kept], sizes[kept])], sizes[kept])
        flat = self.seen.ids[_ragged(at, n_ids)].astype("<u4")
        if self.seen.full():
            self.seen.clear()
        bounds = np.append(0, np.cumsum(n_ids))[np.searchsorted(where, ends)]
        return np.split(flat, bounds[:-1])

    def _group(self, texts: list[str | None]) -> list[np.ndarray]:
        known = [i for i, t in enumerate(texts) if t and self.merges is not None and _KNOWN.fullmatch(t) and "<|" not in t]
        out: list = [None] * len(texts)
        if known:
            for i, ids in zip(known, self._known([texts[i] for i in known])):
                out[i] = ids
        return [np.frombuffer(self._by_word(t) if t else b"", "<u4") if ids is None else ids for t, ids in zip(texts, out)]

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, unsigned 32-bit; none for a null or empty text."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size >= GROUP or len(group) >= GROUP_TEXTS:
                yield from self._group(group)
                group, size = [], 0
        if group:
            yield from self._group(group)

    def encode(self, text: str | None) -> bytes:
        return self._group([text])[0].tobytes()


def encoder(path: str, by_word: bool = True) -> Encoder:
    """This worker's encoder of a file."""
    key = f"{path}:{by_word}"
    if key not in _encoders:
        _encoders[key] = Encoder(path, by_word)
    return _encoders[key]


def vocabulary_size(path: str) -> int:
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
