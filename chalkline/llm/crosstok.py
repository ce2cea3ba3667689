"""Alignment of two tokenizers over the same bytes.

Each text is encoded by a byte-level BPE file (A) and a sentence-piece model (B). The last byte of every
token is a bit in one packed bitset for A and one for B. Their AND holds the shared cuts; a prefix sum of
popcounts ranks a cut among the tokens of either side, so two neighbouring cuts name the range of A tokens
and the range of B tokens between them: a group. Every A token of a group is linked to every B token of it.

Corpus counts: how many documents hold an id pair linked. A task adds its documents up to one count for
each of its distinct pairs; only these are shuffled. The totals return to the task's part as answers in
its own folder (``parts``), and the kept links of each document are looked up there. So a pair that
nearly all documents hold is one row a task, and links themselves are never shuffled.

Words of a text that holds no odd white space are encoded once and kept: neither side has a token that spans the
space between two of them (A's pattern cuts there; B has no piece with an inner word mark, which is checked). Other texts are encoded whole.
Bytes of A are its entries decoded, those of B its pieces with U+2581 as space.

Edge cases: a null or empty text, and one whose tokens don't give back space + text (such as one that holds U+2581), has
no tokens: all counts are zero, and the groups are empty. Repeated rows are documents of their own, and each counts; ids may be null
or of any type. A very long text is encoded at once by one task; a group of many tokens is expanded by its distinct ids, not
by occurrences. An empty table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import session, ship, written
from .parts import Answers, keep

#: How texts are cut before A's merges (a fixed value of such files).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words kept in a worker; when there are more, none. Characters of texts that are aligned at once (one longer text alone).
WORDS, GROUP = 250_000, 700_000
#: Links of a group up to which they are expanded one by one; distinct pairs in a row of a part's counts.
SIMPLE, ROW = 64, 200_000
#: Pairs that wait for being counted together.
WAITING = 2_000_000
#: Where a space may not part two words: beside other white space, at the ends, and where B's own mark is.
_ODD = re.compile("\\A | \\Z|\\s |▁")

_tokenizers: dict[tuple[str, str], "Pair"] = {}


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each size, one after another."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Pair:
    """Two tokenizers and the bytes of their ids."""

    def __init__(self, a_file: str, b_file: str) -> None:
        with open(a_file, encoding="utf-8") as file:
            described = json.load(file)
        letters = _byte_letters()
        special = {t["id"] for t in described["added_tokens"]}
        ranks = {bytes(letters[c] for c in entry): n for entry, n in described["model"]["vocab"].items() if n not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.a_bytes = [b""] * (max(described["model"]["vocab"].values()) + 1)
        for entry, n in ranks.items():
            self.a_bytes[n] = entry
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)]
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        names = [str(n).encode() for n in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.name_sizes = np.array([len(x) for x in names], np.int64)
        self.width = max(map(len, names)) + 1  # decimal digits and what follows them
        self.names = np.frombuffer(b"".join(x.ljust(self.width, b",") for x in names), np.uint8).reshape(-1, self.width)
        self.memo_a: dict[str, bytes] = {}
        self.memo_b: dict[str, bytes] = {}
        self.unequal: set[str] = set()

    def _equal(self, text: str, a: list[int], b: list[int]) -> bool:
        wanted = f" {text}".encode()
        return b"".join([self.a_bytes[n] for n in a]) == wanted and b"".join([self.b_bytes[n] for n in b]) == wanted

    def _learn(self, words: list[str]) -> None:
        if len(self.memo_a) + len(words) > WORDS:
            for held in (self.memo_a, self.memo_b, self.unequal):
                held.clear()
        for word, b in zip(words, self.b.encode(words, num_threads=1)):
            a = self.a.encode_ordinary(f" {word}")
            if not self._equal(word, a, b):
                self.unequal.add(word)
            self.memo_a[word], self.memo_b[word] = np.array(a, "<i4").tobytes(), np.array(b, "<i4").tobytes()

    def _whole(self, text: str) -> tuple[bytes, bytes]:
        a, b = self.a.encode_ordinary(f" {text}"), self.b.encode(text)
        return (np.array(a, "<i4").tobytes(), np.array(b, "<i4").tobytes()) if self._equal(text, a, b) else (b"", b"")

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Ids of both sides of each text, little-endian 32-bit; none where a text has no tokens."""
        plain = {n: t.split(" ") for n, t in enumerate(texts) if t and self.by_word and not _ODD.search(t)}
        new = set().union(*plain.values()) - self.memo_a.keys()
        if new:
            wanted = set().union(*plain.values())
            if len(self.memo_a) + len(new) > WORDS:  # begins anew, with all that this call needs
                new = wanted
            self._learn(list(new))
        out = []
        for n, text in enumerate(texts):
            words = plain.get(n)
            if words is None:
                out.append(self._whole(text) if text else (b"", b""))
            elif self.unequal and not self.unequal.isdisjoint(words):
                out.append(self._whole(text))
            else:
                out.append((b"".join(map(self.memo_a.__getitem__, words)), b"".join(map(self.memo_b.__getitem__, words))))
        return out


def pair(a_file: str, b_file: str) -> Pair:
    """This worker's tokenizers."""
    if (a_file, b_file) not in _tokenizers:
        _tokenizers[a_file, b_file] = Pair(a_file, b_file)
    return _tokenizers[a_file, b_file]


class Bits:
    """A packed bitset with rank."""

    def __init__(self, positions: np.ndarray, size: int) -> None:
        flags = np.zeros(-(-size // 64) * 64, bool)
        flags[positions] = True
        self.words = np.packbits(flags, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def rank(self, positions: np.ndarray) -> np.ndarray:
        """How many bits are set at or before each position."""
        at = positions >> 6
        upto = ~np.uint64(0) >> (63 - (positions & 63)).astype(np.uint64)
        return self.before[at] + np.bitwise_count(self.words[at] & upto)


def _selected(words: np.ndarray) -> np.ndarray:
    """Positions of the set bits."""
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


class Aligned:
    """The groups of some texts, laid one behind another."""

    def __init__(self, own: Pair, texts: list[str | None]) -> None:
        self.own = own
        coded = own.encode(texts)
        self.n_a, self.n_b = (np.array([len(c[side]) >> 2 for c in coded], np.int64) for side in (0, 1))
        self.a, self.b = (np.frombuffer(b"".join([c[side] for c in coded]), "<i4").astype(np.int64) for side in (0, 1))
        ends_a, ends_b = np.cumsum(own.a_sizes[self.a]), np.cumsum(own.b_sizes[self.b])
        size = int(ends_a[-1]) if len(ends_a) else 0
        bits_a, bits_b = Bits(ends_a - 1, size), Bits(ends_b - 1, size)
        cuts = _selected(bits_a.words & bits_b.words)
        # tokens of either side before each group, and behind the last one
        self.from_a, self.from_b = (np.append(0, bits.rank(cuts)) for bits in (bits_a, bits_b))
        # the end of a text is a shared cut
        last = np.cumsum(self.n_a)
        self.groups_before = np.searchsorted(self.from_a, last - self.n_a)
        self.n_groups = np.searchsorted(self.from_a, last) - self.groups_before
        self.size_a, self.size_b = np.diff(self.from_a), np.diff(self.from_b)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Links of each text, and of each group."""
        each = self.size_a * self.size_b
        sums = np.append(0, np.cumsum(each))
        return sums[self.groups_before + self.n_groups] - sums[self.groups_before], each

    def pairs(self, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked id pairs of each text (a * base + b), how often each is linked, and where each text's begin."""
        n_texts = len(self.n_a)
        text_of = np.repeat(np.arange(n_texts), self.n_groups)
        each = self.size_a * self.size_b
        simple = np.flatnonzero(each <= SIMPLE)
        at = np.repeat(simple, each[simple])
        place = np.arange(len(at)) - np.repeat(np.cumsum(each[simple]) - each[simple], each[simple])
        in_a, in_b = np.divmod(place, self.size_b[at])
        keys = [text_of[at] << 32 | self.a[self.from_a[at] + in_a] * base + self.b[self.from_b[at] + in_b]]
        times = [np.ones(len(at), np.int64)]
        for g in np.flatnonzero(each > SIMPLE):
            one, of_one = np.unique(self.a[self.from_a[g] : self.from_a[g + 1]], return_counts=True)
            two, of_two = np.unique(self.b[self.from_b[g] : self.from_b[g + 1]], return_counts=True)
            keys.append((text_of[g] << 32 | one[:, None] * base + two).ravel())
            times.append((of_one[:, None] * of_two).ravel())
        if len(keys) == 1:
            found, n = np.unique(keys[0], return_counts=True)
        else:
            found, back = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.zeros(len(found), np.int64)
            np.add.at(n, back, np.concatenate(times))
        return found & 0xFFFFFFFF, n, np.searchsorted(found >> 32, np.arange(n_texts + 1))

    def written(self) -> list[bytes]:
        """Groups of each text as decimal ids, ``a1,a2|b1;a3|b2,b3``."""
        own = self.own
        # a group's A tokens stand before its B tokens
        place_a = np.arange(len(self.a)) + np.repeat(self.from_b[:-1], self.size_a)
        place_b = np.arange(len(self.b)) + np.repeat(self.from_a[1:], self.size_b)
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        ids[place_a], ids[place_b] = self.a, self.b
        sizes = own.name_sizes[ids] + 1
        rows = own.names[ids]
        rows_flat = rows.reshape(-1)
        end = np.arange(len(ids)) * own.width + sizes - 1
        rows_flat[end] = ord(",")
        rows_flat[end[self.from_a[1:] + self.from_b[:-1] - 1]] = ord("|")
        rows_flat[end[self.from_a[1:] + self.from_b[1:] - 1]] = ord(";")
        text = rows[np.arange(own.width) < sizes[:, None]].tobytes()
        bounds = np.append(0, np.cumsum(sizes))
        ends = np.cumsum(self.n_a + self.n_b)
        return [text[bounds[e - n] : max(bounds[e] - 1, bounds[e - n])] if n else b"" for e, n in zip(ends.tolist(), (self.n_a + self.n_b).tolist())]


def _grouped(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for n, text in enumerate(texts):
        size += len(text or "")
        if size >= GROUP:
            yield start, n + 1
            start, size = n + 1, 0
    if start < len(texts):
        yield start, len(texts)


class Counts:
    """How many of a task's documents hold each pair."""

    def __init__(self) -> None:
        self.pairs, self.docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, pairs: np.ndarray) -> None:
        self.waiting.append(pairs)
        self.size += len(pairs)
        if self.size >= WAITING:
            self.settle()

    def settle(self) -> None:
        found, n = np.unique(np.concatenate([*self.waiting, np.zeros(0, np.int64)]), return_counts=True)
        both, back = np.unique(np.concatenate([self.pairs, found]), return_inverse=True)
        docs = np.zeros(len(both), np.int64)
        np.add.at(docs, back, np.concatenate([self.docs, n]))
        self.pairs, self.docs, self.waiting, self.size = both, docs, [], 0


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))


def groups(docs: DataFrame, a_file: str, b_file: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment of each text: id, ids of both sides, and for each group the number of A and of B tokens up to its end."""
    ship(session(docs))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pair(a_file, b_file)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in _grouped(texts):
                found = Aligned(own, texts[start:end])
                starts_a, starts_b = (np.append(0, np.cumsum(n)) for n in (found.n_a, found.n_b))
                begin = np.append(0, np.cumsum(found.n_groups))
                text_of = np.repeat(np.arange(end - start), found.n_groups)
                upto = [_lists((f[1:] - s[text_of]).astype(np.int32), begin, pa.int32()) for f, s in ((found.from_a, starts_a), (found.from_b, starts_b))]
                columns = [batch.column(0).slice(start, end - start), _lists(found.a, starts_a, pa.int32()), _lists(found.b, starts_b, pa.int32()), *upto]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "a_ids", "b_ids", "a_ends", "b_ends"])

    chosen = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(work, f"id {kind}, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>").withColumnRenamed("id", id_col)


def link_statistics(docs: DataFrame, a_file: str, b_file: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link's count is the number of documents that hold its id pair linked; ``n_best`` counts links whose count
    is the highest of all pairs of their A id, ``count_sum`` adds the counts of all links. The driver takes one number for each
    A id, which the vocabulary bounds.
    """
    spark = session(docs)
    ship(spark)
    base = sentencepiece.SentencePieceProcessor(model_file=b_file).get_piece_size()
    chosen = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.spark_partition_id().cast("long").alias("part"))
    kind = chosen.schema["id"].dataType.simpleString()
    names = ["id", "part", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    schema = f"id {kind}, part long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts, part, id_kind = pair(a_file, b_file), Counts(), None, None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if not len(batch):
                continue
            part, id_kind = batch.column(2)[0].as_py(), batch.column(0).type  # one task is one part
            for start, end in _grouped(texts):
                found = Aligned(own, texts[start:end])
                pairs, times, begin = found.pairs(base)
                counts.add(pairs)
                digests = [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(found.written(), found.n_a.tolist())]
                longs = [pa.array(c, pa.int64()) for c in (found.n_a, found.n_b, found.n_groups, found.links()[0])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), batch.column(2).slice(start, end - start), *longs, pa.array(digests, pa.string()),
                                                  _lists(pairs, begin, pa.int64()), _lists(times, begin, pa.int64())], names=names)
        counts.settle()
        for at in range(0, len(counts.pairs), ROW):  # the part's own counts, told by a null n_a
            p, d = counts.pairs[at : at + ROW], counts.docs[at : at + ROW]
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(1, id_kind), pa.array([part], pa.int64()), none, none, none, none, pa.nulls(1, pa.string()),
                                              _lists(p, np.array([0, len(p)]), pa.int64()), _lists(d, np.array([0, len(d)]), pa.int64())], names=names)

    rows = written(chosen.mapInArrow(align, schema), "aligned")
    own_counts = rows.where("n_a is null").select("part", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "own"))
    totals = own_counts.select("part", "pair", F.sum("own").over(Window.partitionBy("pair")).alias("docs"))
    answers = keep(totals, "part", "pair-counts")
    counted = spark.read.schema("pair long, docs long, part long").parquet(answers)
    highest = counted.groupBy(F.expr(f"pair div {base}").alias("a")).agg(F.max("docs").alias("docs")).collect()
    top = np.zeros(max((r.a for r in highest), default=0) + 1, np.int64)
    for r in highest:
        top[r.a] = r.docs

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Answers(answers, "part")

        def build(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            pairs, docs_ = (table.column(c).to_numpy() for c in ("pair", "docs"))
            order = np.argsort(pairs)
            return pairs[order], docs_[order]

        for batch in batches:
            n = len(batch)
            best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
            parts = batch.column("part").to_numpy()
            runs = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])) if n else []
            for start, end in zip(runs, np.append(runs[1:], n)):
                some = batch.slice(start, end - start)
                pairs, times = some.column("pairs"), some.column("times")
                flat, weights = pairs.flatten().to_numpy(), times.flatten().to_numpy()
                if not len(flat):
                    continue
                all_pairs, all_docs = known.of(int(parts[start]), build)
                docs_ = all_docs[np.searchsorted(all_pairs, flat)]
                bounds = np.append(0, np.cumsum(pairs.value_lengths().to_numpy()))
                for out, value in ((best, weights * (docs_ == top[flat // base])), (total, weights * docs_)):
                    upto = np.append(0, np.cumsum(value))
                    out[start:end] = upto[bounds[1:]] - upto[bounds[:-1]]
            kept = [batch.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(best), pa.array(total), batch.column("groups_sha256")], names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    found = rows.where("n_a is not null").mapInArrow(sums, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return found.withColumnRenamed("id", id_col)
