"""Token alignment, exact dedup and conversation repair against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, decoders

from chalkline.llm import convfix, crosstok, exactdup, queries

from .conftest import sentence

FILES = [public_tokenizers.path(n) for n in queries.ALIGNED]
ODD = [None, "", " ", "x", "a  b", " lead", "trail ", "tab\tx \n y", "é ½ ﬁ", "日本語 テスト", "▁mark", "<|endoftext|> <s>x</s>", "<0x41>", "a\x00b", "a b c", "\n\n \n", "don't DON'T it's'", "x" * 3000, "\t" * 400 + "a" + " " * 400,
       "a\x1cb \x1cc", "word " * 300, "1234567890 3.14"]


# ---- alignment


def spelled(tokenizer, side, ids):
    if side == "a":  # one id at a time, as bytes: the decoder's letters
        letters = {c: b for c, b in crosstok._byte_letters().items()}
        return [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in ids]
    return [bytes([int(p[3:5], 16)]) if tokenizer.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, tokenizer.id_to_piece(i)) for i in ids)]


def brute_groups(a, b, text):
    if not text:
        return None
    ids_a, ids_b = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
    parts_a, parts_b = spelled(a, "a", ids_a), spelled(b, "b", ids_b)
    if not b"".join(parts_a) == b"".join(parts_b) == f" {text}".encode():
        return None
    groups, at_a, at_b, i, j = [([], [])], 0, 0, 0, 0
    while i < len(ids_a) or j < len(ids_b):
        if at_a <= at_b:
            groups[-1][0].append(ids_a[i])
            at_a, i = at_a + len(parts_a[i]), i + 1
        else:
            groups[-1][1].append(ids_b[j])
            at_b, j = at_b + len(parts_b[j]), j + 1
        if at_a == at_b and (i < len(ids_a) or j < len(ids_b)):
            groups.append(([], []))
    return groups


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def expected_links(sides, texts):
    groups = [brute_groups(*sides, t) for t in texts]
    links = [Counter((p, q) for x, y in g or [] for p in x for q in y) for g in groups]
    docs = Counter(pair for found in links for pair in found)
    top = {}
    for (p, _), n in docs.items():
        top[p] = max(top.get(p, 0), n)
    out = []
    for g, found in zip(groups, links):
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        out.append((sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), sum(found.values()), sum(n for k, n in found.items() if docs[k] == top[k[0]]),
                    sum(n * docs[k] for k, n in found.items()), hashlib.sha256(told.encode()).hexdigest() if g else ""))
    return out


def test_link_statistics_equal_brute_force(spark, make, sides):
    rng = random.Random(3)
    texts = ODD + ["hot words here."] * 40 + [sentence(rng, rng.randint(1, 60)) for _ in range(30)] + [sentence(rng, 20_000)]
    rows = [(n if n % 7 else None, t) for n, t in enumerate(texts)]
    got = crosstok.link_statistics(make(rows).repartition(5), *FILES)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = sorted((str(r[0]), *e) for r, e in zip(rows, expected_links(sides, texts)))
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got.collect()) == want
    assert crosstok.link_statistics(make([]), *FILES).count() == 0
    named = make([(1, "a b")]).selectExpr("string(doc_id) as name", "text as body", "1 as part", "2 as pairs")
    assert crosstok.link_statistics(named, *FILES, id_col="name", text_col="body").first().name == "1"


def test_groups_are_the_shared_cuts(spark, make, sides):
    texts = [t for t in ODD] + ["The quick brown fox, unaffordable."]
    for row in crosstok.groups(make(list(enumerate(texts))), *FILES).collect():
        want = brute_groups(*sides, texts[row.doc_id])
        cut = lambda ids, ends: [ids[s:e] for s, e in zip([0, *ends], ends)]
        assert list(zip(cut(row.a_ids, row.a_ends), cut(row.b_ids, row.b_ends))) == [tuple(g) for g in want or []]


def test_memo_that_overflows_changes_nothing(monkeypatch):
    monkeypatch.setattr(crosstok, "WORDS", 3)
    own, fresh = crosstok.Pair(*FILES), crosstok.Pair(*FILES)
    for text in ["a b c d e f", "c d", "x y z a", "▁ a", "f e d c b a"]:
        assert own.encode([text, "q r"]) == [fresh._whole(text), fresh._whole("q r")]


def test_pieces_give_the_bytes_that_decoders_give(sides):
    text = "Ünïcode test, 12 x."
    ids = sides[0].encode(f" {text}", add_special_tokens=False).ids
    assert b"".join(spelled(sides[0], "a", ids)).decode() == decoders.ByteLevel().decode([sides[0].id_to_token(i) for i in ids]) == f" {text}"


# ---- exact dedup


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("seed", range(3))
def test_golomb_round_trip(seed):
    rng = np.random.default_rng(seed)
    bounds = exactdup.owner_bounds(7)
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        for n in (1, 2, 1000):
            values = np.unique(np.append(rng.integers(low, high, n), np.array([low, high - 1][:seed], np.int64)))
            shift, coded = exactdup.encode(values, low, high)
            assert (exactdup.decode(coded, len(values), shift, low) == values).all()
    dense = np.arange(500)
    shift, coded = exactdup.encode(dense, 0, 500)
    assert shift == 0 and (exactdup.decode(coded, 500, shift, 0) == dense).all() and len(coded) == 125  # two bits a value
    spread = np.unique(rng.integers(0, 1 << 48, 60_000))
    assert len(exactdup.encode(spread, 0, 1 << 48)[1]) * 8 / len(spread) < 48 - np.log2(len(spread)) + 2


@pytest.mark.parametrize("bits", [48, 6])
def test_groups_equal_brute_force(spark, make, monkeypatch, bits):
    monkeypatch.setattr(exactdup, "BITS", bits)  # few bits: many suspects that the bytes clear
    rows = [(1, "a  b"), (2, "a b"), (2, "a b"), (3, None), (None, ""), (None, "a\tb"), (9, " "), (10, "\n"), (11, " \r\n"), (4, "zz"), (None, "only"), (None, "only"), (12, "long " * 30_000), (13, "long  " * 30_000),
            (14, "a\x0bb"), (15, "a b"), *[(100 + i, "hot") for i in range(300)], *[(1000 + i, f"t {i % 70}") for i in range(90)]]
    found = exactdup.exact_groups(make(rows).repartition(7)).collect()
    sets: dict[str, list] = {}
    for i, t in rows:
        sets.setdefault(normal(t), []).append(i)
    want = [(i, min((v for v in sets[normal(t)] if v is not None), default=None), len(sets[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest()) for i, t in rows]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in found)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in kept}) == len(sets) and all(r.doc_id == r.keep_id for r in kept)
    made = make(rows)
    left = exactdup.drop_copies(made)
    assert left.columns == made.columns and left.count() == len(sets)
    assert exactdup.exact_groups(make([])).count() == 0


def test_string_ids_and_own_names(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y")], "key string, body string").selectExpr("*", "1 as part", "2 as code", "3 as sha")
    got = {r.key: (r.keep_id, r.kept) for r in exactdup.exact_groups(df, id_col="key", text_col="body").collect()}
    assert got == {"a": ("a", True), "b": ("a", False), "c": ("c", True)}


# ---- conversation repair


def brute_repair(rows):
    """Reports of (conv, turn, role, text) rows as they are: every path, by states."""
    want = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    convs: dict = {}
    for conv, *rest in rows:
        convs.setdefault(conv, [])
        if rest[0] != "dropped":
            convs[conv].append(rest)
    out = {}
    for conv, turns in convs.items():
        turns = sorted(turns, key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        faults, seen = [], set()
        for _, role, text in turns:
            shown = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(turns, turns[1:]))

        def inserted(paths):
            for _ in range(4):
                for state, (cost, audit, said) in list(paths.items()):
                    role = want[state]
                    new = (cost + 3, audit + "I", [*said, (role, "")])
                    if role[0] not in paths or new[:2] < paths[role[0]][:2]:
                        paths[role[0]] = new
            return paths

        paths = inserted({"": (0, "", [])})
        for (_, role, text), fault in zip(turns, faults):
            after: dict = {}

            def put(state, path):
                if state not in after or path[:2] < after[state][:2]:
                    after[state] = path

            for state, (cost, audit, said) in paths.items():
                put(state, (cost + 4, audit + "D", said))
                if fault in ("blank", "duplicate"):
                    continue
                more = 3 * (fault == "truncated")
                put(want[state][0], (cost + 3 + more, audit + "R", [*said, (want[state], text)]))
                if role[:1] and state + role[:1] in ("s", "u", "su", "ua", "au"):
                    put(role[0], (cost + more, audit + "K", [*said, (role, text)]))
            paths = inserted(after)
        cost, audit, said = min((paths[s] for s in ("", "a") if s in paths), key=lambda v: v[:2])
        out[conv] = (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest())
    return out


def damaged_rows(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, "dropped" if kind == 0 else turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def conversations(rng, n, hot):
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            rows.append((rng.choice([conv, conv, conv, None]), rng.choice([turn, turn, turn, None]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(["Hi.", "ok", "x y!", " \t", None, "what?", f"q{rng.randint(0, 9)}."])))
    rows += [(9999, turn, rng.choice(["user", "assistant", "assistant"]), rng.choice([f"Hi {rng.randint(0, hot)}.", "Same."])) for turn in range(hot)]
    return rows


@pytest.mark.parametrize("seed, hot", [(0, 0), (1, 1500), (2, 6000)])
def test_repair_equals_brute_force(spark, seed, hot):
    rows = conversations(random.Random(seed), 50, hot)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as pos", "'x' as audit", "2 as conv").repartition(5)
    want = brute_repair(damaged_rows(rows))
    got = {r.conv_id: tuple(r)[1:] for r in convfix.repair(convfix.damaged(df), present_col="present").collect()}
    assert got == want
    said: dict = {}
    turns = convfix.repair(convfix.damaged(df), present_col="present", turns=True)
    for r in sorted(turns.collect(), key=lambda r: (str(r.conv_id), r.n)):
        said.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(said.get(c, [])).encode()).hexdigest() == e[-1] for c, e in want.items())


def test_small_blocks_choose_the_same_path(spark, monkeypatch):
    monkeypatch.setattr(convfix, "BLOCK", 3)
    rng = random.Random(8)
    for _ in range(60):
        turns = [(n, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b.", "c", "", f"{n}!"])) for n in range(rng.randint(0, 14))]
        seen, judged = set(), []
        for turn, role, text in turns:
            judged.append((turn, role, text, convfix.fault_of(text, (role, text) in seen)))
            seen.add((role, text))
        found, _ = convfix.report([convfix.Block(b, False) for b in convfix._blocks(judged)])
        assert found == brute_repair([("c", *t) for t in turns] or [("c", "dropped", "", "")])["c"]


def test_repair_of_edges(spark):
    ddl = "conv_id string, turn int, role string, text string"
    assert convfix.repair(spark.createDataFrame([], ddl)).count() == 0
    long_text = "word " * 400_000 + "end."
    got = {r.conv_id: r for r in convfix.repair(spark.createDataFrame([("a", 1, "user", long_text), ("a", 2, "assistant", "Ok."), ("b", 5, "user", "Same."), ("b", 5, "user", "Same.")], ddl)).collect()}
    assert (got["a"].cost, got["a"].audit) == (0, "KK") and got["a"].repaired_sha256 == hashlib.sha256(f"user:{long_text}\nassistant:Ok.".encode()).hexdigest()
    assert (got["b"].duplicate, got["b"].cost, got["b"].audit, got["b"].gaps) == (1, 7, "KDI", 0)
