"""Phrases, token counts and conversation tries against plain Python and the library."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import phrases, token_counts, turn_trie
from millrace.llm.radix import RadixTree
from millrace.llm.queries import BYTE_BPE
from tests.llm import brute
from tests.llm.test_contracts import edge_dir, result, rows_of, sf_dir  # noqa: F401


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE_BPE)


def test_token_counts(spark, sf_dir, byte_library):  # noqa: F811
    want = []
    for i, t in rows_of(spark, sf_dir, "doc_id", "text"):
        n = len(byte_library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    assert sorted(tuple(r) for r in result(spark, sf_dir, "op13_token_counts")) == sorted(want)


@pytest.mark.parametrize("hot", [400_000, 20, 1])
def test_token_counts_on_every_path(spark, byte_library, hot):
    """Hot and other pre-tokens, long ones, special strings, null ids, repeated rows and clashing columns."""
    texts = [None, "", "the cat " * 9, "x" * 5000, "y" * 64 + " " + "z" * 63, "a<|endoftext|>b <|endoftext|>", "é\u0085 ½ \x1c漢字　かな 12", "x" * 5000, "don't we'll  \n\n IT'S  "]
    rows = [(None if i % 4 == 0 else i // 2, t, 1, 2, 3) for i, t in enumerate(texts * 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row int, key int, tokens int")
    got = [tuple(r) for r in token_counts.token_counts(docs, BYTE_BPE, limit=10, hot=hot).collect()]
    want = [(r[0], len((r[1] or "").encode()), n := len(byte_library.encode(r[1] or "", add_special_tokens=False).ids), n > 10) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_pre_tokens_are_the_librarys(byte_library):
    """Every character below U+0250 beside letters, numbers, marks and blanks, and random texts beyond."""
    known = token_counts.ByteLevel(BYTE_BPE)
    part = lambda t: [t[a:b] for _, (a, b) in byte_library.pre_tokenizer.pre_tokenize_str(t)]
    for c in map(chr, range(0x250)):
        for text in (c, f"a{c}a", f" {c} {c}{c}", f"1{c}1", f"!{c}!", f"'{c}'s", f"{c}\n", f"\t{c}  {c}\xa0"):
            assert known._parted(text) == part(text), (hex(ord(c)), text)
    draw = random.Random(3)
    letters = [chr(draw.randrange(0x20, 0xD7FF)) for _ in range(300)] + list(" \n'st😀1½ ")
    for _ in range(300):
        text = "".join(draw.choices(letters, k=40))
        tokens = known.pre_tokens(text)[0]
        assert "".join(tokens) == text and sum(known.sizes(tokens)) == len(byte_library.encode(text, add_special_tokens=False).ids)


def test_other_vocabularies_are_refused():
    from millrace.llm.queries import WORD_BPE

    with pytest.raises(ValueError):
        token_counts.ByteLevel(WORD_BPE)


def best_phrases(docs, least, top):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.ASCII_LOWER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            words[lang] += len(w)
            for m in range(1, 5):
                counts[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cands.items():
            inside = [b for q, b in cands.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= 80 * a for b in inside):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def test_collocations(spark, sf_dir):  # noqa: F811
    got = sorted(tuple(r) for r in result(spark, sf_dir, "op12_collocations"))
    assert got == best_phrases(rows_of(spark, sf_dir, "lang", "text"), 30, 2000) and got


@pytest.mark.parametrize("buckets", [8, 1 << 10, 1 << 20])
def test_collocations_whatever_collides(spark, buckets):
    """Random texts of few words; the smaller tables have most counters full."""
    sizes = {"buckets": buckets, "chunk_bytes": 20_000}
    draw = random.Random(buckets)
    words = ["a", "B", "c d", "É", "die", "und", "x", "日本", "\x1cz"]
    texts = [("und" if i % 7 == 0 else None if i % 5 == 0 else "de", "".join(draw.choice(words) + draw.choice([" ", " ", " ", "\t", ". ", "\r\n", ";"]) for _ in range(200))) for i in range(150)]
    texts += [("de", None), (None, ""), ("fr", "  . \n"), ("en", "one " * 3000)]
    docs = spark.createDataFrame([(lang, t, 1, 2) for lang, t in texts], "lang string, text string, n int, w0 int").repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(docs, least=5, top=40, **sizes).collect())
    assert got == best_phrases(texts, 5, 40)
    some = phrases.collocations(docs, least=5, top=3, **sizes).collect()
    assert sorted(map(tuple, some)) == best_phrases(texts, 5, 3)


def test_many_rare_phrases_stay_out_of_the_windows(spark):
    """Far more beginnings than the table has places, nearly all of them rare: windows still end at the rare ones."""
    draw, least, buckets = random.Random(3), 12, 1 << 15
    words = [f"w{i}" for i in range(300)]
    texts = [("en", " ".join(draw.choice(words) for _ in range(1500)) + " so far so good" * (i % 3)) for i in range(40)]
    docs = spark.createDataFrame(texts, "lang string, text string").repartition(3)
    rows = [(tuple(x for x in r[1:-1] if x is not None), r.n) for r in phrases.windows(docs, least=least, buckets=buckets, chunk_bytes=20_000).collect()]
    assert sum(n for _, n in rows) == sum(len(t.split()) for _, t in texts)
    # With counters that fill, nothing was padded: 18 433 windows of four words.
    assert len(rows) < 3000 and len({w for w, _ in rows}) == len(rows)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    got = sorted(map(tuple, phrases.collocations(docs, least=least, buckets=buckets, chunk_bytes=20_000).collect()))
    assert got == best_phrases(texts, least, 2000) and got and spark.conf.get(key) == before


@pytest.mark.parametrize("blocks", [1, 1 << 12])
def test_keys_come_back_from_their_gaps(blocks):
    keys = np.random.default_rng(blocks).integers(0, blocks << phrases.REST, 5000, dtype=np.uint64)
    keys = np.concatenate([keys, keys[:900], np.repeat(keys[:1], 400), np.array([0, (blocks << phrases.REST) - 1], np.uint64)])
    want, n = np.unique(keys, return_counts=True)
    found = [(rest + (block << phrases.REST), count) for block, size, part in phrases._packed(keys, blocks, 255) for rest, count in (divmod(x, 256) for x in phrases._unpacked(size, part).tolist())]
    assert found == list(zip(want.tolist(), np.minimum(n, 255).tolist()))


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 9_000_000_000_000_000
    rows = [("en", [], 4 * big), ("en", ["a"], 2 * big), ("en", ["b"], big + 7), ("en", ["a", "b"], big)]
    made = spark.createDataFrame(rows, "lang string, words array<string>, f bigint")
    monkeypatch.setattr(phrases, "phrase_counts", lambda docs, least: made)
    (row,) = phrases.collocations(made).collect()
    assert tuple(row) == ("en", 1, "a b", big, 2 * big, big + 7, 4 * big, 2_000_000 * big // (3 * big + 7))


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(r)] for c, r in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(donor, [])[:h] + turns[h:]
    return out


def trie_of(convs):
    """Nodes by definition, from sequences by conversation."""
    members = defaultdict(list)
    for c, turns in convs.items():
        at = ()
        members[at].append((c, len(turns) == 0))
        for d, t in enumerate(turns):
            below = (*at, t)
            members[below].append((c, d + 1 == len(turns)))
            at = below
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    least = {p: min(c for c, _ in m) for p, m in members.items()}
    rows = []
    for p, m in members.items():
        ends = ",".join(str(c) for c, end in sorted(m) if end)
        rows.append((least[p], len(p), least[p[:-1]] if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def test_turn_trie(spark, sf_dir):  # noqa: F811
    rows = rows_of(spark, sf_dir, "conv_id", "turn", "role", "text", name="conversations")
    assert sorted((tuple(r) for r in result(spark, sf_dir, "op11_turn_trie")), key=str) == trie_of(rebuilt(rows))


@pytest.mark.parametrize("segment", [1, 2, 5, 1000])
def test_trie_cut_anywhere(spark, segment):
    """Few different turns, so that paths are shared, end inside others, and are cut by stretches at every depth."""
    draw = random.Random(segment)
    turns = [("user", "a"), ("user", "ab"), ("assistant", "é" * 7), ("", ""), ("usera", "b")]
    rows = [(c, t, *draw.choice(turns)) for c in range(-30, 300) for t in range(draw.choice([1, 2, 3, 4, 9, 20]))]
    rows += [(c, t, *turns[t % 2]) for c in range(1000, 1400, 3) for t in range(12)]
    rows += [(None, 1, "user", "lost"), (7, None, None, None), (7, None, None, None), (2**40 + 5, 0, "user", "far")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn int, role string, text string, depth int, key string")
    found = turn_trie.trie(turn_trie.rebuilt(docs.repartition(5)), segment)
    assert sorted(map(tuple, found.collect()), key=str) == trie_of(rebuilt(rows))


def test_large_group_of_equal_conversations(spark, monkeypatch):
    """Ids of one sequence come in blocks and are hashed in ascending order."""
    monkeypatch.setattr(turn_trie, "BLOCK", 7)
    convs = spark.range(-50, 450).selectExpr("id * 3 as conv_id", "unhex(repeat('ab', 40)) as key")
    found = {r.depth: r for r in turn_trie.trie(convs).collect()}
    ids = ",".join(str(3 * i) for i in range(-50, 450))
    assert found[2].n_convs == 500 and found[2].ends_sha256 == hashlib.sha256(ids.encode()).hexdigest()
    assert (found[0].n_children, found[0].n_leaves, found[1].n_children, found[2].n_children) == (1, 1, 1, 0)


@pytest.mark.parametrize("n", [1, 4, 5, 16, 17, 48, 49, 256])
def test_radix_layouts(n):
    draw = random.Random(n)
    keys = {bytes([b, *draw.choices(range(3), k=draw.randrange(6))]) for b in range(n)} | {b"", b"\x00\x00\x00"}
    tree = RadixTree()
    order = draw.sample(sorted(keys), len(keys))
    for key in order:
        tree.insert(key, sorted(keys).index(key))
    seen = [node.value for done, node, *_ in tree.walk() if not done and node.value >= 0]
    assert seen == list(range(len(keys)))
    assert tree.root.room == next(r for r in (4, 16, 48, 256) if n <= r)
