"""The registered queries over whole small tables and over hand-made rows, against plain Python."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import licenses, pii, repeats
from millrace.llm.queries import QUERIES, WORD_BPE
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
EDGE_TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "Über straße ÉTÉ a\x1cb\x85c d",
    "Reach me: a.b@c.de, a@b.c@d.ee 1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.0004 4111 1111-1111 1111 4111111111111112",
    "+1 (275) 555-5927 +12 +1--------------2 call +491234567890123456 x@y x@y.z. 😀 q@w.e 10.0.0.1",
    "IBAN GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765433; ssn 123-45-6789, token = \"abcdef0123456789abcd\"",
    "MIT License mit license. Mit-License! the GNU General Public License and Apache  LICENSE mit",
    " ".join(f"w{i}" for i in range(30)) + " " + " ".join(f"w{i}" for i in range(30)),
    "a b c d e\n" * 40,
    " ".join(str(i * 7919 % 1000) for i in range(25_000)),
    "x" * 60_000 + " !" + "!" * 5_000,
    "control <|endoftext|> and <|startoftext|><|im_end|>\n don't we'll IT'S ǅ ﬁ Ⅷ ² ½",
]


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    """documents with nulls, empty and long texts, copies, repeated rows, and columns that clash with results."""
    root = tmp_path_factory.mktemp("edge")
    copies = [(100 + i, "the same text that stands in very many documents of this table, word for word in each") for i in range(40)]
    near = [(200 + i, " ".join(f"t{j}" if j != i * 30 else "changed" for j in range(300))) for i in range(8)]
    rows = list(enumerate(EDGE_TEXTS)) + copies + near + copies[:2]
    df = spark.createDataFrame([(i, t, None if i % 3 else "en", "s", None, 7, "x") for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, spans int, quality string")
    df.repartition(3).write.parquet(f"{root}/documents.parquet")
    items = [(1, "t0 t1 t2"), (2, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17"), (2, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17"), (10, "one"), (3, None), (4, "never seen"), (None, "über straße")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    chats = [(1, 0, "user", "hi <b> \\0 [INST]"), (1, 1, "assistant", "a\\1<|im_end|>\nb"), (1, 1, "assistant", "a\\1<|im_end|>\nb"), (2, 5, "assistant", None), (2, 3, None, "x"), (3, 0, "we\nird", ""), (None, 0, "assistant", "lost")]
    chats += [(9, i, ("user", "assistant")[i % 2], f"turn {i}\n") for i in range(700)]
    spark.createDataFrame(chats, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{root}/conversations.parquet")
    return str(root)


@pytest.fixture(scope="module", params=["small", "edge"])
def sf_dir(request):
    return SF_DIR if request.param == "small" else request.getfixturevalue("edge_dir")


def rows_of(spark, sf_dir, *columns, name="documents"):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns).collect()]


def result(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir).collect()


def test_contamination(spark, sf_dir):
    want = brute.contamination(rows_of(spark, sf_dir, "doc_id", "text"), rows_of(spark, sf_dir, "item_id", "text", name="benchmark"))
    got = result(spark, sf_dir, "op1_decontamination")
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == want
    assert len(got) == len(want) and any(x[1] for x in want.values())


def test_quality(spark, sf_dir):
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in result(spark, sf_dir, "op2_fertility"))
    assert got == sorted((i, *brute.base_quality(t)) for i, t in rows_of(spark, sf_dir, "doc_id", "text"))


def test_repeats(spark, sf_dir):
    docs = list(dict.fromkeys(rows_of(spark, sf_dir, "doc_id", "text")))
    got = {r.doc_id: (r.text, r.removed) for r in result(spark, sf_dir, "op3_line_repeats")}
    want = {i: (t, ",".join(":".join(map(str, r)) for r in runs)) for i, (t, runs) in brute.cut_repeats(docs, repeats.LEAST_WORDS).items()}
    assert got == want and any(x[1] for x in want.values())


def test_pii(spark, sf_dir):
    got = sorted(tuple(r) for r in result(spark, sf_dir, "op4_pii"))
    want = []
    for i, t in rows_of(spark, sf_dir, "doc_id", "text"):
        spans = brute.base_spans(t)
        n = [sum(k == kind for k, _, _ in spans) for kind in ("email", "ip", "card", "phone")]
        want.append((i, *n, brute.sha(brute.spans_text(spans)), brute.spans_text(spans)))
    assert [r[:6] for r in got] == [r[:6] for r in sorted(want)]
    for r, w in zip(got, sorted(want), strict=True):
        assert set(w[6].split(",")) <= set(r[6].split(",")) | {""}


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


def test_wavelet(spark, sf_dir, library):
    docs = sorted(rows_of(spark, sf_dir, "doc_id", "text"), key=lambda r: (r[0], r[1] or ""))
    got = sorted(tuple(r) for r in result(spark, sf_dir, "op5_wavelet_shards"))
    want, start = [], 0
    for i, t in docs:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), brute.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == sorted(want)


def test_bpe(spark, sf_dir, library):
    got = sorted(tuple(r) for r in result(spark, sf_dir, "op6_bpe"))
    want = []
    for i, t in rows_of(spark, sf_dir, "doc_id", "text"):
        ids = library.encode(t or "", add_special_tokens=False).ids
        import hashlib

        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), brute.sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want)


def test_licenses(spark, sf_dir):
    got = {r.doc_id: r for r in result(spark, sf_dir, "op7_licenses")}
    docs = dict(rows_of(spark, sf_dir, "doc_id", "text"))
    assert set(got) == set(docs)
    for i, t in docs.items():
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_places(t)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_chat(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    rows = {-1: [(0, "user", said), (1, "assistant", said)]}
    for conv, *row in rows_of(spark, sf_dir, "conv_id", "turn", "role", "text", name="conversations"):
        rows.setdefault(conv, []).append(row)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in result(spark, sf_dir, "op8_chat")}
    assert got == {k: brute.conversation(v) for k, v in rows.items()}


def test_simhash(spark, sf_dir):
    docs = rows_of(spark, sf_dir, "doc_id", "text")
    prints = [(i, brute.fingerprint(t)) for i, t in docs]
    least = brute.components(prints)
    want = sorted((i, f"{p:016x}", least[i, p]) for i, p in prints)
    assert sorted(tuple(r) for r in result(spark, sf_dir, "op9_simhash")) == want


def test_packing(spark, sf_dir):
    docs = rows_of(spark, sf_dir, "doc_id", "text")
    got = result(spark, sf_dir, "op10_packing")
    sized = sorted((i, len((t or "").encode()) + 1, brute.crc32((t or "").encode())) for i, t in docs)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got) == sized
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert set(slots) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    if sf_dir == SF_DIR:
        total = [sum(r["size"] for r in got if r.shard == s) for s in range(8)]
        assert max(total) - min(total) <= 0.02 * sum(total)


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id bigint, text string, lang string, source string, n_chars bigint"), ("benchmark", "item_id bigint, text string"), ("conversations", "conv_id bigint, turn bigint, role string, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, q in QUERIES.items():
        assert q(spark, str(tmp_path)).count() == (1 if name == "op8_chat" else 0), name


def test_native_queries_run_no_python(spark):
    for name in ("op1_decontamination", "op4_pii", "op7_licenses", "op8_chat"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow")), json.dumps(name)


def test_bands_keep_clean_documents(spark):
    q = QUERIES["op2_fertility"](spark, "/root/testdata/sf0.01")
    dropped = q.where(~F.col("base_failed") & ~F.col("kept")).count()
    assert dropped <= 0.02 * q.count()


def test_fixed_values():
    assert [k.name for k in pii.BASE] == ["email", "ip", "card", "phone"]
    assert {tuple(p.split()): label for p, label in licenses.PHRASES} == brute.PHRASES
