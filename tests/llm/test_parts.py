"""Parts of the operators with interfaces of their own, and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import chat, decontaminate, fertility, packing, pii, repeats, simhash, wavelet
from millrace.llm.components import connected
from millrace.llm.queries import PIECES, WORD_BPE
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1, 511, 512, 5000])
def test_wavelet_access_rank_select(n):
    ids = np.random.default_rng(n).zipf(1.4, n) % 5000
    w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
    assert (w.to_array() == ids).all() and [w.access(i) for i in range(0, n, 37)] == ids[::37].tolist()
    for symbol in {int(ids[0]), int(ids[-1]), 1, 4999}:
        places = np.flatnonzero(ids == symbol)
        assert w.rank(symbol, n) == len(places) and w.rank(symbol, n // 2) == (places < n // 2).sum()
        assert [w.select(symbol, k) for k in range(min(5, len(places)))] == places[:5].tolist()


ODD_TEXTS = [
    "",
    " \t\n ",
    "<|endoftext|>",
    "say <|endoftext|>, <|ENDOFTEXT|> and é<|startoftext|>!",
    "क़! शुक़, שׁ? Ω, İ! ŉ ſ's ẞ",
    "Don't 'll ''s IT'S l'été, 1st 22nd a--b (c) Ÿ's !'re \x01 a\x1cb c\x85d",
    "x" * 300 + "!" * 300 + " " + "É" * 300,
]


@pytest.mark.parametrize("most", [8, wavelet.CACHE_PIECES])
def test_library_ids(monkeypatch, most):
    monkeypatch.setattr(wavelet, "CACHE_PIECES", most)
    monkeypatch.setattr(wavelet, "_CACHES", {})
    library = Tokenizer.from_file(WORD_BPE)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ODD_TEXTS]
    texts = [t.encode() for t in ODD_TEXTS]
    assert wavelet.library_ids(texts, WORD_BPE) == want
    assert [wavelet.library_ids([t], WORD_BPE)[0] for t in texts[::-1]] == want[::-1]


def test_plain_words_are_encoded_once(monkeypatch):
    monkeypatch.setattr(wavelet, "_CACHES", {})
    wavelet.library_ids([b"Word word, (WORD) word", "wörd WÖRD. wörd's".encode()], WORD_BPE)
    assert set(wavelet._CACHES[WORD_BPE]) == {b"", b"word", b",", b"(", b")", "wörd".encode(), b".", b"'s"}


def test_components(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert len({got[i] for i in range(201)}) == 1 and len({got[i] for i in range(1000, 1100)}) == 1 and got[0] != got[1000]


def test_best_branch_of_a_reply_tree(spark):
    rows = [(1, 0, None, 0.0, "user", "q"), (1, 1, 0, 0.2, "assistant", "bad"), (1, 2, 0, 0.9, "assistant", "good"), (1, 3, 2, 0.9, "user", "more"), (2, 7, 8, 0.0, "user", "circle"), (2, 8, 7, 0.0, "user", "circle")]
    messages = spark.createDataFrame(rows, "tree int, node bigint, parent bigint, score double, role string, text string")
    (best,) = chat.format_paths(messages).select(chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss")).collect()
    assert [t.text for t in best.t] == ["q", "good", "more"] and best.loss == "good"
    assert chat.format_paths(messages, branches=None).count() == 2


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x alpha y beta z"), (2, "alpha " + "w " * 20 + "beta"), (3, None)], "doc_id bigint, text string")
    items = decontaminate.Items(spark.createDataFrame([(1, "beta alpha")], "item_id bigint, text string"))
    index = decontaminate.build_index(docs, items.terms)
    assert {r.doc_id for r in decontaminate.proximity_matches(index, items, 5).collect()} == {1}


def test_redaction_and_removal(spark):
    line = "one line that has more than twenty words so that it counts as a passage of its own and is cut out where it stands again"
    docs = spark.createDataFrame([(1, f"a\n{line}\nb a.b@c.de +1 (275) 555-5927."), (2, f"{line}\nc"), (3, None)], "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean == {1: f"a\n{line}\nb [EMAIL] [PHONE].", 2: f"{line}\nc", 3: None}
    cut = {r.doc_id: (r.text, [tuple(x) for x in r.removed]) for r in repeats.remove_repeats(docs).collect()}
    assert cut[2] == ("c", [(0, len(line) + 1, 1, 2)]) and cut[1][1] == [] and cut[3] == (None, [])


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    good = corpus_pipeline.quality(spark, docs, SF_DIR)
    kept = {r.doc_id for r in good.collect()}
    assert kept == {i for i, t in rows.items() if not brute.base_quality(t)[-1]}  # all of these lie in their bands
    prints = [(i, brute.fingerprint(rows[i])) for i in kept]
    least = brute.components(prints)
    heads = {i for i, p in prints if least[i, p] == i}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {i for i, x in brute.contamination([(i, rows[i]) for i in heads], items).items() if x[-1]}
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in out} == heads - dirty and len(out) == len(heads - dirty)


@pytest.mark.parametrize("lang", ["en", "de", "fr", "es"])
def test_long_clean_text_is_kept(spark, lang):
    """A million tokens with the words of the table, as often as they stand there."""
    clean = fertility.measured(spark.read.parquet(f"{SF_DIR}/documents.parquet"), PIECES).where(F.col("quality.kept") & (F.col("lang") == lang))
    words = [w for r in clean.select("text").collect() for w in r.text.split()]
    text = " ".join(np.random.default_rng(5).choice(words, 700_000))
    (q,) = fertility.measured(spark.createDataFrame([(text, lang)], "text string, lang string"), PIECES).select("quality.*").collect()
    assert q.n_tokens >= 1_000_000 and not q.base_failed and q.kept
    same = " ".join(["alpha beta gamma delta"] * 250_000)
    assert not fertility.measured(spark.createDataFrame([(same, lang)], "text string, lang string"), PIECES, most_repeat=100).first().quality.kept


PASSAGES = {
    "zh": "人人 生而自由 ， 在 尊严 和 权利 上 一律 平等 。 他们 赋有 理性 和 良心 ， 并 应 以 兄弟 关系 的 精神 相对待 。",
    "ja": "すべての人間は、 生まれながらにして 自由であり、 かつ、 尊厳と 権利とについて 平等である。 今日は 天気が とても 良いので、 公園へ 行きました。",
    "ko": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다.",
    "ar": "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق. وقد وهبوا عقلا وضميرا وعليهم أن يعامل بعضهم بعضا بروح الإخاء.",
    "he": "כל בני האדם נולדו בני חורין ושווים בערכם ובזכויותיהם. כולם חוננו בתבונה ובמצפון, לפיכך חובה עליהם לנהוג איש ברעהו ברוח של אחווה.",
    "hi": "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है।",
    "el": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση.",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "vi": "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi. Mọi con người đều được tạo hóa ban cho lý trí.",
    "am": "የሰው ልጅ ሁሉ ሲወለድ ነጻና በክብርና በመብትም እኩልነት ያለው ነው። የተፈጥሮ ማስተዋልና ሕሊና ስላለው አንዱ ሌላውን በወንድማማችነት መንፈስ መመልከት ይገባዋል።",
}


def test_other_scripts_are_kept(spark):
    """By the band of their script, with and without a language name; broken texts of a script with a band are not."""
    rows = [(k, lang, t) for k, t in PASSAGES.items() for lang in (k, None)]
    broken = " ".join("".join(map(chr, w)) for w in np.random.default_rng(1).integers(0x4E00, 0x9FFF, (20, 6)))
    rows += [("broken", None, broken), ("en", "en", PASSAGES["ar"])]
    got = fertility.measured(spark.createDataFrame(rows, "k string, lang string, text string"), PIECES).select("k", "quality.*").collect()
    assert not any(r.base_failed for r in got) and all(r.n_tokens >= fertility.LEAST_TOKENS for r in got)
    assert {r.k for r in got if not r.kept} == {"broken", "en"}


@pytest.mark.parametrize("block_groups", [20_000, 100])
def test_copies_stay_in_one_shard(spark, monkeypatch, block_groups):
    monkeypatch.setattr(packing, "BLOCK_GROUPS", block_groups)
    copies = {"a": 2, "b": 8, "c": 40, "d": 80, "e": 100, "f": 110, "heavy": 1400}  # of 4000; a quarter of a shard is 125
    texts = [f"{name} is a text with copies" for name, n in copies.items() for _ in range(n)]
    texts += [f"text {i} stands once here" for i in range(4000 - len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = packing.shard(docs).collect()
    assert len(got) == len(texts)
    found = {}
    for r in got:
        found.setdefault(texts[r.doc_id].split()[0], set()).add(r.shard)
    assert all(len(found[name]) == 1 for name in "abcdef") and len(found["heavy"]) == 8
    for measure in (lambda r: 1, lambda r: r["size"]):
        filled = [sum(measure(r) for r in got if r.shard == s) for s in range(8)]
        assert max(filled) - min(filled) <= 0.02 * sum(filled)


def test_one_row_of_each_group(spark):
    """Also of rows without an id, of repeated rows, and of different texts with one id."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(1, a), (1, a), (None, a), (2, a), (None, b), (None, b), (None, c), (3, c), (4, d), (4, b + " " + d)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [tuple(r) for r in simhash.keep_one(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, a), (None, b), (3, c), (4, d), (4, b + " " + d)], key=str)


def joins_of_the_index(monkeypatch, run):
    """The plans of the links that ``run`` asks for."""
    plans, whole = [], simhash.connected
    monkeypatch.setattr(simhash, "connected", lambda links: plans.append(links._jdf.queryExecution().executedPlan().toString()) or whole(links))
    run()
    return plans


def test_fingerprint_index_is_not_broadcast(spark, monkeypatch):
    """The index has 70 rows a fingerprint, and Spark would take it to be as small as these few fingerprints."""
    text = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "other words"), (4, None)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    least = brute.components([(i, r.fingerprint % 2**64) for i, r in rows.items()])
    assert {i: r.component_id for i, r in rows.items()} == {i: least[i, r.fingerprint % 2**64] for i, r in rows.items()}
    (plan,) = joins_of_the_index(monkeypatch, lambda: simhash.near_duplicates(docs))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_pipeline_does_not_broadcast_the_index(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "other words")], "doc_id bigint, text string")
    kept = []
    (plan,) = joins_of_the_index(monkeypatch, lambda: kept.append(corpus_pipeline.near_copies(spark, docs, SF_DIR)))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    prints = [(r.doc_id, brute.fingerprint(r.text)) for r in docs.collect()]
    least = brute.components(prints)
    assert {r.doc_id for r in kept[0].collect()} == {i for i, p in prints if least[i, p] == i}
