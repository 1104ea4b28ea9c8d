"""Columns named like helpers, null ids, one id with several texts, repeated rows: nothing leaks, clashes or is lost."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import chat, decontaminate, fertility, licenses, packing, phrases, pii, repeats, simhash, token_counts
from millrace.llm.queries import BYTE_BPE, PIECES, QUERIES
from millrace.llm.words import fresh
from tests.llm import brute

HELPERS = ["_text", "_spans", "_hits", "_gaps", "_steps", "spans", "doc", "_id", "removed", "text_key", "nth", "_nth", "run", "digest", "kept", "quality", "_quality", "row", "key", "n", "ids", "size", "tokens", "group", "shard", "w0", "lang_"]
SECRET = "Write to jane.doe@example.org or 4111 1111 1111 1111 now. " + " ".join(f"word{i} stands here" for i in range(20))
LONG = "The same passage stands in several documents, word for word and line by line. It goes on for a while and ends here at last, with fifty words and more, as a planted passage would do it in a table of many documents that were taken from many sources all over the world."


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, SECRET), (1, SECRET), (1, "another text under one id. " + LONG), (None, "no id at all. " + LONG), (None, None), (2, ""), (3, LONG), (4, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.withColumns({h: F.lit("planted") for h in HELPERS}).repartition(3)


def test_redaction_leaves_no_text_behind(docs):
    done = pii.redact(docs)
    assert done.columns == docs.columns and done.count() == docs.count()
    for row in done.collect():
        said = " ".join(str(v) for v in row)
        assert "jane.doe" not in said and "4111" not in said
        assert all(row[h] == "planted" for h in HELPERS)
    found = pii.with_spans(docs)
    assert found.columns == [c for c in docs.columns if c != "spans"] + ["spans"]
    assert {s.kind for r in found.collect() for s in r.spans} >= {"email", "card"}


def test_removal_follows_documents_not_ids(docs):
    out = repeats.remove_repeats(docs)
    assert out.columns == [c for c in docs.columns if c != "removed"] + ["removed"] and out.count() == docs.count()
    rows = {(r.doc_id, (r.text or "")[:14]): r for r in out.collect()}
    # The document without an id ranks first and keeps the passage; the others lose it at their own offsets.
    assert LONG in rows[None, "no id at all. "].text
    other = rows[1, "another text u"]
    assert other.text == "another text under one id. " and [(s.start, s.stop) for s in other.removed] == [(27, 27 + len(LONG))]
    assert rows[1, SECRET[:14]].text == SECRET and rows[3, ""].removed[0].kept_doc_id is None


@pytest.mark.parametrize("unit", ["sentence", "line", "paragraph"])
def test_units_make_up_the_text(unit):
    for text in ("a b.\n\n c\n \n\nd", "one. two! three？四。\r\nfive", "\n\n", "....", "x" * 50, "a\n \t\n b\n\n\n"):
        parts = repeats.UNITS[unit].findall(text)
        assert "".join(parts) == text


def test_runs_against_brute_force(spark):
    import random

    draw = random.Random(11)
    sentences = [" ".join(draw.choice("abcdefgh") * draw.randrange(1, 4) for _ in range(draw.randrange(1, 9))) + draw.choice([". ", "!\n", "\n", "? "]) for _ in range(30)]
    rows = [(i, "".join(draw.choices(sentences, k=draw.randrange(12)))) for i in range(60)]
    got = {r.doc_id: (r.text, [tuple(s) for s in r.removed]) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), least_words=6).collect()}
    assert got == {i: tuple(x) for i, x in brute.cut_repeats(rows, 6).items()} and any(x[1] for x in got.values())


def test_other_operators_take_any_columns(spark, docs):
    assert fertility.measured(docs, PIECES, name=fresh(docs, "quality")).count() == docs.count()
    assert simhash.keep_one(docs).columns == docs.columns
    packed = {(r.doc_id, r["size"]) for r in packing.shard(docs).collect()}
    assert packed == {(r.doc_id, len((r.text or "").encode()) + 1) for r in docs.collect()}
    assert token_counts.token_counts(docs, BYTE_BPE).count() == docs.count()
    assert phrases.collocations(docs, least=2).count() > 0
    assert licenses.scan_licenses(docs).count() >= 6
    items = spark.createDataFrame([(1, LONG, "x")], "item_id bigint, text string, n string")
    assert {r.doc_id for r in decontaminate.decontaminate(docs, items).where("contaminated").collect()} >= {3}


def test_tokens_of_a_packing(spark):
    texts = [None, "", "  \n", "\n\na b\n", "one\x85two three"]
    got = {r["size"]: r.tokens for r in packing.measured(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")).collect()}
    assert got == {1: 0, 4: 0, 7: 2, len("one\x85two three".encode()) + 1: 2}


def test_pipeline_on_edge_rows(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, LONG)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in out) == [1]
    clean = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        clean = stage(spark, clean, str(tmp_path))
        assert clean.columns == docs.columns
    assert "jane.doe" not in " ".join(str(v) for r in clean.collect() for v in r)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_query_is_registered_with_its_number():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


def test_branching_trees_of_many_turns(spark):
    rows = [(1, i, i - 1 if i else None, 0.5, ("user", "assistant")[i % 2], f"t{i}") for i in range(400)]
    rows += [(1, 1000 + i, 200 + i if i == 0 else 999 + i, 0.9, "assistant", f"b{i}") for i in range(300)]
    messages = spark.createDataFrame(rows, "tree int, node bigint, parent bigint, score double, role string, text string")
    (best,) = chat.format_paths(messages).select(chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss")).collect()
    want = [f"t{i}" for i in range(201)] + [f"b{i}" for i in range(300)]
    assert [t.text for t in best.t] == want
    assert best.loss == "".join(x for x in want if x[0] == "b" or int(x[1:]) % 2)
