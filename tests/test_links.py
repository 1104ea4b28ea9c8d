"""Linked pages against a client that follows cursors one by one."""

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.sources import links


def follow(pages):
    """Names in order, and how it ends, from {cursor: next}."""
    seen, at = [], None
    while at in pages and at not in seen:
        seen.append(at)
        if pages[at] in (None, "", "0"):
            return seen, links.COMPLETE
        at = pages[at]
    return seen, links.NO_START if not seen else links.LOOP if at in pages else links.GAP


def stored(spark, fetches):
    rows = [(f, c, json.dumps({"data": [f"{f}/{c}"], "meta": {"next_cursor": n}})) for f, pages in fetches.items() for c, n in pages.items()]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "fetch_id int, cursor string, text string")
    return df.select("fetch_id", "cursor", F.parse_json("text").alias("payload")).repartition(3)


def test_random_fetches(spark):
    draw = random.Random(7)
    fetches = {}
    for f in range(40):
        names = [None, *(f"c{draw.randrange(10**6)}" for _ in range(draw.randrange(12)))]
        pages = dict(zip(names, [*names[1:], draw.choice([None, "", "0", "nowhere", *names[1:]])]))
        for lost in draw.sample(names, draw.choice([0, 0, 1])):
            pages.pop(lost, None)
        fetches[f] = pages
    want = {f: follow(p) for f, p in fetches.items() if p}
    pages = stored(spark, fetches)
    got = {}
    for r in links.linked_pages(pages).select("fetch_id", "page_no", F.to_json("payload").alias("p")).collect():
        got.setdefault(r.fetch_id, {})[r.page_no] = json.loads(r.p)["data"][0].split("/")[1]
    assert {f: [str(n) for n in names] for f, (names, _) in want.items() if names} == {f: [p[i] for i in range(len(p))] for f, p in got.items()}
    report = {r.fetch_id: r for r in links.link_report(pages).collect()}
    assert {f: r.state for f, r in report.items()} == {f: state for f, (_, state) in want.items()}
    assert all(r.n_pages == len(fetches[f]) and r.n_placed == len(want[f][0]) for f, r in report.items())


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 300])
def test_long_chains_take_few_rounds(spark, monkeypatch, n):
    rounds = []
    real = links._stored
    monkeypatch.setattr(links, "_stored", lambda df, purpose: (rounds.append(purpose), real(df, purpose))[1])
    chain = [None, *(f"p{i:04d}" for i in range(1, n))]
    pages = stored(spark, {1: dict(zip(chain, [*chain[1:], None]))})
    numbers = {r.page_no for r in links.linked_pages(pages).collect()}
    assert numbers == set(range(n)) and rounds.count("placed") <= n.bit_length() + 2


def test_pages_stored_twice_and_no_pages(spark):
    pages = stored(spark, {1: {None: "a", "a": None}})
    twice = pages.unionByName(pages)
    assert links.linked_pages(twice).count() == 2
    assert (links.link_report(twice).first().n_stored, links.link_report(twice).first().n_pages) == (4, 2)
    none = pages.where("fetch_id < 0")
    assert links.linked_pages(none).count() == 0 and links.link_report(none).count() == 0
