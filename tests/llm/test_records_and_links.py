"""Records read back from their own bytes, and all links of the n-gram join."""

import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from tallystar.llm import grouped_prefix_join as G
from tallystar.llm.content_archive import from_records, read_archive, write_archive
from tallystar.llm.grouped_prefix_join import GroupedPrefixJoin

PAGES = "page_id long, url string, html string"


def pages():
    rng = random.Random(3)
    texts = [None, "", "\r\n\r\n", "a\r\n\r\nb", "é" * 5000, "\x00\x85 ", "x", "Content-Length: 7\r\n\r\n"]
    urls = [None, "u", "é\r\n\r\nContent-Length: 1", "http://a/b?c=d"]
    return [(i, rng.choice(urls), rng.choice(texts)) for i in range(60)]


def test_records_say_what_was_written(spark, home):
    rows = pages()
    write_archive(spark.createDataFrame(rows, PAGES).repartition(3), f"{home}/a")
    found = from_records(read_archive(spark, f"{home}/a")).collect()
    want = brute.archive([(i, x) for i, _, x in rows])
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found}
    assert got == want and len(found) == len(rows)


def test_records_of_repeated_and_null_pages_and_of_none(spark, home):
    rows = [(1, "u", "x"), (1, "u", "x"), (None, None, "x"), (None, None, None)]
    write_archive(spark.createDataFrame(rows, PAGES), f"{home}/a")
    found = from_records(read_archive(spark, f"{home}/a")).collect()
    assert Counter((r.page_id, r.record_type, r.payload_bytes) for r in found) == {
        (1, "response", 1): 1, (1, "revisit", 1): 1, (None, "revisit", 1): 1, (None, "response", 0): 1,
    }
    write_archive(spark.createDataFrame([], PAGES), f"{home}/b")
    assert from_records(read_archive(spark, f"{home}/b")).count() == 0


@pytest.mark.parametrize(
    "change",
    [
        "concat(record, X'21')",
        "substring(record, 1, length(record) - 1)",
        "encode(replace(decode(record, 'UTF-8'), 'text\\r', 'tExt\\r'), 'UTF-8')",
        "encode(replace(decode(record, 'UTF-8'), 'Length: 4', 'Length: 5'), 'UTF-8')",
    ],
)
def test_a_damaged_record_is_noticed(spark, home, change):
    write_archive(spark.createDataFrame([(1, "u", "text")], PAGES), f"{home}/a")
    archive = read_archive(spark, f"{home}/a")
    assert from_records(archive).first()["payload_bytes"] == 4
    with pytest.raises(Exception, match="headers state"):
        from_records(archive.withColumn("record", F.expr(change))).collect()


def crowd():
    """Chains of edits, many edits of one text, copies of some, sets of one prefix, odd rows."""
    rng, rows = random.Random(8), []
    base = [f"w{i}" for i in range(60)]
    text = base.copy()
    for i in range(12):
        rows.append((i, " ".join(text)))
        text[5 * i % 60] = f"edit{i}"
    other = [f"v{i}" for i in range(120)]
    for i in range(60):
        own = other.copy()
        for _ in range(1 + i % 3):
            own[rng.randrange(120)] = f"x{rng.randrange(4)}"
        rows += [(100 + 3 * i + j, " ".join(own)) for j in range(1 + (i % 4 == 0))]
    rows += [(900, None), (901, ""), (902, "one"), (903, "One"), (None, "two words"), (904, "two words"), (904, "a b c d")]
    return rows


def linked(rows, k, percent):
    """Links between different sets by their smallest ids, and per row the number of its links."""
    sets = []
    for _, x in rows:
        w = brute.SPACE_WORD.findall(brute.lower(x))
        sets.append(frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset())
    least = {}
    for (i, _), s in zip(rows, sets):
        least[s] = i if least.get(s) is None else least[s] if i is None else min(i, least[s])
    links, counts, kinds = Counter(), Counter(), Counter(s for s in sets if s)
    for s in kinds:
        for t in kinds:
            if 100 * len(s & t) >= percent * len(s | t):
                counts[s] += kinds[t] - (s == t)
                if s != t and sorted(s) < sorted(t):
                    pair = sorted((least[s], least[t]), key=lambda i: (i is not None, i))
                    links[*pair, len(s & t)] += 1
    return links, Counter((i, counts[s]) for (i, _), s in zip(rows, sets))


@pytest.mark.parametrize("k, percent, block", [(4, 85, 256), (4, 85, 3), (5, 80, 7)])
def test_all_links(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(G, "BLOCK", block)
    rows = crowd()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    join = GroupedPrefixJoin(docs, k, percent, whole=True)
    links, counts = linked(rows, k, percent)
    assert Counter(tuple(r) for r in join.links().collect()) == links
    found = join.components().collect()
    assert Counter((r.doc_id, r.n_links) for r in found) == counts
    want = Counter((i, *c) for (i, _), c in zip(rows, brute.components(rows, k, percent)))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == want


def test_spanning_links_are_links_and_connect(spark):
    rows = crowd()
    join = GroupedPrefixJoin(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)
    found = [tuple(r) for r in join.spanning_links().collect()]
    assert len(set(found)) == len(found) and not set(found) - set(linked(rows, 4, 85)[0])
    with pytest.raises(ValueError, match="whole"):
        join.links()


def test_no_links(spark, nothing):
    join = GroupedPrefixJoin(nothing, whole=True)
    assert join.links().count() == join.components().count() == 0
    assert "n_links" in join.components().columns
