"""Each operator against its plain version, on supplied documents and on edge cases."""

import hashlib
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallystar.llm import feistel, merge_counts, packing
from tallystar.llm.components import connected
from tallystar.llm.content_archive import read_archive, write_archive
from tallystar.llm.disclosure import Sanitiser, joined_spans
from tallystar.llm.feistel import permuted, sharded
from tallystar.llm.fertility import Rules, fitted_rules, quality
from tallystar.llm.grouped_prefix_join import GroupedPrefixJoin, ngram_jaccard_components
from tallystar.llm.interpolation import STEPS, interpolated_scores, learned_weights
from tallystar.llm.license_index import NOTICES, Notice, scan
from tallystar.llm.tables import Scratch
from tallystar.llm.winnowing import Winnowing, benchmark_overlap


@pytest.fixture(params=["documents", "edges"])
def table(request):
    frame = request.getfixturevalue(request.param)
    pairs = request.getfixturevalue({"documents": "document_pairs", "edges": "edge_pairs"}[request.param])
    return frame, pairs


def bag(rows):
    return Counter(rows)


# 1


@pytest.mark.parametrize("order", [2, 3, 4])
def test_interpolated_scores(table, order):
    """EM sees ratios in steps; what that does to the scores adds up over the orders."""
    docs, pairs = table
    near = 1e-3 if order > 3 else 1e-4
    got = interpolated_scores(docs, order=order).collect()
    want = defaultdict(list)
    for (i, _), w in zip(pairs, brute.interpolated(pairs, order=order)):
        want[i].append(w)
    assert len(got) == len(pairs)
    for r in got:
        exact = [w for w in want[r.doc_id] if w[:3] == (r.n_tokens, r.n_known, r.train_tokens)]
        assert any(
            abs(w[3] - r.base_score) < 1e-6 and abs(w[4] - r.score) < near * abs(w[4]) for w in exact
        ), r
        assert r.held_out == (brute.part(r.doc_id) == 2)


def test_em_finds_the_weight_that_made_the_data():
    """Events drawn from a mixture of a peaked and a flat estimate."""
    rng = np.random.default_rng(0)
    for weight in (0.2, 0.8):
        # Outcome 0 has probability 0.9 under one estimate and 0.1 under the other.
        from_first = rng.random(20_000) < weight
        zero = rng.random(20_000) < np.where(from_first, 0.9, 0.1)
        step = np.where(zero, round(STEPS * np.log2(9)), -round(STEPS * np.log2(9)))
        got = learned_weights(np.full(20_000, 3), step, np.ones(20_000))
        assert abs(got[3] - weight) < 0.02
        assert got[4] == 0


def test_the_model_beats_the_base_on_held_out_text(documents):
    two, three = (
        interpolated_scores(documents, order=n).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
        for n in (2, 3)
    )
    assert three[0] > two[0] > two[1] == pytest.approx(three[1])


# 2


def test_licences(table):
    docs, pairs = table
    got = scan(docs).collect()
    want = bag((i, *brute.licences(x)) for i, x in pairs)
    assert bag((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def places_of(rows):
    return [[(p.label, p.word, round(p.score, 9)) for p in r.places] for r in rows]


def test_notices_are_those_of_all_offsets(table):
    docs, pairs = table
    got = scan(docs).collect()
    want = brute.notices_found([x for _, x in pairs], NOTICES)
    assert any(want)
    assert bag((r.doc_id, *p) for r, p in zip(got, places_of(got))) == bag(
        (i, *p) for (i, _), p in zip(pairs, want)
    )
    for r in got:
        base = set(filter(None, r.base_labels.split(",")))
        assert set(filter(None, r.labels.split(","))) == base | {p.label for p in r.places}
        assert r.score == max((p.score for p in r.places), default=0.0)


def damaged(rng, words):
    """Some words changed, dropped or put in, and prose around."""
    out = [f"w{rng.integers(9)}" for _ in range(rng.integers(4))]
    for w in words:
        r = rng.random()
        out += [] if r < 0.02 else [f"x{rng.integers(9)}"] if r < 0.06 else [w, "of"] if r < 0.08 else [w]
    return " ".join(out + [f"w{rng.integers(9)}" for _ in range(rng.integers(4))])


def test_whole_and_damaged_notices(spark):
    """Each notice as it is, behind comment signs, twice, damaged in places, and cut off at its end."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{rng.integers(40)}" for _ in range(30)) for _ in range(40)]
    for n in NOTICES:
        words = n.text.split()
        texts += [n.text, "# " + n.text.upper().replace(" ", "\n# "), f"{n.text} . {n.text}", n.text[:-3]]
        texts += [damaged(rng, words) for _ in range(6)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in scan(rows).collect()}
    want = brute.notices_found(texts, NOTICES)
    assert places_of(got[i] for i in range(len(texts))) == want
    assert all(n.label in got[40 + 10 * i + k].labels.split(",") for i, n in enumerate(NOTICES) for k in range(3))


def test_hundreds_of_notices(spark):
    """The plan does not grow with the notices."""
    rng = np.random.default_rng(3)
    notices = []
    for i in range(300):
        words = [f"t{w}" for w in rng.integers(0, 500, 60)]
        notices.append(Notice(f"n{i:03d}", " ".join(words), " ".join(words[20:24])))
    texts = [f"a {notices[7 * i].text} b {notices[(11 * i) % 300].text}" for i in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(scan(rows, notices).collect(), key=lambda r: r.doc_id)
    assert places_of(got) == brute.notices_found(texts, notices)


def test_a_notice_is_found_by_its_rare_words(spark):
    notice = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
    shuffled = " ".join(sorted(notice.split()))
    prose = [(i, f"the of is and to any this {i}") for i in range(20)]
    rows = [(100, f"some words before {notice} and after"), (101, shuffled), *prose]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100].labels == "mit" and got[100].base_labels == ""
    assert [(p.label, p.word) for p in got[100].places] == [("mit", 3)]
    assert all(got[i].labels == "" for i in got if i != 100)


# 3


@pytest.mark.parametrize("copies", [1, 3])
def test_a_notice_in_every_row_is_found(spark, copies):
    text = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    rows = spark.createDataFrame([(i, text) for i in range(copies)], "doc_id long, text string")
    assert [(r.labels, round(r.score, 9)) for r in scan(rows).collect()] == [("mit", 1.0)] * copies


def test_archive(spark, home):
    pages = [(5, "u5", "same"), (3, "u3", "same"), (9, None, None), (8, "a\nb", ""), (7, "u7", "é\r\n" * 4000), (6, "u6", "only")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    write_archive(frame, f"{home}/a")
    rows = read_archive(spark, f"{home}/a").collect()
    want = brute.archive([(i, x) for i, _, x in pages])
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows} == want
    assert spark.read.parquet(f"{home}/a/payloads").count() == 4
    texts = {i: x or "" for i, _, x in pages}
    for r in rows:
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        http, _, body = block.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert bytes(r.payload).decode() == texts[r.page_id]
        assert int(fields["Content-Length"]) == len(block) - 4
        assert body == (bytes(r.payload) if r.record_type == "response" else b"") + b"\r\n\r\n"


def test_archive_of_repeated_and_null_rows_and_of_none(spark, home):
    kind = "page_id long, url string, html string"
    rows = [(1, "u", "x"), (1, "u", "x"), (None, None, "x"), (None, None, None), (None, None, None)]
    write_archive(spark.createDataFrame(rows, kind), f"{home}/a")
    found = read_archive(spark, f"{home}/a").collect()
    assert Counter((r.page_id, r.record_type) for r in found) == {
        (1, "response"): 1, (1, "revisit"): 1, (None, "revisit"): 2, (None, "response"): 1,
    }
    write_archive(spark.createDataFrame([], kind), f"{home}/b")
    assert read_archive(spark, f"{home}/b").count() == 0


def test_small_payloads_are_responses(spark, home):
    frame = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    write_archive(frame, f"{home}/a", least=3)
    assert {r.page_id: r.record_type for r in read_archive(spark, f"{home}/a").collect()} == {
        1: "response", 2: "response", 3: "response", 4: "revisit",
    }


def test_a_damaged_payload_is_noticed(spark, home):
    write_archive(spark.createDataFrame([(1, "u", "ab")], "page_id long, url string, html string"), f"{home}/a")
    stored = spark.read.parquet(f"{home}/a/payloads").withColumn("payload", F.lit(b"xy"))
    rows = stored.collect()
    spark.createDataFrame(rows, stored.schema).write.mode("overwrite").parquet(f"{home}/a/payloads")
    with pytest.raises(Exception, match="address"):
        read_archive(spark, f"{home}/a").collect()


# 4, 5


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(merge_counts.VOCABULARY)


def test_packing(table, library):
    docs, pairs = table
    got = packing.packed(docs).collect()
    ids = bag((i, tuple([*library.encode(x or "", add_special_tokens=False).ids, 0])) for i, x in pairs)
    pieces = Counter()
    for (i, own), times in ids.items():
        for a in range(0, len(own), 1024):
            part = own[a : a + 1024]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            pieces[i, a, len(part), crc, len(own)] += times
    assert bag((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == pieces
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= sum(r.length for r in got) / 1024 * 1.03 + 2


def test_packing_with_many_buckets(documents, monkeypatch):
    """Also with more buckets than are sent to the executors."""
    monkeypatch.setattr(packing, "BROADCAST_BUCKETS", 1)
    monkeypatch.setattr(packing, "BUCKET_PIECES", 3)
    rows = packing.packed(documents).collect()
    ends = defaultdict(list)
    for r in rows:
        ends[r.sequence_id].append((r.offset, r.offset + r.length))
    assert all(sorted(x)[0][0] == 0 and all(a[1] == b[0] for a, b in zip(sorted(x), sorted(x)[1:])) for x in ends.values())


def test_the_closest_filling_is_the_best():
    rng = np.random.default_rng(1)
    for _ in range(60):
        counts = {int(x): int(rng.integers(1, 4)) for x in rng.integers(1, 30, 5)}
        capacity = int(rng.integers(1, 60))
        sums = {0}
        for x, n in counts.items():
            sums = {s + x * k for s in sums for k in range(n + 1) if s + x * k <= capacity}
        used = packing.closest_filling(counts, capacity)
        assert sum(x * n for x, n in used.items()) == max(sums)
        assert all(n <= counts[x] for x, n in used.items())
        plan = packing.fillings(counts, 64)
        total = Counter()
        for one, times in plan:
            assert sum(x * n for x, n in one.items()) <= 64
            total.update({x: n * times for x, n in one.items()})
        assert total == Counter(counts)


def test_token_counts(table, library):
    docs, pairs = table
    got = merge_counts.token_counts(docs).collect()
    want = bag((i, len((x or "").encode()), len(library.encode(x or "", add_special_tokens=False).ids)) for i, x in pairs)
    assert bag((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


# 6


def test_personal_data(table):
    docs, pairs = table
    got = Sanitiser(docs).documents().select("doc_id", joined_spans("base").alias("base"), "n_email", "n_ip", "n_card", "n_phone").collect()
    assert bag((r.doc_id, r.base) for r in got) == bag((i, brute.personal(x)) for i, x in pairs)
    for r in got:
        assert [r.base.count(f"{k}:") for k in ("email", "ip", "card", "phone")] == [r.n_email, r.n_ip, r.n_card, r.n_phone]


def test_terms_that_disclose_an_entity_are_taken_out(spark):
    rows = [(i, f"The zorblax office, write to chief@zorb.example soon {i}") for i in range(4)]
    rows += [(10 + i, f"The office is open {i}; write to us soon") for i in range(60)]
    frame = spark.createDataFrame([(i, x, len(x)) for i, x in rows], "doc_id long, text string, spans int")
    found = Sanitiser(frame)
    spans = {r.doc_id: [(s.kind, s.start) for s in r.spans] for r in found.documents().collect()}
    assert spans[0] == [("term", 4), ("email", 29)] and spans[10] == []
    texts = {r.doc_id: r.text for r in found.sanitised(frame).collect()}
    assert texts[2] == "The  office, write to [EMAIL] soon 2"
    assert texts[12] == rows[6][1]
    assert found.sanitised(frame).columns == frame.columns


def test_terms_far_from_rare_entities_are_taken_out(spark):
    """Two texts that share an entity and a name are enough, wherever it stands; one is not, and
    copies of it count once, however many."""
    filler = " and so on" * 30
    rows = [(1, f"Quimby{filler} writes to q@x.example"), (2, f"b@y.example{filler} by Zorba or ZORBA")]
    rows += [(3, f"Again Zorba{filler}, b@y.example")] + [(4, rows[0][1])] * 5
    rows += [(100 + i, f"again: by or writes to{filler} {i}") for i in range(60)]
    found = Sanitiser(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in found.sanitised(found.rows.select("doc_id", "text")).collect()}
    assert texts[1] == texts[4] == f"Quimby{filler} writes to [EMAIL]"
    assert texts[2] == f"[EMAIL]{filler} by  or " and texts[3] == f"Again {filler}, [EMAIL]"
    assert texts[100] == dict(rows)[100]


def test_sanitised_texts_hold_no_personal_data(edges):
    clean = Sanitiser(edges).sanitised(edges).collect()
    assert all(brute.personal(r.text) == "" for r in clean)
    assert sum(r.text is None for r in clean) == 2
    # Each row is there once, and texts without personal data are as they were.
    assert bag(r.doc_id for r in clean) == bag(r.doc_id for r in edges.collect())
    plain = [r for r in edges.collect() if brute.personal(r.text) == ""]
    assert not bag((r.doc_id, r.text) for r in plain) - bag((r.doc_id, r.text) for r in clean)


def test_texts_full_of_values_are_cut_in_the_right_places(spark):
    """Values across the borders of blocks and cells, kinds that overlap, signs of four bytes."""
    rng = np.random.default_rng(6)
    value = ["jo{}@mail.example.com", "10.0.{}.7", "+1 415 555 {:04d}", "+4111 1111 1111 1111 {}"]
    parts = ["\U0001f600é\n" * int(rng.integers(0, 9)) + value[i % 4].format(int(rng.integers(250))) for i in range(20_000)]
    long = " zorb ".join(parts) + "é" * 3000
    rows = [(1, long), (2, long[: 1024 * 3]), (3, "a@b.cc"), (4, "é" * 1024 + "a@b.cc"), (5, "a@b.cc" + "é" * 1018)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = Sanitiser(frame, support=1)
    spans = {r.doc_id: r.spans for r in found.documents().select("doc_id", "spans").collect()}
    assert len(spans[1]) > 15_000 and any(s.kind == "term" for s in spans[1])
    texts = {r.doc_id: r.text for r in found.sanitised(frame).collect()}
    for i, text in rows:
        out, at = [], 0
        for s in spans[i]:
            if s.start >= at:
                out += [text[at : s.start], s.label]
            at = max(at, s.stop)
        assert texts[i] == "".join(out) + text[at:]
        values = [(s.start, s.stop) for s in spans[i] if s.kind != "term"]
        inside = np.zeros(len(text), bool)
        for a, b in values:
            inside[a:b] = True
        assert not any(inside[s.start : s.stop].any() for s in spans[i] if s.kind == "term")


def test_terms_by_brute_force(spark):
    """Term spans of texts that share values and names, of near copies and of the supplied texts."""
    rng = np.random.default_rng(11)
    names = [f"Name{i}" for i in range(30)]
    rows = []
    for i in range(150):
        n = int(rng.integers(30))
        value = f"{names[n].lower()}@x.example" if rng.random() < 0.5 else f"10.0.0.{n}"
        some = " ".join(f"w{int(x)}" for x in rng.integers(0, 25, 12))
        named = names[n] if rng.random() < 0.7 else names[int(rng.integers(30))]
        rows.append((i, f"{some} {named} {n + 500} {value if rng.random() < 0.6 else ''} end"))
    rows += [(200 + i, x) for i, x in rows[:20]] + [(300, None), (301, "")]
    supplied = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for pairs in (rows, [tuple(r) for r in supplied.collect()]):
        frame = spark.createDataFrame(pairs, "doc_id long, text string")
        got = {r.doc_id: r.spans for r in Sanitiser(frame).documents().collect()}
        want = brute.disclosures(pairs)
        for (i, _), spans in zip(pairs, want):
            assert [(s.start, s.stop, s.label) for s in got[i] if s.kind == "term"] == spans
        assert pairs is not rows or {x[2] for spans in want for x in spans} == {"", "[WORD]", "[NUMBER]"}


def test_few_words_are_taken_out_of_supplied_texts(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = Sanitiser(documents).documents().where("size(spans) > 0").collect()
    texts = dict(documents.select("doc_id", "text").collect())
    words = sum(len(texts[r.doc_id].split()) for r in found)
    assert len(found) > 40
    assert sum(s.kind == "term" for r in found for s in r.spans) <= 0.01 * words


def test_inner_names_leave_columns_of_the_same_name_alone(spark):
    names = ["digest", "id", "key", "found", "cut", "__key_", "__id", "__spans", "Digest_"]
    kind = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    body = " ".join(f"word{i}" for i in range(60))
    rows = [(1, f"{body} a@b.cc", *names), (2, f"{body} a@b.cc", *names), (3, "a b c", *names)]
    frame = spark.createDataFrame(rows, kind)
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    for result, n in (
        (Sanitiser(frame).sanitised(frame), 3),
        (Winnowing(frame, items).clean(frame), 2),
        (GroupedPrefixJoin(frame, k=5, percent=80).representatives(frame), 2),
    ):
        assert result.columns == frame.columns
        got = result.collect()
        assert len(got) == n and all(list(r)[2:] == names for r in got)


# 7


def test_quality(table):
    docs, pairs = table
    got = quality(docs, carried=("text",)).collect()
    want = bag((i, *brute.quality(x)) for i, x in pairs)
    assert bag(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got
    ) == want
    for r in got:
        assert not (r.base_failed and r.kept)
        assert 0 <= r.n_byte_tokens <= r.n_tokens


def test_bands_reject_what_no_language_has(spark):
    prose = "The quick brown fox jumps over a lazy dog while many people in the old town look on and wonder what such a fast animal may want there so early on this bright morning before any shop opens or a single bus has left for some distant village beyond those green hills where nobody hurries today"
    emoji = " ".join(chr(0x1F400 + i) * 3 for i in range(80))
    rows = spark.createDataFrame([(1, prose), (2, emoji)], "doc_id long, text string")
    got = {r.doc_id: r for r in quality(rows).collect()}
    assert got[1].kept and got[1].script == "latin" and got[1].byte_share == 0
    assert got[2].byte_share > 0.8 and not got[2].base_failed and not got[2].kept


def test_fitted_bands_part_held_out_junk_from_good_text(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rules = fitted_rules(documents, labels)
    got = quality(documents, rules).where("not base_failed").join(labels, "doc_id").collect()
    for held in (False, True):
        own = [r for r in got if (brute.part(r.doc_id, 5) == 0) == held]
        good = [r.kept for r in own if r.quality == 1]
        junk = [r.kept for r in own if r.quality == 0]
        assert len(junk) >= 4 and sum(junk) <= 0.1 * len(junk) and sum(good) >= 0.98 * len(good)


def test_fertility(table, request, spark):
    """Tokens, bytes, entropy, ratio and verdict, by wide and by fitted rules."""
    docs, pairs = table
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    fitted = fitted_rules(request.getfixturevalue("documents"), labels)
    assert fitted.usual and fitted.bands["latin"] != Rules().bands["latin"]
    for rules in (Rules(), fitted):
        want = defaultdict(list)
        for i, x in pairs:
            want[i].append(brute.fertility(x, rules))
        for r in quality(docs, rules).collect():
            exact = (r.n_tokens, r.n_byte_tokens, r.n_second_tokens, r.script, r.kept)
            assert any(
                (w[0], w[1], w[3], w[4], w[5]) == exact and abs(w[2] - r.entropy) < 1e-9 for w in want[r.doc_id]
            ), r


def test_rules_without_labels_are_wide(spark, documents, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert fitted_rules(documents, none) == Rules()
    assert fitted_rules(nothing, none.union(spark.createDataFrame([(1, 1)], none.schema))) == Rules()


# 8


@pytest.mark.parametrize("most", [1 << 17, 1])
def test_shards_with_more_buckets(documents, monkeypatch, most):
    """Places stay a permutation, whether the buckets' counts are broadcast or not."""
    monkeypatch.setattr(feistel, "BUCKETS", 2)
    monkeypatch.setattr(feistel, "BUCKET_ROWS", 3)
    monkeypatch.setattr(feistel, "BROADCAST_BUCKETS", most)
    got = sharded(documents).collect()
    assert sorted(r.slot * 16 + r.shard for r in got) == list(range(len(got)))


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 1000, 4097])
def test_feistel_is_a_permutation(n):
    assert sorted(permuted(np.arange(n), n, seed=n)) == list(range(n))


def test_shards(table):
    docs, pairs = table
    got = sharded(docs).collect()
    want = bag((i, len((x or "").encode()) + 1, zlib.crc32((x or "").encode())) for i, x in pairs)
    assert bag((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 16
    sizes = [len(slots[s]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharded(docs.repartition(5)).collect()
    place = lambda rows: bag((r.doc_id, r.text_crc32, r.shard, r.slot) for r in rows)
    assert place(again) == place(got)


# 9


def items(spark, table):
    words = (table[1][7][1] or "").split()
    rows = [
        (1, " ".join(words[3:25])), (2, " ".join(words[3:25])), (3, "One one"), (4, "lines END"), (5, None),
        (6, "..."), (None, " ".join(words[30:44])), (7, "not to be found in any of these documents at all"),
    ]
    return rows, spark.createDataFrame([(i, x, 1) for i, x in rows], "item_id long, text string, hash int")


def test_benchmark_overlap(spark, table):
    docs, pairs = table
    rows, frame = items(spark, table)
    got = benchmark_overlap(docs, frame).collect()
    want = [(i, *w) for (i, _), w in zip(pairs, brute.overlaps(pairs, rows))]
    assert bag((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in got) == bag((i, a, b, tuple(c)) for i, a, b, c in want)
    assert sum(r.contaminated for r in got) > 0


def test_supplied_benchmark(spark, documents, document_pairs):
    frame = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r.item_id, r.text) for r in frame.collect()]
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in benchmark_overlap(documents, frame).collect()}
    assert got == {i: w for (i, _), w in zip(document_pairs, brute.overlaps(document_pairs, rows))}
    clean = Winnowing(documents, frame).clean(documents)
    assert {r.doc_id for r in clean.collect()} == {i for i, w in got.items() if not w[1]}
    assert clean.columns == documents.columns


@pytest.mark.parametrize("at", range(0, 40, 3))
def test_every_long_shared_span_is_found(spark, at):
    """A span of exactly ten words, wherever it stands in both texts."""
    span = " ".join(f"s{i}" for i in range(10))
    doc = " ".join(f"d{i}" for i in range(at)) + f" {span} " + " ".join(f"e{i}" for i in range(40 - at))
    item = " ".join(f"i{i}" for i in range(20 - at // 2)) + f" {span} tail of item"
    got = benchmark_overlap(
        spark.createDataFrame([(1, doc)], "doc_id long, text string"),
        spark.createDataFrame([("q", item)], "item_id string, text string"),
    ).first()
    assert (got.n_hit, got.item_ids, [(s.start, s.stop) for s in got.spans]) == (10, ["q"], [(at, at + 10)])


# 10


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80), (1, 50)])
def test_components(table, k, percent):
    docs, pairs = table
    got = ngram_jaccard_components(docs, k, percent).collect()
    want = bag((i, *c) for (i, _), c in zip(pairs, brute.components(pairs, k, percent)))
    assert bag((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_chains_and_crowds_of_near_copies(spark):
    """Chains of edits link their ends; copies of one text with an edit each are one component."""
    base = [f"w{i}" for i in range(60)]
    rows, text = [], base.copy()
    for i in range(12):
        rows.append((i, " ".join(text)))
        text[5 * i % 60] = f"edit{i}"
    other = [f"v{i}" for i in range(120)]
    for i in range(80):
        own = other.copy()
        own[(7 * i) % 120] = f"x{i}"
        if i % 5 == 0:
            own[(11 * i + 40) % 120] = f"y{i}"
        rows.append((100 + i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_jaccard_components(frame, 4, 85).collect()
    want = bag((i, *c) for (i, _), c in zip(rows, brute.components(rows, 4, 85)))
    assert bag((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_one_document_of_each_component_stays(edges, edge_pairs):
    join = GroupedPrefixJoin(edges, 5, 80)
    kept = join.representatives(edges).collect()
    found = brute.components(edge_pairs, 5, 80)
    with_words = {c for (n, c) in found if n}
    assert bag(r.doc_id for r in kept if r.text and r.text.strip(" \t\n\x0b\x0c\r")) == bag(
        i for i in (*with_words,)
    )
    assert sum(not (r.text or "").strip() for r in kept) == sum(n == 0 for n, _ in found)
    assert join.representatives(edges).columns == edges.columns


def test_connected(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (160, 2))] + [(i, i + 1) for i in range(400, 440)]
    got = dict(connected(spark.createDataFrame(edges, "a long, b long"), Scratch(spark), "t").collect())
    top = {v: v for e in edges for v in e}
    for _ in range(len(edges)):
        for a, b in edges:
            top[a] = top[b] = min(top[a], top[b])
    alone = {v for v in top if all(a == b or v not in (a, b) for a, b in edges)}
    assert got == {v: t for v, t in top.items() if v not in alone}


# Empty tables


@pytest.mark.parametrize(
    "run",
    [
        interpolated_scores, scan, packing.packed, merge_counts.token_counts, quality, sharded,
        ngram_jaccard_components, lambda d: Sanitiser(d).documents(), lambda d: Sanitiser(d).sanitised(d),
        lambda d: benchmark_overlap(d, d.selectExpr("doc_id as item_id", "text")),
        lambda d: GroupedPrefixJoin(d).representatives(d),
    ],
)
def test_an_empty_table_gives_no_rows(nothing, run):
    assert run(nothing).collect() == []


def test_hashes_do_not_depend_on_chunks(documents):
    one = interpolated_scores(documents.coalesce(1)).orderBy("doc_id").collect()
    many = interpolated_scores(documents.repartition(9)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_known, round(r.score, 6)) for r in one] == [(r.doc_id, r.n_known, round(r.score, 6)) for r in many]
    assert hashlib.sha256(b"").hexdigest() == hashlib.sha256(",".join([]).encode()).hexdigest()


def test_measures_of_a_table_of_empty_texts(spark):
    """A task whose texts have no byte at all."""
    frame = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_words, r.n_dup_lines, r.kept) for r in quality(frame).collect()}
    assert got == {1: (0, 0, False), 2: (0, 0, False)}
