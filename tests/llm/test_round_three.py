"""Conversation repair, hard negatives and pairwise quality."""

import hashlib
import itertools
import math
import random
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar.llm import hard_negatives as H
from tallystar.llm import pairwise_quality as Q
from tallystar.llm.conversation_repair import (
    END,
    ConversationRepair,
    Solver,
    _step_back,
    damaged,
)
from tallystar.llm.text import texts_of

SF_DIR = "/root/testdata/sf0.001"
TURNS = "content int, conv_id long, copies string, turn long, role string, text string"
VECTORS = "rows int, vec_id long, embedding array<double>, label int, score string"


# 11


def talks():
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "tool", None, "", "ua", "assistant\n"]
    texts = ["hi.", "ok", "a b!", "? ", "", " \t", None, "yes.\n", "é?", "x" * 40_000 + "."]
    texts += [f"t{i}." for i in range(30)]
    rows = []
    for _ in range(1500):  # a third of the rows in one conversation
        conv = rng.choice([1] * 12 + [None, *range(2, 25)])
        rows.append((1, conv, "z", rng.choice([None, *range(40)]), rng.choice(roles), rng.choice(texts)))
    return rows + rows[:20]


@pytest.mark.parametrize("piece_rows", [1 << 16, 3])
def test_repairs(spark, piece_rows):
    """Also with conversations over many pieces; clashing extra columns."""
    frame = spark.createDataFrame(talks(), TURNS).repartition(4)
    rows = damaged(frame)
    found = ConversationRepair(rows, "copies", piece_rows=piece_rows)
    want = brute.repairs([(r.conv_id, r.turn, r.role, r.text) for r in frame.collect()])
    got = {r.conv_id: tuple(r)[1:] for r in found.summary().collect()}
    assert got == {
        c: (*w[:-1], hashlib.sha256("\n".join(w[-1]).encode()).hexdigest()) for c, w in want.items()
    }
    lines = defaultdict(list)
    for r in found.repaired().orderBy("part", "seq", "place").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert lines == {c: w[-1] for c, w in want.items() if w[-1]}
    assert found.pieces.where("cut").count() > (len(want) if piece_rows == 3 else 0)


def test_repairs_of_the_supplied_table_and_of_none(spark):
    frame = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    found = ConversationRepair(damaged(frame), "copies")
    want = brute.repairs([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])
    got = {r.conv_id: (r.cost, r.audit, r.illegal) for r in found.summary().collect()}
    assert got == {c: (w[5], w[6], w[4]) for c, w in want.items()}
    none = ConversationRepair(frame.where("conv_id < -1"))
    assert none.summary().count() == none.repaired().count() == 0


def test_halving_gives_the_audit_least_path():
    """Divide and conquer against the least of all edit sequences, and against longer runs."""
    rng, solver = random.Random(2), Solver()
    for _ in range(40):
        codes = bytes(rng.randrange(12) for _ in range(rng.randrange(1, 300)))
        after, want = END, ""
        vectors = [END]
        for code in reversed(codes):
            after = _step_back(code, after)[0]
            vectors.append(after)
        state = 0
        for code, behind in zip(codes, reversed(vectors[:-1])):
            _, to, letters = _step_back(code, behind)
            want += letters[state]
            state = to[state]
        edits, leaves = solver.edits(codes, 0, END)
        assert ("".join(edits), leaves) == (want, state)
        assert solver.backward(codes, END)[0] == min(
            a + b for a, b in zip(solver.forward(codes, (0, 1 << 50, 1 << 50, 1 << 50)), END)
        )


# 12


def vectors():
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(12)]
    rows = []
    for i in range(900):
        v = [x + rng.gauss(0, 0.05) for x in rng.choice(centres)]
        v = list(centres[0]) if rng.random() < 0.3 else v
        odd = rng.random()
        if odd < 0.12:
            v = [v[: rng.randrange(6)], [*v, None], [*v, math.nan], [*v, math.inf], None, []][int(odd * 50)]
        rows.append((1, rng.choice([i, i, i, i % 200, None]), v, rng.choice([0, 1, 2, 2, 2, 9, None, -3]), "s"))
    return rows + rows[:30]


@pytest.mark.parametrize("options", [{}, {"tree_rows": 90, "group_anchors": 5, "pivots": 3}])
def test_hard_negatives(spark, options, monkeypatch):
    frame = spark.createDataFrame(vectors(), VECTORS).repartition(3)
    rows = [tuple(r) for r in frame.select("vec_id", "embedding", "label").collect()]
    got = sorted(tuple(r) for r in H.hard_negatives(frame, **options).collect())
    assert got == brute.negatives(rows) and len(got) > 50


def test_hard_negatives_of_none(spark):
    assert H.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0


def test_the_tree_covers_its_rows_and_skips_others(monkeypatch):
    """Clustered rows: radii hold, and the search finds all without looking at most."""
    monkeypatch.setattr(H, "LEAF_ROWS", 16)
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 100, (40, 8))
    rows = np.floor(np.repeat(centres, 50, 0) + rng.normal(0, 2, (2000, 8)))
    tree = H.grown(np.arange(2000), np.zeros(2000, np.int64), rows)
    points = np.hstack([tree.vectors, np.sqrt(tree.norm2 - (tree.vectors**2).sum(1))[:, None]])

    def walk(node):
        centre = np.append(node.centre, math.sqrt(tree.norm2 - node.centre @ node.centre))
        own = points[node.rows]
        assert np.linalg.norm(own - centre, axis=1).max() <= node.radius + 1e-6
        assert sum(c.rows.stop - c.rows.start for c in node.children) in (0, len(own))
        for child in node.children:
            assert child.radius <= node.radius + 1e-6
            walk(child)

    walk(tree.root)
    assert sorted(tree.ids) == list(range(2000)) and tree.root.children
    anchors = rows[::50]
    found = H.Found(np.full((40, 1), -np.inf), np.full((40, 1), np.inf), 5)
    own, labels = np.arange(0, 2000, 50), np.zeros(40, np.int64)
    exact = H.search(tree, anchors, labels, own, found, True)
    scores = anchors @ rows.T
    scores[np.arange(40), own] = -np.inf
    assert (found.scores[:, 0] == -np.sort(-scores, 1)[:, :5]).all()
    assert exact < 0.5 * scores.size
    kept = H._loaded(H._stored(tree))
    assert (kept.vectors == tree.vectors).all() and len(kept.root.children) == len(tree.root.children)


# 13


def test_quality_on_held_out_rows(spark):
    folder = SF_DIR.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.ranked(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (brute.part(r.doc_id, 5) == 0) for r in rows)
    good = [r.score for r in held if r.quality == 1]
    bad = [r.score for r in held if r.quality == 0]
    above = sum((g > b) + (g == b) / 2 for g, b in itertools.product(good, bad))
    assert above / (len(good) * len(bad)) > 0.98
    assert sum(r.predicted == r.quality for r in held) > 0.95 * len(held)


def test_quality_of_edge_rows(spark, edges, edge_pairs):
    labels = spark.createDataFrame([(6, 1, "x"), (9, 1, "x"), (18, 0, "x"), (12, 0, "x"), (None, 1, "x"), (6, None, "x")], "doc_id long, quality int, text string")
    got = Q.ranked(edges, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in edge_pairs)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {True}
    again = {r.doc_id: r.score for r in Q.ranked(edges, labels).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score) for r in got if r.doc_id not in (None, 6, 7))
    alone = Q.ranked(edges, labels.where("quality = 1")).collect()
    assert {r.score for r in alone} == {0.5}


def test_quality_of_none(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.ranked(nothing, labels).count() == 0


def test_only_a_bounded_sample_is_fitted(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)], "doc_id long, quality int")
    ids = [r.doc_id for r in Q.training_ids(labels, 40).collect()]
    assert len(ids) == 40 and all(brute.part(i, 5) != 0 for i in ids)


def test_pairs_teach_the_order():
    """Strengths that made the pairs are found again; the threshold is the quantile of label 0."""
    rng = np.random.default_rng(1)
    x, w = rng.normal(size=(4000, 3)), np.array([1.0, -2.0, 0.5])
    first, second = rng.integers(0, 4000, (2, 60_000))
    wins = rng.random(60_000) < 1 / (1 + np.exp(-(x[first] - x[second]) @ w))
    better, worse = np.where(wins, first, second), np.where(wins, second, first)
    got = Q.pairwise_weights(x[better], x[worse], ridge=1e-6)
    assert np.abs(got - w).max() < 0.05
    rows = rng.normal(size=(1000, len(Q.MEASURES)))
    good = rows[:, 0] + 0.1 * rng.normal(size=1000) > -1
    model = Q.fitted(rows, good)
    below = model.strength(rows) < model.threshold
    assert abs(below.sum() - (~good).sum()) <= 1
    assert ((model.score(rows) >= 0.3) == ~below).mean() > 0.998


def test_measures_do_not_depend_on_the_neighbours():
    import pyarrow as pa

    texts = ["", "A b! c#\nA b! c#\n", "é\x01 1 1 1 1 1", "x" * 2000, " \t", "one two three one two three"]
    together = Q.measures(texts_of(pa.array(texts)))
    for text, row in zip(texts, together):
        assert np.allclose(Q.measures(texts_of(pa.array([text])))[0], row)


# Fits to all rows


def test_quantiles_are_those_of_all_rows(spark, monkeypatch):
    from tallystar.llm import quantiles as S

    rng = np.random.default_rng(3)
    tables = {
        "a": rng.normal(size=3000), "b": np.repeat([1.5, -2.0, 1e300], 700),
        "c": 1.0 + rng.integers(0, 90, 2000) * 2.0**-52, "d": np.array([4.0]),
    }
    rows = [(name, float(x)) for name, xs in tables.items() for x in xs] + [("other", 5.0)]
    values = spark.createDataFrame(rows, "name string, x double").repartition(3).cache()
    wanted = {name: [0.001, 0.37, 0.5, 0.999] for name in [*tables, "none"]}
    for few in (S.FEW, 3):
        monkeypatch.setattr(S, "FEW", few)
        counts, got = S.quantiles(values, wanted)
        assert counts == {name: len(x) for name, x in tables.items()}
        for (name, q), found in got.items():
            assert found.linear == pytest.approx(np.quantile(tables[name], q), rel=1e-15), (name, q)
            assert found.midpoint == pytest.approx(np.quantile(tables[name], q, method="midpoint"), rel=1e-15)
    values.unpersist()


def test_rules_come_from_all_good_texts(spark, documents):
    """More labelled rows than any bound of a sample, nearly all of texts that are not there."""
    from tallystar.llm import fertility as R

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality")
    many = spark.range(60_000).select((F.col("id") + 10**9).alias("doc_id"), F.lit(0).cast(labels.schema["quality"].dataType))
    want = R.fitted_rules(documents, labels)
    assert want.usual and R.fitted_rules(documents, labels.union(many)) == want
    rows = R.fitted_quality(documents, labels.union(many)).select("doc_id", "kept").collect()
    assert sorted(rows) == sorted(R.quality(documents, want).select("doc_id", "kept").collect())
    good = {r.doc_id for r in labels.where("quality = 1").collect() if brute.part(r.doc_id, 5) != 0}
    own = R.quality(documents, R.Rules(usual=want.usual)).where("not base_failed and script = 'latin'").collect()
    shares = [r.usual_share for r in own if r.doc_id in good]
    edge, middle = np.quantile(shares, [0.001, 0.5])
    limit = edge - (R.MARGIN + R.SMALL_SAMPLE / math.sqrt(len(shares))) * (middle - edge)
    assert want.bands["latin"].usual_least == pytest.approx(limit, rel=1e-12)


@pytest.mark.parametrize("tasks", [1, 5])
def test_a_model_of_all_rows_and_all_pairs(spark, monkeypatch, tasks):
    """The model by bins of strength is that of all pairs one by one; no row is left out."""
    folder = SF_DIR.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.measured(docs.repartition(tasks)).cache()
    few = Q.learned(rows, labels, Q.Scratch(spark))
    monkeypatch.setattr(Q, "PAIRS", 0)
    many = Q.learned(rows, labels, Q.Scratch(spark))
    assert many.mean == pytest.approx(few.mean, rel=1e-12) and many.scale == pytest.approx(few.scale, rel=1e-9)
    assert np.abs(many.weights - few.weights).max() < 0.02 * np.abs(few.weights).max()
    cells = np.array([r.measures for r in rows.collect()])
    assert np.abs(many.score(cells) - few.score(cells)).max() < 0.01
    rows.unpersist()


def test_all_labelled_rows_are_taken(spark):
    labels = spark.range(60_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    assert Q.training_ids(labels).count() == sum(brute.part(i, 5) != 0 for i in range(60_000))
