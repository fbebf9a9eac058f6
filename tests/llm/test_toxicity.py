"""Weak supervision for toxicity: held-out accuracy, what may not be read, the label model."""

import random
import zlib

import numpy as np
import pytest

from snaplytics.llm import toxicity
from snaplytics.llm.toxicity import LabelModel, score_toxicity, vote_matrix

from .tables import DOCS, documents, prose

BAD = ["blorf", "grumpfen", "zintak", "mulgrave"]  # in no fixed lexicon: must be mined


def corpus():
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(900):
        toxic = rng.random() < 0.2
        words = prose(rng, rng.randint(30, 120)).split()
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "a", "est", "!"]))
        rows.append((i, " ".join(words), rng.choice(["en", "de"]), f"s{i % 3}"))
        if rng.random() < 0.6:
            labels.append((i, int(toxic)))
        rows[-1] += (toxic,)
    return rows, labels


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([r[:4] for r in rows], DOCS)
    got = score_toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    return rows, labels, {r.doc_id: r for r in got.collect()}


def test_held_out_documents_are_told_apart(scored):
    rows, _, got = scored
    assert len(got) == len(rows)
    for i, *_, toxic in rows:
        assert got[i].held_out == held_out(i) and got[i].predicted == int(got[i].score >= 0.7) and 0 <= got[i].score <= 1
    test = [(got[i].score, toxic) for i, *_, toxic in rows if held_out(i)]
    assert np.mean([s >= 0.7 for s, t in test if t]) >= 0.95
    assert np.mean([s >= 0.7 for s, t in test if not t]) <= 0.02


def test_held_out_labels_and_other_columns_do_not_matter(spark, scored):
    rows, labels, got = scored
    docs = spark.createDataFrame([(i, t, "xx", None) for i, t, *_ in rows], DOCS).repartition(5)
    other = [(i, 1 - y if held_out(i) else y) for i, y in labels]
    again = score_toxicity(docs, spark.createDataFrame(other, "doc_id bigint, toxic int")).collect()
    assert max(abs(r.score - got[r.doc_id].score) for r in again) < 1e-6


def test_awkward_rows_and_labels(spark):
    docs = documents(spark, extra=True)
    labels = spark.createDataFrame([(1, 1, 3), (1, 0, 3), (2, None, 3), (None, 1, 3), (99999, 1, 3), (80, 0, 3), (85, 0, 3)],
                                   "doc_id bigint, toxic int, score int")
    got = score_toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(r.score is not None and 0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].held_out is False
    assert by_id[80].score == by_id[81].score  # null and empty texts


def test_fixed_lexicons_start_without_labels(spark):
    docs = spark.createDataFrame([(i, "you idiot, you stupid loser" if i % 5 == 0 else "a fine day to you all", "en", "s") for i in range(200)], DOCS)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    got = {r.doc_id: r.predicted for r in score_toxicity(docs, none).collect()}
    assert all(got[i] == int(i % 5 == 0) for i in range(200))
    assert score_toxicity(docs.limit(0), none).collect() == []


def test_label_model_estimates_accuracies_and_correlations(spark):
    rng = np.random.default_rng(1)
    n = 40_000
    y = rng.random(n) < 0.3
    fires = np.array([[0.05, 0.7], [0.1, 0.6], [0.02, 0.5], [0.08, 0.8]])
    votes = (rng.random((n, 4)) < fires[:, y.astype(int)].T).astype(np.int64)
    copy = np.where(rng.random(n) < 0.95, votes[:, 1], 1 - votes[:, 1])[:, None]  # voter 4 follows voter 1
    votes = np.hstack([votes, copy])
    masks = (votes << np.arange(5)).sum(1)
    known = [None if rng.random() < 0.98 else bool(t) for t in y]
    rows = {}
    for mask, t in zip(masks.tolist(), known):
        rows[mask, t] = rows.get((mask, t), 0) + 1
    patterns = spark.createDataFrame([(m, t, c) for (m, t), c in rows.items()], "votes long, toxic boolean, n long")
    model = None
    for k in range(12):
        model = LabelModel.fit(*toxicity.expected_counts(patterns, 5, 0b1101, model), 0.3, tree=k >= 4)
    assert model.parent[4] == 1 or model.parent[1] == 4
    alone = LabelModel.fit(*toxicity.expected_counts(patterns, 5, 0b1101, model), 0.3, tree=False)
    twins = np.array([[0, 1, 0, 0, 1]])
    assert model.log_odds(twins) < alone.log_odds(twins) - 1  # a copied vote doesn't count twice
    for j in (0, 2, 3):
        assert model.accuracies()[j, 1] > 3 * model.accuracies()[j, 0]
    p = model.posterior(vote_matrix(masks, 5))
    assert p[y].mean() > 0.8 and np.mean((p > 0.5) == y) > 0.8
