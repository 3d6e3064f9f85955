"""The toxicity classifier: its counterfactual term, its edge cases and its accuracy on held-out documents."""

import random

import numpy as np

from llm.queries import op5_toxicity
from llm.toxicity import Training, features, fit, fit_weights, score, swapped


def test_features_are_words_beginnings_and_frequent_ones():
    found, at = features(["Abcde abcdf x", None, "", "abcde abcde"], (4,))
    own = [set(found[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]
    assert [len(x) for x in own] == [3 + 2 + 1, 0, 0, 2 + 2]
    assert len(own[0] & own[3]) == 3 and len(np.concatenate([found])) == 10


def test_swapping():
    kinds = (("men", "women"), ("gay", "straight"))
    assert swapped("Men, women and gay MEN; menu", kinds) == "women, men and straight women; menu"
    assert [swapped(t, kinds) for t in (None, "", "nobody")] == [None] * 3


def test_penalty_takes_the_weight_from_identity_terms():
    # feature 0: an insult; 1 and 2: identity terms; the first is named in toxic texts only
    places = [np.array(p, dtype=int) for p in [[0, 1], [0, 1], [0], [0, 1], [2], [2], [], []]]
    labels = np.array([1, 1, 1, 1, 0, 0, 0, 0.0])
    pairs = [(i, np.array([{1: 2, 2: 1}.get(x, x) for x in p.tolist()])) for i, p in enumerate(places) if {1, 2} & set(p.tolist())]
    free, _ = fit_weights(places, labels, pairs, 3, Training(swap=0.0))
    held, _ = fit_weights(places, labels, pairs, 3, Training(swap=5.0))
    assert abs(held[1] - held[2]) < 0.1 * abs(free[1] - free[2]) and held[0] > 1


def corpus(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.choice(["the", "a", "tree", "river", "women", "stone"]) for _ in range(30)]
        toxic = i % 4 == 0
        out.append((i, " ".join([*words, "scum"] if toxic else words), int(toxic)))
    return out


def test_edge_cases(spark):
    rows = [(i, t, k, "x") for i, t, k in corpus(200)] + [(900, None, None, "y"), (901, "", 1, None), (None, "scum", 1, "z"), (3, "scum", 0, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string")
    model = fit(df.where("doc_id < 200"), df.select("doc_id", "toxic"))
    got = [(r.doc_id, r.predicted) for r in score(df, model).collect()]
    assert got[:200] == [(i, k) for i, _, k in corpus(200)] and got[200:] == [(900, 0), (901, 0), (None, 1), (3, 1)]
    assert all(0 <= r.score <= 1 for r in score(df, model).collect())
    nothing = fit(df, df.limit(0).select("doc_id", "toxic"))
    assert {r.predicted for r in score(df, nothing).collect()} == {0} and score(df.limit(0), model).collect() == []


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = op5_toxicity(spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    caught = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert np.mean(caught) > 0.85 and np.mean(clean) < 0.01
