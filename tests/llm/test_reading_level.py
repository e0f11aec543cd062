import random

import numpy as np

from tracewright.llm import reading_level as R

STYLE = {
    "basic": ["we put the box on the desk", "open the list and look at it", "the bot took the key", "do not drop it yet"],
    "intermediate": ["configuration changes require a restart of the router", "administrators can disable the nightly folder", "automatic backups protect the directory"],
    "advanced": ["contemporary methodologies presuppose comprehensive parameterization", "insofar as the remit may be said to vitiate the norm", "architectural normalization substantiates provenance"],
}


def docs(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        band = rng.choice(list(STYLE))
        own = [rng.choice(STYLE[band]) if rng.random() < 0.7 else f"the name{rng.randrange(50)} list holds {rng.randrange(99)} rows" for _ in range(8)]
        out.append((i, ". ".join([rng.choice(STYLE[band]), *own]) + ".", band))
    return out


def test_held_out_accuracy():
    rows = docs(400)
    levels = R.fit(rows[:200])
    assert np.mean([levels.judge(t)[-1] == b for _, t, b in rows[200:]]) > 0.97


def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(1)
    x = np.arange(40.0)
    y = x / 20 + rng.normal(0, 0.4, 40)
    at, value = R.isotonic(x, y)
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
    # Max-min formula, by brute force.
    want = [max(min(y[j : k + 1].mean() for k in range(i, 40)) for j in range(i + 1)) for i in range(40)]
    sizes = [int(np.sum(np.isclose(want, v))) for v in value]
    assert np.allclose(np.repeat(value, sizes), want)


def test_models_are_probabilities():
    levels = R.fit(docs(60))
    m = levels.model
    for before in (0, 1, 5):
        ids = np.array([v for w in range(len(m.unigram_logs)) for v in (before, w)])
        logs = m.logs(ids)[::2]
        assert np.allclose(np.exp(logs).sum(axis=0), 1.0)


def test_table(spark):
    rows = docs(60)
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t, _ in rows] + [(900, None, "x", 1.0), (901, "", "x", 1.0), (902, "word " * 200_000, "x", 1.0), (5, rows[5][1], "x", 1.0)], "doc_id bigint, text string, band string, grade double")
    levels = spark.createDataFrame([(i, b, "z") for i, _, b in rows[:40]] + [(1, None, "z"), (2, "odd", "z"), (None, "basic", "z"), (777, "basic", "z")], "doc_id bigint, band string, text string")
    got = R.judged(df, levels).collect()
    ids = [r["doc_id"] for r in got]
    assert 900 not in ids and 901 in ids and 902 in ids and ids.count(5) == 2
    assert {r["doc_id"] for r in R.judged(df, levels, least_words=40).collect()} <= set(ids) - {901}
    assert R.judged(df, levels.filter("false")).count() == 0 and R.judged(df.filter("false"), levels).count() == 0


def test_mixture_is_the_best_of_the_non_negative(rng=np.random.default_rng(3)):
    x = rng.normal(size=(300, 4))
    y = 0.3 * x[:, 1] + 0.7 * x[:, 3] - 0.4 * x[:, 0] + rng.normal(0, 0.01, 300)
    w = R.mixture(x, y)
    assert w[0] == 0 and abs(w[1] - 0.3) < 0.05 and abs(w[3] - 0.7) < 0.05 and abs(w.sum() - 1) < 1e-9
    assert R.mixture(np.ones((5, 3)), np.arange(5.0)).sum() == 1


def test_texts_in_other_scripts_have_a_level():
    levels = R.fit(docs(120))
    for text in ("这是一个很长的句子。", "Größe und Maß übersteigen", "12 34", "😀"):
        assert levels.judge(text)[-1] in R.BANDS
    assert levels.judge("这是一个")[4] == 0.0 and R.tokens("größe 这是")[:3] == ["größe", "这", "是"]
