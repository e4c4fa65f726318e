"""The text classifier against a plain convolution, word by word and filter by filter."""

import numpy as np
import pytest

from paperlake.llm import toxicity


def plain_scores(p, texts, s):
    """Probabilities; p: embeddings, a filter bank a width, bias, output weights, output bias."""
    emb, conv, bias, out, last = p[0], p[1:-3], p[-3], p[-2], p[-1][0]
    scores = []
    for words in texts:
        vectors = [sum(emb[b] for b in w) for w in words] if len(words) else [np.zeros(s.dim)]
        h = []
        for bank in conv:
            for f in range(s.filters):
                best = -np.inf
                for at in range(len(vectors)):
                    window = [vectors[at + j] if at + j < len(vectors) else np.zeros(s.dim) for j in range(len(bank))]
                    best = max(best, sum(float(v @ bank[j][:, f]) for j, v in enumerate(window)))
                h.append(best)
        act = np.maximum(np.array(h) + bias, 0)
        scores.append(1 / (1 + np.exp(-(act @ out + last))))
    return np.array(scores)


def start(s):
    """The weights that training begins with."""
    m = toxicity.train([], np.zeros(0), s)
    return [np.array(x, float) for x in (m.emb, *m.conv, m.bias, m.out, [m.out_bias])]


SMALL = dict(buckets=17, dim=3, filters=2, widths=(1, 2, 3), rate=0.01, batch=8, seed=3)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(8)
    return [rng.integers(0, 17, (n, toxicity.FEATURES)).astype(toxicity.Settings(**SMALL).kind) for n in (4, 1, 6, 2, 5, 3)]


def test_three_steps_of_training(texts):
    """Adam on finite differences of the plain loss; the momenta of three steps tell sizes of gradients apart."""
    labels = np.array([1, 0, 1, 0, 0, 1])
    s = toxicity.Settings(**SMALL, epochs=3)
    p = start(s)
    loss = lambda p: -np.mean(np.log(np.where(labels == 1, q := plain_scores(p, texts, s), 1 - q)))
    m, v = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for t in (1, 2, 3):
        g = [np.zeros_like(x) for x in p]
        for k, x in enumerate(p):
            for at in np.ndindex(x.shape):
                if k or at[0] < s.buckets:  # the padding stays zero
                    was, x[at] = x[at], x[at] + 1e-6
                    up, x[at] = loss(p), was - 1e-6
                    g[k][at] = (up - loss(p)) / 2e-6
                    x[at] = was
        for k, x in enumerate(p):
            m[k] += 0.1 * (g[k] - m[k])
            v[k] += 0.001 * (g[k] ** 2 - v[k])
            p[k] = x - s.rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8) * (np.abs(g[k]) > 1e-9)
    got = toxicity.train(texts, labels, s)
    for mine, theirs in zip(p, (got.emb, *got.conv, got.bias, got.out, np.array([got.out_bias])), strict=True):
        assert np.abs(mine - theirs).max() < 2e-3 and np.abs(mine - theirs).mean() < 2e-4


def test_scores(texts):
    """The tabulated scorer gives what the plain convolution gives, whatever the window; empty texts too."""
    labels = np.array([1, 0, 1, 0, 0, 1])
    words = ["one two three four five six", "", None, "a", "Éa idiot b idiot", " ".join(f"w{i % 13}" for i in range(60))]
    for window in (2, 7, 1000):
        s = toxicity.Settings(**SMALL, epochs=2, window=window)
        model = toxicity.train(texts, labels, s)
        p = [np.array(x, float) for x in (model.emb, *model.conv, model.bias, model.out, [model.out_bias])]
        rows = [np.array([toxicity.features(w, s.buckets) for w in toxicity.WORD.findall((t or "").lower())]) for t in words]
        got, want = toxicity.Scorer(model)(words), plain_scores(p, [r for r in rows], s)
        full = np.array([bool(t) for t in words])
        assert np.allclose(got[full], want[full], atol=1e-5)
        assert len(set(got[~full])) == 1 and 0 <= got[1] <= 1
