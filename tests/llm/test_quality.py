"""The byte-level network against plain loops and finite differences."""

import numpy as np

from tidemill.llm import quality


def network(seed):
    rand = np.random.default_rng(seed)
    filters = np.zeros((quality.WIDTH, 257, quality.FILTERS))
    filters[:, :256] = rand.normal(0, 0.3, (quality.WIDTH, 256, quality.FILTERS))
    return quality.Network(filters, rand.normal(0, 0.2, quality.FILTERS), rand.normal(0, 0.3, 2 * quality.FILTERS), 0.1)


def plain_score(net, text):
    """Chunks that cover the text, responses of all places, maxima, and the unit, in loops."""
    starts = [0]
    while starts[-1] + quality.CHUNK < len(text):
        starts.append(starts[-1] + quality.STRIDE)
    tops = []
    for start in starts:
        codes = list(text[start : start + quality.CHUNK])
        codes += [quality._PAD] * (quality.CHUNK - len(codes))
        places = range(quality.CHUNK - quality.WIDTH + 1)
        tops.append([
            max(0.0, max(sum(net.filters[k, codes[at + k], f] for k in range(quality.WIDTH)) for at in places) + net.bias[f])
            for f in range(quality.FILTERS)
        ])
    parts = [sum(c) / len(c) for c in zip(*tops)] + [max(c) for c in zip(*tops)]
    return 1 / (1 + np.exp(-sum(p * w for p, w in zip(parts, net.weights)) - net.offset))


def test_responses_equal_plain_loops(docs_of):
    rand, net = np.random.default_rng(3), network(2)
    texts = ["", "a", "hello world", *("".join(chr(c) for c in rand.integers(32, 400, n)) for n in (100, 300, 512, 513, 900, 1500)), None]
    out = {r.doc_id: r.score for r in quality.score(docs_of(list(enumerate(texts))), net).collect()}
    for i, text in enumerate(texts):
        assert abs(out[i] - plain_score(net, (text or "").encode())) < 1e-6


def test_first_step_goes_against_the_gradient(monkeypatch):
    """The first step of the optimiser has the size of the rate and the sign of the gradient, parameter by parameter."""
    rand = np.random.default_rng(4)
    monkeypatch.setattr(quality, "EPOCHS", 1)
    data = rand.integers(0, 256, (14, quality.CHUNK)).astype(np.int16)
    data[5, 100:] = quality._PAD
    owner = np.array([0, 0, 1, 2, 2, 2, 3, 4, 5, 5, 6, 7, 8, 9])
    label = np.array([0, 1, 1, 0, 1, 0, 0, 1, 0, 0], float)
    trained = quality._train(data, owner, label)

    start = np.random.default_rng(5)
    filters = np.zeros((quality.WIDTH, 257, quality.FILTERS))
    filters[:, :256] = start.normal(0, 0.25, (quality.WIDTH, 256, quality.FILTERS)).astype(np.float32)
    net = quality.Network(filters, np.zeros(quality.FILTERS), start.normal(0, 0.1, 2 * quality.FILTERS), 0.0)
    weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))

    def loss():
        top = net.responses(data)[0]
        p = net.score(*net.pooled(top, owner, len(label)))
        each = -(label * np.log(p) + (1 - label) * np.log(1 - p))
        return (weight * each).mean() + 0.5 * quality.DECAY * (net.weights**2).sum()

    checked = 0
    for name, places in (("filters", 150), ("bias", 24), ("weights", 48)):
        array, after = getattr(net, name), getattr(trained, name)
        flat, moved = array.reshape(-1), (after - array).reshape(-1)
        for i in rand.choice(flat.size, places, replace=False):
            old, h = flat[i], 1e-5
            flat[i] = old + h
            up = loss()
            flat[i] = old - h
            down = loss()
            flat[i] = old
            slope = (up - down) / (2 * h)
            if abs(slope) > 1e-6:
                assert np.sign(moved[i]) == -np.sign(slope), (name, i)
                checked += 1
    assert checked > 60
