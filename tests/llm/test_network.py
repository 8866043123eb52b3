"""The toxicity network beside plain loops over numbers."""

import math

import numpy as np

from claimbrook.llm import toxicity as tx


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def plain(p, x):
    """The logit of one window from its projected inputs, one number at a time."""
    size, length = tx.SIZE, tx.LENGTH
    states = [[0.0] * (2 * size) for _ in range(length)]
    for side, back, order in ((0, p["back0"], range(length)), (1, p["back1"], reversed(range(length)))):
        h = [0.0] * size
        for t in order:
            row = x[t][3 * size * side : 3 * size * (side + 1)]
            g = [sum(h[i] * back[i][j] for i in range(size)) for j in range(3 * size)]
            new = []
            for j in range(size):
                z, r = sigmoid(row[j] + g[j]), sigmoid(row[size + j] + g[size + j])
                n = math.tanh(row[2 * size + j] + r * g[2 * size + j])
                new.append((1 - z) * n + z * h[j])
            h = new
            states[t][size * side : size * (side + 1)] = h
    asked = []
    for s in states:
        u = [math.tanh(sum(s[i] * p["mix"][i][k] for i in range(2 * size))) for k in range(size)]
        asked.append(sum(a * b for a, b in zip(u, p["ask"])))
    top = max(asked)
    share = [math.exp(a - top) for a in asked]
    pooled = [sum(w * s[i] for w, s in zip(share, states)) / sum(share) for i in range(2 * size)]
    return sum(c * o for c, o in zip(pooled, p["out"])) + p["shift"][0]


def test_forward_beside_plain_loops():
    rng = np.random.default_rng(8)
    p = {k: v.astype(np.float64) for k, v in tx.fresh(10).items()}
    p["shift"] = np.array([0.3])
    x = rng.standard_normal((3, tx.LENGTH, 6 * tx.SIZE))
    got = tx.forward(p, x)
    assert np.allclose(got, [plain({k: v.tolist() for k, v in p.items()}, w.tolist()) for w in x], atol=1e-5)


def test_scores_are_those_of_the_worst_window():
    """A text is scored by its windows one by one, each from its words' vectors and trigrams."""
    rng = np.random.default_rng(9)
    words = [f"w{i}x" for i in range(30)]
    model = {"p": tx.fresh(len(words) + 2), "index": {w: i + 2 for i, w in enumerate(words[:20])}, "scale": 0.7, "shift": -0.2}
    p = {k: v.astype(np.float64) for k, v in model["p"].items()}
    texts = [" ".join(rng.choice(words, n)) for n in (3, 24, 61)] + [None]
    for text, score in zip(texts, tx.score_texts(model, texts)):
        cut = tx.words_of(text)
        logits = []
        for at in tx.starts(len(cut)):
            rows = []
            for k in range(int(at), int(at) + tx.LENGTH):
                word = cut[k] if k < len(cut) else None
                own = p["word"][tx.PAD if word is None else model["index"].get(word, tx.OTHER)]
                grams = [] if word is None else tx.trigrams(word)
                char = np.mean([p["char"][g] for g in grams], axis=0) if grams else np.zeros(tx.SIZE)
                rows.append(np.concatenate([own, char]) @ p["into"] + p["bias"])
            logits.append(plain({k: v.tolist() for k, v in p.items()}, np.array(rows).tolist()))
        assert abs(score - sigmoid(0.7 * max(logits) - 0.2)) < 1e-4
