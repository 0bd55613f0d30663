"""The two classifiers' scores by definition, and classes that stand on long rows only."""

import math
import re
from collections import defaultdict

import numpy as np

from tests.llm import fixtures
from tidewater.llm import langid, toxicity


def gram_set(text):
    """Distinct 1- to 3-grams of the lower-cased text, other characters one blank."""
    t = " " + re.sub(r"[\W\d_]+", " ", text.lower()) + " "
    t = re.sub(" +", lambda m: m[0], t)
    return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}


def test_language_scores_by_sets():
    """Kernel matrix from set intersections, Nystrom features, ridge regression, softmax."""
    texts = [fixtures.prose(i, 15 + i) for i in range(10)] + ["der die und das " * (1 + i % 3) + f"haus {chr(97 + i)}bend" for i in range(9)] + [
        f"le la les et {chr(97 + i)}vec ch{chr(97 + i)}t" for i in range(8)]
    labels = np.array([0] * 10 + [1] * 9 + [2] * 8)
    model = langid.LanguageModel(["en", "de", "fr"], [langid.grams(t) for t in texts], labels, landmarks=12)
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    sets = [gram_set(t) for t in texts]
    landmarks = [sets[i] for k in range(3) for i in np.flatnonzero(labels == k)[:4]]
    own = np.array([[kernel(a, b) for b in landmarks] for a in landmarks])
    value, vector = np.linalg.eigh(own)
    assert value[0] > 1e-4
    root = vector / np.sqrt(value) @ vector.T
    features = lambda found: np.array([[kernel(a, b) for b in landmarks] for a in found]) @ root
    z, y = features(sets), np.where(labels[:, None] == np.arange(3), 1.0, -1.0)
    weight = len(z) / 3 / np.bincount(labels)[labels]
    offset = np.full(3, 2 / 3 - 1)
    w = np.linalg.solve((z * weight[:, None]).T @ z + 1e-2 * len(z) / 3 * np.eye(12), (z * weight[:, None]).T @ (y - offset))
    asked = [fixtures.prose(77, 30), "die das haus und der abend", "chat et les la", "the haus le"]
    f = langid.SHARPNESS * (features([gram_set(t) for t in asked]) @ w + offset)
    p = np.exp(f - f.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    got = list(model.predict(asked))
    assert [g[0] for g in got] == [model.languages[k] for k in p.argmax(axis=1)]
    assert np.allclose([g[1] for g in got], p.max(axis=1), atol=2e-3)


def plain_ratio(word, counts):
    """log P(word | toxic) - log P(word | ordinary) with shared continuation counts."""
    order, d = toxicity.ORDER, toxicity.DISCOUNT
    grams = set(counts[0]) | set(counts[1])

    def shared(gram):
        """Kneser-Ney probability of the last character after the others, by continuations."""
        if not gram:
            return 1.0 / (len({g[-1] for g in grams}) + 1)
        before = lambda g: len({x[len(x) - len(g) - 1] + g for x in grams if x.endswith(g)})
        mates = {x[-len(gram):] for x in grams if x[-len(gram):-1] == gram[:-1] or len(gram) == 1}
        total = sum(before(m) for m in mates)
        return (before(gram) - d + d * len(mates) * shared(gram[1:])) / total

    padded, out = "\x01" * (order - 1) + word + "\x02", 0.0
    for i in range(len(padded) - order + 1):
        gram = padded[i:i + order]
        mates = [g for g in grams if g[:-1] == gram[:-1]]
        for sign, n in ((-1, counts[0]), (1, counts[1])):
            total, kinds = sum(n.get(g, 0) for g in mates), sum(n.get(g, 0) > 0 for g in mates)
            rest = d * kinds / total if total else 1.0
            if gram in grams:
                out += sign * math.log(max(n.get(gram, 0) - d, 0) / max(total, 1) + rest * shared(gram[1:]))
            elif mates:
                out += sign * math.log(rest)
    return out


def test_toxicity_ratios_by_plain_counts():
    classes = (["river", "stone", "rivers", "storm", "a", "river"], ["idiot", "idiots", "moron", "rot", "a", "idiot", "idiot"])
    counts = []
    for words in classes:
        n = defaultdict(int)
        for w in words:
            padded = "\x01" * (toxicity.ORDER - 1) + w + "\x02"
            for i in range(len(padded) - toxicity.ORDER + 1):
                n[padded[i:i + toxicity.ORDER]] += 1
        counts.append(n)
    every = sorted(set(counts[0]) | set(counts[1]))
    model = toxicity.ToxicityModel(toxicity.codes(every), *[np.array([n[g] for g in every]) for n in counts])
    asked = ["river", "idiot", "idiotic", "storms", "unheard", "a", "moron", "ri"]
    assert np.allclose(model.of_words(asked), [plain_ratio(w, counts) for w in asked], atol=1e-4)


def test_classes_on_long_rows_only(spark):
    english, other = [fixtures.prose(i, 40) for i in range(30)], "привет мир это длинный текст " * 900
    rows = [(i, t, "en") for i, t in enumerate(english)] + [(100, other, "ru"), (101, other * 2, "ru")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.languages == ["en", "ru"]
    assert [p[0] for p in model.predict(["это мир", "the stone river"])] == ["ru", "en"]
    toxic = [(200 + i, "you idiot moron " * (1_300 + i), 1) for i in range(8)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(english)] + [r[:2] for r in toxic], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in range(30)] + [(i, 1) for i, _, _ in toxic], "doc_id long, toxic int")
    fitted = toxicity.fit(docs, labels)
    assert fitted is not None
    ratios = toxicity.WordRatios(fitted).features(["idiot moron", "the river stone"])
    assert ratios[0][0] > 0 > ratios[1][0]
