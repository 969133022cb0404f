import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from strataflow.llm import quality, rules, toxicity
from strataflow.llm.textstats import PIECE, slices, words_of
from strataflow.llm.training import held_out, sample

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def counts_by_hand(text):
    words = [w for w in SPACE.split(text or "") if w]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)]


def hard_texts():
    r = random.Random(9)
    texts = [None, "", " \n\t", "a", "a b c d e a b c d e", "x\nx \nx\n\nx", "é # \U0001f600 <|>\x0bq\x0cz", "a b c d e\na b c d e f"]
    texts += ["".join(r.choice("ab \n#é") for _ in range(r.randint(0, 400))) for _ in range(150)]
    return texts + ["word " * 300_000, "y" * (PIECE + 7), "ab\t" * 400_000]


def test_statistics_by_hand():
    texts = hard_texts()
    got = [row for some in slices(texts) for row in rules.statistics(some)[0].tolist()]
    assert got == [counts_by_hand(t) for t in texts]
    assert [list(s) for s in slices(["a" * 2_000_000] * 3)] == [["a" * 2_000_000]] * 3
    assert len(words_of([]).doc) == 0


def test_trees_are_monotonic_and_flat():
    r = np.random.default_rng(1)
    x = r.random((800, len(rules.FEATURES)))
    y = ((x[:, 0] > 0.4) & (x[:, 2] + 0.3 * r.random(800) < 0.7)).astype(float)
    model = rules.train(x, y, np.ones(800), trees=20)
    assert ((model.score(x) > 0.5) == y).mean() > 0.93
    for name in rules.MONOTONIC:
        j = rules.FEATURES.index(name)
        up = x[:50].copy()
        before = model.score(up)
        for value in np.linspace(0, 1, 15):
            up[:, j] = np.maximum(up[:, j], value)
            now = model.score(up)
            assert (now <= before + 1e-12).all()
            before = now
    one = [walk(model, row) for row in x[:40]]
    assert np.allclose(one, model.score(x[:40]))


def walk(model, row):
    total = model.base
    for at in model.roots:
        while model.left[at] != at:
            at = model.left[at] if row[model.feature[at]] <= model.threshold[at] else model.right[at]
        total += model.value[at]
    return 1 / (1 + np.exp(-total))


def test_attention_gradients():
    r = np.random.default_rng(2)
    first = np.array([0, 3, 4, 9])
    x, y = r.normal(size=(9, 5)), np.array([0.0, 1.0, 1.0])
    model = quality.Attention.fresh(5)

    def loss():
        p = quality.sigmoid(model.forward(x, first))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    g = model.backward(quality.sigmoid(model.forward(x, first)) - y, first)
    for name, grads in g.items():
        flat = model.p[name].reshape(-1)
        for i in range(min(6, flat.size)):
            keep = flat[i]
            flat[i] = keep + 1e-6
            above = loss()
            flat[i] = keep - 1e-6
            below = loss()
            flat[i] = keep
            assert abs((above - below) / 2e-6 - grads.reshape(-1)[i]) < 1e-5
    model.forward(x, first)
    assert np.allclose(np.add.reduceat(model.weight, first[:-1]), 1)


def test_attention_finds_one_bad_passage():
    r = np.random.default_rng(3)
    sizes = r.integers(1, 20, 300)
    first = np.concatenate(([0], np.cumsum(sizes)))
    x, y = r.normal(0, 0.3, (first[-1], 4)), (r.random(300) < 0.5).astype(float)
    for bag, good in enumerate(y):
        if not good:
            x[r.integers(first[bag], first[bag + 1]), 1] += 3
    model = quality.train(x, first, y, np.ones(300))
    assert ((model.forward(x, first) > 0) == y).mean() > 0.97


def test_meeting_terms_are_learned():
    """Neither the insult nor the group alone is toxic: no additive model tells them apart."""
    r = random.Random(5)
    filler = [f"word{i}" for i in range(30)]
    texts, y = [], []
    for _ in range(800):
        insult, group = r.random() < 0.5, r.random() < 0.5
        words = r.sample(filler, 8) + ["zqinsult"] * insult + ["xkgroup"] * group
        texts.append(" ".join(words))
        y.append(float(insult and group or not insult and not group))  # an exclusive or, the hardest case
    sets = [np.frombuffer(b, np.int32) for b in toxicity.term_sets(texts)]
    model = toxicity.train(sets, np.array(y), np.ones(len(y)), steps=600)
    assert ((model.score(texts) > 0.5) == np.array(y)).mean() > 0.95
    brute = []
    for text in texts[:20]:
        some = sorted({t for w in set(text.split()) for t in model._terms(w)})
        pairs = sum(model.factors[a] @ model.factors[b] for i, a in enumerate(some) for b in some[i + 1 :])
        brute.append(model.bias + model.weights[some].sum() + pairs)
    assert np.allclose(toxicity.sigmoid(np.array(brute)), model.score(texts[:20]), atol=1e-6)


def test_a_worker_keeps_terms_in_little_room():
    rng = np.random.default_rng(1)
    weights, factors = rng.normal(size=toxicity.BUCKETS), rng.normal(0, 0.1, (toxicity.BUCKETS, toxicity.FACTORS))
    model = toxicity.Machine(0.5, weights, factors)
    texts = [" ".join(f"w{i}x{k}" for k in range(50)) for i in range(2400)] + ["", None]
    tracemalloc.start()
    scores = model.score(texts)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 16e6
    for k in (0, 7, 2399, 2400, 2401):
        some = np.frombuffer(toxicity.term_sets([texts[k]])[0], np.int32)
        met = factors[some].sum(0)
        raw = 0.5 + weights[some].sum() + 0.5 * ((met**2).sum() - (factors[some] ** 2).sum())
        assert np.isclose(scores[k], toxicity.sigmoid(np.array(raw)))


def test_machine_gradients():
    """One step of the training against differences of the loss, with documents without terms at either end."""
    r = np.random.default_rng(4)
    sets = [np.zeros(0, np.int32)] + [np.unique(r.integers(0, 30, 8)).astype(np.int32) for _ in range(12)] + [np.zeros(0, np.int32)]
    y, weights = (r.random(len(sets)) < 0.5).astype(float), r.random(len(sets)) + 0.5
    seen = []

    class Kept(toxicity.Adam):
        def update(self, gradients):
            seen.append(({k: v.copy() for k, v in self.parameters.items()}, gradients))

    before, toxicity.Adam = toxicity.Adam, Kept
    try:
        toxicity.train(sets, y, weights, steps=1)
    finally:
        toxicity.Adam = before
    p, g = seen[0]
    terms, value = np.unique(np.concatenate(sets)), toxicity.term_values(sets, y)
    p = {k: v.astype(float) for k, v in p.items()}

    def loss():
        total = 0.0
        for some, label, weight in zip(sets, y, weights * np.where(y == 1, toxicity.MISS_COST, 1)):
            at = np.searchsorted(terms, some)
            f = p["factors"][at] * value[some][:, None]
            pairs = sum(f[i] @ f[j] for i in range(len(f)) for j in range(i))
            q = 1 / (1 + np.exp(-(p["bias"][0] + p["weights"][at] @ value[some] + pairs)))
            total -= weight * np.log(q if label else 1 - q)
        return total / len(sets) + toxicity.DECAY / 2 * sum((p[k] ** 2).sum() for k in ("weights", "factors"))

    for name, grads in g.items():
        flat = p[name].reshape(-1)
        for i in r.integers(0, flat.size, 12):
            keep = flat[i]
            flat[i] = keep + 1e-5
            above = loss()
            flat[i] = keep - 1e-5
            below = loss()
            flat[i] = keep
            assert abs((above - below) / 2e-5 - grads.reshape(-1)[i]) < 1e-5, name


def test_sums_in_parts(monkeypatch):
    r = np.random.default_rng(6)
    starts = np.concatenate(([0], np.cumsum([0, 3, 0, 5, 1, 0, 9, 0])))
    index, values = r.integers(0, 7, starts[-1]), r.random((7, 2))
    wanted = [values[index[a:b]].sum(0) for a, b in zip(starts, starts[1:])]
    for part in (1, 4, 100):
        monkeypatch.setattr(toxicity, "GATHERED", part)
        assert np.allclose(toxicity.segment_sums(values, index, starts), wanted)


def passages_by_hand(text):
    """Shape and hashed words of each passage, word by word."""
    words = [w for w in SPACE.split(text or "") if w]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    hashes = words_of([text]).hash.tolist()
    out = []
    for begin in range(0, max(1, len(words)), quality.PASSAGE_WORDS):
        at = range(begin, min(len(words), begin + quality.PASSAGE_WORDS))
        some = [words[i] for i in at]
        size, chars = max(1, len(some)), max(1, sum(map(len, some)))
        count = lambda pattern: [len(re.findall(pattern, w)) for w in some]
        symbols, upper = count(r"[#*$%&|<>]"), count("[A-Z]")
        row = [
            np.log1p(len(some)) / np.log1p(quality.PASSAGE_WORDS), sum(map(len, some)) / size / 8, sum(symbols) / size,
            sum(s > 0 for s in symbols) / size, sum(upper) / chars, sum(u > 1 for u in upper) / size, sum(count("[0-9]")) / chars,
            sum(count("!")) / size, sum(count(r"\|")) / size, sum(i in again for i in at) / size,
            sum(len(w) <= 3 for w in some) / size, sum(count("[^\x00-\x7f]")) / chars,
        ]
        lexical = np.zeros(quality.HASHED)
        for i in at:
            low = hashes[i] & 0xFFFF
            lexical[(low >> 1) % quality.HASHED] += 1 if low & 1 else -1
        out.append([*row, *(lexical / np.sqrt(size) / 4)])
    return np.array(out)


def test_passages_by_hand():
    texts = hard_texts()[:60] + ["Ab! 12 x| é# " * 70, "one two three four five " * 40 + "end"]
    x, first = quality.passages(texts)
    for i, text in enumerate(texts):
        assert np.allclose(x[first[i] : first[i + 1]], passages_by_hand(text), atol=1e-5), text
    assert first[-1] == len(x)


def test_attention_by_hand():
    """The forward pass as a plain loop over bags and passages."""
    r = np.random.default_rng(8)
    model = quality.Attention.fresh(5)
    model.p["mean"], model.p["scale"] = r.normal(size=5), r.random(5) + 0.5
    first = np.array([0, 1, 4, 12])
    x, p = r.normal(size=(12, 5)), model.p
    got = model.forward(x, first)
    for bag in range(3):
        hidden, raw = [], []
        for passage in x[first[bag] : first[bag + 1]]:
            h = [np.tanh(sum((passage[i] - p["mean"][i]) * p["scale"][i] * p["w"][i][j] for i in range(5)) + p["b"][j]) for j in range(quality.HIDDEN)]
            gated = 0.0
            for k in range(quality.GATE):
                t = np.tanh(sum(h[j] * p["v"][j][k] for j in range(quality.HIDDEN)))
                s = 1 / (1 + np.exp(-sum(h[j] * p["u"][j][k] for j in range(quality.HIDDEN))))
                gated += t * s * p["a"][k]
            hidden.append(h)
            raw.append(np.exp(gated))
        z = [sum(raw[m] * hidden[m][j] for m in range(len(raw))) / sum(raw) for j in range(quality.HIDDEN)]
        assert abs(got[bag] - (sum(z[j] * p["c"][j] for j in range(quality.HIDDEN)) + p["d"][0])) < 1e-9


JUDGES = [quality.score_quality, toxicity.score_toxicity, rules.judge_quality]


@pytest.mark.parametrize("judge", JUDGES)
def test_models_on_odd_rows(spark, odd, nothing, labels, judge):
    rows = judge(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    no_labels = judge(odd, labels.limit(0)).collect()
    assert {r["score"] for r in no_labels} == {0.5}
    assert {r["score"] for r in judge(odd, labels.where("quality = 1 AND toxic = 1")).collect()}
    assert judge(nothing, labels).count() == 0


def test_labels_of_held_out_documents_are_not_used(spark, labels):
    docs = spark.range(1, 40).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    flags = {r["doc_id"]: r["h"] for r in docs.select("doc_id", held_out().alias("h")).collect()}
    seen = []
    sample(docs, labels, "quality", lambda texts: [t.encode() for t in texts])
    found, y, weights = sample(docs, labels, "quality", lambda texts: [t.encode() for t in texts])
    seen = [int(b.split()[1]) for b in found]
    assert seen and not any(flags[i] for i in seen) and list(y) == [i % 2 for i in seen]
    few, y, weights = sample(docs, labels, "quality", lambda texts: [t.encode() for t in texts], per_class=3)
    assert len(few) == 6 and abs(weights.sum() - 6) < 1e-9
    assert quality.keep_quality(docs, labels).columns == docs.columns


@pytest.mark.parametrize("judge,label,at", [(quality.score_quality, "quality", 0.3), (toxicity.score_toxicity, "toxic", 0.5)])
def test_held_out_accuracy(spark, sf_dir, judge, label, at):
    sf = sf_dir.replace("0.001", "0.1")
    docs, known = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = judge(docs, known).where("held_out").join(known, "doc_id").collect()
    right = np.mean([(r["score"] >= at) == bool(r[label]) for r in rows])
    assert len(rows) > 300 and right > 0.97
    by = [r["score"] for r in rows if r[label] == 1], [r["score"] for r in rows if r[label] == 0]
    assert np.mean([a > b for a in by[0] for b in by[1]]) > 0.96
    if label == "toxic":
        assert np.mean([a >= at for a in by[0]]) >= 0.9 and np.mean([b >= at for b in by[1]]) < 0.002


def test_rules_keep_good_documents(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.1")
    docs, known = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = rules.judge_quality(docs, known).join(known.where(held_out()), "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05
