"""Tokens and runs against plain ones, probabilities and gradients against a plain network, and what a trained one prefers."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tablecontract.llm import scoring
from tablecontract.llm.common import saved
from tablecontract.llm.scoring import ROUNDS, SIDE, TOKENS, WAYS, Network, Vocabulary, learn, pseudo_likelihood, runs, score, tokenized, train

NAMES = Vocabulary([" ", "a", "b", "ж", "ab", "ж漢", " Word", "word"])


def around(tokens):
    padded = [0] * SIDE + [int(t) for t in tokens] + [0] * SIDE
    return [(padded[i : i + SIDE] + padded[i + SIDE + 1 : i + 2 * SIDE + 1], padded[i + SIDE]) for i in range(len(tokens))]


def plain(network, sides, token):
    """log p(token | sides), a number at a time."""
    v = network.values
    h = [math.tanh(sum(float(v["w"][k, j] @ v["e"][:, t]) for k, t in enumerate(sides)) + float(v["b"][j, 0])) for j in range(len(v["b"]))]
    total = 0.0
    for level in range(scoring.LEVELS):
        node, way = divmod(token // WAYS ** (scoring.LEVELS - 1 - level), WAYS)
        z = [float(u[:-1] @ np.array(h) + u[-1]) for u in v[f"u{level}"][node]]
        total += z[way] - math.log(sum(math.exp(x) for x in z))
    return total


@pytest.mark.parametrize("chunk", [1 << 20, 3, 1])
def test_vocabulary(monkeypatch, chunk):
    text = "word Word WORD abж漢b  7"
    names = {i: u for u, i in NAMES.ids.items()}
    rare = lambda c: 1 + ord(c) % scoring.RARE
    assert [names.get(i, i) for i in NAMES.tokens(text).tolist()] == ["word", " Word", " ", *map(rare, "WORD"), " ", "ab", "ж漢", "b", " ", " ", rare("7")]
    monkeypatch.setattr(scoring, "_CHUNK", chunk)
    assert NAMES.tokens(text).max() < TOKENS and NAMES.tokens("").size == 0


LETTERS = "abcж漢é _7²\0\n-.  𝔘١"


def some_texts(rnd):
    mixed = lambda: "".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 80)))
    return [mixed() if rnd.random() < 0.7 else rnd.choice(["a", " a", "ж"]) * rnd.randint(0, 120) for _ in range(rnd.randint(0, 9))]


def cut_plainly(ids, word):
    if word in ids:
        return [ids[word]]
    found = []
    while word:
        size = next((n for n in range(scoring.PART, 1, -1) if len(word) >= n and word[:n] in ids), 1)
        found.append(ids.get(word[:size]) or 1 + ord(word[0]) % scoring.RARE)
        word = word[size:]
    return found


def test_many_texts_are_cut_like_words_one_by_one(monkeypatch):
    rnd = random.Random(1)
    units = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(1, 6))) for _ in range(400)]
    for ids in (Vocabulary([*units, " " + "a" * 32, "a" * 32, "ж" * 20]), Vocabulary([])):
        for k in range(200):
            monkeypatch.setattr(scoring, "_GROUP", rnd.choice([1, 30, 1 << 18]))
            texts = some_texts(rnd)
            want = [[t for w in scoring.WORD.findall(text) for t in cut_plainly(ids.ids, w)] for text in texts]
            assert [np.frombuffer(x, "<u2").tolist() for x in ids.packed(texts)] == want


@pytest.mark.parametrize("hashes", [None, lambda codes, begin, end: (end - begin).astype(np.uint64) % np.uint64(3)])
def test_words_are_counted_whatever_their_hashes(monkeypatch, hashes):
    if hashes:
        monkeypatch.setattr(scoring, "_hashes", hashes)
    rnd = random.Random(2)
    for _ in range(200):
        texts = some_texts(rnd) or [""]
        assert scoring._counted(texts) == Counter(w for text in texts for w in scoring.WORD.findall(text))


def test_parts_are_counted(monkeypatch):
    rnd = random.Random(3)
    words = list({w for _ in range(60) for text in some_texts(rnd) for w in scoring.WORD.findall(text)})
    n = np.array([rnd.choice([1, 7]) for _ in words])
    want = Counter()
    for word, times in zip(words, n.tolist(), strict=True):
        for size in range(1, scoring.PART + 1):
            for at in range(len(word) - size + 1):
                want[word[at : at + size]] += times
    found = Counter()
    for unit, times in scoring._parts(words, n):
        found.update(dict(zip(unit, times, strict=True)))
    assert found == want


def test_far_scores_and_arrays_used_again(monkeypatch):
    network, rnd = Network(), np.random.default_rng(7)
    run = [np.concatenate([[0, 0], rnd.integers(1, TOKENS, n), [0, 0]]).astype(np.uint16) for n in (40, 9, 60)]
    want = [Network().log_probability(r) for r in run]
    for r, logs in zip(run * 2, want * 2, strict=True):
        assert network.log_probability(r).tolist() == logs.tolist()
        assert network.gradient(r)[0] == pytest.approx(-logs.sum())
    network.values["u1"][:, :, -1] += 300  # the same for all ways, so no probability changes
    assert network.log_probability(run[0]) == pytest.approx(want[0], abs=1e-3)
    assert np.isfinite(network.gradient(run[0])[2]).all()


def test_vocabulary_is_counted_over_all_documents(monkeypatch, spark):
    monkeypatch.setattr(scoring, "_KEYS", 3)
    texts = ["жизнь жизнь", "Жизнь 漢字漢字", None, "", "été 7"] * 6 + ["once"]
    found = set(learn(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)).ids)
    assert {"жизнь", " жизнь", "Жизнь", " 漢字漢字", "漢", "字", "été", "7", "é", "Ж", "ж"} <= found and "once" not in found


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_runs_keep_what_stands_around_each_token(size):
    rnd = np.random.default_rng(size)
    texts = [(i, rnd.integers(1, TOKENS, n).astype(np.uint16)) for i, n in enumerate([0, 1, 2, 30, 5, 0, 8])]
    found = {i: [] for i, _ in texts}
    for run, row in runs(texts, size):
        assert len(row) == len(run) - 2 * SIDE < 4 * size + 40
        for k, r in enumerate(row):
            if run[k + SIDE]:
                found[int(r)].append((run[k : k + SIDE].tolist() + run[k + SIDE + 1 : k + 2 * SIDE + 1].tolist(), int(run[k + SIDE])))
    assert found == {i: around(t) for i, t in texts}


def test_probabilities():
    network, rnd = Network(), np.random.default_rng(5)
    tokens = rnd.integers(1, TOKENS, 50)
    run = np.concatenate([[0, 0], tokens, [0, 0]]).astype(np.uint16)
    assert network.log_probability(run) == pytest.approx([plain(network, *w) for w in around(tokens)], rel=1e-4)
    every = [np.array([9, 5, t, 6, 7], np.uint16) for t in range(1, TOKENS)]
    total = sum(math.exp(network.log_probability(w)[0]) for w in every) + math.exp(plain(network, [9, 5, 6, 7], 0))
    assert total == pytest.approx(1, rel=1e-4)


def test_gradient():
    network, rnd = Network(), np.random.default_rng(2)
    network.use(network.flat.astype(np.float64))
    run = np.concatenate([[0, 0], rnd.integers(1, TOKENS, 30), [0, 0], rnd.integers(1, TOKENS, 9), [0, 0]]).astype(np.uint16)
    loss, n, gradient = network.gradient(run)
    assert n == 39 and loss == pytest.approx(-network.log_probability(run).sum())
    moved = np.flatnonzero(gradient)
    for at in rnd.choice(moved, 60, replace=False):
        value, losses = network.flat[at], []
        for step in (1e-5, -1e-5):
            network.flat[at] = value + step
            losses.append(-network.log_probability(run).sum())
        network.flat[at] = value
        assert gradient[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-3, abs=1e-5)


def test_start_is_the_count_of_tokens():
    network, n = Network(), np.arange(1, 101) * 1000.0
    network.start(np.arange(1, 101), n)
    network.values["w"][:] = 0  # nothing around a place is seen
    logs = [network.log_probability(np.array([0, 0, t, 0, 0], np.uint16))[0] for t in range(1, 101)]
    assert logs == pytest.approx(np.log((n + 1) / (n.sum() + TOKENS)).tolist(), abs=1e-3)


def test_scores_are_sums_of_conditional_log_probabilities(spark):
    rows = [(1, "word ab"), (2, None), (3, ""), (4, "ab ж漢 7"), (1, "word ab"), (None, "word " * 100_000)]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, N_TOKENS int, tokens string")
    network = Network()
    out = score(frame, network, NAMES)
    assert out.columns == ["doc_id", "text", "tokens", "n_tokens", "log_likelihood", "per_token"]
    out = out.collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out) == sorted((i or 0, t or "") for i, t in rows)
    for r in out:
        tokens = NAMES.tokens(r.text or "")
        assert r.n_tokens == len(tokens) and (r.per_token is None) == (not len(tokens)) and r.tokens == "x"
        if len(tokens) < 100:
            rare = sum(math.log(scoring.RARE / 0x110000) for t in tokens if t <= scoring.RARE)
            assert r.log_likelihood == pytest.approx(rare + sum(plain(network, *w) for w in around(tokens)), rel=1e-4)
    with pytest.raises(ValueError, match="name of a result"):
        score(frame.withColumnRenamed("text", "per_token"), network, NAMES, text="per_token")


def test_every_document_is_in_one_round(spark):
    frame = spark.range(100).selectExpr("id", "concat('word ', id) AS text").repartition(3)
    parts = [r.part for r in tokenized(frame, NAMES).collect()]
    assert len(parts) == 100 and set(parts) == set(range(sum(ROUNDS)))


def test_held_out_texts_are_likelier_than_by_counts_of_tokens(spark, table):
    docs = table("documents").select("doc_id", "text")
    known, other = docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 3 = 0")
    vocabulary = learn(known)
    rows = saved(tokenized(known, vocabulary).repartition(2), "tokens")
    network = train(rows, batch=512)
    counts = np.ones(TOKENS)
    for r in scoring.count_tokens(rows).collect():
        counts[r.token] += r.n
    logs = np.log(counts / counts.sum())
    ours = by_count = n = 0
    for r in score(other, network, vocabulary).collect():
        tokens = vocabulary.tokens(r.text or "")
        rare = np.log(scoring.RARE / 0x110000) * (tokens <= scoring.RARE).sum()
        ours, by_count, n = ours + r.log_likelihood - rare, by_count + logs[tokens].sum(), n + len(tokens)
    assert ours / n > by_count / n + 0.3, (ours / n, by_count / n, n)


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pseudo_likelihood(empty).count() == 0
    assert [r.n_tokens for r in pseudo_likelihood(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()] == [0]


@pytest.mark.parametrize("script", ["абвгдежзийклмно", "αβγδεζηθικλμνξο", "漢字仮名交文書語学校生先時間"])
def test_noise_in_any_script_scores_below_sense(spark, script):
    rnd = random.Random(4)
    lexicon = ["".join(rnd.choice(script) for _ in range(5)) for _ in range(12)]
    sense = [" ".join(lexicon[(i + k) % 12] for k in range(30)) for i in range(60)]
    noise = " ".join("".join(rnd.choice(script) for _ in range(5)) for _ in range(30))
    rows = spark.createDataFrame(list(enumerate([*sense, noise])), "doc_id long, text string").coalesce(1)
    out = {r.doc_id: r.per_token for r in pseudo_likelihood(rows, batch=64).collect()}
    assert min(out[i] for i in range(60)) > out[60] + 1
