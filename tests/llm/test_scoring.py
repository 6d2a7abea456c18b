"""Language-model scoring against plain counts and a token-by-token model."""

import base64
import binascii
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from placepulse.llm import attention, scoring

PATH = f"{scoring.TOKENIZERS}/{scoring.RANKS_FILE}"
DOCS = "doc_id BIGINT, text STRING, ids STRING, _row INT, score INT"


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in zip(ids, texts, strict=True)], DOCS).repartition(3)


def held_out(i):
    return binascii.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def words(text):
    return re.findall(r"[^ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    lexicon = ["the", "of", "Über", "naïve", "x y", "中文", "<|endoftext|>", "a.b", "don't", "\u00a0", "x\u00a0", "\u00a0y", "\u2003\u2003", "it's'll", *(f"w{i}" for i in range(60))]
    found = [" ".join(rng.choice(lexicon) for _ in range(rng.randint(1, 90))) for _ in range(120)]
    return [*found, "", None, " \t\n", "THE of\x0bThe", found[3], "z" * 5000]


def test_counts(spark, texts):
    ids = [None, 5, 5, *range(3, len(texts))]
    for frequent in (scoring.FREQUENT, 3, 0):
        got = scoring.score_texts(docs(spark, texts, ids), frequent=frequent, model=untrained())
        got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got.collect()]
        counts = Counter(w for i, t in zip(ids, texts, strict=True) if not held_out(i) for w in [*words(t), None])
        total, want = sum(counts.values()), []
        for i, t in zip(ids, texts, strict=True):
            own = [*words(t), None]
            base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
            want.append((i, held_out(i), len(own), sum(counts[w] > 0 for w in own), total, round(base, 6)))
        assert sorted(got, key=repr) == sorted(want, key=repr)


def untrained():
    size = len(scoring.tokenizer(PATH)[1]) + 1
    counts = np.random.RandomState(1).randint(0, 500, size)
    flat = attention.started(counts, 3)
    flat += np.random.RandomState(2).standard_normal(len(flat)).astype(np.float32) * 0.2
    return scoring.Model(flat, attention.Ranks.of(counts))


def slow_score(model, text):
    """One token after the other, each from the context of the one window that scores it."""
    w = {k: v.astype(float) for k, v in attention.unpacked(model.flat).items()}
    tokenize = scoring.tokenizer(PATH)[0].encode_ordinary
    ids = [i for word in words(text) for i in tokenize(" " + word)] + [model.end]
    ranks = model.ranks.rank[ids].tolist()
    inputs, total = [int(model.ranks.rank[model.end]), *ranks[:-1]], 0.0
    for t, rank in enumerate(ranks):
        late = max(0, t - attention.WINDOW + 1)
        start = -(-late // attention.FRESH) * attention.FRESH
        x = w["embedding"][inputs[start : t + 1]] + w["place"][: t + 1 - start]
        q, k, v = x[-1] @ w["query"], x @ w["key"], x @ w["value"]
        a = np.exp(k @ q / math.sqrt(attention.WIDTH))
        h = x[-1] + (a / a.sum()) @ v @ w["out"]
        c, m = divmod(rank, attention.MEMBERS)
        e = np.exp(h @ w["classes"] + w["class_bias"])
        total += math.log(e[c] / e.sum())
        if c < attention.CLASSES:
            e = np.exp(h @ w["members"][c] + w["member_bias"][c])
            total += math.log(e[m] / e.sum())
    return (total + model.ranks.rare[ids].sum()) / math.log(10)


def test_windows_score_every_token_once(spark, texts):
    model = untrained()
    got = {r["doc_id"]: r["score"] for r in scoring.score_texts(docs(spark, texts), model=model).collect()}
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(slow_score(model, text), rel=1e-4)


def test_probabilities_sum_to_one():
    model = untrained()
    weights = attention.unpacked(model.flat)
    inputs = np.random.RandomState(5).randint(0, 1025, (1, 9)).astype(np.int32)
    known = attention.CLASSES * attention.MEMBERS
    every = np.array([attention.log_likelihoods(weights, inputs, np.array([[r]], np.int32), 8)[0, 0] for r in range(known + 1)])
    assert np.exp(every[:known]).sum() + np.exp(every[known]) == pytest.approx(1, abs=1e-4)
    rare = model.ranks.rare[model.ranks.rank == known]
    assert np.exp(rare).sum() == pytest.approx(1, abs=1e-9)


def test_gradient():
    rng = np.random.RandomState(0)
    flat = attention.started((1e6 / (np.arange(5000) + 1)).astype(int), 1).astype(float)
    inputs, targets = (rng.randint(0, 1025, (3, attention.WINDOW)) for _ in range(2))
    there = rng.rand(3, attention.WINDOW) < 0.8
    grad, loss = attention.gradient(attention.unpacked(flat), inputs, targets, there)

    def mean(weights):
        return -attention.log_likelihoods(attention.unpacked(weights), inputs, targets, 0)[there].sum() / there.sum()

    assert loss == pytest.approx(mean(flat))
    felt = np.flatnonzero(np.abs(grad) > 1e-5)
    for i in rng.choice(felt, 60):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        assert (mean(up) - mean(down)) / 2e-5 == pytest.approx(grad[i], abs=1e-6)


def test_learns_order_that_counts_miss(spark):
    rng = random.Random(9)
    lines = []
    for _ in range(3000):
        at, out = rng.randrange(8), []
        for _ in range(60):
            out.append("red blue green black white grey pink gold".split()[at])
            at = (at + 1 if rng.random() < 0.95 else rng.randrange(8)) % 8
        lines.append(" ".join(out))
    table = docs(spark, lines).coalesce(1)
    model = scoring.fit_model(scoring.subwords(table), batch_size=16)
    rows = scoring.score_texts(table, model=model).where("held_out").collect()
    assert sum(r["score"] for r in rows) > 0.5 * sum(r["base_score"] for r in rows)


def test_edge_tables(spark):
    assert scoring.score_texts(docs(spark, [])).count() == 0
    ids = [i for i in range(60) if held_out(i)][:2]
    rows = scoring.score_texts(docs(spark, ["a b", None], ids)).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_a_subword_never_holds_two_words(spark):
    texts = ["a \u00a0 \u00a0 b", "A" + " \u00a0" * 4 + " "]
    rows = scoring.score_texts(docs(spark, texts, [0, 2]), model=untrained()).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in rows] == [5, 6]


def test_windows_of_many_texts_are_those_of_each():
    rng = np.random.RandomState(6)
    sizes = np.array([1, 5, 32, 33, 56, 57, 200, 1])
    texts = [rng.randint(0, 1025, n).astype(np.int32) for n in sizes]
    for step in (attention.WINDOW, attention.FRESH):
        got = attention.windows(np.concatenate(texts), sizes, 7, attention.WINDOW, step)
        for i, text in enumerate(texts):
            inputs, targets, counts, turn = (part[got[3] == i] for part in (*got[:3], got[4]))
            assert turn.tolist() == list(range(len(turn)))
            assert targets[counts].tolist() == text.tolist()
            assert inputs[counts].tolist() == [7, *text[:-1]]
            for k in range(1, len(turn)):
                assert inputs[k, 0] == text[k * step - 1]


def test_special_tokens_are_plain_text_and_not_looked_for_everywhere():
    encoding = scoring.tokenizer(PATH)[0]
    assert encoding.special_tokens_set and "" not in encoding.special_tokens_set
    text = "a <|endoftext|>b<|endoftext|> \u00a0 \u00a0 c"
    want = [i for word in words(text) for i in encoding.encode_ordinary(" " + word)]
    assert scoring.encoded(text, PATH).tolist() == want
    assert max(want) < encoding.max_token_value


def test_blanks_within_words_and_between():
    blanks = [chr(c) for c in range(0x110000) if chr(c).isspace() and chr(c) not in " \t\n\x0b\x0c\r"]
    tokenize = scoring.tokenizer(PATH)[0].encode_ordinary
    for blank in [*blanks, "\u200b", "\ufeff", "a"]:
        for text in (f"x{blank}y", f"{blank}x it's{blank}", f"x{blank} {blank}y", f"x {blank} y", f"{blank}{blank}x 12"):
            want = [i for word in words(text) for i in tokenize(" " + word)]
            assert scoring.encoded(text, PATH).tolist() == want, (blank, text)


def test_exponentials_of_all_classes_are_taken_at_once():
    rng = np.random.RandomState(4)
    weights = attention.unpacked(attention.started(np.ones(2000), 1))
    states = rng.standard_normal((500, attention.WIDTH)).astype(np.float32)
    targets = rng.randint(0, attention.CLASSES * attention.MEMBERS + 1, 500)
    predicted = attention._Predicted(weights, states, np.arange(500), targets)
    found = [(len(shares), len(parts)) for _, parts, shares, _, _ in predicted.softmaxes()]
    known = int((targets < attention.CLASSES * attention.MEMBERS).sum())
    assert found == [(500, 1), (known, attention.CLASSES)]


def test_larger_vocabularies(spark, tmp_path):
    assert scoring.kept_as(1 << 16) == np.uint16
    lines, size = open(PATH, "rb").read().splitlines(), (1 << 16) + 5_000
    more = [base64.b64encode(b"~~%d~~" % i) + b" %d" % i for i in range(len(lines), size)]
    (tmp_path / scoring.RANKS_FILE).write_bytes(b"\n".join([*lines, *more]))
    table, columns = docs(spark, ["a b", "~~66000~~ a", "~~66001~~ ~~66000~~"], [0, 2, 3]), ("doc_id", "n_tokens", "n_known", "base_score")
    found = [sorted(map(tuple, scoring.score_texts(table, tokenizers=t).select(*columns).collect())) for t in (scoring.TOKENIZERS, str(tmp_path))]
    assert [r[:3] for r in found[0]] == [r[:3] for r in found[1]]
    assert [r[3] for r in found[0]] == pytest.approx([r[3] for r in found[1]])
