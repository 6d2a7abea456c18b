"""Token alignment against the plain definition."""

import hashlib
import json
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from placepulse.llm import alignment as al
from placepulse.operators import joins

A_PATH, B_PATH = al._paths(al.TOKENIZERS)
TEXTS = [
    "Hello there, world. It's 12 o'clock!", "", None, " ", "  two  spaces\n\n\tand tab ", "a", "<|endoftext|> and </s><s><unk>",
    "naïve café ångström – “quotes” 中文字符 and emoji 🎉🎉", "▁ is not a space", "x" * 300, "\x00\x01 control", "Hello there, world. It's 12 o'clock!",
    "é combining  nbsp  em", "ababababab" * 30, "1234567 89", "\n", "ﬁ ligature ² ①",
]


def tokens(text):
    """Ids and spellings of both sides, token by token."""
    (a_encode, a), (b_encode, b) = al.byte_tokenizer(A_PATH), al.piece_tokenizer(B_PATH)
    if not text:
        return None
    sides = []
    for ids, words in ((a_encode([" " + text])[0], a), (b_encode([text])[0], b)):
        sides.append([(i, bytes(words.blob[words.starts[i] : words.starts[i] + words.lengths[i]])) for i in ids])
    return sides if all(b"".join(w for _, w in s) == (" " + text).encode() for s in sides) else None


def spans(side):
    at, out = 0, []
    for i, word in side:
        out.append((i, at, at + len(word)))
        at += len(word)
    return out


def brute(texts):
    held = []
    for text in texts:
        sides = tokens(text)
        a, b = map(spans, sides) if sides else ([], [])
        ends = sorted({z for *_, z in a} & {z for *_, z in b})
        groups, at = [], 0
        for end in ends:
            groups.append([[i for i, s, z in side if at < z <= end] for side in (a, b)])
            at = end
        links = [(i, j) for i, _, y in a for j, _, z in b if y == z]
        over = [(p, i, q, j, min(y, z) - max(x, w)) for p, (i, x, y) in enumerate(a) for q, (j, w, z) in enumerate(b) if min(y, z) > max(x, w)]
        held.append((a, b, groups, links, over))
    counts = Counter(link for *_, links, _ in held for link in links)
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    rows = []
    for a, b, groups, links, over in held:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        rows.append((len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
                     hashlib.sha256(text.encode()).hexdigest() if a else "", len(over), sum(len(x) * len(y) for x, y in groups)))
    return rows, held


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 1, "x") for i, t in zip(ids, texts, strict=True)], "doc_id BIGINT, text STRING, _row INT, pair STRING")


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps", "n_shared")


def test_alignment(spark, monkeypatch):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice(" abé.\n9中Z") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    want, held = brute(texts)
    found, pairs = al.align_documents(docs(spark, texts))
    assert [tuple(r) for r in found.orderBy("doc_id").select(*NAMES).collect()] == want
    assert sum(r["count"] for r in pairs.collect()) == sum(len(h[3]) for h in held)
    # No broadcast, hot pairs salted; ids null and repeated.
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    found, _ = al.align_documents(docs(spark, texts, [None, 7] + [None] * (len(texts) - 2)))
    assert sorted(tuple(r) for r in found.select(*NAMES).collect()) == sorted(want)
    assert al.align_documents(docs(spark, []))[0].count() == 0


def test_links(spark):
    _, held = brute(TEXTS)
    got = {tuple(r) for r in al.token_links(docs(spark, TEXTS)).drop("together").collect()}
    assert got == {(d, *link) for d, h in enumerate(held) for link in h[4]}
    both = al.token_links(docs(spark, TEXTS), "shared")
    assert both.where("together").count() == sum(len(h[3]) for h in held)
    assert both.count() == sum(len(x) * len(y) for h in held for x, y in h[2])
    with pytest.raises(ValueError):
        al.token_links(both, "other")


def test_ranks_give_the_ids_of_the_merges(tmp_path):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(A_PATH)
    slow.encode_special_tokens = True
    encode, words = al.byte_tokenizer(A_PATH)
    rng = random.Random(5)
    entries = [bytes(words.blob[s : s + n]) for s, n in zip(words.starts.tolist(), words.lengths.tolist(), strict=True)]
    texts = [t for t in TEXTS if t] + ["".join(rng.choices("aab  bc\n\t's.1!é中 'll ", k=99)) for _ in range(300)]
    texts += [b"".join(rng.choices(entries, k=9)).decode(errors="ignore") for _ in range(2000)]
    texts += [f" a{chr(c)}b 1{chr(c)}2 {chr(c)}! {chr(c)}{chr(c)}\n{chr(c)}x'{chr(c)} {chr(c)}" for c in [*range(0x3100), *rng.choices(range(0xE000, 0x110000), k=3000)]]
    want = [e.ids for e in slow.encode_batch_fast(texts, add_special_tokens=False)]
    assert [list(ids) for ids in encode(texts)] == want
    # The ranks did it, and a token that merges never make keeps to the list of merges.
    assert al._merges_by_rank(A_PATH, entries)
    held = json.loads(Path(A_PATH).read_text(encoding="utf-8"))
    held["model"]["merges"][7], held["model"]["merges"][8] = held["model"]["merges"][8], held["model"]["merges"][7]
    (tmp_path / "other.json").write_text(json.dumps(held), encoding="utf-8")
    assert al._merges_by_rank(str(tmp_path / "other.json"), entries) is None


def test_products():
    rng = np.random.RandomState(4)
    for _ in range(20):
        a, b = (rng.rand(*shape) < 0.3 for shape in ((7, 9), (9, 5)))
        sparse = []
        for dense in (a, b):
            rows, columns = np.nonzero(dense)
            indptr = np.searchsorted(rows, np.arange(len(dense) + 1))
            sparse.append(al.Csr(indptr, columns, np.ones(len(rows), np.int64), dense.shape[1]))
        out = al.gustavson(*sparse)
        dense = np.zeros((7, 5), int)
        dense[out.rows(), out.indices] = out.data
        assert (dense == a.astype(int) @ b.astype(int)).all()
        back = sparse[0].transposed()
        dense = np.zeros((9, 7), bool)
        dense[back.rows(), back.indices] = True
        assert (dense == a.T).all()


def test_long_text_is_cut_at_common_ends(monkeypatch):
    whole = al.align(TEXTS, A_PATH, B_PATH)
    monkeypatch.setattr(al, "CHUNK", 16)
    cut = al.align(TEXTS, A_PATH, B_PATH)
    for one, two in ((whole.links, cut.links), (whole, cut)):
        for name in one.__dataclass_fields__:
            if name != "links":
                assert np.array_equal(getattr(one, name), getattr(two, name)), name
    blocks = list(al.shared(cut.a_ends, cut.b_ends, 4))
    assert len(blocks) > 3
    assert sum(len(p.indices) for _, p in blocks) == sum(len(p.indices) for _, p in al.shared(cut.a_ends, cut.b_ends))
