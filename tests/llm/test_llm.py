"""Every operator against brute force on small tables, with the awkward cases in them."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from placepulse.llm import exact_dedup, mixing, near_dedup, packing, quality, sharding, suffixes, topk, warc, wrappers
from placepulse.session import scratch_path

DOCS = "doc_id BIGINT, text STRING, lang STRING, kept STRING, _text INT"


def docs(spark, texts, ids=None):
    """Texts with ids, a language, and columns whose names the operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "x", 1) for i, t in zip(ids, texts, strict=True)], DOCS)


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(5)
    words = ["".join(rng.choice(["ba", "lo", "ti", "ne", "ru", "sa"]) for _ in range(rng.randint(1, 3))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(30, 120))) for _ in range(60)]
    for i in range(0, 20):
        copy = texts[i].split(" ")
        for _ in range(1 + i % 4):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append(" ".join(copy))
    return [*texts, texts[3], texts[3].upper(), "Ba lo", "ba LO", "", None, "  \n ", "x", "é " * 9]


def test_exact_dedup(spark):
    texts = ["a  b", "a b", None, "", "a\tb", "c", "aab", "a b", " "]
    ids = [5, 3, 7, 6, 9, 1, None, 3, None]
    for digest in (exact_dedup.sha256, lambda t: F.length(t)):
        got = rows(exact_dedup.find_copies(docs(spark, texts, ids), digest=digest))
        groups = {}
        for i, t in zip(ids, texts, strict=True):
            groups.setdefault(re.sub(r"[ \t\n\r\x0b\x0c]+", " ", t or ""), []).append(i)
        want = []
        for text, members in groups.items():
            named = [m for m in members if m is not None]
            keep = min(named) if named else None
            want += [(m, keep, len(members), m == keep, hashlib.sha256(text.encode()).hexdigest()) for m in members]
        assert sorted(map(str, (tuple(r.values()) for r in got))) == sorted(map(str, want))
    assert sorted(r["doc_id"] for r in rows(exact_dedup.drop_copies(docs(spark, ["a", "a ", "b"], [1, 2, 3])))) == [1, 2, 3]
    assert exact_dedup.drop_copies(docs(spark, ["a", "a", "b"], [1, 2, 3])).count() == 2
    assert exact_dedup.find_copies(docs(spark, [])).count() == 0


def brute_components(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^ \t\n\r\x0b\x0c]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(texts)))
    for _ in texts:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 75 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    return [(i, len(s), label[i], label[i] == i) for i, s in enumerate(sets)]


def test_near_dedup(spark, prose):
    got = near_dedup.near_duplicates(docs(spark, prose)).collect()
    assert sorted(map(tuple, got)) == brute_components(prose)
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0
    odd = rows(near_dedup.near_duplicates(docs(spark, ["a b c", "a b c", "q", None], [4, None, None, None])))
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in odd) == [
        ("4", "4", True), ("None", "4", False), ("None", "None", True), ("None", "None", True)]


def test_near_duplicates_without_ids_go_one_by_one(spark):
    long = [" ".join(f"{c}{n}" for n in range(100)) for c in "abc"]
    texts = [long[0], long[0] + " x", long[1], long[1] + " y", long[2], "a b c", "A b c", "q", None]
    ids = [4, None, None, None, None, 5, None, None, None]
    left = [(r["doc_id"], r["text"]) for r in rows(near_dedup.drop_near_duplicates(docs(spark, texts, ids)))]
    one = [r for r in left if r[1] in texts[2:4]]
    assert len(one) == 1 and one[0][0] is None
    assert sorted(map(str, left)) == sorted(map(str, [(4, long[0]), (5, "a b c"), *one, (None, long[2]), (None, "q"), (None, None)]))


def test_near_dedup_in_a_family_with_one_form(spark):
    # All texts share a form and are 0.745 alike; two at a time are 0.752 alike, which few stars would meet.
    form = " ".join(f"f{n}" for n in range(800))
    own = [" ".join(f"w{i}x{n}" for n in range(132)) for i in range(40)]
    texts = [f"{form} p{i // 2} q{i // 2} r{i // 2} s{i // 2} {w}" for i, w in enumerate(own)]
    got = rows(near_dedup.near_duplicates(docs(spark, texts)))
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i // 2 * 2 for i in range(40)}


def test_rest_pairs_hold_all_similar_pairs(spark):
    rng = random.Random(4)
    base = [rng.sample(range(1, 4_000), rng.randint(8, 40)) for _ in range(12)]
    sets = [sorted({*rng.sample(b, rng.randint(len(b) * 7 // 10, len(b))), *rng.sample(range(1, 4_000), rng.randint(0, 3))}) for b in base for _ in range(8)]
    table = spark.createDataFrame(list(enumerate(sets)), "id BIGINT, set ARRAY<BIGINT>")
    labels = spark.createDataFrame([(i, i if i % 3 else 0) for i in range(len(sets))], "_member BIGINT, _label BIGINT")
    pairs = near_dedup._rest_pairs(labels, table, 75)
    got = {tuple(r) for r in near_dedup.confirmed(pairs, table, 75).collect()}
    want = {(i, j) for j, y in enumerate(map(set, sets)) for i, x in enumerate(map(set, sets[:j]))
            if 100 * len(x & y) >= 75 * len(x | y) and (i % 3 or j % 3)}
    assert want and got == want


def test_densification_fills_every_bin():
    order = near_dedup.orders(64)
    sets = [np.sort(np.random.RandomState(n).randint(0, 2**63, n).astype(np.uint64) * np.uint64(2)) for n in (1, 3, 40, 500)]
    for one, signature in zip(sets, near_dedup.signatures(sets, order), strict=True):
        assert np.isin(signature, one).all()


@pytest.mark.parametrize("batches", [1, 5])
def test_repeated_strings(spark, batches):
    rng = random.Random(batches)
    texts = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 90))) for _ in range(30)]
    shared = "".join(rng.choice("abcdefgh") for _ in range(45))
    texts += [t[:9] + shared[rng.randrange(9) :] + t[9:] for t in texts[:12]] + [texts[0], "z" * 70, None, "abc" * 20, shared[3:24]]
    size = 20
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - size + 1):
            seen[d[i : i + size]] = seen.get(d[i : i + size], 0) + 1
    want = {}
    for i, d in enumerate(data):
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - size + 1):
            if seen[d[k : k + size]] > 1:
                gone[k : k + size] = True
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want[i] = (len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    got = rows(suffixes.repeated_spans(docs(spark, texts), size, batches))
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want
    if batches == 1:
        alike = rows(suffixes.repeated_spans(docs(spark, [shared, shared], [1, 1]), size, 1))
        assert [r["n_removed"] for r in alike] == [45, 45]
        assert suffixes.repeated_spans(docs(spark, []), size, 1).count() == 0


def test_repeated_strings_over_cuts(spark):
    # A text without repeats of more bytes than are indexed at once loses none around the cut.
    rng = random.Random(2)
    unique = "".join(rng.choices("abcdefghijklmnop", k=2 * suffixes.PIECE + 5_000))
    got = rows(suffixes.repeated_spans(docs(spark, [unique])))
    assert [(r["n_removed"], r["spans"]) for r in got] == [(0, [])]
    size = 20
    texts = [unique[:700], unique[100:400] + unique[5_000:5_300], unique[650:1_400], "ab" * 90]
    seen = [t[i : i + size] for t in texts for i in range(len(t) - size + 1)]
    want = {n: len({k for i in range(len(t) - size + 1) if seen.count(t[i : i + size]) > 1 for k in range(i, i + size)}) for n, t in enumerate(texts)}
    got = rows(suffixes.repeated_spans(docs(spark, texts), size, 2, piece=5))
    assert {r["doc_id"]: r["n_removed"] for r in got} == want


def test_warc_round_trip(spark):
    html = ["<p>a</p>" * 9, "", None, "x\r\n\r\nWARC/1.1\r\n\r\n0\r\n\r\n", "é" * 500, "<p>a</p>" * 9, "y" * 64, "ab\r\n", "ab\r\n"]
    ids = [8, 2, 1, 4, 5, 6, 7, None, 9]
    urls = ["http://a/ b\n", None, "u", "u", "u", "u", "u", "u", "u"]
    pages = spark.createDataFrame(list(zip(ids, urls, html, html, strict=True)), "page_id BIGINT, url STRING, html STRING, _digest STRING")
    path = scratch_path(spark, "warc-test")
    warc.write_warc(pages, path, segment_bytes=100, chunk_bytes=7)
    got = {r["page_id"]: r for r in rows(warc.read_warc(spark, path))}
    assert len(got) == len(ids) and all(r["complete"] for r in got.values())
    first = {8: 6, 2: 1, None: 9}
    for i, h in zip(ids, html, strict=True):
        data = (h or "").encode()
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[i]) if i in first else ("response", None))
        assert r["record_type"] == "revisit" or bytes(r["payload"]) == data
    assert got[5]["segments"] > 1 and got[8]["url"] == "http://a/%20b%0A"
    # A record that lacks a segment is there, and said to be incomplete.
    parts = warc.read_segments(spark, path)
    broken = rows(warc.reassemble(parts.where("segment <> 2")))
    assert broken and not any(r["complete"] or r["payload"] for r in broken)
    empty = scratch_path(spark, "warc-test")
    warc.write_warc(pages.limit(0), empty)
    assert warc.read_warc(spark, empty).count() == 0


def test_top_k(spark):
    rng = np.random.RandomState(1)
    vectors = [(i, rng.randint(-2, 3, 4).astype(float).tolist()) for i in range(120)]
    vectors += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [1e12, 0.0, 0.0, 1e12]), (204, [1.0]), (None, [1.0] * 4)]
    table = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id BIGINT, embedding ARRAY<FLOAT>, _id INT")
    got = rows(topk.top_k(table, table.where("vec_id % 10 = 0"), shard_rows=30, query_rows=5))
    clean = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in vectors
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (i for i in clean if i % 10 == 0):
        scored = sorted((-sum(a * b for a, b in zip(clean[q], v, strict=True)), i) for i, v in clean.items() if i != q and len(v) == len(clean[q]))
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)
    assert topk.top_k(table.limit(0), table.limit(0)).count() == 0


def test_smallest_capacity_is_minimal():
    rng = random.Random(3)
    for _ in range(200):
        sizes = np.array([rng.choice([1, 2, 9, 40]) for _ in range(rng.randint(1, 12))])
        shards = rng.randint(1, 6)
        best = [[0 if not i else None for i in range(len(sizes) + 1)]]
        for _ in range(shards):
            last = best[-1]
            best.append([min((max(last[j], int(sizes[j:i].sum())) for j in range(i + 1) if last[j] is not None), default=None) for i in range(len(sizes) + 1)])
        assert sharding.smallest_capacity(sizes, shards) == best[-1][-1]
        placed = sharding.cut(sizes, shards)
        assert (np.diff(placed) >= 0).all() and placed.max() < shards
        assert np.bincount(placed, sizes).max() == best[-1][-1] or np.bincount(placed, sizes).max() <= best[-1][-1]


def test_sharding(spark, prose):
    texts, ids = [*prose, *["same"] * 50], [*range(len(prose)), *range(500, 550)]
    got = rows(sharding.assign_shards(docs(spark, texts, ids), 7, window_rows=8))
    by_text = {}
    text_of = dict(zip(ids, texts, strict=True))
    for r in got:
        by_text.setdefault(text_of[r["doc_id"]] or "", set()).add(r["shard"])
        assert r["size"] == len((text_of[r["doc_id"]] or "").encode()) + 16
    assert len(got) == len(texts) and all(len(s) == 1 for s in by_text.values())
    for shard in range(7):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    assert sharding.assign_shards(docs(spark, []), 7).count() == 0


def test_packing(spark):
    texts = ["w " * n for n in (5, 3, 9, 25, 1, 10, 2, 2)] + ["", None, "w " * 3]
    got = rows(packing.pack_documents(docs(spark, texts, [*range(10), 1]), lengths=(4, 8, 10), cost=1))
    bins = {}
    for r in got:
        if r["bin_id"] is not None:
            bins.setdefault(r["bin_id"], []).append(r)
    for packed in bins.values():
        packed.sort(key=lambda r: r["bin_offset"])
        total = 0
        for r in packed:
            assert r["bin_offset"] == total
            total += r["n_tokens"]
        assert total == packed[0]["bin_tokens"] and packed[0]["bin_length"] == min(n for n in (4, 8, 10) if n >= total)
    assert sum(r["n_tokens"] for r in got) == sum((t or "").count("w") for t in texts)
    assert [r["n_tokens"] for r in sorted(got, key=lambda r: r["piece"]) if r["doc_id"] == 3] == [10, 10, 5]
    assert sum(r["bin_id"] is None for r in got) == 2
    assert packing.pack_documents(docs(spark, [])).count() == 0


def test_best_fit_takes_the_tightest_bin():
    placed, lengths = packing.fit([7, 6, 3, 2], [4, 10], cost=1)
    assert placed == [0, 1, 0, 1] and lengths == [10, 10]
    assert packing.fit([3], [4, 10], cost=1) == ([0], [4])


def test_quality(spark, sf):
    table, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.score_quality(table, labels)
    assert got.count() == table.count()
    judged = got.join(labels, "doc_id")
    assert judged.where("quality = 1 AND toxic = 0 AND NOT kept").count() <= 0.02 * judged.where("quality = 1 AND toxic = 0").count()
    assert judged.where("quality = 0 AND kept").count() <= 0.5 * judged.where("quality = 0").count()
    # Shards of the model add up to the whole.
    parts = quality.score_quality(table, labels, shard_entries=20_000)
    both = got.select("doc_id", "perplexity").join(parts.select("doc_id", F.col("perplexity").alias("p")), "doc_id")
    assert both.where("abs(perplexity - p) > 1e-4 * p").count() == 0
    none = quality.score_quality(docs(spark, ["a b", "", None], [1, None, 2]), labels.limit(0))
    assert sorted(r["kept"] for r in rows(none)) == [True] * 3


def test_kneser_ney_sums_to_one(spark):
    counts = spark.createDataFrame([("en", g, 1 + i % 4) for i, g in enumerate(["aba", "abb", "abc", "bab", "bac", "cab", "\u0002\u0002a", "\u0002ab"])], "lang STRING, gram STRING, n BIGINT")
    model = {r["gram"]: r for r in rows(quality.kneser_ney(counts, 3))}
    for context in ("ab", "ba", "b", ""):
        total = 0.0
        for c in "abc":
            back, p = 1.0, None
            for k in range(len(context) + 1):
                found = model.get(context[k:] + c)
                if found and found["logp"] is not None:
                    p = back * np.exp(found["logp"])
                    break
                weight = model.get(context[k:])
                back *= np.exp(weight["logg"]) if weight and weight["logg"] is not None else 1.0
            total += p
        # One unknown character has the rest.
        assert 0.7 < total < 1.0


def test_mixing(spark):
    # The smallest tables have 80 labelled rows, too few to tell the domains by their words.
    sf = "/root/testdata/sf0.01"
    table, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    mixed = mixing.mix(table, labels)
    assert mixed.count() == table.count() and mixed.where("rate < 0 OR rate IS NULL").count() == 0
    total = mixed.agg(F.sum("n_tokens")).scalar()
    assert total is not None
    shares = mixed.agg(*(F.sum(F.expr(f"rate * n_tokens * p_{d}")).alias(d) for d in mixing.TARGETS), F.sum("n_tokens").alias("all")).first()
    for domain, target in mixing.TARGETS.items():
        assert abs(shares[domain] / shares["all"] - target) < 0.01
    odd = rows(mixing.mix(docs(spark, ["a b", "", None, "a b"], [1, None, 2, 1]), labels.limit(0)))
    assert len(odd) == 4 and all(r["rate"] == 1.0 for r in odd)
    assert mixing.mix(table.limit(0), labels).count() == 0


def test_wrappers(spark):
    def page(body, extra=""):
        return f"<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a href=x>Menu</a></nav>{extra}<article>{body}</article><div class='comment-list'><p>me too</p></div><footer>c</footer>"

    html = [
        page("<h1>A &amp; B</h1><p><b>one\n two<br><p>three</p>"),
        page("<h1>C</h1><p>x</p><p>y</p><p>z</p>", "<div class=ad>buy</div>"),
        page("<h1>D</h1><p>q<aside>no</aside></p>"),
        "<p>plain</p><form>no</form>", "", None, "text only",
    ]
    pages = spark.createDataFrame([(i, "http://h.x/a" if i < 3 else None, h, "z") for i, h in enumerate(html)], "page_id BIGINT, url STRING, html STRING, text STRING")
    got = {r["page_id"]: r["text"] for r in rows(wrappers.extract_text(pages))}
    assert got == {0: "A & B\none two\nthree", 1: "C\nx\ny\nz", 2: "D\nq", 3: "plain", 4: "", 5: "", 6: "text only"}
    pattern = {r["host"]: r["pattern"] for r in rows(wrappers.infer_wrappers(pages))}["h.x"]
    assert "div.ad" in pattern and ")?" in pattern and ")+" in pattern
    assert wrappers.extract_text(pages.limit(0)).count() == 0


def test_scripts_and_quotes_are_no_markup(spark):
    html = {
        "<article><h1>T</h1><script>if (a<b) x();</script>Hello": "T\nHello",
        "<p>One</p><script>for(i=0;i<n;i++) // don't</script><p>it's fine</p>": "One\nit's fine",
        "<p data-x=it's>one</p><p>two's</p>": "one\ntwo's",
        "<p title='a>b' class = \"x>y\">three</p><style>a<b{}</style>": "three",
        "<SCRIPT>'<p>'</Script ><p>four": "four",
        "<p>" + "long " * 400_000 + "</p><script><" + "x<" * 1000: ("long " * 400_000).strip(),
    }
    pages = spark.createDataFrame([(i, f"http://h{i % 2}/", h) for i, h in enumerate(html)], "page_id BIGINT, url STRING, html STRING")
    got = {r["page_id"]: r["text"] for r in rows(wrappers.extract_text(pages))}
    assert got == dict(enumerate(html.values()))


def test_clashing_names(spark, tmp_path):
    ddl = "doc_id BIGINT, text STRING, lang STRING, _hash INT, _times INT, _dropped_doc_id INT, _own_doc_id INT, _whole INT, _shard INT, `a.b` INT"
    table = spark.createDataFrame([(i, "a b c", "en", *range(7)) for i in (1, 2, None)], ddl)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id BIGINT, quality INT, toxic INT")
    for out in (exact_dedup.drop_copies(table), near_dedup.drop_near_duplicates(table), quality.drop_low_quality(table, labels),
                mixing.apply_rates(table, labels)):
        assert out.columns == table.columns
        assert all(tuple(r)[3:] == tuple(range(7)) for r in out.collect())
    assert exact_dedup.drop_copies(table).count() == near_dedup.drop_near_duplicates(table).count() == 1
    named = table.where("doc_id IS NOT NULL")
    sharding.write_shards(named, sharding.assign_shards(named, 2), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 2


def test_packs_stay_bounded(spark):
    table = docs(spark, ["a b c"] * 3000, [None] * 2000 + [7] * 1000)
    packs = packing.pack_documents(table, lengths=(4, 8), pack_rows=100).selectExpr("shiftright(bin_id, 32) AS p").groupBy("p").count()
    assert max(r["count"] for r in packs.collect()) < 200 and packs.count() == 30


def test_pipeline(spark, sf):
    import corpus_pipeline

    result = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, result, sf)
        assert result.columns == spark.read.parquet(f"{sf}/documents.parquet").columns
    assert {n for n, _ in corpus_pipeline.STAGES} == {"quality", "exact_dedup", "near_dedup", "mixing", "packing"}
