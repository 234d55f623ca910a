"""Decontamination against plain windows, and longest matches against all starts."""

import random
import re

import pytest

from assaylake.llm import suffix_leaks

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=10):
    """(n_words, hit words, items) of each document."""
    spelled = {}
    for i, text in items:
        w = words(text)
        n = min(window, len(w))
        for p in range(len(w) - n + 1) if n and i is not None else ():
            spelled.setdefault(tuple(w[p : p + n]), set()).add(str(i))
    out = []
    for _, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in spelled}:
            for p in range(len(w) - n + 1):
                if (own := spelled.get(tuple(w[p : p + n]))) is not None:
                    hit |= set(range(p, p + n))
                    found |= own
        out.append((len(w), sorted(hit), sorted(found)))
    return out


def data(seed=0, n_docs=120):
    rng = random.Random(seed)
    say = lambda n, kinds: " ".join(rng.choice(kinds) for _ in range(n))
    few, many = ["a", "b"], [f"Wört{i}" for i in range(40)] + ["x1", "y-z", "ÄÖ", "日本"]
    items = [(i, say(rng.randint(1, 60), rng.choice([few, many]))) for i in range(12)] + [(3, say(12, many)), (50, "only, three. words"), (51, ""), (52, None), (None, say(15, many)), (53, "..."), (54, "a b a b a b a b a b a b")]
    docs = []
    for i in range(n_docs):
        parts = [say(rng.randint(0, 30), rng.choice([few, many])) for _ in range(rng.randint(0, 4))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            w = (rng.choice(items)[1] or "").split(" ")
            a = rng.randint(0, len(w))
            parts.insert(rng.randint(0, len(parts)), "; ".join(w[a : a + rng.randint(5, 40)]).upper())
        docs.append((i, ".\n".join(parts)))
    docs += [(7, docs[7][1]), (None, docs[8][1]), (900, None), (901, ""), (902, " \t.,"), (903, "a " * 500), (904, "only THREE\x00words")]
    rng.shuffle(docs)
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, n_words int, item_id string").repartition(3), spark.createDataFrame(items, "item_id long, text string")


def told(rows):
    return sorted(((r["doc_id"], r["text"], r["n_words"], [k for s in r["spans"] for k in range(s["start"], s["end"])], r["item_ids"]) for r in rows), key=str)


@pytest.mark.parametrize("shard,benchmark", [(4 << 20, 32 << 20), (300, 32 << 20), (60, 400)])
def test_against_plain_windows(spark, monkeypatch, shard, benchmark):
    monkeypatch.setattr(suffix_leaks, "SHARD_BYTES", shard)
    monkeypatch.setattr(suffix_leaks, "MAX_BENCHMARK_BYTES", benchmark)
    docs, items = data()
    got = suffix_leaks.overlaps(*frames(spark, docs, items))
    assert got.columns == ["doc_id", "text", "item_id", "n_words", "spans", "item_ids"]
    want = sorted(((i, t, *r) for (i, t), r in zip(docs, plain(docs, items))), key=str)
    assert told(got.collect()) == want and any(r[3] for r in want)
    clean = suffix_leaks.decontaminate(*frames(spark, docs, items))
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == sorted(((r[0], r[1]) for r in want if not r[3]), key=str)


@pytest.mark.parametrize("shard", [4 << 20, 200])
def test_longest_matches(spark, monkeypatch, shard):
    monkeypatch.setattr(suffix_leaks, "SHARD_BYTES", shard)
    docs, items = data(4, 40)
    want = {}
    for i, text in items:
        w = words(text)
        for s in range(len(w)) if i is not None else ():
            for j, t in docs:
                d = words(t)
                for p in range(len(d)) if j is not None else ():
                    n = 0
                    while s + n < len(w) and p + n < len(d) and w[s + n] == d[p + n]:
                        n += 1
                    if n >= 5:
                        want[str(i), s] = min(want.get((str(i), s), (0, 0, 0)), (-n, j, p))
    got = suffix_leaks.longest_matches(*frames(spark, docs, items), min_words=5)
    assert {(r["item_id"], r["item_start"]): (-r["length"], r["doc_id"], r["doc_start"]) for r in got.collect()} == want != {}


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """Windows are compared as text: with one hash for all words the result is the same."""
    monkeypatch.setattr(suffix_leaks, "BASE", suffix_leaks.np.uint64(0))
    docs, items = data(2, 30)
    search = suffix_leaks.Search(suffix_leaks.Tests([str(i) for i, t in items if i is not None and t], [t.encode() for i, t in items if i is not None and t], 10))
    got = search.documents([(t or "").encode() for _, t in docs], list(range(len(docs))))
    want = plain(docs, items)
    assert [(f.n_words, [k for s in suffix_leaks.joined(f.spans) for k in range(s["start"], s["end"])], sorted(f.items)) for f in got] == want


def test_suffix_arrays_are_sorted():
    rng = suffix_leaks.np.random.default_rng(0)
    keys = rng.integers(0, 3, 400).astype("uint64")
    order = suffix_leaks.Shard(keys, 64).order.tolist()
    told = [keys[p : p + 64].tolist() for p in order]
    assert told == sorted(told) and sorted(order) == list(range(400))


def test_edges(spark):
    docs, items = data()
    d, b = frames(spark, docs, items)
    assert suffix_leaks.overlaps(d.limit(0), b).count() == 0 and suffix_leaks.longest_matches(d.limit(0), b).count() == 0
    none = suffix_leaks.overlaps(d, b.limit(0))
    assert none.where("size(spans) > 0 OR size(item_ids) > 0").count() == 0 and none.count() == len(docs)
    got = {r["doc_id"]: r for r in suffix_leaks.digest(suffix_leaks.overlaps(d, b)).collect()}
    assert (got[900]["n_words"], got[900]["n_hit"], got[900]["contaminated"]) == (0, 0, False) and (got[904]["n_words"], got[904]["n_hit"], got[904]["n_items"]) == (3, 3, 1)
