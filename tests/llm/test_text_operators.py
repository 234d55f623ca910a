"""Brute force, round trips and edge cases: nulls, empty and long texts, repeated rows, empty tables, clashing columns."""

import hashlib
import itertools
import random
import re
import shutil
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assaylake.llm import chat_format, entries, lang_id, line_dedup, lm_score, near_copies, packing, pii, sentencepieces, simhash, tokens
from assaylake.llm.cuckoo import CuckooFilter, Shards

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, spans string, n_lines long, score double, v int"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def odd(spark):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows and columns with clashing names."""
    long = "Some words of a very long text, again and again. " * 4000
    rows = [(1, None, "en"), (2, "", None), (3, " \n\t", "en"), (4, long, "en"), (4, long, "en"), (5, "The same words\nthe same words", "en"), (6, "The same words\nthe same words", "de"), (None, "no id here but words", "en"), (7, "1234 !!", None), (8, "Ein anderer Text über Straßen", "de")]
    return spark.createDataFrame([(i, t, g, "x", 9, 0.5, 1) for i, t, g in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return entries.table(spark, SF, "documents")


# SentencePiece


@pytest.fixture(scope="module")
def unigram():
    """The model's pieces as a unigram model with mild scores, for the library's own search."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    with open(PIECES, "rb") as f:
        spec.ParseFromString(f.read())
    spec.trainer_spec.model_type = 1
    for p in spec.pieces:
        if p.type == 1:
            p.score = max(p.score, -40000.0) / 1000
    raw = spec.SerializeToString()
    return sentencepieces.Pieces(raw), sentencepiece.SentencePieceProcessor(model_proto=raw), [p.score for p in spec.pieces]


@settings(deadline=None, max_examples=150)
@given(st.text(alphabet="aeth tion\n\t é日①𝄞  x.", max_size=40))
def test_best_path_equals_the_library(unigram, text):
    own, library, scores = unigram
    a, b = own.encode(text).tolist(), library.encode(text)
    assert a == b or sum(scores[i] for i in a) == pytest.approx(sum(scores[i] for i in b), abs=1e-3)  # equal scores may be split either way
    assert own.decode(np.array(a)) == text == library.decode(a)


def test_best_path_equals_brute_force():
    with open(PIECES, "rb") as f:
        own = sentencepieces.Pieces(f.read())
    held = {p: (s, i) for p, (_, s, i) in ((k, v) for k, v in own.automaton.items())}
    r = random.Random(8)
    letters = ["▁", *"etaoinshrd", "日", "é", "\U0001d11e", "th", "ing", "▁the"]
    for text in ("the", "nation", "zz日q", "tions", *("".join(r.choice(letters) for _ in range(r.randrange(1, 7)))[:9] for _ in range(150))):
        best = -float("inf")
        for mask in range(1 << (len(text) - 1)):
            cuts = [0, *[i + 1 for i in range(len(text) - 1) if mask >> i & 1], len(text)]
            parts = [text[a:b] for a, b in zip(cuts, cuts[1:])]
            scores = [held[p][0] if p in held else own.unknown_score if len(p) == 1 else -float("inf") for p in parts]
            best = max(best, sum(scores))
        ids = own.viterbi(text)
        got = sum(held[own.pieces[i]][0] for i in ids if own.kinds[i] != sentencepieces.BYTE) + own.unknown_score * sum(c not in own.single for c in text)
        assert got == pytest.approx(best)


def test_sentencepiece_frames(spark):
    made = sentencepieces.encode(odd(spark), PIECES, with_ids=True)
    rows = made.collect()
    assert len(rows) == 10 and all(r["round_trip"] for r in rows)
    assert [r["round_trip"] for r in sentencepieces.encode(spark.createDataFrame([(1, "a\u2581b")], "doc_id long, text string"), PIECES).collect()] == [False]
    assert {r["doc_id"]: r["n_tokens"] for r in rows}[1] == 0
    back = {r["doc_id"]: r["text"] for r in sentencepieces.decode(made, PIECES).collect()}
    assert {r["doc_id"]: r["text"] or "" for r in odd(spark).collect()} == back
    assert sentencepieces.encode(empty(spark), PIECES).count() == 0
    full = entries.op1_sentencepiece(spark, SF)
    assert full.where("NOT round_trip").count() == 0 and full.count() == documents(spark).count()


# Packing


@settings(deadline=None, max_examples=100)
@given(st.text(alphabet="aA1 \n\t\r é'ßs.<|>日本𝄞‍़ाⅧ!?-", max_size=60))
def test_engines_agree(text):
    with open(BPE, "rb") as f:
        own = tokens.encoder(f.read())
    assert own._fast is not None and own.check([text, text + "<|endoftext|>" + text])


def packed_well(rows, texts, capacity=1024):
    """Coverage, offsets and hashes of packed rows against `tokenizers`; gives the share of padding."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(BPE)
    ids = {k: np.array([*slow.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for k, t in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for k, own in by_doc.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[k]) and r["ids_crc32"] == zlib.crc32(ids[k][at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids[k])
    used = room = 0
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
        used, room = used + at, room + (at if at & (at - 1) == 0 else capacity)
    return 1 - used / room


def test_packing(spark):
    docs = documents(spark)
    rows = entries.op2_packing(spark, SF).collect()
    assert packed_well(rows, {r["doc_id"]: r["text"] for r in docs.collect()}) < 0.01
    again = odd(spark).where("doc_id IS NULL OR doc_id != 4")
    assert packed_well(packing.pack(again, BPE).collect(), {r["doc_id"]: r["text"] for r in again.collect()}) < 0.01
    twice = packing.pack(odd(spark).where("doc_id = 4"), BPE, with_ids=True).collect()
    assert sum(r["length"] for r in twice) == 2 * twice[0]["doc_tokens"] and all(len(r["ids"]) == r["length"] for r in twice)
    assert packing.pack(empty(spark), BPE).count() == 0


def test_long_runs_of_white_space(spark):
    texts = {1: " " * 1_000_000, 2: "a\n" + "\n" * 1_000_000 + "b", 3: "\t" * 300_000}
    rows = packing.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), BPE).collect()
    assert packed_well(rows, texts) < 0.01


@given(st.lists(st.integers(1, 5000), max_size=40))
def test_bins(lengths):
    bins = packing.Bins(1024, 64, 0)
    out = []
    for doc, n in enumerate(lengths):
        out += bins.add(doc, np.arange(n))
    whole = len({r[4] for r in out})
    out += bins.flush()
    seen = defaultdict(set)
    for doc, start, ids, total, seq, at in out:
        assert ids[0] == start and total == lengths[doc] and not seen[doc] & set(ids.tolist())
        seen[doc] |= set(ids.tolist())
    assert {d: len(s) for d, s in seen.items()} == dict(enumerate(lengths))
    last = Counter()
    for *_, ids, _, seq, at in out:
        last[seq] += len(ids)
    assert all(n == 1024 or n & (n - 1) == 0 for s, n in last.items() if s >= whole)


# Personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, (name, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if name == "ip" else True, "card": 13 <= len(digits) <= 19 and double % 10 == 0, "phone": 9 <= len(digits) <= 15}[name]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


@settings(deadline=None, max_examples=400)
@given(st.one_of(st.text(alphabet="a1@.-_ ", max_size=40), st.text(alphabet="0123456789 -+().", max_size=60), st.text(alphabet="12.5@a%é+", max_size=40)))
def test_base_spans(text):
    assert sorted(pii.base_spans(text)) == sorted(plain_spans(text))


def test_long_runs_are_quick():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "@" * 50_000, "1." * 100_000, "+1" * 50_000, "(" * 100_000, ("a" * 200 + "@") * 1000):
        assert pii.base_spans(text) is not None and pii.tokens(text) is not None
    assert pii.base_spans("0" * 6000 + "1.2.3.4") == [(1, 0, 6007)]


def test_messages_are_exact_on_a_tree():
    field = pii.solve([])
    graph = pii.Graph()
    text = "Call +1 (017) 555-7713 or 1 017 555 7713."
    graph.add(0, text, pii.base_spans(text))
    assert graph.edges["similar"] == [(2, 3), (2, 4), (2, 5), (2, 6)] and graph.label == [4, 4, 4, -1, -1, -1, -1]
    graph.edges["similar"] = []  # what is left is a tree
    assert np.allclose(graph.marginals(field), enumerated(graph, field), atol=1e-3)


def enumerated(graph, field):
    """Marginals by the sum over all labellings."""
    n, k = len(graph.label), 5
    unary = np.array(graph.x) @ field.weights + np.array([field.chain[0] * left + field.chain[:, 0] * right for left, right in graph.alone])
    out = np.zeros((n, k))
    for labels in itertools.product(*[range(k) if y < 0 else [y] for y in graph.label]):
        total = sum(unary[i, y] for i, y in enumerate(labels) if graph.label[i] < 0)
        for kind, own in graph.edges.items():
            total += sum(field.chain[labels[a], labels[b]] if kind == "chain" else getattr(field, kind) * (labels[a] == labels[b]) for a, b in own)
        for i, y in enumerate(labels):
            out[i, y] += np.exp(total)
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("seed", range(12))
def test_messages_are_close_on_loops(seed):
    """Graphs with skip edges over chains of a learned field's strength: loopy marginals against the sum over all labellings."""
    r = np.random.default_rng(seed)
    chain = r.normal(size=(5, 5)) * 0.3
    field = pii.Field(r.normal(size=(pii.FEATURES, 5)) * 0.5, chain, 0.8, 0.5)
    graph = pii.Graph()
    text = ["+1 (017) 555-7713 7713555 or 7713555 7713555", "a1@b.c.d a1@b and 12345 12345 a1@b.c.d", "12345 x 12345 12345 y 12345"][seed % 3]
    graph.add(0, text, pii.base_spans(text))
    assert graph.edges["same"] and graph.edges["chain"] and -1 in graph.label
    got, want = graph.marginals(field), enumerated(graph, field)
    assert np.abs(got - want).max() < 0.1 and (got.argmax(axis=1) == want.argmax(axis=1)).mean() >= 0.8


def test_added_spans(spark):
    field = pii.fit(documents(spark))
    texts = ["Call +1 (017) 555-7713 or 1 017 555 7713 now.", "id 12345678 and 555-7713", "a.b@x.example.com and again a.b@x here", "4929963689861571 4929963689861571"]
    bases = [pii.base_spans(t) for t in texts]
    assert pii.added_spans(texts, bases, field, 0.5) == [[(3, 26, 40)], [], [(0, 28, 33)], []]
    assert pii.redacted(texts[0], bases[0] + [(3, 26, 40)]) == "Call [PHONE] or [PHONE] now."
    assert pii.redacted("abcdef", [(0, 1, 4), (3, 2, 5)]) == "a[EMAIL]f"


def test_the_field_finds_what_patterns_swallow(spark):
    """On 10,000 documents: every added span is a card by its check digit, or a phone in its usual form."""
    docs = entries.table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs)).join(docs, "doc_id").collect()
    added = [(k, r["text"][a:b]) for r in found for k, a, b in parsed(r["spans"]) if (k, a, b) not in {(list(BASE)[x], y, z) for x, y, z in plain_spans(r["text"])}]
    assert added and all(pii.luhn(x) if k == "card" else re.fullmatch(r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}", x) for k, x in added), added


def parsed(said):
    return [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in said.split(",") if x)]


def test_pii_frames(spark):
    docs = documents(spark)
    for r in entries.op3_pii(spark, SF).join(docs, "doc_id").collect():
        base = sorted(plain_spans(r["text"]))
        said = ",".join(f"{list(BASE)[k]}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest() and set(said.split(",")) <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in BASE] == [sum(b[0] == i for b in base) for i in range(4)]
    field = pii.fit(empty(spark))
    assert pii.find(odd(spark), field).count() == 10 and pii.find(empty(spark), field).count() == 0
    assert [r["text"] for r in pii.redact(odd(spark).where("doc_id = 1"), field).collect()] == [None]


# Chat formatting


@settings(deadline=None, max_examples=25)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "[INST]", None]), st.one_of(st.none(), st.lists(st.sampled_from(["\\", "</s>", "[INST]", "[/INST]", "<", "/s>", "[/", "a", "\n", "é"]), max_size=6).map("".join))), max_size=5))
def test_chat_round_trip(spark, turns):
    rows = spark.createDataFrame([(5, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    found = chat_format.format_conversations(rows).collect()
    if not turns:
        assert not found
        return
    (got,) = found
    assert [(t["role"], t["text"]) for t in got["turns"]] == [(r or "", t or "") for r, t in turns]
    masked = [re.sub(r"(?s)\\(.)", r"\1", got["formatted"][m["start"] : m["end"]]) for m in got["loss_mask"]]
    assert masked == [t or "" if r == "assistant" else "" for r, t in turns]
    assert chat_format.digest(chat_format.format_conversations(rows)).first()["loss_sha256"] == hashlib.sha256("".join(masked).encode()).hexdigest()
    assert all(got["formatted"].count(c) == len(turns) for c in (chat_format.OPEN, chat_format.MID, chat_format.CLOSE))


def test_chat_edges(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a", 1), (1, 0, "user", "a", 2), (1, None, None, None, 3), (None, 1, "assistant", "x" * 100_000, 4)], "conv_id long, turn long, role string, text string, formatted int")
    found = {r["conv_id"]: r for r in chat_format.digest(chat_format.format_conversations(rows)).collect()}
    assert found[1]["n_turns"] == 3 and found[None]["loss_chars"] == 100_000
    assert chat_format.format_conversations(rows.limit(0)).count() == 0


# SimHash


def plain_fingerprint(text, size):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    own = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def grouped(fps, ids, radius):
    root = list(range(len(fps)))
    moved = True
    while moved:
        moved = False
        for i in range(len(fps)):
            low = min(root[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= radius)
            moved |= low < root[i]
            root[i] = min(root[i], low)
    return [min(x for x, r in zip(ids, root) if x is not None and r == root[i]) if any(x is not None and r == root[i] for x, r in zip(ids, root)) else None for i in range(len(fps))]


def test_simhash_equals_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in documents(spark).collect())
    fps = [plain_fingerprint(t, 3) for _, t in docs]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in entries.op5_simhash(spark, SF).collect()}
    assert got == {i: (f"{f:016x}", c) for (i, _), f, c in zip(docs, fps, grouped(fps, [i for i, _ in docs], 3))}


@pytest.mark.parametrize("tile", [7, 1 << 14])
def test_links_of_random_fingerprints(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(30)]
    fps = list({b ^ sum(1 << r.randrange(64) for _ in range(r.randrange(4))) & (1 << 64) - 1 for b in base for _ in range(5)})
    rows = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in enumerate(fps)], "id long, fp long")
    got = {r["fp"]: r["component_id"] for r in simhash.components(rows).collect()}
    assert [got[int(np.uint64(f).view(np.int64))] for f in fps] == grouped(fps, list(range(len(fps))), 3)


def test_simhash_edges(spark):
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(odd(spark)).collect()]
    assert len(got) == 10 and {c for i, f, c in got if f == "0" * 16} == {1} and {c for i, _, c in got if i in (5, 6)} == {5} and [c for i, _, c in got if i is None] == [None]
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("tile", [3, 256])
def test_near_dedup_equals_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(near_copies, "GROUP_TILE", tile)
    r = random.Random(9)
    docs = []
    for g in range(12):
        base = [f"w{r.randrange(10_000)}" for _ in range(120)]
        for _ in range(8):
            own = list(base)
            for _ in range(r.randrange(7)):
                own[r.randrange(len(own))] = f"x{r.randrange(10_000)}"
            docs.append(" ".join(own))
    docs += ["", None, "one two", "one two", "ONE two", "three"]
    sets = [set(simhash.shingle_hashes((t or "").encode(), 5).tolist()) for t in docs]
    root = list(range(len(docs)))
    for _ in docs:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if (not a and not b) or len(a & b) >= 0.8 * len(a | b) > 0:
                    root[i] = root[j] = min(root[i], root[j])
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(docs)], "doc_id long, text string, rep int")
    assert sorted(r["doc_id"] for r in near_copies.near_dedup(rows).collect()) == [i for i, x in enumerate(root) if i == x]


def test_a_dominant_run_makes_no_copies(spark):
    texts = [" ".join(["0"] * 300 + [f"d{d}w{k}" for k in range(60)]) for d in range(6)] + ["- " * 400 + "one end of it", "- " * 400 + "quite another end here"]
    twice = [*texts, "0 " * 40 + texts[2]]  # the same set of shingles
    rows = spark.createDataFrame(list(enumerate(twice)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_copies.near_dedup(rows).collect()) == list(range(len(texts)))


def test_repeats_do_not_hide_near_copies(spark):
    texts = []
    for g in range(5):
        base = " ".join(f"g{g}w{k}" for k in range(200))
        texts += [base, base + f" one phrase of five {g}" * 300]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_copies.near_dedup(rows).collect()) == [0, 2, 4, 6, 8]


def test_no_short_near_copy_is_missed(spark):
    texts = []
    for g in range(300):  # 4 of 5 shingles, 8 of 10 and 12 of 15: exactly 0.8, and below it
        a, n = [f"g{g}w{k}" for k in range(40)], (4, 5, 8, 10, 12, 15, 3, 4)[g % 4 * 2 :][:2]
        texts += [" ".join(a[: n[0] + 4]), " ".join(a[: n[1] + 4])]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_copies.near_dedup(rows).collect()) == [i for i in range(600) if i % 2 == 0 or i // 2 % 4 == 3]


def copies_by_brute_force(texts):
    """Ids that stay, by all pairs that share a shingle."""
    sets = [set(simhash.shingle_hashes((t or "").encode(), 5).tolist()) for t in texts]
    holders, root = defaultdict(list), list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in enumerate(sets):
        common = Counter(j for h in own for j in holders[h])
        for j, n in common.items():
            if n >= 0.8 * (len(own) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                root[b] = a
        for h in own:
            holders[h].append(i)
        if not own and (empties := [j for j in range(i) if not sets[j]]):
            root[top(i)] = top(empties[0])
    return [i for i in range(len(texts)) if top(i) == i]


@pytest.mark.parametrize("tile", [5, 1 << 16])
def test_sizes_skip_no_near_copy(spark, monkeypatch, tile):
    """Texts cut to 0.75 to 1 of their length, with repeats: pairs on both sides of the threshold, in many classes of sizes."""
    monkeypatch.setattr(near_copies, "TILE", tile)
    r = random.Random(3)
    texts = []
    for g in range(60):
        n = r.randrange(70, 900)
        words = [f"w{r.randrange(1 << 30)}" for _ in range(n)]
        for _ in range(3):
            texts.append(" ".join(words[: r.randrange(int(0.75 * n), n)]) + r.choice(["", " and so on"]) * r.choice([1, 200]))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_copies.near_dedup(rows).collect()) == copies_by_brute_force(texts)


def test_near_dedup_of_documents_equals_brute_force(spark):
    docs = entries.table(spark, "/root/testdata/sf0.01", "documents")
    rows = sorted(docs.select("doc_id", "text").collect())
    assert [r["doc_id"] for r in rows] == list(range(len(rows)))
    assert sorted(r["doc_id"] for r in near_copies.near_dedup(docs).collect()) == copies_by_brute_force([r["text"] for r in rows])


def test_near_dedup_edges(spark):
    got = near_copies.near_dedup(odd(spark))
    assert got.columns == odd(spark).columns and sorted((r["doc_id"] for r in got.collect()), key=str) == [1, 4, 4, 5, 7, 8, None]
    assert near_copies.near_dedup(empty(spark)).count() == 0


# Line dedup


def plain_line_dedup(docs, min_chars, min_docs):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t.strip(" \t\n\r\x0b\x0c"))
    held = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            if i is not None and len(low(x)) >= min_chars:
                held[low(x)].add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(held.get(low(x), ())) < min_docs or i == max(held[low(x)])]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def shared_lines(n=60, seed=1):
    r = random.Random(seed)
    lines = [f"Line {i} é " + "x" * r.randrange(30) for i in range(12)]
    return [(i, "\n".join(f"{' ' * r.randrange(3)}{r.choice(lines)}".swapcase() if r.random() < 0.3 else r.choice(lines) for _ in range(r.randrange(6)))) for i in range(n)]


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_line_dedup_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "MAX_FILTER_BYTES", limit)  # 0: every document takes the exact way
    docs = [*shared_lines(), (None, shared_lines()[0][1]), (99, None), (100, "")]
    rows = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, n_lines string")
    got = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup.dedup(rows, min_chars=20, min_docs=5).select("doc_id", "text", "n_lines", "n_dropped").collect()]
    assert sorted(got, key=str) == plain_line_dedup(docs, 20, 5)


def test_line_dedup_edges(spark):
    got = line_dedup.dedup(odd(spark))
    assert got.count() == 10 and line_dedup.dedup(empty(spark)).count() == 0 and got.where("n_dropped > 0").count() == 0


def test_line_index_takes_batches_larger_than_itself(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 16)
    index = line_dedup.LineIndex(spark, str(tmp_path / "i"), min_chars=20)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    table = lambda a, b: spark.createDataFrame([(i, f"A line of text with number {i} of them") for i in range(a, b)], "doc_id long, text string")
    keys = lambda df: line_dedup.postings(df, "doc_id", "text", 20).select("hi", "lo").distinct()
    assert "CoGroups" not in plan(index._maybe(keys(table(0, 300))))
    index.insert(table(0, 10))
    assert index.bits == 0
    asked = index._maybe(keys(table(0, 300)))
    assert "part" in plan(asked) and "pmod(xxhash64" in plan(asked) and ", 32)" in plan(asked)
    got = {(r["hi"], r["lo"]): r["maybe"] for r in asked.collect()}
    assert len(got) == 300 and all(got[r["hi"], r["lo"]] for r in keys(table(0, 10)).collect())
    index.insert(table(5, 300))
    assert index.table("counts").where("n_docs = 1").count() == 300


def test_line_index_is_reversible(spark, tmp_path):
    docs = shared_lines(40)
    table = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    index = line_dedup.LineIndex(spark, str(tmp_path / "i"), min_chars=20)
    index.insert(table(docs[:25]))
    before = sorted(map(tuple, index.table("counts").select("hi", "lo", "n_docs", "last").collect()))
    index.insert(table(docs[25:]))
    got = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in index.apply(table(docs)).collect()]
    assert sorted(got, key=str) == plain_line_dedup(docs, 20, 5)
    index.delete(table(docs[25:]))
    assert sorted(map(tuple, index.table("counts").select("hi", "lo", "n_docs", "last").collect())) == before
    got = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in index.apply(table(docs[:25])).collect()]
    assert sorted(got, key=str) == plain_line_dedup(docs[:25], 20, 5)


def held(index):
    return sorted(map(tuple, index.table("counts").select("hi", "lo", "n_docs", "last").collect()))


def test_line_index_after_a_failed_commit(spark, tmp_path, monkeypatch):
    """A write that fails leaves the open index as it was: what is inserted again counts once."""
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 4)
    say = lambda a, b: spark.createDataFrame([(i, "\n".join(f"a line of document {i} with number {k}" for k in range(8))) for i in range(a, b)], "doc_id long, text string")
    index = line_dedup.LineIndex(spark, str(tmp_path / "i"), min_chars=20)
    index.insert(say(0, 1))
    real = spark.createDataFrame
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda self, *a, **b: (_ for _ in ()).throw(OSError("no room")) if "bits int" in str(a[1:]) else real(*a, **b))
        with pytest.raises(OSError):
            index.insert(say(1, 60))  # many keys: more shards
    index.insert(say(0, 1))
    counts = index.table("counts").collect()
    assert len(counts) == 8 and {r["n_docs"] for r in counts} == {1} and index.table("postings").count() == 8


def test_line_index_is_durable(spark, tmp_path):
    docs = shared_lines(30)
    table = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    make = lambda: line_dedup.LineIndex(spark, str(tmp_path / "i"), min_chars=20, expected_keys=1000)
    index = make()
    index.insert(table(docs[:20]))
    before = held(index)
    index.insert(table(docs[:20]))  # again
    index.insert(table(docs[:20]).limit(0))  # nothing
    assert held(index) == before == held(make()) and make().generation == 3
    index.insert(table(docs[20:]))
    shutil.rmtree(tmp_path / "i" / f"{index.generation:012d}" / "commit")  # as if the writer had died before its commit
    again = make()
    assert held(again) == before
    again.insert(table(docs[20:]))
    got = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in make().apply(table(docs)).collect()]
    assert sorted(got, key=str) == plain_line_dedup(docs, 20, 5)
    again.delete(table(docs[20:]))
    assert held(make()) == before
    with pytest.raises(ValueError, match="was made for"):
        line_dedup.LineIndex(spark, str(tmp_path / "i"), min_chars=21)


def test_filters_grow_with_insertions(spark, tmp_path, monkeypatch):
    """Small batches into few shards: filters take keys in place, full ones are built again, and no key that is held is ever denied."""
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 64)
    index = line_dedup.LineIndex(spark, str(tmp_path / "i"), min_chars=20, expected_keys=256)
    table = lambda a, b: spark.createDataFrame([(i, f"A line of text with number {i} of them") for i in range(a, b)], "doc_id long, text string")
    sizes = []
    for a, b in ((0, 100), (90, 160), (160, 420), (420, 900)):
        index.insert(table(a, b))
        asked = index._maybe(line_dedup.postings(table(0, b + 500), "doc_id", "text", 20).select("hi", "lo").distinct())
        denied = asked.where("NOT maybe").join(index.table("counts"), ["hi", "lo"])
        assert denied.count() == 0 and asked.where("NOT maybe").count() > 480 and index.table("counts").count() == b
        sizes.append((index.bits, sum(CuckooFilter.from_bytes(bytes(r["filter"])).size for r in index.table("filters").collect())))
    assert sizes == [(2, 100), (2, 160), (2, 420), (2, 900)] or sizes[:3] == [(2, 100), (2, 160), (2, 420)] and sizes[3][1] == 900


@given(st.sets(st.integers(0, (1 << 128) - 1), max_size=300), st.data())
@settings(deadline=None, max_examples=20)
def test_cuckoo_filter(keys, data):
    split = lambda ks: (np.array([k >> 64 for k in ks], dtype=np.uint64), np.array([k & (1 << 64) - 1 for k in ks], dtype=np.uint64))
    keys = sorted(keys)
    gone = data.draw(st.sets(st.sampled_from(keys))) if keys else set()
    own = CuckooFilter.of(*split(keys))
    assert own.contains(*split(keys)).all()
    own.delete(*split(sorted(gone)))
    left = [k for k in keys if k not in gone]
    own = CuckooFilter.from_bytes(own.to_bytes())
    assert own.contains(*split(left)).all() and own.size == len(left) and Shards(0, {0: own}).contains(*split(left)).all()


def test_cuckoo_filter_says_no_mostly():
    r = np.random.default_rng(1)
    own = CuckooFilter.of(*r.integers(0, 1 << 63, (2, 5000)).astype(np.uint64))
    assert own.contains(*r.integers(0, 1 << 63, (2, 20000)).astype(np.uint64)).mean() < 0.01


# Language models


def test_scores_equal_plain_counting(spark):
    docs = [(1, "a b a c"), (2, "a a b"), (3, "z y"), (4, None), (5, " ")]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    targets = spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")
    model = lm_score.fit(rows, targets, vocab_size=2, bits=16, weight=0.6, alpha=0.1)
    assert list(model.words) == [b"a", b"b"]
    got = {r["doc_id"]: r for r in lm_score.score(rows, model).collect()}
    words = lambda t: [w if w in "ab" else "?" for w in (t or "").split()]
    for text, i in (("a b a c", 1), ("a a b", 2), ("z y", 3)):
        losses = []
        for own in ([docs[0]], docs):
            uni, bi = Counter(), Counter()
            for _, t in own:
                uni.update(words(t))
                bi.update(zip(["^", *words(t)], words(t)))
            context = Counter(a for (a, _), n in bi.items() for _ in range(n))
            uni_context = {**uni, "^": sum(1 for _, t in own if words(t))}
            loss = 0.0
            for a, b in zip(["^", *words(text)], words(text)):
                plain = (uni[b] + 0.1) / (sum(uni.values()) + 0.3)
                h = uni_context.get(a, 0)
                loss -= np.log(0.6 * bi[a, b] / h + 0.4 * plain if h else plain)
            losses.append(loss / len(words(text)))
            del context
        assert got[i]["target_loss"] == pytest.approx(losses[0]) and got[i]["background_loss"] == pytest.approx(losses[1]) and got[i]["score"] == pytest.approx(losses[0] - losses[1])
    assert got[4]["score"] is None and got[5]["n_tokens"] == 0


@pytest.mark.parametrize("frequent", [0, 40, 1 << 20])
def test_all_words_and_bigrams_have_counts(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    r = random.Random(4)
    docs = [(i, " ".join(f"w{r.randrange(40) if r.random() < 0.3 else r.randrange(200_000)}" for _ in range(1500))) for i in range(50)] + [(50, None), (51, " ")]
    docs.append((52, docs[7][1]))  # repeated text
    rows, asked = spark.createDataFrame(docs, "doc_id long, text string"), [*docs, (60, "w1 never seen w2 w1")]
    monkeypatch.setattr(lm_score, "SLICE_TEXT", 100_000)
    monkeypatch.setattr(lm_score, "BUCKET_TEXT", 100_000)
    monkeypatch.setattr(lm_score, "HELD", 10_000)
    wanted = spark.createDataFrame([(i,) for i in range(0, 50, 3)], "doc_id long")
    for given, singles in ((docs, True), (docs, False), (asked, True)):
        model = lm_score.fit(rows, wanted, singles=singles)
        assert model.words == len({w for _, t in docs for w in (t or "").split()}) > (1 << 15) and model.bits == 3
        frame = rows if given is docs else spark.createDataFrame(given, "doc_id long, text string")
        got = {x["doc_id"]: x for x in lm_score.score(frame, model).collect()}
        assert len(got) == len(given) and got[50]["score"] is None and got[51]["n_tokens"] == 0
        for m, own in (("target_loss", [t for i, t in docs if i < 50 and i % 3 == 0]), ("background_loss", [t for _, t in docs])):
            uni, bi = Counter(), Counter()
            for t in own:
                words = (t or "").split()
                uni.update(words)
                bi.update(zip(["^", *words], words))
            total, v, starts = sum(uni.values()), len({w for _, t in docs for w in (t or "").split()}) + 1, sum(1 for t in own if (t or "").split())
            for i, t in given:
                words = (t or "").split()
                if words:
                    plain = [(uni[w] + 0.1) / (total + 0.1 * v) for w in words]
                    h = [starts if a == "^" else uni[a] for a in ["^", *words[:-1]]]
                    want = np.mean([-np.log(0.6 * bi[a, b] / n + 0.4 * p if n else p) for a, b, n, p in zip(["^", *words], words, h, plain)])
                    assert got[i][m] == pytest.approx(want)


def test_asks_are_distinct_by_sorting(monkeypatch):
    """np.unique without counts hashes (0.64 s where sorting takes 0.02 s): asks are made without it."""
    monkeypatch.delattr(np, "unique")
    texts = lm_score.Texts(np.array([1 << 20]), *np.random.default_rng(5).integers(0, 1 << 20, (2, 1 << 20)).astype(np.uint64))
    assert texts.asked().tolist() == sorted({*texts.pairs.tolist(), *texts.words.tolist(), int(lm_score.FIRST)})
    assert lm_score.distinct(np.zeros(0, np.uint64)).tolist() == [] and lm_score.distinct(np.array([3, 1, 3], np.uint64)).tolist() == [1, 3]


def test_answers_are_laid_in_place_and_asks_are_searched():
    """A slice's answers need little more than their own arrays; a bucket's work for an ask goes by the ask's length."""
    import tracemalloc

    r = np.random.default_rng(3)
    keys = np.unique(r.integers(0, 1 << 63, 1 << 20).astype(np.uint64) << np.uint64(1))
    t, b = (r.integers(0, 99, len(keys)) for _ in range(2))
    rows = [{"bucket": k, "n": x.stop - x.start, "keys": lm_score.packed_keys(keys[x]), "t": lm_score.packed(t[x]), "b": lm_score.packed(b[x])} for k, x in lm_score.by_bucket(keys, 6)]
    random.Random(3).shuffle(rows)
    told = pa.array([[], rows, None], pa.list_(pa.struct({"bucket": pa.int32(), "n": pa.int64(), "keys": pa.binary(), "t": pa.binary(), "b": pa.binary()})))
    tracemalloc.start()
    got = lm_score.laid(told[1].values)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all((x == y).all() for x, y in zip(got, (keys, t, b), strict=True)) and most < 1.3 * 24 * len(keys)
    assert [len(x) for i in (0, 2) for x in lm_score.laid(told[i].values)] == [0] * 6
    for short in (20, 50, 60):  # heads that are single, and ones that many keys share
        heads = keys >> np.uint64(short)
        asked = np.unique(np.concatenate((heads[::1000], r.integers(0, 1 << (64 - short), 50).astype(np.uint64))))
        assert lm_score.with_heads(heads, asked).tolist() == np.flatnonzero(np.isin(heads, asked)).tolist()
    assert len(lm_score.with_heads(keys[:0], keys[:5])) == len(lm_score.with_heads(keys, keys[:0])) == 0


def test_vocabulary(spark):
    rows = documents(spark).select(F.col("text").cast("binary").alias("text"))
    seen = Counter(w for r in rows.collect() for w in bytes(r["text"]).lower().split())
    for n in (3, 500, len(seen) + 9):
        assert list(lm_score.vocabulary(rows, n)) == [w for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:n]]


def test_scores_tell_quality(spark):
    got = entries.op7_lm_score(spark, SF).join(entries.table(spark, SF, "labels"), "doc_id").groupBy("quality").agg(F.avg("score").alias("s")).collect()
    means = {r["quality"]: r["s"] for r in got}
    assert means[1] < means[0]


def test_score_edges(spark):
    model = lm_score.fit(odd(spark), odd(spark).limit(0))
    assert lm_score.score(odd(spark), model).count() == 10 and lm_score.score(empty(spark), model).count() == 0
    assert lm_score.score(odd(spark), lm_score.fit(empty(spark), empty(spark))).count() == 10
    with pytest.raises(ValueError, match="fitted on"):
        lm_score.score(odd(spark), lm_score.fit(empty(spark), empty(spark), singles=False))


# Language


def test_held_out_accuracy(spark):
    got = lang_id.identify(entries.table(spark, "/root/testdata/sf0.01", "documents")).join(entries.table(spark, "/root/testdata/sf0.01", "documents"), "doc_id")
    held = got.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count() and 250 < held.count() < 420
    assert got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_language_edges(spark):
    got = {r["doc_id"]: r for r in lang_id.identify(odd(spark)).collect()}
    assert {got[i]["lang_pred"] for i in (1, 2, 3, 7)} == {"und"} and got[1]["score"] == 0 and got[None]["held_out"] is False
    assert {r["lang_pred"] for r in lang_id.identify(odd(spark).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert lang_id.identify(empty(spark)).count() == 0


def all_grams(texts):
    return sorted((int(t), int(g)) for text, found in lang_id.grams(texts, (1, 2, 3, 4), 1 << 15) for t, g in zip(text, found, strict=True))


def test_pieces_lose_no_gram(monkeypatch):
    texts = ["Überall sprechen Menschen. " * 50, "a", "été 12 «x»", "", "Ωmega... ", "!!", "ab\ncd"]
    whole = all_grams(texts)
    assert [x for x in whole if x[0] == 1] == [(1, g) for _, g in all_grams(["a"])] and not [x for x in whole if x[0] in (3, 5)]
    assert whole == sorted((i, g) for i, t in enumerate(texts) for _, g in all_grams([t]))
    monkeypatch.setattr(lang_id, "PIECE", 37)
    assert all_grams(texts) == whole


def test_letters_only():
    codes, ends = lang_id.letter_codes(["«Ab» – c…", "日本、é2"])
    assert "".join(map(chr, codes)) == " ab c  日本 é " and ends.tolist() == [6, 12]


def test_scores_equal_plain_naive_bayes(spark):
    """The batch against naive Bayes over the n-grams of each text as strings; few n-grams, so that buckets do not clash."""
    rows = [(i, t, g) for i, (t, g) in enumerate([("aba ab!", "x"), ("bb b", "y"), ("abba", "x"), ("b a", "y"), ("ab b", None), (None, None), ("12", None), ("ba", None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.fit(docs, orders=(1, 2), buckets=1 << 15, alpha=0.5)
    got = {r["doc_id"]: r for r in lang_id.predict(docs, model).collect()}

    def own(text):
        line = " " + re.sub(r"[^a-z]+", " ", text).strip() + " "
        return [line[i : i + n] for n in (1, 2) for i in range(len(line) - n + 1)]

    counts = {g: Counter(x for _, t, k in rows if k == g for x in own(t)) for g in ("x", "y")}
    for i, t, _ in rows:
        if t and re.search("[a-z]", t):
            logs = np.array([np.log(0.5) + sum(np.log((counts[g][x] + 0.5) / (sum(counts[g].values()) + 0.5 * (1 << 15))) for x in own(t)) for g in ("x", "y")])
            p = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
            assert got[i]["lang_pred"] == "xy"[int(p.argmax())] and got[i]["score"] == pytest.approx(p.max(), abs=1e-5)
        else:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
