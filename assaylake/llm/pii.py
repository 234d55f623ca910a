"""Personal data by base patterns and a skip-chain conditional random field.

Base spans come from fixed patterns (see `base_spans`) and always stay. The field adds spans that the
patterns miss, such as a card that a pattern swallowed together with the number before it, or a known
number where it stands without its marks. It labels tokens (runs without white space) with a kind or
none. Tokens without a digit or an @ are none by definition, so the nodes are the others, however long;
tokens that a base span touches are clamped to its kind. Edges are the chain of neighbouring tokens
(the fixed neighbours enter as they are) and skip edges to the last token before with the same text
("same"), and to the last number (a run of number tokens, however it is spaced) with the same last seven
digits or the last address with the same local part ("similar"). Sum-product messages run over
the loops until they settle, and a free token becomes part of a span where a kind has the largest
marginal, at least `min_marginal`. Pieces that follow each other under one label are one span.

Fit, piecewise, on a drawn sample of documents with a digit or an @ (about `max_train_docs`, a documented
bound): node weights by softmax regression over shape and context features, chain potentials from
the labels of neighbours, skip potentials from how often linked tokens agree, where one of them is
known. Free tokens are unlabelled rather than clean, so they count as none by `UNLABELLED` only.

Defined cases: null and empty texts have no spans; repeated rows are treated alike; a null id stays
null; an empty table gives no rows and a field without evidence adds nothing; other columns are
ignored by `find` and pass through `redact`.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.llm._common import quoted, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
DIGIT = re.compile(r"[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")
MARK_OR_WORD = re.compile(r"\w")
SPACE = re.compile(r"\s")
CORE = re.compile(r"[A-Za-z0-9+(@](?:.*[A-Za-z0-9)])?")
WORD_BEFORE = re.compile(r"(\S{1,32})\s*$")
NOT_DIGIT = re.compile(r"[^0-9]")

CONTEXTS = 32
SHAPES = 26
FEATURES = SHAPES + CONTEXTS
#: Weight of "none" in the training target of a free token; the rest is spread over the kinds.
UNLABELLED = 0.9
#: Digits from which a number is told from others by its text; shorter ones repeat by chance and have no skip edges.
TELLING = 5
#: Digits of a card and of a phone at most: pieces that follow each other under one label are one span up to that.
MOST = {3: 19, 4: 15}
MIN_MARGINAL = 0.5
SWEEPS, SETTLED, DAMPING = 30, 1e-4, 0.3

Span = tuple[int, int, int]  # kind's number in KINDS, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost spans of each kind that do not overlap; a match that fails its check is passed over whole."""
    found: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found.append((0, start, m.end()))
            last = m.end()
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)
    if DIGIT.search(text):
        found += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(d := p.lstrip("0")) <= 3 and int(d or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
        if "+" in text:
            found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return found


def tokens(text: str) -> list[tuple[int, int]]:
    """Places of the tokens with a digit or an @, without marks around them, in text order."""
    out, end = [], 0
    while m := MARK.search(text, end):
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        stop = SPACE.search(text, m.end())
        end = stop.start() if stop else len(text)
        if own := CORE.search(text, start, end):
            out.append(own.span())
    return out


def dotted(own: str) -> bool:
    parts = own.split(".")
    return len(parts) == 4 and all(p.isdecimal() and p.isascii() and len(p) <= 3 and int(p) <= 255 for p in parts)


def features(text: str, start: int, end: int) -> np.ndarray:
    """Shape and left context of a token."""
    own = text[start:end]
    digits = NOT_DIGIT.sub("", own)
    x = np.zeros(FEATURES)
    x[0] = 1
    x[1 + int(np.searchsorted((1, 3, 5, 7, 9, 13, 16, 17, 20), len(digits), side="right"))] = 1
    x[11], x[12], x[13] = "@" in own, "." in own.rpartition("@")[2], dotted(own)
    x[14], x[15], x[16] = "-" in own, "(" in own, own[:1] == "+"
    x[17], x[18] = any(map(str.isalpha, own)), own.isalnum() and not own.isdecimal() and len(own) >= 16
    x[19] = 13 <= len(digits) <= 19 and len(digits) == len(own) and luhn(digits)
    if before := WORD_BEFORE.search(text, max(0, start - 40), start):
        word = before[1].lower()
        x[20], x[21], x[22] = word[-1] in ":=", word[0] == "+", word[-1].isdecimal()
        x[SHAPES + zlib.crc32(word.encode("utf-8", "replace")) % CONTEXTS] = 1
    return x


@dataclass(frozen=True)
class Field:
    weights: np.ndarray  # FEATURES x labels
    chain: np.ndarray  # labels x labels
    same: float
    similar: float


class Graph:
    """Tokens of several documents as one graph without edges between documents."""

    def __init__(self):
        self.x: list[np.ndarray] = []
        self.label: list[int] = []  # of tokens in base spans; -1 for free ones
        self.where: list[tuple[int, int, int]] = []  # document, start, end
        self.alone: list[tuple[bool, bool]] = []  # whether the neighbour on the left, on the right is none by definition
        self.edges: dict[str, list[tuple[int, int]]] = {"chain": [], "same": [], "similar": []}

    def add(self, doc: int, text: str, base: list[Span]) -> None:
        taken = sorted((a, b, k + 1) for k, a, b in base)
        seen: dict[str, dict[str, int]] = defaultdict(dict)
        at, reach, last, run = 0, [], None, []

        def link(kind: str, key: str, nodes: list[int]) -> None:
            before = seen[kind].get(key)
            seen[kind][key] = nodes[-1]
            if before is not None:
                self.edges[kind] += [(before, node) for node in nodes]

        def close() -> None:
            """A run of number tokens is one number, however it is spaced."""
            digits = "".join(NOT_DIGIT.sub("", text[self.where[node][1] : self.where[node][2]]) for node in run)
            if len(digits) >= TELLING:
                link("similar", digits[-7:], run)
            run.clear()

        for a, b in tokens(text):
            while at < len(taken) and taken[at][0] < b:
                reach.append(taken[at])
                at += 1
            reach = [r for r in reach if r[1] > a]
            node, own = len(self.label), text[a:b]
            self.x.append(features(text, a, b))
            self.label.append(reach[0][2] if reach else -1)
            self.where.append((doc, a, b))
            beside = last is not None and not MARK_OR_WORD.search(text, last, a)
            self.alone.append((not beside, True))
            if beside:
                self.alone[node - 1] = (self.alone[node - 1][0], False)
                self.edges["chain"].append((node - 1, node))
            last = b
            number = "@" not in own and not any(map(str.isalpha, own))
            if run and not (beside and number and (own[0] != "+")):
                close()
            if number:
                run.append(node)
            elif "@" in own:
                link("similar", "@" + own.lower().partition("@")[0], [node])
            if "@" in own or len(NOT_DIGIT.sub("", own)) >= TELLING:
                link("same", own.lower(), [node])
        if run:
            close()

    def marginals(self, field: Field) -> np.ndarray:
        """Loopy sum-product in log space."""
        n, k = len(self.label), len(LABELS)
        unary = np.array(self.x).reshape(n, FEATURES) @ field.weights
        alone = np.array(self.alone, dtype=float).reshape(n, 2)
        unary = unary + alone[:, :1] * field.chain[0] + alone[:, 1:] * field.chain[:, 0]
        label = np.array(self.label)
        known = np.flatnonzero(label >= 0)
        unary[known] = -50.0
        unary[known, label[known]] = 0.0
        agree = np.eye(k)
        potentials = {"chain": field.chain, "same": field.same * agree, "similar": field.similar * agree}
        pairs = [(a, b, potentials[kind]) for kind, own in self.edges.items() for a, b in own]
        belief = unary
        if pairs:
            src = np.array([p[0] for p in pairs] + [p[1] for p in pairs])
            dst = np.array([p[1] for p in pairs] + [p[0] for p in pairs])
            pot = np.stack([p[2] for p in pairs] + [p[2].T for p in pairs])
            back = np.roll(np.arange(len(src)), len(pairs))
            msg = np.zeros((len(src), k))
            for _ in range(SWEEPS):
                belief = unary.copy()
                np.add.at(belief, dst, msg)
                cavity = belief[src] - msg[back]
                new = np.logaddexp.reduce(cavity[:, :, None] + pot, axis=1)
                new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
                new = DAMPING * msg + (1 - DAMPING) * new
                moved = np.abs(new - msg).max()
                msg = new
                if moved < SETTLED:
                    break
            belief = unary.copy()
            np.add.at(belief, dst, msg)
        return np.exp(belief - np.logaddexp.reduce(belief, axis=1, keepdims=True))


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", max_train_docs: int = 5000) -> Field:
    """A field from a hash-drawn sample of documents with a digit or an @; the sample's sums go to the driver, not its texts."""
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text")).where(F.col("text").rlike("[0-9@]"))
    n = rows.count()
    share = min(1.0, max_train_docs / n) if n else 1.0
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("pii"), "id"), F.lit(1 << 30)) < F.lit(share) * (1 << 30)).select("text")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[bytes, int], int] = defaultdict(int)
        for batch in slices(batches, "text"):
            graph = Graph()
            for i, text in enumerate(batch.column("text").to_pylist()):
                graph.add(i, text, base_spans(text))
            for x, label in zip(graph.x, graph.label, strict=True):
                seen[b"x" + np.packbits(x > 0).tobytes(), label] += 1
            own = [max(0, y) for y in graph.label]
            for a, b in graph.edges["chain"]:
                seen[b"c", own[a] * len(LABELS) + own[b]] += 1
            for y, (left, right) in zip(own, graph.alone, strict=True):
                seen[b"c", y] += left
                seen[b"c", y * len(LABELS)] += right
            for kind in ("same", "similar"):
                for a, b in graph.edges[kind]:
                    if own[a] or own[b]:
                        seen[kind[:2].encode(), int(own[a] == own[b])] += 1
        if seen:
            yield pa.RecordBatch.from_pydict({"what": pa.array([k[0] for k in seen], pa.binary()), "label": pa.array([k[1] for k in seen], pa.int32()), "n": pa.array(list(seen.values()), pa.int64())})

    got = drawn.mapInArrow(gather, "what binary, label int, n long").groupBy("what", "label").agg(F.sum("n").alias("n")).collect()
    return solve([(bytes(r["what"]), r["label"], r["n"]) for r in got])


def solve(sums: list[tuple[bytes, int, int]], rounds: int = 300, rate: float = 0.5, doubt: float = 5.0) -> Field:
    """A field from the sample's sums; `doubt` is the number of tokens that the prior, which says none, weighs as much as."""
    k = len(LABELS)
    nodes = [(np.unpackbits(np.frombuffer(w[1:], np.uint8))[:FEATURES], y, n) for w, y, n in sorted(sums) if w[:1] == b"x"]
    weights = np.zeros((FEATURES, k))
    weights[0, 0] = np.log((k - 1) * UNLABELLED / (1 - UNLABELLED))
    prior = weights.copy()
    if nodes:
        x = np.array([v[0] for v in nodes], dtype=float)
        target = np.array([np.eye(k)[y] if y > 0 else np.array([UNLABELLED, *[(1 - UNLABELLED) / (k - 1)] * (k - 1)]) for _, y, _ in nodes])
        mass = np.array([v[2] for v in nodes], dtype=float)
        step = np.zeros_like(weights)
        for _ in range(rounds):
            p = x @ weights
            p = np.exp(p - p.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            step = 0.9 * step + rate * (x.T @ ((target - p) * mass[:, None]) / mass.sum() - doubt / mass.sum() * (weights - prior))
            weights = weights + step
    pairs, agreed = np.full((k, k), 1.0), {b"sa": np.ones(2), b"si": np.ones(2)}
    for w, y, n in sums:
        if w == b"c":
            pairs[y // k, y % k] += n
        elif w in agreed:
            agreed[w][y] += n
    chain = np.log(pairs * pairs.sum()) - np.log(pairs.sum(axis=1, keepdims=True) * pairs.sum(axis=0, keepdims=True))
    same, similar = (float(np.log(agreed[w][1] / agreed[w][0])) for w in (b"sa", b"si"))
    return Field(weights, np.clip(chain, -3, 3), same, similar)


def added_spans(texts: list[str], bases: list[list[Span]], field: Field, min_marginal: float) -> list[list[Span]]:
    """What the field adds to each document."""
    graph, out = Graph(), [[] for _ in texts]
    for i, (text, base) in enumerate(zip(texts, bases, strict=True)):
        graph.add(i, text, base)
    if -1 in graph.label:
        p = graph.marginals(field)
        best = p.argmax(axis=1)
        for node, (i, a, b) in enumerate(graph.where):
            kind = int(best[node])
            if graph.label[node] >= 0 or not kind or p[node, kind] < min_marginal:
                continue
            before = out[i][-1] if out[i] and not graph.alone[node][0] and graph.where[node - 1][2] == out[i][-1][2] else None
            if before and before[0] == kind - 1 and kind in MOST and len(NOT_DIGIT.sub("", texts[i][before[1] : b])) <= MOST[kind]:
                out[i][-1] = (kind - 1, before[1], b)
            else:
                out[i].append((kind - 1, a, b))
    return out


def said(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", min_marginal: float = MIN_MARGINAL) -> DataFrame:
    """id, base counts, hash of the base spans, and all spans of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    rows = docs.select(F.col(quoted(id_col)).alias(id_col), F.col(quoted(text_col)).alias("text"))
    names = [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            bases = [base_spans(x) for x in texts]
            more = added_spans(texts, bases, shared.value, min_marginal)
            counts = [pa.array([sum(s[0] == k for s in b) for b in bases], pa.int64()) for k in range(len(KINDS))]
            digests = pa.array([hashlib.sha256(said(b).encode()).hexdigest() for b in bases])
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *counts, digests, pa.array([said([*b, *m]) for b, m in zip(bases, more, strict=True)])], names=names)

    long = T.LongType()
    return rows.mapInArrow(run, T.StructType([T.StructField(id_col, rows.schema[id_col].dataType), *(T.StructField(n, long) for n in names[1:5]), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]))


def redacted(text: str, spans: list[Span]) -> str:
    """Spans replaced by their kind; overlapping ones become one mark of the first kind."""
    out, at = [], 0
    for a, b, k in sorted((a, -b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, -b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, field: Field, text_col: str = "text", min_marginal: float = MIN_MARGINAL) -> DataFrame:
    """`docs` with every span replaced; null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            raw = batch.column(text_col).to_pylist()
            texts = [x or "" for x in raw]
            bases = [base_spans(x) for x in texts]
            more = added_spans(texts, bases, shared.value, min_marginal)
            new = [None if r is None else redacted(t, [*b, *m]) for r, t, b, m in zip(raw, texts, bases, more, strict=True)]
            at = batch.schema.get_field_index(text_col)
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
