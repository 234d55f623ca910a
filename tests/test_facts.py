"""Facts and their boxes against plain Python."""

import random
import re

from assaylake.operators import facts

SENTENCES = [
    "FA-1 contained 45.2 wt.% crystalline and 54.8 wt.% amorphous phases.", "Slag had 20% crystalline phases, and 70 % amorphous matter.", "Soil A contained 42.1 wt.% quartz and 7.5 wt.% mullite in all.",
    "The amorphous content of FA2 was approximately 71.5%.", "Amorphous fraction of GBS is 99.9 wt% here.", "Nothing to see.", "Ash contained 120% crystalline and 4% amorphous.",
]


def page(rng, n):
    words = " ".join(rng.choice([*SENTENCES, "filler words of 12 % that say nothing"]) for _ in range(n)).split(" ")
    return [(k, w, 10.0 * k, 5.0, 10.0 * k + len(w), 9.0) for k, w in enumerate(words)]


def plain(words):
    """{(shape, fact, role): (snippet, x0, x1)} by Python's own matches."""
    text, spans = " ".join(w[1] for w in words), []
    at = 0
    for w in words:
        spans.append((at, at + len(w[1]), w))
        at += len(w[1]) + 1
    out = {}
    for shape, parts in facts.SHAPES.items():
        for n, m in enumerate(re.finditer("".join(f"({p})" for _, p in parts), text)):
            for i, (role, _) in enumerate(parts):
                if role and m.group(i + 1):
                    own = [w for lo, hi, w in spans if lo < m.end(i + 1) and hi > m.start(i + 1)]
                    out[shape, n + 1, role] = (m.group(i + 1), min(w[2] for w in own), max(w[4] for w in own))
    return out


def test_facts_have_the_boxes_of_their_words(spark):
    rng = random.Random(0)
    pages = {(d, p): page(rng, rng.randint(0, 9)) for d in range(6) for p in range(3)}
    rows = [(d, p, *w) for (d, p), words in pages.items() for w in words]
    got = facts.phase_facts(spark.createDataFrame(rows, "document int, page int, place int, text string, x0 double, y0 double, x1 double, y1 double")).collect()
    found = {(r["document"], r["page"], r["shape"], r["fact"], r["role"]): (r["snippet"], r["x0"], r["x1"]) for r in got}
    assert found == {(*k, *f): v for k, words in pages.items() for f, v in plain(words).items()} and len(found) > 50 and {k[2] for k in found} == set(facts.SHAPES)
    states = {(r["snippet"], r["status"]) for r in got if r["role"] == "crystalline"}
    assert states <= {("45.2", "CANDIDATE"), ("20", "INCONSISTENT"), ("120", "INCONSISTENT")} and len(states) > 1


def test_table_text_is_out_of_scope(spark):
    rng = random.Random(2)
    texts = ["1. Methods", "prose", "References", "Table 1", "more prose"]
    blocks, regions = [], []
    for d in range(8):
        for k in range(25):
            x, y = rng.randint(0, 300), rng.randint(0, 300)
            blocks.append((d, rng.randint(1, 2), k, *([float(x), float(y), x + 10.0, y + 5.0] if rng.random() < 0.9 else [None] * 4), rng.choice(texts if d else texts[1:])))
        for _ in range(3):
            x, y = rng.randint(0, 250), rng.randint(0, 250)
            regions.append((d, rng.randint(1, 2), float(x), float(y), x + 120.0, y + 90.0))
    df = spark.createDataFrame(blocks, "document int, page int, k int, x0 double, y0 double, x1 double, y1 double, text string")
    boxes = spark.createDataFrame(regions, "document int, page int, x0 double, y0 double, x1 double, y1 double")
    said = lambda p: df["text"].rlike(p)
    got = {(r["document"], r["k"]) for r in facts.reading_scope(df, boxes, ["k"], said("^1\\."), said("^References$"), said("^Table")).collect()}
    want = set()
    for d in range(8):
        free = [b for b in blocks if b[0] == d and not any(r[:2] == b[:2] and b[3] is not None and b[3] >= r[2] - 2 and b[4] >= r[3] - 2 and b[5] <= r[4] + 2 and b[6] <= r[5] + 2 for r in regions)]
        on, anywhere = False, any(b[7].startswith("1.") for b in free)
        for b in sorted(free, key=lambda b: b[2]):
            on = True if b[7].startswith("1.") else False if b[7] == "References" else on
            if on or not anywhere or b[7] == "Table 1":
                want.add((d, b[2]))
    assert got == want and 0 < len(got) < len(blocks)


def test_words_are_not_broadcast(spark):
    words = spark.range(2).selectExpr("id AS document", "1 AS page", "posexplode(array('Slag', 'contained', '5.5', '%', 'quartz', 'and', '7', '%', 'mullite')) AS (place, text)").selectExpr("*", "0D AS x0", "0D AS y0", "1D AS x1", "1D AS y1")
    plan = facts.phase_facts(words)._jdf.queryExecution().toString()
    assert "Broadcast" not in plan.split("== Physical Plan ==")[1]
