"""Operator 12 against a plain Python mix."""

import hashlib
import random
import re

import pytest

from noteflow.llm import curriculum as C

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, source string, text string, _source int, size int, _row int"


def naive(rows):
    size = {i: len(WORDS.findall(t or "")) for i, _, t in rows}
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    own = {s: sum(size[i] for i, x, _ in rows if x == s) for s in sources}
    weight = {s: k % 3 + 1 for k, s in enumerate(sources)}
    total, fixed = sum(own.values()), set()
    while True:
        rest = total - sum(3 * own[s] for s in fixed)
        w = sum(weight[s] for s in sources if s not in fixed)
        above = {s for s in sources if s not in fixed and weight[s] * rest > 3 * own[s] * w}
        if not above:
            break
        fixed |= above
    target = {s: float(3 * own[s]) if s in fixed else weight[s] * rest / w for s in sources}
    out = {}
    for s in sources:
        quota, place = int(target[s] + 0.5), 0
        ids = sorted((i for i, x, _ in rows if x == s), key=lambda i: (int(hashlib.md5(f"0:{i}".encode()).hexdigest()[:15], 16), i))
        for i in ids:
            taken = sum(max(0, min(size[i], quota - place - p * own[s])) for p in range(3))
            out[i] = (size[i], own[s], target[s], taken)
            place += size[i]
    return out


def documents(n, seed, shares):
    rng = random.Random(seed)
    names, weights = zip(*shares)
    rows = [(i, rng.choices(names, weights)[0], " ".join(["w"] * rng.choice([0, 1, 3, 40, 200]))) for i in range(n)]
    return rows + [(n, names[0], None), (n + 1, names[0], ""), (n + 2, None, "a b  c\n"), (n + 3, names[0], "é " * 20_000)]


@pytest.mark.parametrize("bucket_rows", [7, 1000])
def test_documents_equal_the_naive_mix(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(C, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(C, "FAN_BITS", 2)
    rows = documents(400, 1, [("zz", 60), ("Z", 1), ("a", 5), ("é", 3), ("b", 30), ("empty", 0.01)])
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    got = {r["doc_id"]: tuple(r)[1:5] for r in C.place(frame).select("doc_id", "size", "source_size", "target", "taken").collect()}
    want = naive(rows)
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert got[i][:2] == w[:2] and got[i][2] == pytest.approx(w[2], rel=1e-12) and got[i][3] == w[3]
    assert all(t <= 3 * s for s, _, _, t in got.values())


def test_sequence_follows_the_curves(spark):
    rows = [(i, s, " ".join(["w"] * (5 + i % 4))) for i, s in enumerate(["a", "b", "c"] * 600)]
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    placed = C.place(frame).collect()
    seq = C.sequence(frame).collect()
    assert sum(r["n_words"] for r in seq) == sum(r["taken"] for r in placed)
    per = {}
    for r in seq:
        per[r["doc_id"]] = per.get(r["doc_id"], 0) + r["n_words"]
    assert per == {r["doc_id"]: r["taken"] for r in placed if r["taken"]}
    times = [r["time"] for r in seq]
    assert times == sorted(times) and 0 <= times[0] and times[-1] <= 1
    # the early source's words come sooner than the late one's: shares of the first half are 5/8, 1/2 and 5/12
    for s, share in (("a", 0.625), ("b", 0.5), ("c", 2.5 / 6)):
        mine = [r for r in seq if r["source"] == s]
        assert sum(r["n_words"] for r in mine if r["time"] < 0.5) / sum(r["n_words"] for r in mine) == pytest.approx(share, abs=0.01)
    # places in the mix follow the words before them
    first = {(r["doc_id"], r["pass"]): k for k, r in enumerate(seq)}
    before, upto = {}, 0
    for r in seq:
        before[r["doc_id"], r["pass"]], upto = upto, upto + r["n_words"]
    assert all(abs(before[r["doc_id"], 0] - r["starts_at"]) < 60 for r in placed if (r["doc_id"], 0) in first)


def test_curves_invert(spark):
    for curve in (*C.CURVES, ((0.0, 0.0), (0.25, 4.0), (0.5, 0.0), (1.0, 1.0))):
        got = spark.range(101).selectExpr("id / 100.0D AS x").select("x", C.reached(curve, C.time_of(curve, C.F.col("x"))).alias("y")).collect()
        assert all(r["y"] == pytest.approx(r["x"], abs=1e-9) for r in got)
    with pytest.raises(ValueError):
        C.integrals(((0.0, 0.0), (1.0, 0.0)))


def test_nulls_repeats_and_reruns(spark):
    rows = [(None, None, "a b c", 1, 2, 3), (None, None, "a b c", 1, 2, 3), (5, "s", "x", 1, 2, 3), (5, "s", "x y", 1, 2, 3), (6, "s", None, 1, 2, 3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    runs = [sorted(map(str, C.place(frame.repartition(k)).select("doc_id", "size", "source_size", "target", "taken").collect())) for k in (1, 4)]
    assert runs[0] == runs[1] and len(runs[0]) == 5
    assert sum(r["taken"] for r in C.place(frame).collect()) == 9


def test_no_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.place(none).collect() == [] and C.sequence(none).collect() == []


def test_no_words_at_all(spark):
    got = C.place(spark.createDataFrame([(1, "s", "", 1, 2, 3), (2, None, None, 1, 2, 3)], SCHEMA)).collect()
    assert [(r["size"], r["target"], r["taken"], r["time"]) for r in got] == [(0, 0.0, 0, None)] * 2
