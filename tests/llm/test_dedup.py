"""Operators 1, 2, 4 and 9 against brute force."""

import hashlib
import itertools

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from noteflow.llm import lines, minhash, substrings, util, vectors


def smallest(ids, links):
    """id -> smallest id reachable."""
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


# ---------------------------------------------------------------- 1

def cut_by_force(docs, n=50):
    first = {}
    for i, t in docs:
        for j in range(len(t) - n + 1):
            k = t[j:j + n]
            first[k] = min(first.get(k, i), i)
    out = []
    for i, t in docs:
        gone = bytearray(len(t))
        for j in range(len(t) - n + 1):
            if first[t[j:j + n]] < i:
                gone[j:j + n] = b"\1" * n
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and (not j or not gone[j - 1]) for j, g in enumerate(gone))
        out.append((i, len(t), sum(gone), int(runs), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_substrings_match_brute_force(spark, documents, frame):
    rows = [(i, (t or "").encode()) for i, t in documents]
    got = substrings.dedup_substrings(frame, with_text=False).collect()
    assert sorted(map(tuple, got)) == cut_by_force(rows)


def test_shared_anchors_sort_a_bucket_once(monkeypatch):
    rng = np.random.default_rng(3)
    sent = [rng.integers(0, 4000, 50).astype("<u4") for _ in range(300)] + [np.array([5, 5, 9], "<u4"), np.empty(0, "<u4")]
    rows = substrings.records([(7, c, x.tobytes()) for c, x in enumerate(sent)], substrings.SENT)
    times = dict(zip(*np.unique(np.concatenate(sent), return_counts=True)))
    monkeypatch.setattr(substrings, "HOT_CELLS", 4)
    want = [(c, 1, 7, np.unique([v for v in x if 1 < times[v] <= 4]).astype("<u4").tobytes(), np.unique([v for v in x if times[v] > 4]).astype("<u4").tobytes())
            for c, x in enumerate(sent)]
    calls, isin = [], np.isin
    monkeypatch.setattr(substrings.np, "isin", lambda *a, **k: calls.append(1) or isin(*a, **k))
    got = substrings.shared_anchors(rows)
    assert [tuple(r.values()) for r in got.to_pylist()] == [w for w in want if w[3] or w[4]]
    assert len(calls) <= 2          # not once or twice a cell over all values of the bucket


def test_substrings_small_cases(spark):
    p = "".join(f"{k:03d}-" for k in range(20))           # 80 bytes, no repeats
    docs = [(5, p), (3, "x" + p[:50]), (9, p[10:70] + "#" + p[:55]), (9, p), (None, p), (11, "A" * 200), (12, "A" * 51), (13, p[:49])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["n_bytes"]): (r["n_removed"], r["n_spans"]) for r in substrings.dedup_substrings(df).collect()}
    assert got[3, 51] == (0, 0)
    assert got[5, 80] == (50, 1)                          # only what document 3 has
    assert got[9, 116] == (60 + 55, 2)                    # both pieces stand in document 5
    assert got[9, 80] == (80, 1) and got[None, 80] == (80, 1)
    assert got[11, 200] == (0, 0) and got[12, 51] == (51, 1) and got[13, 49] == (0, 0)


def test_substrings_hot_passage(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CELL_BYTES", 600)
    passage = "the passage that every document of this table shares, word by word by word"
    docs = [(i, f"{hashlib.md5(str(i).encode()).hexdigest() * 2} {passage} {hashlib.md5(str(-i).encode()).hexdigest() * 2}") for i in range(300)]
    got = substrings.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string"), with_text=False).collect()
    assert sorted(map(tuple, got)) == cut_by_force([(i, t.encode()) for i, t in docs])


def test_anchor_windows_do_not_depend_on_place():
    rng = np.random.default_rng(1)
    a = rng.integers(97, 123, 400).astype(np.uint8)
    b = np.concatenate([rng.integers(97, 123, 77).astype(np.uint8), a[100:300]])
    sets = []
    for data, lo in ((a, 100), (b, 77)):
        h, first, last, _ = substrings.anchors(data, np.array([len(data)]), 50)
        at = {w: int(x) for x, f, l in zip(h, first, last) for w in range(f, l + 1)}
        sets.append([at[w] for w in range(lo, lo + 151)])
    assert sets[0] == sets[1]


def test_earlier_match_needs_a_smaller_document():
    t = np.frombuffer(b"z" * 60 + b"abcdefgh" * 8 + b"abcdefgh" * 8, np.uint8)
    at = np.array([60, 68, 124])
    assert substrings.earlier_matches(t, at, np.array([4, 4, 4]), 50).tolist() == [False] * 3
    assert substrings.earlier_matches(t, at, np.array([4, 4, 2]), 50).tolist() == [True, True, False]


# ---------------------------------------------------------------- 2

def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_match_brute_force(spark, documents, frame, n):
    rng = np.random.default_rng(n)
    base = documents[5][1].split()
    more = []
    for k in range(40):                                   # one group of near copies
        w = list(base)
        for j in rng.choice(len(w), max(1, len(w) // 40), replace=False):
            w[j] = f"edit{k}x{j}"
        more.append((1000 + k, " ".join(w)))
    df = frame.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    sets = {i: shingles(t, n) for i, t in documents + more}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = smallest(sets, links)
    got = minhash.near_duplicates(df, n).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == \
        {i: (len(s), want[i], want[i] == i) for i, s in sets.items()}
    assert len(got) == len(sets) and links


def test_near_duplicates_null_and_repeated_ids(spark):
    long_text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(2, long_text), (1, long_text + " x"), (1, "short"), (None, long_text), (4, None), (5, "")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df, 2).collect()), key=str)
    assert got == sorted([(2, 1, False), (1, 1, True), (1, 1, True), (None, None, True), (4, 4, True), (5, 5, True)], key=str)


def test_estimate_is_corrected_for_chance(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    rows = []
    for share in (0.0, 0.5, 0.8, 0.95):
        k = int(len(a) * 2 * share / (1 + share))
        b = np.unique(np.concatenate([a[:k], rng.integers(0, 1 << 63, len(a) - k, dtype=np.uint64)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        rows.append((true, *(minhash.packed(minhash.minima(x)).tolist() for x in (a, b))))
    frame = spark.createDataFrame(rows, "true double, a array<long>, b array<long>")
    # the largest threshold that lets a pair through is its estimate plus the slack
    passes = frame.select("true", *[minhash.similar(F.col("a"), F.col("b"), p).alias(f"p{p}") for p in range(20, 119)]).collect()
    for r in passes:
        most = max((p for p in range(20, 119) if r[f"p{p}"]), default=0) / 100
        assert abs(most - minhash.SLACK - r["true"]) < 0.15 or (r["true"] == 0 and most < 0.35)


def test_one_passage_in_many_documents_loses_no_link(spark):
    """2,000 short documents share a passage without being near-duplicates; some pairs among them are."""
    rng = np.random.default_rng(3)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, passage + " " + " ".join(f"u{i}x{j}" for j in range(40))) for i in range(2000)]
    rows += [(2000 + k, rows[int(i)][1] + f" tail{k}") for k, i in enumerate(rng.choice(2000, 60, replace=False))]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    twin = {2000 + k: int(i) for k, i in enumerate(np.random.default_rng(3).choice(2000, 60, replace=False))}
    assert got == {i: twin.get(i, i) for i, _ in rows}


def random_edges():
    rng = np.random.default_rng(8)
    return [(int(a), int(b)) for a, b in rng.integers(-50, 250, (240, 2))] + [(k, k + 1) for k in range(1000, 1040)] + [(7, 7), (2000, 2001), (2001, 2000)]


@pytest.mark.parametrize("limit", [0, 60, util.SMALL_EDGES])
def test_components_of_few_and_of_many_edges_agree(spark, monkeypatch, limit):
    monkeypatch.setattr(util, "SMALL_EDGES", limit)
    edges = random_edges()
    got = {r["id"]: r["component_id"] for r in util.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {(a, b) for a, b in edges if a != b}
    assert got == smallest({x for e in linked for x in e}, linked)


def test_components_of_few_edges_run_few_tasks(spark):
    """The driver's work must not follow rounds times shuffle partitions."""
    sc, key = spark.sparkContext, "spark.sql.shuffle.partitions"
    edges = util.durable(spark.createDataFrame(random_edges(), "u long, v long").coalesce(1))
    was, adaptive = spark.conf.get(key), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(key, "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sc.setJobGroup("few-edges", "components")
        util.components(edges)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set(key, was)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    status = sc.statusTracker()
    stages = {s for j in status.getJobIdsForGroup("few-edges") for s in status.getJobInfo(j).stageIds}
    assert 0 < sum(i.numCompletedTasks for s in stages if (i := status.getStageInfo(s))) <= 160      # 1,900 with a shuffle each round


def tasks_of(spark, group, run):
    """Tasks that ``run`` takes with 40 shuffle partitions."""
    sc, key = spark.sparkContext, "spark.sql.shuffle.partitions"
    was, adaptive = spark.conf.get(key), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(key, "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sc.setJobGroup(group, group)
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set(key, was)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    status = sc.statusTracker()
    stages = {s for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds}
    return sum(i.numCompletedTasks for s in stages if (i := status.getStageInfo(s)))


def test_components_end_in_one_task_once_few_edges_are_left(spark, monkeypatch):
    """A graph that only its first round finds large."""
    edges = util.durable(spark.createDataFrame(random_edges(), "u long, v long").coalesce(1))
    most = edges.where("u <> v").select(*minhash.ordered("u", "v")).distinct().count()
    monkeypatch.setattr(util, "SMALL_EDGES", 0)
    every = tasks_of(spark, "every-round", lambda: util.components(edges))
    monkeypatch.setattr(util, "SMALL_EDGES", most - 1)
    assert 0 < tasks_of(spark, "one-round", lambda: util.components(edges)) < 0.7 * every


def test_links_of_the_first_pass_are_walked_once(spark, monkeypatch):
    """The second components gets links between components alone, not all links again."""
    rng = np.random.default_rng(5)
    rows = []
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(120)]
        for k in range(30):
            w = list(base)
            w[int(rng.integers(0, 120))] = f"edit{g}x{k}"
            rows.append((100 * g + k, " ".join(w)))
    walked = []
    monkeypatch.setattr(minhash, "components", lambda e, u, v: walked.append(e.count()) or util.components(e, u, v))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert got == {i: i // 100 * 100 for i, _ in rows}
    assert len(walked) == 2 and walked[0] >= 6 * 29 and walked[1] < walked[0] / 4


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(7, 3), (3, 9), (5, 5)], "u long, v long")
    got = {r["id"]: r["component_id"] for r in util.components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 3: 3, 7: 3, 9: 3}


# ---------------------------------------------------------------- 4

def test_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE", 64)
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 16))
    x = np.concatenate([base[rng.integers(0, 40, 300)] + 0.25 * rng.standard_normal((300, 16)), np.repeat(base[:3], 20, 0), 5 * base[:5]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [float("inf")] + [1.0] * 15), (1004, [1.0]), (1005, [2.0]),
           (1006, [None] * 16), (None, rows[0][1]), (3, rows[3][1])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows + odd], "vec_id long, embedding array<double>, kept int")
    got = vectors.near_vectors(df).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    comp = smallest(range(len(u)), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])
    want = {i: (int(near[i].sum()), comp[i], comp[i] == i) for i in range(len(u))}
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is not None and r["vec_id"] < 1000} == want
    rest = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is None or r["vec_id"] >= 1000}
    assert rest == {**{i: (0, i, True) for i in (1000, 1001, 1002, 1003, 1006)}, 1004: (1, 1004, True), 1005: (1, 1004, False), None: (0, None, True)}
    assert len(got) == len(rows) + len(odd) and near.sum() > 1000


# ---------------------------------------------------------------- 9

def test_lines_match_sql(spark, documents, frame):
    con = duckdb.connect()
    con.register("docs_", __import__("pandas").DataFrame(documents, columns=["doc_id", "text"]))
    con.execute("CREATE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text FROM docs_")
    sql = lines.OP9_SQL
    want = {r[0]: r[1:] for r in con.execute(sql).fetchall()}
    got = lines.dedup_lines(frame, counts=True).collect()
    assert "kept" in got[0].asDict() and len(got) == len(documents)
    for r in got:
        n, removed, runs, md5 = want[r["doc_id"]]
        if r["text"] is None:
            assert r["_n_lines"] == 0
            continue
        assert (r["_n_lines"], r["_n_removed"], r["_n_runs"]) == (n, removed, runs), r["doc_id"]
        assert hashlib.md5(r["text"].encode()).hexdigest() == md5
    assert sum(r["_n_removed"] for r in got) > 0


def test_lines_small_cases(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    long_line = " ".join(f"z{i}" for i in range(40))
    docs = [(1, f"{a}\n{b}\nend"), (2, f"start\n{a}\n\n{b}\nown"), (3, f"{a}\n{c}\n{b}"), (4, f"x\n{long_line}\ny\n{long_line}"), (5, long_line), (6, None),
            (None, f"{b}\nq\n{a}\n{b}"), (7, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(df).collect()}
    assert got[1] == docs[0][1]                            # the first copy stays
    assert got[2] == "start\nown"                          # 40 words of lines a, b in a row
    assert got[3] == docs[2][1]                            # 20 words alone are no run
    assert got[4] == f"x\n{long_line}\ny" and got[5] == ""  # again in the same document, and in the next
    assert got[6] is None and got[7] == "" and got[None] == f"{b}\nq"


def test_lines_plan_is_native(spark, frame):
    plan = lines.dedup_lines(frame)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ---------------------------------------------------------------- empty tables

def test_empty_tables(spark, empty):
    assert substrings.dedup_substrings(empty).count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    assert lines.dedup_lines(empty).count() == 0
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_many_copies_of_one_text(spark):
    text = " ".join(f"word{i}" for i in range(60))
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    r = substrings.dedup_substrings(df, with_text=False).agg(F.sum((F.col("n_removed") == F.col("n_bytes")).cast("int"))).first()[0]
    assert r == 499
    assert minhash.near_duplicates(df).where("kept").count() == 1
