"""Merkle manifest and hard negatives against brute force, the quality model on held-out rows."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwork.llm import hard_negatives, merkle, quality

# Merkle manifest

DOC = "doc_id long, text string, lang string, source string, n_chars long, grp string, key int, leaf string, pos int, node string"


def documents(spark, rows):
    return spark.createDataFrame([(*r, "g", 1, "l", 2, "n") for r in rows], DOC)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    values = [doc_id, source, lang, n_chars, text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_of(nodes):
    """The root and, for each node, its path as ``(left, right)`` siblings."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            other = nodes[place ^ 1] if place ^ 1 < len(nodes) else None
            paths[i].append((other, None) if place % 2 else (None, other))
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        at = [place // 2 for place in at]
    return nodes[0], paths


def brute_manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        group = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees[name] = group, *tree_of([leaf_of(*r) for r in group])
    root, above = tree_of([trees[n][1] for n in names])
    out = []
    for name, upper in zip(names, above):
        group, subroot, paths = trees[name]
        for row, path in zip(group, paths):
            path = path + upper
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None
            fold = leaf_of(*row[:4], row[4] + 1) if hit else leaf_of(*row)
            for left, right in path:
                fold = h(left or "", fold, right or "")
            proof = h(*[left or right or "" for left, right in path])
            out.append((row[0], leaf_of(*row), subroot, root, proof, fold, fold == root))
    return sorted(out, key=repr)


def manifest_rows(spark, rows):
    return sorted(map(tuple, merkle.documents_manifest(documents(spark, rows).repartition(3)).collect()), key=repr)


MANY = [
    *[(i, f"text {i}", "en", "s", i) for i in range(0, 70, 2)], *[(i, "ü" * i, "de", None, None) for i in range(5)],
    (7, "lone", "fr", "s", 3), (None, "no id", "en", "s", 1), (None, "no id", "en", "s", 1), (4, None, None, None, 9),
    (4, "text 4", "en", "s", 4), (4, "other", "en", "s", 4), (11, "", "", "", 0), (12, "x" * 300_000, "zz", "s", 300_000),
    (-3, "below", "en", "s", 1), (13, "13", None, "s", 2),
]


@pytest.mark.parametrize("digits", [1, 2, 8])
def test_manifest_against_brute_force(spark, monkeypatch, digits):
    """Small blocks need several rounds and give the same tree."""
    monkeypatch.setattr(merkle, "DIGITS", digits)
    assert manifest_rows(spark, MANY) == brute_manifest(MANY)


def test_manifests_of_one_row_and_none(spark):
    row = [(7, "lone", "fr", "s", 3)]
    assert manifest_rows(spark, row) == brute_manifest(row)
    assert manifest_rows(spark, []) == []


def test_rows_go_to_blocks_by_one_shuffle(spark):
    nodes = spark.range(64).selectExpr("string(id % 3) grp", "id % 2 AS n", "id pos", "struct(string(id) AS digest) AS node")
    plan = merkle.blocks(nodes, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


# Quality


def test_trees_take_the_best_cut():
    g, hess, n = np.array([-3.0, -2, 4, 5, -6]), np.ones(5) * 8, np.full(5, 10.0)

    def gain(cut):
        return sum(g[p].sum() ** 2 / (hess[p].sum() + quality.RIDGE) for p in (slice(0, cut), slice(cut, 5)))

    best, cut = quality.best_cut(g, hess, n)
    assert cut == max(range(1, 5), key=gain)
    assert best == pytest.approx(gain(cut) - g.sum() ** 2 / (hess.sum() + quality.RIDGE))
    _, tree = quality.shallow_tree(g, hess, n)
    assert len(set(tree)) <= quality.LEAVES and np.sign(tree).tolist() == [1, 1, -1, -1, 1]


def test_pairs_learn_what_no_single_feature_shows():
    x = np.random.default_rng(1).random((2000, len(quality.NAMES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(int)
    model = quality.fit(x[:1500], y[:1500])
    assert ((model.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.9
    assert (2, 5) in [(i, j) for i, j, _ in model.pairs]


def test_the_score_is_the_sum_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.random((400, len(quality.NAMES)))
    model = quality.fit(x, (x[:, 0] + x[:, 1] > 1).astype(int))
    for row, score in zip(x[:20], model.score(x[:20])):
        z = model.constant + sum(t[sum(row[i] >= c)] for i, (t, cuts) in enumerate(zip(model.tables, model.cuts)) for c in [cuts])
        z += sum(t[sum(row[i] >= model.coarse[i]), sum(row[j] >= model.coarse[j])] for i, j, t in model.pairs)
        assert score == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def test_text_features():
    names = dict(zip(quality.NAMES, quality.text_features("Abc abc, x1 x1!\nline two&\nline two&\n")))
    assert names["words"] == pytest.approx(np.log1p(8))
    assert names["distinct"] == 6 / 8 and names["doubled"] == 0 and names["lines_repeated"] == pytest.approx(1 / 3)
    assert names["mark_ends"] == 3 / 8 and names["word_ends"] == 1 / 8 and names["short_lines"] == 1
    assert not quality.text_features("").any() and not quality.text_features(" \n\t").any()
    long = "wort ü " * 400_000
    assert np.isfinite(quality.text_features(long)).all() and np.isfinite(quality.text_features("x" * 3_000_000)).all()


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    scored = quality.score_documents(docs, quality.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    for label in (0, 1):
        of = [r["predicted"] == label for r in scored if r["quality"] == label]
        assert len(of) >= 5 and np.mean(of) >= 0.9


def test_quality_of_odd_rows(spark):
    schema = "doc_id long, text string, quality int, score double, x int"
    rows = [(i, ("Plain words here. " * 9) if i % 3 else "$$$ !!! ### " * 9, 9, 0.5, 1) for i in range(90)]
    odd = [(None, None, 1, 0.0, 1), (500, "", 1, 0.0, 1), (501, None, 1, 0.0, 1), (2, rows[2][1], 1, 0.0, 1), (502, "ß" * 200_000, 1, 0.0, 1)]
    docs = spark.createDataFrame(rows + odd, schema)
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), "t") for i in range(90)] + [(3, 7, "t"), (3, None, "t"), (None, 1, "t"), (500, 1, "t")],
        "doc_id long, quality int, text string",
    )
    got = quality.score_documents(docs, quality.train(docs, labels)).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= quality.THRESHOLD) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[i]["predicted"] for i in (3, 4)] == [0, 1]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    none = labels.where("false")
    assert {r["score"] for r in quality.score_documents(docs, quality.train(docs, none)).collect()} == {0.5}
    ones = quality.train(docs, labels.where("quality = 1"))
    assert min(r["score"] for r in quality.score_documents(docs, ones).collect()) > 0.5
    assert quality.score_documents(docs.where("false"), ones).count() == 0
    assert quality.train(docs, labels, train_rows=5).constant != 0


# Hard negatives


def brute_mined(rows):
    kept = set()
    for vec_id, label, v in rows:
        if None in (vec_id, label, v) or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.add((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(int(np.floor(256 * float(x))) for x in v)))
    out = []
    for anchor in (r for r in kept if r[0] % 100 == 0):
        scored = sorted((-sum(x * y for x, y in zip(anchor[2], r[2])), r[0], r[1]) for r in kept if r != anchor)
        for score, positive, _ in [s for s in scored if s[2] == anchor[1]][:5]:
            top = -score
            inside = [s for s in scored if s[2] != anchor[1] and 80 * top <= -100 * s[0] <= 100 * top][:5]
            out += [(anchor[0], positive, i + 1, s[1], top, -s[0]) for i, s in enumerate(inside)]
    return sorted(out)


def embedding_rows(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, "a", 2) for r in rows], "vec_id long, label int, embedding array<double>, id int, anchor string, score int"
    )


def mined(spark, rows):
    return sorted(map(tuple, hard_negatives.mined(embedding_rows(spark, rows).repartition(3)).collect()))


@pytest.mark.parametrize("tile", [7, 8192])
def test_hard_negatives_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", tile)
    monkeypatch.setattr(hard_negatives, "TILE_ANCHORS", 3)
    rng = np.random.default_rng(5)
    rows = [(i * 10, int(rng.integers(0, 3)), [float(x) for x in rng.integers(-2, 4, 4) / 8]) for i in range(260)]
    rows += [(5, 1, [0.5, 0.5, 0.5, 0.5])] * 40  # copies of a row
    rows += [(7000 + i, i % 2, [0.25, 0.25, 0.25, 0.25]) for i in range(60)]  # many ties
    rows += [(100, 2, [1.0, 0.0, 0.5, 0.25]), (100, 2, [0.0, 1.0, 0.5, 0.25]), (200, 1, [0.5])]  # ids again, a short one
    rows += [
        (None, 1, [1.0] * 4), (900, None, [1.0] * 4), (901, 1, None), (902, 1, [1.0, None, 1.0, 1.0]), (300, 1, []),
        (903, 1, [float("nan"), 0.0, 0.0, 0.0]), (904, 1, [float("inf"), 0.0, 0.0, 0.0]), (400, 2, [0.0] * 4),
    ]
    got = mined(spark, rows)
    assert got == brute_mined(rows) and len(got) > 100


def test_large_components_and_no_rows(spark):
    rows = [(i, i % 2, [1e4 * (i + 1), 3.0 * i, 1e3]) for i in range(0, 700, 7)]
    assert mined(spark, rows) == brute_mined(rows)
    assert mined(spark, []) == [] and mined(spark, [(100, 1, [1.0])]) == []
    extreme = [(100, 1, [1e300, 1.0]), (101, 1, [1e300, 2.0]), (102, 2, [1e300, 3.0])]
    assert [r[:4] for r in mined(spark, extreme)] == [(100, 101, 1, 102)]


def test_products_are_exact():
    a = np.array([[2**40, -(2**40), 3]])
    b = np.array([[2**20, 2**20 - 1, 1], [2**30, 0, 0]])
    assert hard_negatives.products(a, b).tolist() == [[2**40 + 3, min(2**70, 2**63 - 1)]]


def test_windows_of_one_anchor_straddle_batches():
    import pyarrow as pa

    rows = [(1, 0, 100, 0, 9), (1, 0, 100, 1, 2), (1, 0, 90, 0, 8), (1, 0, 81, 1, 3), (1, 0, 79, 1, 4), (2, 0, 90, 1, 5)]
    names = [x.split()[0] for x in hard_negatives.FOUND.split(",")]
    batches = [pa.RecordBatch.from_arrays([pa.array([x]) for x in r], names) for r in rows]
    out = [tuple(c[0] for c in b.to_pydict().values()) if b.num_rows == 1 else b.to_pylist() for b in hard_negatives.streamed(iter(batches))]
    flat = [tuple(r.values()) for b in out if isinstance(b, list) for r in b] + [b for b in out if isinstance(b, tuple)]
    assert sorted(flat) == sorted([(1, 9, 1, 2, 100, 100), (1, 9, 2, 3, 100, 81), (1, 8, 1, 3, 90, 81), (1, 8, 2, 4, 90, 79)])
