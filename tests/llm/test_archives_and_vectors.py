"""WARC archives and embeddings: round trips and brute force on small tables."""

import base64
import hashlib
import random

import numpy as np
import pytest

from tillwork.llm import embeddings, warc

PAGES = "page_id long, url string, html string, sha1 string, largest long, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, "b") for r in rows], PAGES)


ROWS = [
    (1, "http://a.example/1", "<p>x</p>"), (2, "http://a.example/2\r\nX: 1", "<p>x</p>"), (3, None, None),
    (4, "http://a.example/ü%0A", ""), (5, "u", "é\r\n\r\nWARC/1.1\r\n"), (6, "u", "y" * 300_000), (7, "u", "<p>x</p>"),
    (7, "again", "<p>x</p>"), (None, "n", "<p>x</p>"), (None, "n", "alone"), (8, "u", "alone 8"),
]


def test_archives_against_brute_force(spark):
    got = warc.archive_round_trip(pages(spark, ROWS).repartition(3)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    ).collect()
    expected = []
    for page_id, url, html in ROWS:
        data = (html or "").encode()
        same = [p for p, _, h in ROWS if (h or "") == (html or "")]
        largest = max((p for p in same if p is not None), default=None)
        revisit = largest is not None and page_id != largest
        expected.append((
            page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
            "revisit" if revisit else "response", largest if revisit else None, url,
        ))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_small_payloads_can_be_kept(spark):
    got = warc.archive_round_trip(pages(spark, ROWS), min_revisit_bytes=9)
    assert got.where("record_type = 'revisit'").count() == 0


def test_a_selection_is_read_through_the_index(spark, folder):
    where = f"file://{folder}" if not folder.startswith("file:") else folder
    index = warc.write_archives(warc.with_record_types(pages(spark, ROWS)), where)
    assert index.count() == len(ROWS)
    some = warc.read_archives(index.where("page_id in (5, 6)"), where).collect()
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in some} == {5: ROWS[4][2], 6: ROWS[5][2]}
    assert warc.read_archives(index.where("false"), where).count() == 0


def test_an_empty_table_gives_an_empty_index(spark):
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def test_ranges_are_coalesced():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 10, 10), ("a", 20 + warc.GAP_BYTES + 1, 5), ("b", 0, 5)]
    ranges = [(f, s, e, len(m)) for f, s, e, m in warc.coalesced(iter(rows))]
    gap = 20 + warc.GAP_BYTES + 1
    assert ranges == [("a", 0, 20, 3), ("a", gap, gap + 5, 1), ("b", 0, 5, 1)]
    big = [("a", i * warc.RANGE_BYTES, warc.RANGE_BYTES) for i in range(3)]
    assert len(list(warc.coalesced(iter(big)))) == 3


# Embeddings


def brute(rows, threshold=0.9):
    n = len(rows)
    usable = [
        i for i, (_, v) in enumerate(rows)
        if v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    ]
    links, group = [0] * n, list(range(n))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in usable:
        for b in usable:
            if b < a and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], float) for k in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    group[top(a)] = top(b)
            if b < a and rows[a][0] is not None and rows[a][0] == rows[b][0]:
                group[top(a)] = top(b)
    least = {}
    for i, (v, _) in enumerate(rows):
        if v is not None:
            least[top(i)] = min(v, least.get(top(i), v))
    out = []
    for i, (v, _) in enumerate(rows):
        component = None if v is None else least[top(i)]
        out.append((v, links[i], component, v == component))
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(150)]
    for i in range(60):  # near and equal copies, chains among them
        source = rows[int(rng.integers(0, len(rows)))][1]
        noise = rng.normal(size=16) * (0 if i % 4 == 0 else 0.15)
        rows.append((len(rows), (np.array(source) + noise).astype(np.float32).tolist()))
    rows += [
        (300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] + [1.0] * 15), (304, [None] + [1.0] * 15),
        (305, [float("inf")] + [1.0] * 15), (306, rows[3][1]), (306, rows[3][1]), (None, rows[3][1]),
        (None, rng.normal(size=16).astype(np.float32).tolist()), (-5, rows[7][1]),
        # Ids again, of other vectors: the least of two classes, and neither's least.
        (0, rng.normal(size=16).astype(np.float32).tolist()), (0, rows[9][1]), (0, rows[9][1]), (-5, rows[11][1]), (306, rows[12][1]),
        (307, [1.0, 2.0]), (308, [2.0, 4.0]), (309, [-0.0, 1.0]), (310, [0.0, 3.0]),
    ]
    random.Random(1).shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, "k", 2) for i, v in rows], "vec_id long, embedding array<float>, label int, key string, first long"
    )


def test_embeddings_against_brute_force(spark, vectors, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 40)  # several blocks
    got = embeddings.near_duplicates(frame(spark, vectors).repartition(4)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(vectors), key=repr)


def test_an_id_of_two_vectors_keeps_the_links_of_both(spark):
    rows = [(5, [1.0, 0.0, 0.0]), (5, [0.0, 1.0, 0.0]), (6, [0.0, 1.0, 0.1]), (7, [1.0, 0.0, 0.1]), (8, [0.0, 0.0, 1.0])]
    got = embeddings.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted([(5, 1, 5, True), (5, 1, 5, True), (6, 1, 5, False), (7, 1, 5, False), (8, 0, 8, True)])


def test_embeddings_of_few_rows(spark):
    assert embeddings.near_duplicates(frame(spark, [])).count() == 0
    odd = embeddings.near_duplicates(frame(spark, [(1, None), (2, [0.0])])).collect()
    assert sorted(map(tuple, odd)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_bounds_lose_no_pair():
    rng = np.random.default_rng(9)
    base = rng.normal(size=(300, 24))
    x = embeddings.unit(np.concatenate([base, base[:100] + 0.25 * rng.normal(size=(100, 24))]))
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    i, j = embeddings.linked_pairs(x, x, x @ axes, x @ axes, 0.9)
    expected = {(a, b) for a, b in zip(*np.nonzero(x @ x.T >= 0.9))}
    assert set(zip(i.tolist(), j.tolist())) == {(int(a), int(b)) for a, b in expected}
