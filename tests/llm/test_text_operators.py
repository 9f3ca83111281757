"""Operators on documents: brute force on small tables with null, empty, long and repeated rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from tillwork.llm import bpe, fingerprints, jaccard, packing, suffix_tree

SCHEMA = "doc_id long, text string, name string, sets string, task int, n long, key string"


def table(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", "y", 1, 2, "z") for i, t in rows], SCHEMA)


def prose(seed, n):
    rng = random.Random(seed)
    syllables = "the an er ing on re th ea in st ed or ha ti es".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


LONG = prose(1, 6000)
ROWS = [
    (3, prose(3, 40)), (1, None), (2, ""), (10, " \n\t "), (4, prose(4, 120)), (5, prose(4, 120) + " extra"),
    (6, prose(4, 120)), (7, "Straße ÄÖ 日本語 😀\n\nx"), (8, "one two"), (9, "ONE  TWO"), (11, LONG), (12, LONG[:-40]),
    (13, "a" * 3000), (14, "word " * 500), (15, prose(3, 40)), (15, prose(15, 60)), (None, prose(3, 40)), (None, None),
    (16, "the <|endoftext|> don't 12,5"),
]


def words_of(text):
    return [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def by_text(rows):
    return sorted(rows, key=repr)


# Fingerprints


def winnowed(text):
    mask = (1 << 40) - 1
    hashes = [xxhash.xxh64_intdigest(w.encode(), seed=42) & mask for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w]
    if not hashes:
        return []
    m, size = fingerprints.MULTIPLIER, fingerprints.GRAM
    grams = []
    for i in range(max(1, len(hashes) - size + 1)):
        own = hashes[i : i + size]
        value = own[0]
        if len(own) < size:  # one by one
            for h in own[1:]:
                value = (value * pow(m, 1, 1 << 22) + h) & mask
        else:
            value = (own[0] * pow(m, 1, 1 << 22) + own[1]) & mask
            value = (value * pow(m, 1, 1 << 22) + own[2]) & mask
        grams.append(xxhash.xxh64_intdigest(value.to_bytes(8, "little"), seed=42) >> 33)
    kept = []
    for i in range(max(1, len(grams) - fingerprints.WIN + 1)):
        window = range(i, min(i + fingerprints.WIN, len(grams)))
        at = min(window, key=lambda p: (grams[p], -p))
        if (grams[at], at) not in kept:
            kept.append((grams[at], at))
    return kept


def jaccard_of(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_against_brute_force(docs):
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    expected = []
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, after = winnowed(text), winnowed(edited), winnowed(following)
        show = lambda kept: " ".join(f"{h:x}@{p}" for h, p in kept)
        expected.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), show(own), show(changed),
            jaccard_of(own, changed), jaccard_of(own, after),
        ))
    got = [tuple(r) for r in fingerprints.fingerprints(docs).collect()]
    assert by_text(got) == by_text(expected)


def test_windows_share_a_gram_wherever_enough_words_agree():
    shared = prose(77, fingerprints.GRAM + fingerprints.WIN - 1)
    for seed in range(20):
        a, b = f"{prose(seed, 30)} {shared} {prose(seed + 100, 9)}", f"{prose(seed + 200, 5)} {shared} tail"
        assert {h for h, _ in winnowed(a)} & {h for h, _ in winnowed(b)}


def test_fingerprints_of_few_rows(spark, empty):
    assert fingerprints.fingerprints(empty).count() == 0
    alone = fingerprints.fingerprints(table(spark, [(1, "a b c d")])).first()
    assert alone["near_next"] == 1.0
    nulls = fingerprints.fingerprints(table(spark, [(None, "a b"), (None, None)])).collect()
    assert sorted(r["n_chars"] for r in nulls) == [0, 3]


# Jaccard join


def components_of(rows, words=5):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append(frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset())
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            union = sets[i] | sets[j]
            if rows[i][0] == rows[j][0] and sets[i] and sets[j] or union and 100 * len(sets[i] & sets[j]) >= 80 * len(union):
                if sets[i] and sets[j]:
                    group[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return [(d, len(s), None if d is None else least[top(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def test_jaccard_against_brute_force(docs):
    got = [tuple(r) for r in jaccard.linked_components(docs).collect()]
    assert by_text(got) == by_text(components_of(ROWS))


def test_jaccard_of_an_empty_table(empty):
    assert jaccard.linked_components(empty).count() == 0


def test_jaccard_of_chains_and_shared_passages(spark):
    rng, rows = random.Random(5), []
    passage = prose(99, 60)
    for group in range(12):
        base = prose(1000 + group, rng.randint(4, 90)).split()
        for copy in range(9):
            rows.append((len(rows), " ".join(base)))
            for _ in range(rng.randint(0, 2)):  # each copy edits the last, so ends may not link
                base[rng.randrange(len(base))] = f"e{len(rows)}x"
    rows += [(len(rows) + i, f"{passage} {prose(3000 + i, 25)}") for i in range(40)]
    got = [tuple(r) for r in jaccard.linked_components(table(spark, rows)).collect()]
    assert by_text(got) == by_text(components_of(rows))


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(2)
    starts = jaccard.bands((80, 100), 5000)
    for _ in range(400):
        n = int(rng.choice([1, 3, 5, 9, 10, 11, 20, 45, 100, 400, 3000]))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        edits = int(rng.integers(0, n // 9 + 1))
        b = np.unique(np.concatenate([a[: len(a) - edits], rng.integers(0, 1 << 63, int(rng.integers(0, n // 9 + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert len(np.intersect1d(jaccard.signatures(a, (80, 100), starts), jaccard.signatures(b, (80, 100), starts)))


def test_one_document_of_each_group_stays(spark, docs):
    kept = jaccard.keep_one_of_each(spark, docs, "").select("doc_id").collect()
    expected = {d for d, _, c in components_of(ROWS) if d == c and d is not None}
    ids = [r["doc_id"] for r in kept]
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    assert ids.count(None) == 2


def test_clashing_columns_stay_as_they_are(spark):
    rows = [(1, "a b c d e f g", 9, 8, "r", 7), (2, "a b c d e f g", 9, 8, "r", 7), (1, "x", 9, 8, "r", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id int, __turn int, row string, turn int")
    kept = jaccard.keep_one_of_each(spark, docs, "")
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == rows[:1]


def test_of_a_repeated_document_one_row_stays(spark):
    """Document 5 is empty in one row and a copy of 1 in the other; 7 is in a group by its second row only."""
    rows = [(1, "a b c d e f g"), (5, ""), (5, "a b c d e f g"), (6, "p q r s t u v"), (7, "x"), (7, "p q r s t u v"), (9, "y")]
    kept = jaccard.keep_one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a b c d e f g"), (5, ""), (6, "p q r s t u v"), (9, "y")]


def test_few_rows_are_marked_beyond_those_asked_for(spark):
    docs, ids = spark.range(5_000).selectExpr("id doc_id", "'t' text"), spark.range(0, 5_000, 50).selectExpr("id doc_id")
    found = {r["doc_id"] for r in jaccard.marked(docs, ids).where("maybe").collect()}
    assert jaccard.marked(docs, ids).count() == 5_000 and set(range(0, 5_000, 50)) <= found and len(found) < 110


# Byte-level BPE


@pytest.fixture(scope="module")
def multi():
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    import public_tokenizers as public

    path = public.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, public.PATTERN, tiktoken.Encoding("t", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_against_tiktoken(docs, multi):
    path, pattern, reference = multi
    expected = []
    for doc_id, text in ROWS:
        ids = reference.encode_ordinary(text or "")
        ids_text = ",".join(map(str, ids))
        expected.append((
            doc_id, len(ids), hashlib.sha256(ids_text.encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        ))
    got = [tuple(r) for r in bpe.encode_documents(docs, path, pattern).collect()]
    assert by_text(got) == by_text(expected)


def test_bpe_of_random_strings(multi):
    path, pattern, reference = multi
    pairs, rng = bpe.codec(path, pattern), random.Random(8)
    for _ in range(400):
        text = "".join(rng.choices("abcdeinorst  \n\t'.,!09Äßé中\x1c\x85😀", k=rng.choice([3, 30, 200])))
        text += rng.choice(["a", "ab", " ", "=", "the", "ß"]) * rng.choice([0, 5, 90])
        ids = pairs.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert [i for c in bpe.chunks(text) for i in pairs.encode(c)] == ids
        assert pairs.decode(ids) == text.encode()


def test_joining_is_associative(multi):
    path, pattern, _ = multi
    pairs, rng = bpe.codec(path, pattern), random.Random(9)
    for _ in range(200):
        a, b, c = ("".join(rng.choices("etaoinshr", k=rng.randint(0, 25))).encode() for _ in range(3))
        x, y, z = map(pairs.merge, (a, b, c))
        assert pairs.join(pairs.join(x, y), z) == pairs.join(x, pairs.join(y, z)) == pairs.merge(a + b + c)


# Packing


def test_packing_against_the_tokenizer(docs):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers as public

    model = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    expected = []
    for doc_id, text in ROWS:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        at, size, piece = 0, len(ids) % 1024 or 1024, 0
        while at < len(ids):
            part = ids[at : at + size]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            expected.append((doc_id, piece, at, len(part), crc))
            at, size, piece = at + size, 1024, piece + 1
    got = packing.pack_documents(docs).collect()
    assert by_text([tuple(r)[:5] for r in got]) == by_text(expected)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1])
        assert sum(n for _, n in parts) <= 1024
    total = sum(r["length"] for r in got)
    assert len(bins) <= math.ceil(total / 1024) + 1


def test_the_query_gives_special_tokens_their_ids(spark, folder):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers as public

    model = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    literals = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", "  <|endoftext|>  don't", "<|endoftext"]
    rows = ROWS + [(100 + i, t) for i, t in enumerate(literals)]
    docs = table(spark, rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    expected = []
    for doc_id, text in rows:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        at, size, piece = 0, len(ids) % 1024 or 1024, 0
        while at < len(ids):
            part = ids[at : at + size]
            expected.append((doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
            at, size, piece = at + size, 1024, piece + 1
    for got in (packing.op10_packing(spark, folder), packing.pack_stage(spark, docs, folder)):
        assert by_text([tuple(r)[:5] for r in got.collect()]) == by_text(expected)


def test_packing_of_an_empty_table(empty):
    assert packing.pack_documents(empty).count() == 0


def test_fullest_combination_against_all():
    rng = random.Random(4)
    for _ in range(200):
        counts = np.zeros(13, np.int64)
        for _ in range(rng.randint(0, 6)):
            counts[rng.randint(1, 12)] += 1
        room = rng.randint(0, 12)
        items = [n for n in range(13) for _ in range(counts[n])]
        best = max(sum(x) for x in _subsets(items) if sum(x) <= room)
        chosen = packing.fullest(counts, room)
        assert sum(n * k for n, k in chosen) == best
        assert all(k <= counts[n] for n, k in chosen)


def _subsets(items):
    for mask in range(1 << len(items)):
        yield [x for i, x in enumerate(items) if mask >> i & 1]


# Language model


def test_base_score_and_counts_against_brute_force(docs, empty):
    tokens = [words_of(t) + [b""] for _, t in ROWS]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in ROWS]
    counts = collections.Counter(w for own, h in zip(tokens, held) if not h for w in own)
    size = sum(counts.values()) + len(counts) + 1
    expected = [
        (d, h, len(own), sum(counts[w] > 0 for w in own), sum(counts.values()),
         round(sum(math.log10((counts[w] + 1) / size) for w in own), 6))
        for (d, _), h, own in zip(ROWS, held, tokens)
    ]
    got = suffix_tree.score_documents(docs).collect()
    assert by_text([(*tuple(r)[:5], round(r["base_score"], 6)) for r in got]) == by_text(expected)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert suffix_tree.score_documents(empty).count() == 0


def test_unseen_tokens_share_one_mass(spark):
    """A word's share of the tokens, and the spelling, each with its own weight and nothing more."""
    training = [(i, "aa bb aa") for i in range(40) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(40, 400) if zlib.crc32(str(i).encode()) % 7 == 2]
    new = ["", "aa", "ab", "c" * 5000, "aa aa"]
    docs = table(spark, [*training, *zip(held, new)])
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score_documents(docs).collect()}
    tree = suffix_tree.grow_tree(suffix_tree.count_grams(table(spark, training).selectExpr("cast(text as binary) as text")))
    share = {b"aa": 0.5, b"bb": 0.25, b"": 0.25}
    for doc_id, text in zip(held, new):
        spelled = tree.spelled([suffix_tree.normal(text.encode())])
        parts = zip([*text.encode().split(), b""], spelled)
        known = suffix_tree.WORD_SHARE
        expected = sum(
            math.log10(known * share[w] + (1 - known) * 10.0**s) if w in share else math.log10(1 - known) + s
            for w, s in parts
        )
        assert math.isclose(got[doc_id], expected, rel_tol=1e-4)


def test_tree_gives_probabilities_and_uses_the_longest_context():
    texts = [suffix_tree.normal(t) for t in (b"abra cadabra " * 40, b"abc " * 60, b"xyz " * 9)]
    codes = np.concatenate([suffix_tree.gram_codes(np.append(suffix_tree.stream([t])[0], 0)[:-1]) for t in texts])
    levels = []
    for depth in range(suffix_tree.DEPTH + 1):
        values, n = np.unique(codes & np.uint64((1 << 8 * (depth + 1)) - 1), return_counts=True)
        levels.append((values, n))
    tree = suffix_tree.build_tree(levels)
    unseen = 256 - len(np.unique(tree.symbols[tree.symbols < tree.symbols.max()]))
    p = 10.0 ** tree.log10[:-1].astype(float)
    total = p[:, :-1].sum(1) + p[:, -1] * unseen
    assert np.allclose(total, 1, atol=1e-4)
    assert len(tree.child) > 5
    spelled = tree.spelled([suffix_tree.normal(b"abra qqq"), b""])
    assert len(spelled) == 4 and spelled[0] > spelled[1]


def test_grams_in_slices_are_those_of_the_whole(spark, monkeypatch):
    docs = table(spark, [(i, prose(i, 50)) for i in range(30)])
    rows = docs.selectExpr("cast(text as binary) as text")
    whole = np.concatenate([suffix_tree.gram_codes(suffix_tree.stream([suffix_tree.normal(prose(i, 50).encode())])[0]) for i in range(30)])
    expected = dict(zip(*(x.tolist() for x in np.unique(whole, return_counts=True))))
    got = {r["code"]: r["n"] for r in suffix_tree.count_grams(rows).collect()}
    assert got == expected
