"""Operators with trained models: planted rows, defined results, held-out accuracy."""

import random

import numpy as np
import pytest

from tillwork.llm import language, licences, toxicity

EXTRA = ", score double, held_out boolean, source string, lettered string"
SYLLABLES = {
    "aa": "the an er ing on re th ea in st".split(),
    "bb": "ung sch ein ver ich ge pf tz ß ä".split(),
    "cc": "que eau oi ré è la ou ment ç".split(),
}


def prose(lang, seed, n):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame(
        [(i, t, x, 0.5, True, "s", "t") for i, t, x in rows], "doc_id long, text string, lang string" + EXTRA
    )


EMPTY_CASES = [(9001, None, None), (9002, "", "aa"), (9003, "12 34 %%", None), (None, "12", None), (9004, "…" * 5000, "aa")]


# Language


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(1)
    rows = [(i, prose(x, i, rng.randint(3, 300)), x) for i, x in enumerate(rng.choices(list(SYLLABLES), k=400))]
    return table(spark, rows + EMPTY_CASES + rows[:2]).repartition(3).cache()


def test_language_of_held_out_texts(tongues):
    rows = language.identify(tongues, language.train(tongues)).join(tongues.select("doc_id", "lang").distinct(), "doc_id").collect()
    real = [r for r in rows if r["doc_id"] < 9000]
    assert len(real) == 402  # with the repeated rows
    held = [r for r in real if r["held_out"]]
    assert held and np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] >= 9000)


def test_language_without_anything_to_learn(spark, tongues):
    none = table(spark, [(1, "abc def", None), (2, None, "aa")])
    assert {r["lang_pred"] for r in language.identify(none, language.train(none)).collect()} == {"und"}
    nothing = table(spark, [])
    assert language.identify(nothing, language.train(nothing)).count() == 0
    kept = language.drop_unidentified(spark, tongues, "")
    assert kept.columns == tongues.columns and kept.where("doc_id >= 9000 or doc_id is null").count() == 0


def test_tables_give_the_same_sums_as_the_filters():
    rng = np.random.default_rng(0)
    net = language.fit(rng.integers(0, 256, (40, language.WINDOW)).astype(np.uint8), rng.integers(0, 2, 40), ["a", "b"])
    windows = rng.integers(0, 256, (5, language.WINDOW)).astype(np.uint8)
    pooled = []
    for w in language.WIDTHS:
        seen = np.stack([net.embedding[windows[:, i : i + language.WINDOW - w + 1]] for i in range(w)])
        pooled.append(np.einsum("inse,ief->nsf", seen, net.filters[w]).max(1) + net.offsets[w])
    assert np.allclose(np.maximum(np.concatenate(pooled, 1), 0), net.pooled(windows, net.tables()), atol=1e-3)


def test_gradients_against_differences():
    rng = np.random.default_rng(3)
    x, y, weight = rng.integers(0, 9, (6, 30)).astype(np.uint8), rng.integers(0, 2, 6), np.ones(6)
    p = {"e": rng.normal(size=(256, language.EMBEDDING)), "o": rng.normal(size=(language.FILTERS * 3, 2)), "b": np.zeros(2)}
    for w in language.WIDTHS:
        p[f"f{w}"], p[f"c{w}"] = rng.normal(size=(w, language.EMBEDDING, language.FILTERS)), np.zeros(language.FILTERS)

    def loss(q):
        raw = np.concatenate([
            (sum((q["e"] @ q[f"f{w}"][i])[x[:, i : i + 30 - w + 1]] for i in range(w)) + q[f"c{w}"]).max(1)
            for w in language.WIDTHS
        ], 1)
        z = np.maximum(raw, 0) @ q["o"] + q["b"]
        z -= z.max(1, keepdims=True)
        return -(z[np.arange(6), y] - np.log(np.exp(z).sum(1))).mean()

    grads = language.gradients(p, x, y, weight)
    for name, at in (("e", (3, 2)), ("f3", (1, 4, 7)), ("o", (5, 1)), ("b", (0,)), ("c2", (3,))):
        up, down = {k: v.copy() for k, v in p.items()}, {k: v.copy() for k, v in p.items()}
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - grads[name][at]) < 1e-4


# Toxicity


@pytest.fixture(scope="module")
def spoken(spark):
    rng, rows, labels = random.Random(2), [], []
    for i in range(600):
        words = prose("aa", i, rng.randint(5, 200)).split()
        toxic = int(i % 4 == 0)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["villain", "wretch", "scoundrel"]))
        rows.append((i, " ".join(words) + ".", "aa"))
        labels.append((i, toxic, 1))
    labels += [(9001, 1, 0), (9002, 0, 0), (5, None, None), (None, 1, 1), (77777, 1, 1)]
    return table(spark, rows + EMPTY_CASES).cache(), spark.createDataFrame(labels, "doc_id long, toxic int, text int")


def test_toxicity_of_held_out_texts(spoken):
    docs, labels = spoken
    scorer = toxicity.train(docs, labels)
    rows = toxicity.score_documents(docs, scorer).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 9000 and r["toxic"] is not None]
    assert held and all(r["predicted"] == r["toxic"] for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert toxicity.score_documents(docs, scorer).count() == docs.count()


def test_disguised_words_are_restored(spoken):
    docs, labels = spoken
    scorer = toxicity.train(docs, labels)
    restore = scorer.characters.restore
    assert restore("w3lcome")[:3] == "wel" and restore("scoundreeeel") == "scoundrel"
    assert "villain" in {r for w in ("v1lla1n", "vi||ain") for r in toxicity.readings(w, scorer.characters)}
    for text in ("you wretch", "you wr3tch!", "you w r e t c h.", "you $coundrel", "you wretttch"):
        assert scorer.score(text) >= 0.7, text
    for text in ("", "the one", "w e", "a 3 of 5", "12:30"):
        assert scorer.score(text) < 0.7, text


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    model = toxicity.CharacterModel(np.log(rng.dirichlet(np.ones(toxicity.SIZE), (toxicity.SIZE, toxicity.SIZE))).astype(np.float32))

    def cost(letters):
        edged = ["\0", "\0", *letters, "\0"]
        ids = [toxicity.INDEX.get(c, 0) for c in edged]
        return sum(float(model.trigrams[a, b, c]) for a, b, c in zip(ids, ids[1:], ids[2:]))

    for word in ("a1b", "1|x", "aab", "0a-b"):
        paths = [("", 0.0)]
        for k, sign in enumerate(word):
            arcs = [(sign, 0.0)] + ([("", -toxicity.COST_DROPPED_REPEAT)] if k and word[k - 1] == sign else [])
            if not sign.isalpha():
                dropped = toxicity.COST_DROPPED_LEET if sign in toxicity.STANDS_FOR else toxicity.COST_DROPPED_SIGN
                arcs = [(sign, -toxicity.COST_KEPT_SIGN), ("", -dropped)]
                arcs += [(c, -toxicity.COST_LEET) for c in toxicity.STANDS_FOR.get(sign, "")]
            paths = [(p + a, s + c) for p, s in paths for a, c in arcs]
        best = max(s + cost(p) for p, s in paths)
        got = model.viterbi(word)
        assert abs(best - max(s + cost(p) for p, s in paths if p == got)) < 1e-4


def test_toxicity_without_labels(spark, spoken):
    docs, labels = spoken
    scorer = toxicity.train(docs, labels.where("false"))
    assert {r["predicted"] for r in toxicity.score_documents(docs, scorer).collect()} == {0}
    nothing = table(spark, [])
    assert toxicity.score_documents(nothing, toxicity.train(nothing, labels)).count() == 0


def test_the_stage_drops_toxic_rows_only(spark, spoken, folder):
    docs, labels = spoken
    labels.write.parquet(f"{folder}/labels.parquet")
    kept = toxicity.drop_toxic(spark, docs, folder)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert {9001, 9002, 9003, 9004, None} <= ids
    assert not {i for i in range(0, 600, 4)} & ids and {i for i in range(600) if i % 4} <= ids


# Licences


@pytest.fixture(scope="module")
def licensed(spark):
    rows = [(i, prose("aa", i, 30) + "\n" + prose("aa", -i, 10), None) for i in range(200)]
    rows += [(1000 + i, f"{prose('aa', i, 9)}\n{t}\n\n{prose('aa', i, 5)}", f) for i, (f, t) in enumerate(
        (f, t) for f, ts in licences.TEMPLATES.items() for t in ts
    )]
    rows += [(2000, "All roads are reserved for rights of way", None), (2001, "the license plate of the public bus, version 3", None)]
    rows += [(2002, prose("aa", 1, 500) + " Released under the MIT License. " + prose("aa", 2, 500), "mit")]
    return table(spark, rows + [(a, b, None) for a, b, _ in EMPTY_CASES]).cache()


def test_licences_are_found_and_prose_is_left_alone(licensed):
    found = licences.licences(licensed, licences.train(licensed)).join(licensed.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == 200 + sum(map(len, licences.TEMPLATES.values())) + 3 + 4  # the null id joins nothing
    for r in found:
        assert r["families"] == (r["lang"] or ""), r
    assert next(r for r in found if r["doc_id"] == 9001)["n_paragraphs"] == 0
    assert next(r for r in found if r["doc_id"] == 1000)["n_paragraphs"] == 3


def test_licences_of_an_empty_table(spark):
    nothing = table(spark, [])
    assert licences.licences(nothing, licences.train(nothing)).count() == 0


MIT = """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software."""
BSD = """BSD 3-Clause License

Copyright (c) 2020, Jane Doe

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
COMMENTED = "\n".join(f" * {x}" for x in GPL.split("\n"))
DUAL = "Licensed under the MIT License or the Apache License, Version 2.0, at your choice."
AGPL = "This program is licensed under the GNU Affero General Public License, version 3."


@pytest.fixture(scope="module")
def scanner(licensed):
    return licences.train(licensed)


@pytest.mark.parametrize("text, families", [
    (MIT, "mit"), (BSD, "bsd"), (GPL, "gpl"), (COMMENTED, "gpl"), (MIT.replace("\n", "\r\n"), "mit"),
    (DUAL, "apache,mit"), (DUAL.replace(" or ", " or\n"), "apache,mit"), (f"{MIT}\n\n{GPL}", "gpl,mit"),
    ("Licensed under CC BY 4.0 and Licensed under CC BY-SA 4.0.", "cc-by,cc-by-sa"),
    (AGPL, "agpl"), (AGPL.replace("GNU ", "GNU\n"), "agpl"),
    ("This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License.", "cc-by-nc"),
])
def test_wrapped_and_dual_notices(scanner, text, families):
    for whole in (text, f"{prose('aa', 1, 30)}\n\n{text}\n\n{prose('aa', 2, 30)}", f"{prose('aa', 3, 50)}\n{text}"):
        own = licences.scan(whole.encode(), scanner)[1]
        assert ",".join(sorted({x["family"] for x in own if x["confirmed"]})) == families
        assert len({(x["paragraph"], x["family"]) for x in own}) == len(own)


def test_wrapped_notices_are_no_unknown_sample():
    lines = [licences.plain_words(x.encode()) for x in (MIT + "\n\nThe source library is old.").split("\n")]
    free = [b" ".join(x) for x in licences.free_lines(lines)]
    assert b"the source library is old" in free and not any(b"associated documentation" in x for x in free)


@pytest.fixture(scope="module")
def english():
    """A character model of words with 'a' and 'i' among them, and a scorer of three words."""
    text = " ".join(["you are a stupid person", "i am an idiot here", "a loser is a person", "the art of the word"] * 50)
    model = toxicity.CharacterModel.from_counts(toxicity.triple_counts(text))
    return toxicity.Scorer(model, {"stupid": 9.0, "idiot": 9.0, "loser": 9.0}, -5.0)


@pytest.mark.parametrize("text", [
    "you are a s t u p i d person", "a l.o.s.e.r here", "an i d ! o t", "I d-1-0-t", "you i d 1 o t", "s t u p i d !",
    "a s t u p ! d I am", "y o u  a r e  s t u p i d", "you are\ts\tt\tu\tp\ti\td", "s t u u u u p i d",
    "t h e a r t o f t h e w o r d " * 9 + "a s t u p i d p e r s o n",
    "x " * 130 + "s t u p i d  p e r s o n  " + "y " * 130, "l" + "o" * 150 + "ser", "s t u p i d " * 40,
])
def test_spacing_is_in_the_lattice(english, text):
    assert english.score(text) >= 0.7


@pytest.mark.parametrize("text", ["a b c", "1 2 3 4 5", "the a r t of", "* * * * *", "- - - - -", "x | y | z", "*" * 5000, "a " * 400, "a.b" * 999])
def test_other_runs_stay_clean(english, text):
    assert english.score(text) < 0.7
