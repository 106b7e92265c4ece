"""Operators with a trained model: held-out accuracy, and gradients against differences."""

from __future__ import annotations

import inspect
import math
import random
import textwrap
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from replaystats.llm import licenses, lm_score, toxicity
from replaystats.llm.queries import RANKS
from tests.llm.cases import documents, edges, words

LABELS = "doc_id long, toxic int, text string"


def insults(seed, n):
    """Toxic only where an insult meets a group: neither word alone tells."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        text = words(rng, 30, 200) + ["vermin"] * a + ["strangers"] * b
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(a and b), "x"))
    return rows, labels


def test_toxicity_learns_pairs(spark):
    rows, labels = insults(1, 1200)
    docs = documents(spark, rows)
    marked = spark.createDataFrame(labels[:900] + [(5000, 1, None), (7, None, None), (8, 3, None)], LABELS)
    model = toxicity.train(docs, marked, epochs=30)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    right = sum((scores[i] >= 0.5) == bool(y) for i, y, _ in labels[900:])
    assert right >= 0.95 * 300
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in scores.items() if s < 0.5}


def test_toxicity_edges(spark):
    docs = documents(spark, edges())
    none = spark.createDataFrame([], LABELS)
    flat = toxicity.train(docs, none)
    got = toxicity.score(docs, flat).collect()
    assert len(got) == len(edges()) and {r["score"] for r in got} == {0.5}
    one = toxicity.train(docs, spark.createDataFrame([(4, 1, "x")], LABELS))
    assert all(0.5 < r["score"] < 1 for r in toxicity.score(docs, one).collect())
    assert toxicity.score(documents(spark, []), flat).collect() == []


def test_licences(spark):
    plain = [" ".join(words(random.Random(i), 12)) + "." for i in range(200)]
    lines = [
        "Released under the MIT License.",
        "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under the Frobnicate Sample License.",
    ]
    text = "\n".join([plain[0], *lines, plain[1]])
    docs = documents(spark, edges() + [(50, text), (50, text), (51, "\n".join(plain))])
    model = licenses.train(docs)
    got = sorted((r["doc_id"], r["line"], r["family"]) for r in licenses.scan(docs, model).collect())
    want = [(50, i + 1, f) for i, f in enumerate(["mit", "apache-2.0", "gpl-3.0", "cc-by-nc", "unknown"])]
    assert got == sorted(want * 2)
    assert licenses.scan(documents(spark, []), licenses.train(documents(spark, []))).collect() == []


def test_short_and_foreign_notices(spark):
    plain = [" ".join(words(random.Random(i), 12)) + "." for i in range(200)]
    notices = {
        "SPDX-License-Identifier: MIT": "mit",
        "// SPDX-License-Identifier: Apache-2.0": "apache-2.0",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.": "isc",
        "Lizenziert unter der Frobnix-Lizenz.": "unknown",
        "Distribué sous licence Frobnix.": "unknown",
    }
    text = "\n\n".join(x for pair in zip(plain, notices, strict=False) for x in pair)
    model = licenses.train(documents(spark, [(1, "\n".join(plain)), (2, "x" * 5000)]), max_plain=150)
    got = {r["line"]: r["family"] for r in licenses.scan(documents(spark, [(None, text)]), model).collect()}
    assert got == {4 * i + 2: family for i, family in enumerate(notices.values())}


NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
}


def test_wrapped_licences(spark):
    plain = [" ".join(words(random.Random(i), 12)) + "." for i in range(200)]
    rows, want = [], []
    for i, (family, notice) in enumerate(NOTICES.items()):
        for j, width in enumerate((40, 72, 80)):
            wrapped = textwrap.wrap(notice, width)
            assert len(wrapped) > 1
            for k, (before, after) in enumerate((([], []), ([plain[0], ""], ["", plain[1]]), ([plain[2]], [plain[3]]))):
                rows.append((100 * i + 10 * j + k, "\n".join([*before, *wrapped, *after])))
                want.append((rows[-1][0], len(before), len(before) + len(wrapped) - 1, family))
    model = licenses.train(documents(spark, [(1, "\n".join(plain))]))
    got = licenses.scan(documents(spark, rows), model).select("doc_id", "line", "last_line", "family").collect()
    assert sorted(map(tuple, got)) == want


def test_groups_are_judged_like_their_words():
    plain = [" ".join(words(random.Random(i), 12)) + "." for i in range(200)]
    model = licenses.fit(plain)
    lines = [licenses.words_in(x) for x in ["see the", "---", *textwrap.wrap(NOTICES["bsd"], 30), "of the", *plain[:3]]]
    got = licenses.paragraph(model, lines, 0.5, 0.7)
    assert [x[2] for x in got if x[2] != "unknown"] == ["bsd"]
    first, last, family, chance, agreement = next(x for x in got if x[2] == "bsd")
    assert first <= 2 and last >= 1 + len(textwrap.wrap(NOTICES["bsd"], 30)) and chance >= 0.5 and agreement >= 0.7
    assert licenses.paragraph(model, [[]] * 100_000, 0.5, 0.7) == []  # lines without a word cost nothing


def test_licences_without_a_clue_word(spark):
    """Every line is judged by the model, whatever its words."""
    plain = [" ".join(words(random.Random(i), 12)) + "." for i in range(200)]
    lines = ["Released under the Apache 2.0", "Released under MPL 2.0", "Distributed under Apache-2.0", "subject to the terms of the Mozilla MPL", *plain]
    model = licenses.train(documents(spark, [(1, "\n".join(plain))]))
    want = [i for i, line in enumerate(lines) if licenses.CLASSES[model._logits([model.rows(licenses.words_in(line))])[0].argmax()] != licenses.NONE]
    got = {r["line"]: r["family"] for r in licenses.scan(documents(spark, [(1, "\n\n".join(lines))]), model).collect()}
    assert sorted(got) == [2 * i for i in want]
    assert got[0] == "apache-2.0"


def crc(ident):
    return zlib.crc32(("" if ident is None else str(ident)).encode()) % 5


def base(rows):
    lists = [(i, [*(t or "").encode().lower().split(), b" "]) for i, t in rows]
    counts = Counter(w for i, ws in lists if crc(i) != 1 for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, ws in lists:
        score = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        out.append((i, crc(i) == 1, len(ws), sum(counts[w] > 0 for w in ws), total, round(score, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("head", [5, 50_000])
def test_base_scores(spark, head):
    rng = random.Random(2)
    rows = [(i, " ".join(words(rng, rng.randint(0, 60), 80)) + "\nThe END") for i in range(60)] + edges()
    df = lm_score.score(documents(spark, rows), RANKS, P.PATTERN, head=head, epochs=1, max_docs=20)
    got = df.collect()
    assert sorted(((r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in got), key=repr) == base(rows)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_model_beats_base_and_empty_table(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["alpha beta gamma delta"] * rng.randint(5, 20))) for i in range(120)]
    got = lm_score.score(documents(spark, rows), RANKS, P.PATTERN, epochs=10).filter("held_out").collect()
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert lm_score.score(documents(spark, []), RANKS, P.PATTERN).collect() == []


def test_ids_are_counted_as_they_stand(spark):
    rows = [(1, "alpha beta\n\nalpha\n  beta"), (2, "alpha beta\n\nalpha\n  beta"), (3, "\n"), *edges()]
    coder = lm_score.Coder(spark, RANKS, P.PATTERN)
    coded = lm_score.encode(documents(spark, rows).selectExpr("cast(text as binary) as raw"), coder)
    size = coder.get().n_vocab + 1
    want = Counter(i for _, t in rows for i in [*coder.get().encode_ordinary(t or ""), size - 1])
    got = lm_score.id_counts(coded, size)
    assert {int(i): int(got[i]) for i in np.flatnonzero(got)} == want
    assert want[coder.get().encode_single_token(b"\n")] > 0


def test_attention_learns_from_all_texts(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(words(rng, rng.randint(1, 30)))) for i in range(320)]  # more than the 300 of before
    docs = documents(spark, rows + [(900 + i, rows[0][1]) for i in range(160)])  # a third are copies
    coder = lm_score.Coder(spark, RANKS, P.PATTERN)
    coded = lm_score.stage(lm_score.encode(docs.selectExpr("cast(text as binary) as raw"), coder), "ids")
    size = coder.get().n_vocab + 1
    model = lm_score.build(lm_score.id_counts(coded, size), window=8, width=4, entries=30)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    sent = spark.sparkContext.broadcast(model)
    texts = [np.array([*coder.get().encode_ordinary(t), size - 1]) for t in sorted({t for _, t in rows})]
    windows = lm_score.windows_of(texts, 8)
    assert Counter(windows[:, 1:][windows[:, 1:] >= 0].tolist()) == Counter(np.concatenate(texts).tolist())
    seen, grads = lm_score.summed_gradients(coded, sent)
    assert seen == sum(map(len, texts))
    for name, grad in lm_score._gradients(model, windows).items():
        assert np.allclose(grads[name], grad * seen, atol=1e-3), name
    assert 1 < coded.select("bucket").distinct().count() <= lm_score.STEPS


def small_model():
    counts = np.arange(400)[::-1].astype(float)
    model = lm_score.build(counts, window=6, width=4, entries=30)
    rng = np.random.default_rng(1)
    for k, v in model.weights.items():
        model.weights[k] = v.astype(np.float64) + (rng.normal(0, 0.3, v.shape) if k == "head" else 0)
    return model


def test_each_id_is_scored_once():
    model = small_model()
    share = np.zeros(lm_score.CLASSES)
    np.add.at(share, model.group, np.exp(model.share.astype(float)))
    assert np.allclose(share[np.bincount(model.group, minlength=lm_score.CLASSES) > 0], 1, atol=1e-3)
    rng = np.random.default_rng(2)
    for n in (1, 5, 6, 7, 20):
        text = rng.integers(0, 400, n).tolist()
        want, stride = 0.0, 4
        for at, ident in enumerate(text):
            low = 0 if at < 6 else -(-(at - 5) // stride) * stride  # the first window that reaches it
            y = model.logits(np.array([[-1, *text][low : at + 1]]))[0, -1]
            want += y[model.group[ident]] - np.log(np.exp(y).sum()) + model.share[ident]
        assert np.isclose(model.score([text], stride)[0], want, rtol=1e-5)
    assert np.allclose(model.score([[3, 4], [5] * 9], 4), [model.score([[3, 4]], 4)[0], model.score([[5] * 9], 4)[0]])


def test_pairs_share_out_each_class():
    model = small_model()
    rng = np.random.default_rng(8)
    text = rng.integers(200, 212, 3000)
    codes, counts = np.unique((np.concatenate([[-1], text[:-1]]) + 1) * 400 + text, return_counts=True)
    model.pairs = lm_score.Pairs(codes, counts, model.group)
    every = np.arange(400)
    for before in (-1, 200, 207, 3):  # the start of a text, ids that were seen, and one that was not
        share = np.exp(model.pairs.log_share(np.full(400, before), every, model.share))
        mass = np.bincount(model.group, share, lm_score.CLASSES)
        assert np.allclose(mass[np.bincount(model.group, minlength=lm_score.CLASSES) > 0], 1, atol=1e-3)
    plain = small_model()
    y = rng.integers(200, 212, 50).tolist()
    own = sum(model.pairs.log_share(np.array([a]), np.array([b]), model.share[[b]])[0] - model.share[b] for a, b in zip([-1, *y], y, strict=False))
    assert np.isclose(model.score([y], 4)[0] - plain.score([y], 4)[0], own, atol=1e-3) and own > 1


def test_pairs_are_counted_over_all_texts(spark):
    rows = [(1, "alpha beta alpha beta"), (2, "alpha beta alpha beta"), (3, "beta"), *edges()]
    coder = lm_score.Coder(spark, RANKS, P.PATTERN)
    coded = lm_score.encode(documents(spark, rows).selectExpr("cast(text as binary) as raw"), coder)
    size = coder.get().n_vocab + 1
    want = Counter()
    for _, t in rows:
        ids = [-1, *coder.get().encode_ordinary(t or ""), size - 1]
        want.update((a + 1) * size + b for a, b in zip(ids, ids[1:], strict=False))
    for held in (2_000_000, 3):
        codes, counts = lm_score.pair_counts(coded, size, 1 << 20, held)
        assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == want
    codes, counts = lm_score.pair_counts(coded, size, 3)
    assert len(codes) <= 3 and set(counts) <= set(sorted(want.values())[-3:])


def test_pairs_that_are_not_shipped_count_as_well(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(words(rng, rng.randint(1, 40), 30))) for i in range(60)] + edges()
    runs = {}
    for most in (0, 3, 40, 1 << 20):
        df = lm_score.score(documents(spark, rows), RANKS, P.PATTERN, epochs=1, max_docs=5, window=8, stride=4, width=4, pairs=most)
        runs[most] = sorted(((r["doc_id"] is None, r["doc_id"], r["n_tokens"], r["score"]) for r in df.collect()), key=repr)
    for most in (0, 3, 40):
        assert [r[:3] for r in runs[most]] == [r[:3] for r in runs[1 << 20]]
        assert np.allclose([r[3] for r in runs[most]], [r[3] for r in runs[1 << 20]], rtol=1e-5)


def test_open_terms_complete_the_score():
    model, part = small_model(), small_model()
    rng = np.random.default_rng(8)
    text = rng.integers(200, 212, 3000)
    codes, counts = np.unique((np.concatenate([[-1], text[:-1]]) + 1) * 400 + text, return_counts=True)
    model.pairs = whole = lm_score.Pairs(codes, counts, model.group)
    sums = dict(zip(whole.class_codes.tolist(), whole.class_counts.tolist(), strict=True))
    part.pairs = lm_score.Pairs(codes[::3], counts[::3], model.group, sums=(whole.class_codes[::2], whole.class_counts[::2]))
    texts = [rng.integers(198, 212, n).tolist() for n in (1, 30, 0, 7)]
    known, rest = part.score_apart(texts, 4)
    first, pairs = 401 * lm_score.CLASSES, dict(zip(codes.tolist(), counts.tolist(), strict=True))
    for i, terms in enumerate(lm_score.open_terms(len(texts), rest, 400).to_pylist()):
        for t in terms:
            count = sums.get(t["key"], 0) if t["key"] < first else pairs.get(t["key"] - first, 0)
            known[i] += (-1 if t["key"] < first else 1) * t["times"] * math.log(count + lm_score.PAIR_WEIGHT * math.exp(t["share"]))
    assert np.allclose(known, model.score(texts, 4), rtol=1e-5)


def test_default_windows_give_real_context():
    defaults = {k: p.default for k, p in inspect.signature(lm_score.score).parameters.items()}
    window, stride = defaults["window"], defaults["stride"]
    assert window >= 128 and 2 * stride <= window
    model = lm_score.build(np.arange(400)[::-1].astype(float), window, width=4, entries=300)
    rng = np.random.default_rng(7)
    model.weights = {k: v.astype(np.float64) + rng.normal(0, 0.3, v.shape) for k, v in model.weights.items()}
    text = rng.integers(0, 300, 3 * window).tolist()
    last = lambda t: np.subtract(*model.score([t, t[:-1]], stride))
    for end in (window, window + 1, window + stride + 1, 3 * window):  # also the first fresh id of a window
        far = text[:end]
        far[end - stride] = (far[end - stride] + 1) % 300
        assert abs(last(far) - last(text[:end])) > 1e-9


def test_gradients():
    model = small_model()
    rng = np.random.default_rng(4)
    part = rng.integers(0, 400, (5, 7))
    part[:, 0] = -1
    part[2, 4:] = -2

    def loss():
        y = model.logits(np.maximum(part[:, :-1], -1))
        goal = part[:, 1:]
        own = np.take_along_axis(y, model.group[np.maximum(goal, 0)][..., None], 2)[..., 0]
        return ((np.log(np.exp(y).sum(2)) - own) * (goal >= 0)).sum() / (goal >= 0).sum()

    grads = lm_score._gradients(model, part)
    for name, grad in grads.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in grad.shape)
            keep = model.weights[name][at]
            model.weights[name][at] = keep + 1e-5
            up = loss()
            model.weights[name][at] = keep - 1e-5
            down = loss()
            model.weights[name][at] = keep
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-4, name
