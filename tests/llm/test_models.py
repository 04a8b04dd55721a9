"""Trained operators and chat formatting: held-out accuracy, brute force, round trips."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import chat_format, langid, license_scan, linear, secret_scan, toxicity


# ------------------------------------------------------------ linear models
def test_ftrl_separates_and_l1_empties_noise():
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(600):
        k = int(rng.integers(3))
        at = np.unique(np.append(rng.integers(3, 50, 6), k))
        rows.append((at, np.ones(len(at))))
        y.append(k)
    w, b = linear.Ftrl(3, 50, l1=2.0).fit(rows, np.array(y)).weights()
    pred = [int((w[:, at] @ x + b).argmax()) for at, x in rows]
    assert np.mean(np.array(pred) == y) > 0.98 and (w[:, 3:] == 0).mean() > 0.8


def test_temperature_softens_sure_mistakes():
    scores = np.array([[9.0, 0.0]] * 8 + [[0.0, 9.0]] * 2)
    assert linear.fit_temperature(scores, np.zeros(10, int)) > 3
    assert linear.fit_temperature(scores[:0], np.zeros(0, int)) == 1.0


# -------------------------------------------------------------- language
def test_language_held_out_accuracy_and_inputs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_held_out_labels_are_not_learned(spark, documents):
    held = langid.held_out(F.col("doc_id"))
    lied = documents.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in langid.train(lied, epochs=1).labels


def test_language_edge_cases(edge, empty):
    got = langid.identify(edge).collect()
    assert len(got) == edge.count()
    for r in got:
        if r.doc_id in (1, 2, 3, 12, 15):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in ("en", "fr")
    left = langid.drop_unidentified(edge)
    assert left.columns == edge.columns and left.filter("text is null or text = ''").count() == 0
    assert langid.identify(empty).count() == 0


def test_ngram_counts_are_those_of_a_loop():
    t = "Ab c1é  "
    u = "  " + re.sub(r"[^\w]|\d|_", " ", t.lower()) + "  "
    n = sum(c != " " for c in u) + sum(not u[i:i + 2].isspace() for i in range(1, len(t) + 2)) + sum(
        u[i + 1] != " " or (u[i] != " " and u[i + 2] != " ") for i in range(1, len(t) + 2))
    c = next(langid.counts_of([t]))
    assert c[1:].sum() == n
    assert (next(langid.counts_of(["zz", t][1:])) == list(langid.counts_of(["zz", t]))[1]).all()


# -------------------------------------------------------------- toxicity
def test_toxicity_on_unseen_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    known = labels.filter("doc_id % 3 <> 0")
    unseen = labels.filter("doc_id % 3 = 0").select("doc_id", F.col("toxic").alias("y"))
    got = toxicity.classify(docs.join(unseen.select("doc_id"), "doc_id").unionByName(
        docs.join(known.select("doc_id"), "doc_id")), known).join(unseen, "doc_id").collect()
    hit = sum(r.toxic and r.y == 1 for r in got)
    assert hit / sum(r.y for r in got) > 0.85
    assert sum(r.toxic and r.y == 0 for r in got) / sum(r.y == 0 for r in got) < 0.01


def test_chain_uses_earlier_categories_and_threshold_fits():
    chain = toxicity.train_chain(["bad idiot"] * 30 + ["fine day"] * 60,
                                 {"insult": np.array([1] * 30 + [0] * 60), "toxic": np.array([1] * 30 + [0] * 60)})
    a, b = chain.predict("you idiot bad"), chain.predict("fine day")
    assert a[1] > chain.threshold > b[1] and a[0] > b[0]
    assert toxicity.best_threshold(np.array([0.9, 0.8, 0.3]), np.array([1, 1, 0])) == pytest.approx(0.55)


def test_kinds_come_from_the_training_rows():
    rng = random.Random(4)
    calm = [" ".join(rng.choices(["river", "stone", "lamp", "green", "walks"], k=6)) for _ in range(200)]
    first = [c + " zork" + rng.choice([" zorka", ""]) for c in calm[:40]]
    second = [c + " blim" + rng.choice([" blimo", ""]) for c in calm[40:60]]
    texts, y = first + second + calm, np.array([1] * 60 + [0] * 200)
    kinds = toxicity.toxic_kinds(texts, y)
    assert [k.sum() for k in kinds] == [40, 20]  # words that no list knows
    assert kinds[0][:40].all() and kinds[1][40:60].all()
    assert [k.sum() for k in toxicity.toxic_kinds(calm[:100], np.arange(100) % 2)] == [0, 0]  # nothing marks them


def test_chain_on_words_that_no_list_knows(spark):
    """Toxic rows of an invented vocabulary, two label columns before the decision."""
    rng = random.Random(6)
    rows = []
    for i in range(600):
        text = " ".join(rng.choices(["river", "stone", "lamp", "green", "walks", "slowly"], k=12))
        bad = i % 5 == 0
        rows.append((i, text + (rng.choice([" zork", " zorka", " blim", " blimo"]) if bad else ""), int(bad), i % 2))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, t, q if i % 7 else None) for i, _, t, q in rows if i % 3],
                                   "doc_id bigint, toxic int, quality int")
    got = toxicity.classify(docs, labels, categories=("quality",))
    assert got.columns == ["doc_id", "p_quality", "p_kind_1", "p_kind_2", "p_toxic", "toxic"]
    assert {r.doc_id for r in got.collect() if r.toxic} == {r[0] for r in rows if r[2]}


def test_batch_of_texts_equals_one_by_one():
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["bad", "idiot", "fine", "day", "sky"], k=rng.randint(0, 5))) for _ in range(90)] + [""]
    y = np.array([int("idiot" in t) for t in texts])
    chain = toxicity.train_chain(texts, {"a": y, "b": y})
    assert np.allclose(chain.predict_all(texts), [chain.predict(t) for t in texts], atol=1e-12)
    assert chain.predict_all([]).shape == (0, 2)


def test_toxicity_edge_cases(spark, edge, empty):
    labels = spark.createDataFrame([(6, 1, 1), (7, 0, 0), (None, 0, 1), (9, 0, None), (6, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    got = toxicity.classify(edge, labels)
    assert got.count() == edge.count() and got.filter("p_toxic is null or p_toxic not between 0 and 1").count() == 0
    assert toxicity.classify(edge, labels.limit(0)).filter("toxic").count() == 0  # nothing to learn from
    assert toxicity.classify(empty, labels).count() == 0


# --------------------------------------------------------------- secrets
def brute_base(text):
    assign = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|"""
                        r"""(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secret_scan.KINDS[k], a, b) for a, k, b in sorted(out)]


def test_base_spans_by_brute_force():
    rng = random.Random(2)
    parts = ["password", "PassWD", "secret", "to\u212aen", "token", "api_key", "APIKEY", "=", ":", " ", "'", '"', "abcdef",
             "abc", "AKIA", "ABCDEFGH1234", "deadbeef", "0123456789abcdef", "é", "\n", "ſecret", "-", "İ"]
    for _ in range(4000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert [s[:3] for s in secret_scan.base_spans(t)] == brute_base(t), repr(t)


@pytest.fixture(scope="module")
def field(spark):
    return secret_scan.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_stretches_give_the_same_tags_as_whole_viterbi(field, documents):
    scanner = secret_scan.Scanner(field)
    texts = [r.text for r in documents.limit(60).collect()] + [
        "key AbCd1234EfGh5678IjKl9012 then", "token = 9f8e7d6c5b4a39281706f5e4d3c2b1a0 and more", "x"]
    for t in texts:
        types = scanner.types.of(secret_scan.TOKEN.findall(t))
        if not len(types):
            continue
        got = np.zeros(len(types), np.int64)
        for at, tags in scanner.tags(types, secret_scan.text_features(t)):
            got[at:at + len(tags)] = tags
        unary = sum(table[secret_scan._neighbour(types, r)] for table, r in zip(scanner.tables, secret_scan.ROLES))
        assert (got == field.viterbi(unary + secret_scan.text_features(t) @ field.text)).all()


def test_field_finds_secrets_of_rows_it_has_not_seen(spark, field):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").orderBy(F.xxhash64("doc_id").desc()).limit(4000)
    scanner, hit, total = secret_scan.Scanner(field), 0, 0
    for r in docs.collect():
        base = secret_scan.base_spans(r.text)
        if not base:
            continue
        tokens = list(secret_scan.TOKEN.finditer(r.text))
        types = scanner.types.of([m[0] for m in tokens])
        marked = [m.span() for at, tags in scanner.tags(types, secret_scan.text_features(r.text))
                  for m, tag in zip(tokens[at:at + len(tags)], tags) if tag]
        total += len(base)
        hit += sum(any(a < e and s < b for a, b in marked) for _, _, e, s in base)
    assert total > 20 and hit / total > 0.8


def test_field_finds_secrets_that_no_pattern_knows(spark, field):
    """Secrets of other forms in prose of the corpus, and none where there is none."""
    rng = random.Random(11)
    some = lambda chars, n: "".join(rng.choices(chars, k=n))
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    forms = [lambda: "ghp_" + some(alnum, 36), lambda: "Authorization: Bearer " + some(alnum, 24) + "." + some(alnum, 30),
             lambda: "sk_live_" + some(alnum, 24), lambda: "DB_PASS: " + some(alnum, 14),
             lambda: "MII" + some(alnum + "+/", 61), lambda: f"xoxb-{rng.randrange(10**11)}-" + some(alnum, 24),
             lambda: some(alnum + "+/", 40), lambda: "credential = " + some(alnum, 16)]
    scanner = secret_scan.Scanner(field)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("length(text) > 300").orderBy(
        F.xxhash64("doc_id").desc()).limit(800).collect()
    hit = total = false = 0
    for i, r in enumerate(docs):
        words = r.text.split(" ")
        plain = scanner.spans(r.text)
        false += any(k == "crf" for k, _, _ in plain)
        at = rng.randrange(1, len(words)) if len(words) > 1 else 0
        secret = forms[i % len(forms)]()
        before = " ".join(words[:at]) + " "
        end = len(before) + len(secret)
        got = scanner.spans(before + secret + " " + " ".join(words[at:]))
        total += 1
        hit += any(a < end and end - 8 < b for _, a, b in got)  # reaches the secret's own end
    assert total > 500 and hit / total >= 0.9 and false / total < 0.01


def test_scan_edge_cases(edge, empty, field):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.base_sha256, r.n_assign, r.n_access, r.n_hex)
                 for r in secret_scan.report(edge, field).collect())
    want = []
    for r in edge.collect():
        spans = brute_base(r.text or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((r.doc_id is None, r.doc_id or 0, hashlib.sha256(text.encode()).hexdigest(),
                     *[sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]))
    assert got == sorted(want)
    assert secret_scan.report(empty).count() == 0
    assert secret_scan.report(edge.filter("doc_id = 4")).count() == 1  # nothing to learn from


# --------------------------------------------------------------- licences
@pytest.fixture(scope="module")
def licences(spark):
    return license_scan.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_licence_lines_of_the_corpus(spark, licences):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    want = (F.when(F.col("text").contains("Released under the MIT License"), "mit")
            .when(F.col("text").contains("Licensed under CC BY-NC 4.0"), "cc-by-nc")
            .when(F.col("text").contains("Apache License, Version 2.0"), "apache-2.0")
            .when(F.col("text").contains("GNU General Public License"), "gpl")
            .when(F.col("text").contains("All rights reserved."), "proprietary"))
    got = license_scan.scan(docs, licences).join(docs.select("doc_id", want.alias("want")), "doc_id")
    assert got.filter("want is not null").count() > 200
    assert got.filter("not (license <=> want)").count() == 0


def test_licence_families_and_near_misses(spark, licences):
    rows = [(i, "ab cd ef\n" + t + "\nxy", f) for i, (f, t) in enumerate((f, t) for f in license_scan.NOTICES
                                                                        for t in license_scan.NOTICES[f])]
    rows += [(1000, "The license plate of the car was under the snow.", None), (1001, "a general public hearing", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, want string")
    got = license_scan.scan(df, licences).join(df, "doc_id").collect()
    assert sum(r.license == r.want for r in got) / len(got) > 0.9
    assert all(r.license is None for r in got if r.want is None)
    assert all(m.line == 1 for r in got if r.want for m in r.matches)  # not the words around it
    assert not any(m.confirmed for r in got if r.want is None for m in r.matches)


def test_every_kind_of_licence_line_of_the_corpus(spark, licences):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    kinds = {"Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
             "Licensed under the Apache License, Version 2.0.": "apache-2.0", "All rights reserved.": "proprietary",
             "This work is licensed under the GNU General Public License, version 3.": "gpl"}
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line").isin(list(kinds)))
    want = {r.doc_id: kinds[r.line] for r in lines.collect()}
    got = {r.doc_id: r.license for r in license_scan.scan(docs, licences).filter("license is not null").collect()}
    assert got == want and set(want.values()) == set(kinds.values())


def test_rights_reserved(spark, licences):
    rows = [(1, "Copyright 2020 Someone. All rights reserved.", "proprietary"), (2, "He reserved all rights of way.", None),
            (3, "All rights reserved.\nReleased under the BSD License.", "bsd")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, want string")
    got = license_scan.scan(df, licences).join(df, "doc_id").collect()
    assert {r.doc_id: r.license for r in got} == {r.doc_id: r.want for r in got}
    unknown = len(license_scan.FAMILIES) - 1
    taken = license_scan.training_rows(df.limit(1).withColumn("text", F.lit("All rights reserved.")), 100)
    assert taken.filter(F.col("label") == unknown).count() == 0


WRAPPED = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights""",
    "bsd": """Copyright (c) 2009, Someone.
All rights reserved.
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:""",
    "gpl": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or"""}


def test_wrapped_notices(spark, licences):
    rows = []
    for family, text in WRAPPED.items():
        for mark in ("", "# ", " * ", "// "):
            marked = "\n".join(mark + x for x in text.split("\n"))
            rows.append((len(rows), f"{mark}first words\n{mark.rstrip()}\n{marked}\n{mark.rstrip()}\nlast words", family))
    first, rest = WRAPPED["mit"].split("\n", 1)
    rows += [(100, f"{first}\n\n{rest}"[:140], None), (101, "we all have\nrights and some\nare reserved", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, want string")
    got = license_scan.scan(df, licences).join(df, "doc_id").collect()
    assert {r.doc_id: r.license for r in got} == {r.doc_id: r.want for r in got}
    assert all([(m.line, m.last) for m in r.matches if m.confirmed and m.family == r.want]
               == [(2, 2 + WRAPPED[r.want].count("\n"))] for r in got if r.want)


def test_licence_edge_cases_and_plan(edge, empty, licences):
    got = license_scan.scan(edge, licences)
    assert got.count() == edge.count()
    assert {r.doc_id: r.license for r in got.collect() if r.license} == {16: "mit"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange hashpartitioning" not in plan
    assert license_scan.scan(empty).count() == 0


# ------------------------------------------------------------------ chats
def plain_digest(rows):
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return (len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


CHATS = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] \\ ok \\[/INST] <s> <\\s>"), (1, 2, "assistant", ""),
         (2, 1, "assistant", "second"), (2, 0, None, None), (2, 1, "assistant", "second"), (3, None, "user", "x" * 20000),
         (None, 0, "user", "[INST]"), (None, 1, "assistant", "[/"), (4, 0, "us[INST]er", "\\"), (4, 1, "assistant", "\n")]


def test_chats_read_back(spark):
    df = spark.createDataFrame(CHATS, "conv_id bigint, turn bigint, role string, text string").withColumn("spans", F.lit(1))
    formatted = chat_format.format_chats(df)
    got = {r.conv_id: tuple(r)[1:5] for r in chat_format.digests(formatted).collect()}
    want = {}
    for c in {c for c, *_ in CHATS}:
        rows = sorted([(t is not None, t or 0, r or "", x or "") for i, t, r, x in CHATS if i == c])
        want[c] = plain_digest([(r, x) for _, _, r, x in rows])
    assert got == want
    assert all(r.rewritten is None for r in formatted.collect())
    assert chat_format.digests(chat_format.format_chats(df.limit(0))).count() == 0


def test_escape_is_reversible():
    rng = random.Random(9)
    parts = ["\\", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<", "s>", "/", "INST]", "a", "[", "\n"]
    for _ in range(5000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 10)))
        e = chat_format.escape(t)
        assert chat_format.unescape(e) == t and not any(c in e for c in chat_format.CONTROLS)


def test_a_template_that_rewrites_history_is_reported():
    def last_only(turns):  # drops earlier assistant texts, as some templates drop old reasoning
        return "".join(f"|{r}:{t if i == len(turns) - 1 or r == 'user' else ''}" for i, (r, t) in enumerate(turns))

    turns = [("user", "a"), ("assistant", "bb"), ("user", "c"), ("assistant", "dd")]
    text, spans, rewritten = chat_format.locate(turns, last_only)
    assert rewritten == 2 and text == last_only(turns)
    assert text[spans[3]["text_start"]:spans[3]["text_end"]] == "dd"
    _, _, none = chat_format.locate(turns, chat_format.marked)
    assert none is None
