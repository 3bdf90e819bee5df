from holdfast.llm import licences as L

from .conftest import SCHEMA, rows_of


def pairs(text):
    w = L.plain_words(text)
    return set(zip(w, w[1:]))


def brute(text):
    """Licences at or above the threshold over all units, by comparing each with every template."""
    text = text or ""
    import re

    paragraphs = re.split(r"\n[ \t\r]*\n", text)
    units = [*text.split("\n"), *[p for p in paragraphs if "\n" in p], *([text] if len(paragraphs) > 1 else [])]
    found, hits = {}, 0
    for unit in units:
        a, hit = pairs(unit), False
        for name, template in L.TEMPLATES:
            b = pairs(template)
            dice = 2 * len(a & b) / (len(a) + len(b)) if a else 0
            if dice >= L.THRESHOLD:
                found[name], hit = max(found.get(name, 0), dice), True
        hits += hit
    return found, hits


def test_against_every_template(spark, edges):
    texts = [t for _, t in L.TEMPLATES]
    texts += ["some words\n" + t + "\nmore words" for _, t in L.TEMPLATES]
    texts += [t.replace(" ", "\n", 7) for _, t in L.TEMPLATES] + [t.upper().replace(" the ", " our ") for _, t in L.TEMPLATES]
    texts += [" ".join(t.split()[: len(t.split()) * k // 10]) for _, t in L.TEMPLATES for k in (5, 6, 7, 8, 9)]
    texts += ["\n\n".join(t for _, t in L.TEMPLATES[:3]), None, "", "license", "x. All rights reserved. " * 50]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    found = L.scan(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        want, hits = brute(texts[r.doc_id])
        best = min(want, key=lambda n: (-want[n], n), default=None)
        assert (r.licence, r.dice, r.licences, r.n_units) == (best, want.get(best), ",".join(sorted(want)), hits), texts[r.doc_id]
    assert {r.licence for r in found if r.doc_id < len(L.TEMPLATES)} == {n for n, _ in L.TEMPLATES}


def test_edges(edges, empty):
    found = L.scan(edges)
    assert found.count() == edges.count() and found.where("licence IS NOT NULL").count() == 0
    assert L.scan(empty).count() == 0


def test_key_words_lose_nothing():
    keys = set(L.key_words())
    for _, text in L.TEMPLATES:
        b = pairs(text)
        free = sum(keys.isdisjoint(x) for x in b)
        assert free < L.THRESHOLD * len(b) / (2 - L.THRESHOLD)
    assert not keys & L.COMMON


def best_windows(text):
    """(licence, place, dice) of the windows at or above the threshold that overlap no better one of their family."""
    w = L.plain_words(text or "")
    grams, best, kept = list(zip(w, w[1:])), {}, []
    for name, template in L.TEMPLATES + L.NOTICES + L.full_texts():
        b = pairs(template)
        length = len(L.plain_words(template)) - 1
        size = min(length, len(grams))
        for at in range(len(grams)):
            window = grams[at : at + length]
            shared = len(b.intersection(window))
            dice = 2 * shared / (shared + size - sum(g in b for g in window) + len(b))
            key = (name.split("-")[0].replace("LGPL", "GPL"), at)
            if dice >= L.THRESHOLD:
                best[key] = min(best.get(key, (0, 0, "", 0)), (-dice, -size, name, at))
    for (kin, _), x in sorted(best.items(), key=lambda item: item[1]):
        if all(kin != k or x[3] >= y[3] - y[1] or y[3] >= x[3] - x[1] for k, y in kept):
            kept.append((kin, x))
    return sorted((x[2], x[3], round(-x[0], 9)) for _, x in kept)


INSIDE = [
    ("Copyright 2020 Foo Inc. All rights reserved.", "Proprietary"),
    ("Released under the MIT License, see LICENSE for details.", "MIT"),
    ("This tool was written last year and is now, as our team agreed, released under the MIT License so that others may read it.", "MIT"),
    ("/*\n * Licensed under the Apache License,\n * Version 2.0.\n */\nint main;", "Apache-2.0"),
]


def test_licences_inside_units(spark):
    short = ["BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT", "Unlicense"]
    full = dict(L.full_texts())
    rows = [*INSIDE, *[(full[k], k) for k in short], *[("Some words before it.\n\n" + full[k] + "\n\nand some after it", k) for k in short]]
    rows += [("Licensed under CC BY 4.0.\nMore, licensed under CC BY-NC 4.0, here and licensed under CC BY-SA 4.0 there.", "CC-BY-4.0")]
    rows += [("all rights reserved copyright x. " * 30, "Proprietary"), ("words of no licence at all", None), (None, None), ("license", None)]
    docs = spark.createDataFrame(rows_of([t for t, _ in rows]), SCHEMA).repartition(3)
    found = L.window_matches(docs).collect()
    whole = {r.doc_id: r for r in L.scan(docs, windows=True).collect()}
    assert len(whole) == len(rows)
    for k, (text, licence) in enumerate(rows):
        got = sorted((r.licence, r.at, round(r.dice, 9)) for r in found if r.doc_id == k)
        assert got == best_windows(text), (k, got)
        assert whole[k].licence == licence and (whole[k].n_units > 0) == (licence is not None), (k, whole[k])


def test_rows_that_share_an_id_keep_apart(spark):
    mit = dict(L.TEMPLATES)["MIT"]
    rows = rows_of([mit, "nothing at all here", mit, "words of no licence"])
    docs = spark.createDataFrame([(7 if k > 1 else None, *r[1:]) for k, r in enumerate(rows)] * 3, SCHEMA)
    for windows in (False, True):
        found = sorted((r.doc_id or 0, r.licence or "", r.dice or 0.0) for r in L.scan(docs, windows=windows).collect())
        assert found == [(0, "", 0.0)] * 3 + [(0, "MIT", 1.0)] * 3 + [(7, "", 0.0)] * 3 + [(7, "MIT", 1.0)] * 3


def test_full_licence_texts(spark):
    rows = L.full_texts()
    docs = spark.createDataFrame(rows_of(["file\n" + t + "\nend" for _, t in rows]), SCHEMA)
    found = {r.doc_id: r for r in L.scan(docs, windows=True).collect()}
    for k, (name, _) in enumerate(rows):
        assert found[k].licence == name, (name, found[k])


def test_windows_add_nothing_to_whole_notices(spark, documents, edges, empty):
    assert sorted(L.scan(documents, windows=True).collect()) == sorted(L.scan(documents).collect())
    assert L.scan(edges, windows=True).count() == edges.count() and L.scan(empty, windows=True).count() == 0
