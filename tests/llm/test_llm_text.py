import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from fixtures import SCHEMA, corpus, frame, got, prose
from wattloom.llm import brown, licenses, quality, substrings, toxicity, triejoin
from wattloom.llm.components import components
from wattloom.llm.wordhash import Hasher, chunks


def blank_words(text):
    return (text or "").encode().split()


def test_word_hashes_tell_words_apart():
    texts = [t for _, t in corpus()]
    seen = {}
    for _, _, data, offsets in chunks(pa.array([None if t is None else t.encode() for t in texts], pa.binary())):
        words = Hasher(lower=False).words(data, offsets)
        plain = [w for t in texts for w in blank_words(t)]
        assert [bytes(data[a:b]) for a, b in zip(words.begin, words.end)] == plain
        assert list(np.diff(words.first)) == [len(blank_words(t)) for t in texts]
        for w, h in zip(plain, words.hashes):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(400 + i, 401 + i) for i in range(40)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    want = {n: r for n, r in label.items() if any(a != b and n in (a, b) for a, b in edges)}
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == want and len(found) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def linked(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    links, label = Counter(), list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links[x] += 1
                links[y] += 1
                old, new = label[x], label[y]
                label = [new if v == old else v for v in label]
    least = defaultdict(list)
    for v, (i, _) in zip(label, sets):
        least[v].append(i)
    known = lambda ids: min((i for i in ids if i is not None), default=None)
    return sorted(
        ((i, len(s), known(least[label[x]]) if s else i, links[x]) for x, (i, s) in enumerate(sets)), key=repr
    )


COLUMNS = ("doc_id", "n_shingles", "component_id", "n_links")


def near_copies(seed=5, groups=6, size=25):
    """Groups of edited copies at distances around the threshold, and chains of them."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = prose(rng, rng.randrange(40, 160), 300).split()
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randrange(5)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(50)}"
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("piece", [triejoin.PIECE, 700, 30])
def test_jaccard_components_match_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(triejoin, "PIECE", piece)  # the small one joins blocks in several pieces
    monkeypatch.setattr(triejoin, "CELLS", 4000 if piece == 700 else triejoin.CELLS)
    rows = near_copies() + [(1000 + (i or 0), t) for i, t in corpus()] + [(None, "a lone one with no id"), (None, "one")]
    assert got(triejoin.jaccard_components(frame(spark, rows)), *COLUMNS) == linked(rows)


def test_one_of_each_component_stays(spark):
    docs = frame(spark, near_copies())
    kept = triejoin.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {c for _, _, c, _ in linked(near_copies())}
    assert triejoin.jaccard_components(docs.limit(0)).count() == 0


def test_blocks_of_loose_ties_are_joined_tie_by_tie(spark, monkeypatch):
    """Short texts of few words hang together by runs that mean little, and some are alike."""
    monkeypatch.setattr(triejoin, "PIECE", 40)
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(5, 14), 4)) for i in range(250)]
    units, found = [], triejoin._units
    monkeypatch.setattr(triejoin, "_units", lambda *a: (units.append(found(*a)), units[-1])[1])
    assert got(triejoin.jaccard_components(frame(spark, rows)), *COLUMNS) == linked(rows)
    ways = units[0].selectExpr("block", "inline(units)").groupBy("block").agg({"tie": "count"}).collect()
    assert any(r["count(tie)"] > 100 for r in ways)  # a block with a unit for each tie


def test_trie_join_finds_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.choice(400, 60, replace=False)
    sets = []
    for _ in range(60):
        keep = rng.random(60) > rng.choice([0.02, 0.1, 0.5])
        extra = rng.choice(10_000, rng.integers(0, 8))
        sets.append(np.unique(np.concatenate([base[keep], extra])).astype(np.uint64))
    every = list(range(len(sets)))
    found = {(i, int(q)) for i, qs in triejoin.trie_join(sets, every, every) for q in qs}
    want = {
        (i, j)
        for i in every
        for j in every
        if 100 * len(set(sets[i]) & set(sets[j])) >= 85 * len(set(sets[i]) | set(sets[j]))
    }
    # A set need not be found for itself; the blocks leave that out anyway.
    assert {p for p in found if p[0] != p[1]} == {p for p in want if p[0] != p[1]} and len(want) > 160


def without_repeats(rows, window=20):
    first = {}
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode())))
    for i, text in order:
        w = blank_words(text)
        for s in range(len(w) - window + 1):
            first.setdefault(tuple(w[s : s + window]), (i, text, s))
    out = []
    for i, text in rows:
        w = blank_words(text)
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] != (i, text, s):
                gone |= set(range(s, s + window))
        out.append((i, len(w), len(gone), b" ".join(x for n, x in enumerate(w) if n not in gone)))
    return sorted(out, key=repr)


def test_substring_dedup_matches_brute_force(spark):
    rows = corpus() + near_copies(groups=3, size=8) + [(None, corpus()[0][1] or "x")]
    kept = substrings.remove_repeats(frame(spark, rows)).collect()
    found = sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in kept), key=repr)
    assert found == without_repeats([(i, t) for i, t in rows])
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def lm_counts(rows, held):
    tokens = {}
    for i, text in rows:
        tokens.setdefault(i, []).extend([*(text or "").encode().lower().split(), None])
    counts = Counter(w for i, t in tokens.items() if not held(i) for w in t)
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t))
        for i, t in tokens.items()
    }


def test_lm_counts_and_gain(spark):
    rng = random.Random(9)
    kinds = [[f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]]
    rows = [(i, " ".join(rng.choice(kinds[(j + i) % 2]) for j in range(rng.randrange(5, 60)))) for i in range(200)]
    rows += [(200, None), (201, ""), (202, "unseen words here"), rows[3], (None, "a1 b2")]
    from pyspark.sql import functions as F

    held = lambda i: i is not None and i % 5 == 2
    found = brown.score_documents(frame(spark, rows), F.col("doc_id") % 5 == 2).collect()
    want = lm_counts(rows, held)
    assert len(found) == len(want)
    for r in found:
        n, known, train, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, train)
        assert abs(r.base_score - base) < 1e-6 and math.isfinite(r.score)
    tested = [r for r in found if held(r.doc_id)]
    assert sum(r.score for r in tested) > sum(r.base_score for r in tested)
    nothing = brown.score_documents(frame(spark, rows), F.lit(True)).collect()
    assert all(r.score == 0 and r.base_score == 0 and r.n_known == 0 for r in nothing)
    assert brown.score_documents(frame(spark, []), F.lit(False)).count() == 0


def test_lm_probabilities_sum_to_one(spark):
    """After any text, the next words known, one unseen word per class, and the end share 1."""
    rng = random.Random(5)
    rows = [(i, prose(rng, 30, 25)) for i in range(60)]
    from pyspark.sql import functions as F

    vocabulary = sorted({w for _, t in rows for w in t.split()})
    tests = [(1000 + i, f"w3 {w}") for i, w in enumerate(vocabulary)] + [(2000, "w3")]
    scored = brown.score_documents(frame(spark, rows + tests), F.col("doc_id") >= 1000)
    score = {r.doc_id: r.score for r in scored.collect()}
    start = score[2000]
    # P(w3 w end) / P(w3 end) * P(end | w3) / P(end | w) is P(w | w3); ends vary, so only a bound holds.
    assert all(score[i] < 0 for i, _ in tests) and start > min(score[i] for i, _ in tests[:-1])


def test_lm_shares_sum_to_one(spark, monkeypatch):
    """Classes after any class share 1; the known words of a class and its one unseen word share 1."""
    rng = random.Random(6)
    rows = [(i, f"{prose(rng, 30, 25)} once{i} {'twice' if i % 30 == 0 else ''}") for i in range(60)]
    from pyspark.sql import functions as F

    models, score = [], brown._score
    monkeypatch.setattr(brown, "_score", lambda model: (models.append(model), score(model))[1])
    brown.score_documents(frame(spark, rows), F.col("doc_id") % 5 == 2).collect()
    model = models[0]
    np.testing.assert_allclose((10.0 ** model.transition).sum(axis=1), 1.0)
    counts = Counter(w for i, t in rows if i % 5 != 2 for w in t.split())
    vocabulary = sorted(counts)
    data = np.frombuffer("".join(vocabulary).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(w) for w in vocabulary)])
    units = brown._unit_run(Hasher(lower=True), brown._lower(), model, data, offsets)[1]
    share = 10.0 ** model.unseen
    for w, unit in zip(vocabulary, units):
        c = model.classes[unit]
        share[c] += counts[w] * 10.0 ** model.known[c]
    used = sorted({int(model.classes[u]) for u in units})
    assert len(used) > 5 and 0 not in used
    np.testing.assert_allclose(share[used], 1.0)


def test_exchange_is_the_best_single_move(spark):
    """The likelihood after every possible move of a unit, counted anew."""
    rng = np.random.default_rng(3)
    units, k = 14, 5
    pairs = rng.integers(0, 9, (units, units))
    now = np.append(0, rng.integers(1, k, units - 1))

    def counted(classes):
        n = np.zeros((k, k))
        np.add.at(n, (classes[:, None], classes[None, :]), pairs)
        return n

    after, before = (np.array([np.bincount(now, weights=row, minlength=k) for row in m]) for m in (pairs, pairs.T))
    to = brown.exchange(counted(now), now[1:], after[1:], before[1:], np.diagonal(pairs)[1:].astype(float))
    for u in range(1, units):
        reached = []
        for c in range(1, k):
            changed = now.copy()
            changed[u] = c
            reached.append(brown._likelihood(counted(changed)))
        assert reached[to[u - 1] - 1] >= max(reached) - 1e-6
        n, moved = counted(now), now.copy()
        moved[u] = to[u - 1]
        brown._moved(n, now[u : u + 1], to[u - 1 : u], after[u : u + 1], before[u : u + 1], np.diagonal(pairs)[u : u + 1].astype(float))
        np.testing.assert_allclose(n, counted(moved))


def test_exchange_separates_alternating_words(spark):
    units = [(a, b, 10) for a in range(1, 7) for b in range(1, 7) if (a + b) % 2] + [(0, 1, 3), (2, 0, 3)]
    now, matrix = brown.cluster(spark.createDataFrame(units, "a long, b long, n long"), classes=2, rounds=8)
    assert len({now[u] for u in (1, 3, 5)}) == 1 and len({now[u] for u in (2, 4, 6)}) == 1 and now[1] != now[2]
    assert matrix.sum() == sum(n for _, _, n in units)


def test_every_repeated_word_is_clustered(spark, monkeypatch):
    """3,000 words of the same ending, each rarer than 1 in 2,048 tokens, in two alternating kinds."""
    rng = random.Random(4)
    kinds = [[f"{c}{i}end" for i in range(1500)] for c in "ab"]
    rows = [(i, " ".join(rng.choice(kinds[(i + j) % 2]) for j in range(120))) for i in range(500)]
    from pyspark.sql import functions as F

    models = []
    score = brown._score
    monkeypatch.setattr(brown, "_score", lambda model: (models.append(model), score(model))[1])
    found = brown.score_documents(frame(spark, rows), F.col("doc_id") % 5 == 2).collect()
    counts = Counter(w for i, t in rows if i % 5 != 2 for w in t.split())
    model = models[0]
    assert len(model.unit_hashes) == sum(n >= brown.LEAST for n in counts.values()) > 2500
    hasher = Hasher(lower=True)
    kind = [Counter(), Counter()]
    for side, words in enumerate(kinds):
        for w in words:
            if counts[w] >= brown.LEAST:
                data = np.frombuffer(w.encode(), np.uint8)
                place = np.searchsorted(model.unit_hashes, hasher.words(data, np.array([0, len(data)])).hashes[0])
                kind[side][int(model.classes[place + 2 + len(model.endings)])] += 1
    assert (kind[0] & kind[1]).total() < 0.02 * (kind[0] + kind[1]).total()
    held = [r for r in found if r.doc_id % 5 == 2]
    # Knowing the kind of the next word halves its choices.
    assert sum(r.score - r.base_score for r in held) > 0.6 * math.log10(2) * 120 * len(held)


def rules_by_hand(text):
    t = text or ""
    w = blank_words(t)
    windows = defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i : i + 3])].append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [x for x in t.encode().split(b"\n") if x.split()]
    return (
        len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)
    )


def test_quality_measures_and_votes(spark):
    rng = random.Random(1)
    good = [" ".join(rng.choice(["the", "and", *prose(rng, 8, 900).split()]) for _ in range(150)) for _ in range(80)]
    symbols = [" ".join("#%" + x + "*|" for x in prose(rng, 120, 900).split()) for _ in range(20)]
    rows = list(enumerate(good + symbols)) + [(1000 + i, t) for i, t in corpus()] + [(None, "short")]
    found = quality.quality(frame(spark, rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(((r.doc_id, *(r[n] for n in names)) for r in found), key=repr) == sorted(
        ((i, *rules_by_hand(t)) for i, t in rows), key=repr
    )
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].quality >= 0.5 and not by_id[i].base_failed for i in range(80))
    assert all(by_id[i].quality < 0.5 for i in range(80, 100))
    assert by_id[None].base_failed
    assert quality.quality(frame(spark, [])).count() == 0


def test_em_finds_rule_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.7
    accuracy = np.array([0.95, 0.9, 0.8, 0.6, 0.85])
    right = rng.random((4000, 5)) < accuracy
    votes = np.where(right == truth[:, None], 1, -1) * (rng.random((4000, 5)) < 0.8)
    patterns, place, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior = quality.expectation_maximisation(patterns, counts.astype(float))[place.ravel()]
    assert ((posterior >= 0.5) == truth).mean() > 0.95
    assert len(quality.expectation_maximisation(np.empty((0, 5)), np.empty(0))) == 0


def test_toxic_words_are_found_on_held_out_texts(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        words = prose(rng, rng.randrange(20, 120), 800).split()
        toxic = i % 4 == 0
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["vilebeast", "foulmouth", "scoundrel"]))
        rows.append((i, " ".join(words)))
        labels.append((i, None if i == 1 else int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "y" * 3000), rows[0], (None, "plain")]
    docs = frame(spark, rows)
    marks = spark.createDataFrame(labels + [(None, 1)], "doc_id long, toxic int")
    scored = toxicity.toxicity(docs, marks).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    score = {r.doc_id: r.score for r in scored}
    right = sum((score[i] >= 0.5) == (i % 4 == 0) for i in held)
    assert right >= 0.97 * len(held)
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in score.items() if s < 0.5}
    assert all(r.score == 0 for r in toxicity.toxicity(docs, marks.limit(0)).collect())
    assert toxicity.toxicity(docs.limit(0), marks).count() == 0


def dice_by_hand(text):
    """Every window that begins and ends with a bigram of a template, without any pruning by count."""
    words = re.findall(licenses.WORD, (text or "").encode().lower())
    pairs = list(zip(words, words[1:]))
    found = []
    for name, texts in licenses.TEMPLATES.items():
        for notice in texts:
            known = re.findall(licenses.WORD, notice.encode().lower())
            template = set(zip(known, known[1:]))
            for s in range(len(pairs)):
                if pairs[s] not in template:
                    continue
                seen = set()
                for e in range(s, min(len(pairs), s + 120 * len(template) // 80)):
                    seen.add(pairs[e])
                    dice = 2 * len(seen & template) / (len(seen) + len(template)) if pairs[e] in template else 0.0
                    if dice >= 0.8:
                        found.append((-dice, name, s, e))
    if not found:
        return None, 0.0, 0
    # A place begins where no other window reaches over; windows that only touch are apart.
    places = sum(not any(a < s <= b for _, _, a, b in found) for s in {s for _, _, s, _ in found})
    return min(found)[1], -min(found)[0], places


def test_license_scan_matches_brute_force(spark):
    notices = [t for texts in licenses.TEMPLATES.values() for t in texts]
    rows = corpus() + [(2000 + i, f"some text\n{n.upper()}\nmore text\n\nlast") for i, n in enumerate(notices)]
    rows += [(3000 + i, "\n".join(n.split(", ")) + "\n\nand then") for i, n in enumerate(notices)]
    rows += [(4000, "released under the terms of the mit license"), (4001, notices[3] + "\n" + notices[3]), (None, notices[0])]
    rows += [(4002, f"{notices[0]} {notices[0]} and {notices[9]}"), (4003, notices[1][: len(notices[1]) // 2])]
    found = licenses.scan_licenses(frame(spark, rows))
    assert got(found, "doc_id", "license", "dice", "n_matches") == sorted(
        ((i, *dice_by_hand(t)) for i, t in rows), key=repr
    )
    assert licenses.scan_licenses(frame(spark, [])).count() == 0


def test_licences_in_running_text():
    scanner = licenses.Scanner(licenses.TEMPLATES, 80)
    named = lambda text: scanner.scan(text.encode())[0]
    assert named("Copyright 2020 X. Released under the MIT License.") == "mit"
    assert named("x " * 500 + "we say it is licensed under the\nApache License, version 2.0 " + "y " * 500) == "apache-2.0"
    mit = licenses.TEMPLATES["mit"][-1]
    assert named(mit[:200]) == "mit" and named(mit.replace("copy", "kopie")) == "mit"
    assert named("Copyright (c) X. All rights reserved. " + mit + " Anything else.") == "mit"
    for name, texts in licenses.TEMPLATES.items():
        assert {named(t) for t in texts} == {name}
    assert named("this is free of charge and under the general public") is None


def test_digest_query_hashes_kept_words(spark, tmp_path):
    rows = corpus()
    frame(spark, rows).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    found = substrings.op10_substring_dedup(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=repr) == sorted(
        ((i, n, m, hashlib.sha256(k).hexdigest()) for i, n, m, k in without_repeats(rows)), key=repr
    )


def test_fixture_has_clashing_columns():
    assert {"word", "set", "n", "part"} <= {c.split()[0] for c in SCHEMA.split(", ")}
