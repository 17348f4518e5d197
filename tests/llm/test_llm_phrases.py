import random
import re
from collections import Counter

from wattloom.llm import phrases

DOCS = "doc_id long, text string, lang string, n long, phrase string, f double, w int, part int"


def frame(spark, rows):
    """Texts with further columns, some of which clash with names the operator uses."""
    return spark.createDataFrame([(i, t, g, 1, "x", 0.5, 2, 3) for i, (t, g) in enumerate(rows)], DOCS).repartition(3)


def texts(seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(500):
        words = rng.choices(["new", "york", "City", "the", "of", "a", "é", "state", f"w{i}"], k=rng.randrange(60))
        joints = rng.choices([" ", "\t", "  ", ", ", ".", "\n", " ; ", "?!"], weights=[30, 2, 1, 2, 1, 1, 1, 1], k=60)
        rows.append(("".join(w + j for w, j in zip(words, joints)), rng.choice(["en", "en", "fr", None])))
    passage = " ".join(rng.choices([f"p{i}" for i in range(30)], k=80))
    rows += [(f"start{i} {passage} end", "en") for i in range(40)]
    rows += [(None, "en"), ("", "en"), (" .,; ", "fr"), ("one", None), ("the the " * 2000, "de"), ("x" * 3000, "de"), ("lone words", "it")]
    rows += [(". leading", "en"), ("trailing .", "en"), rows[0], rows[0]]  # repeated rows
    return rows


def brute(rows, longest=4, least=30, top=2000):
    f, total = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: n for p, n in counts.items() if 1 < len(p) and n >= least}
        rows = []
        for p, a in candidates.items():
            if any(
                len(q) > len(p) and 100 * n >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, n in candidates.items()
            ):
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_collocations(spark):
    rows = texts()
    want = brute(rows)
    assert {r[0] for r in want} == {"de", "en", "fr", "und"} and len(want) > 50
    assert found(phrases.collocations(frame(spark, rows))) == want


def test_collocations_cut_short_and_longer(spark):
    rows = texts(6)
    assert found(phrases.collocations(frame(spark, rows), longest=5, least=12, top=7, modulus=3)) == brute(rows, 5, 12, 7)
    assert found(phrases.collocations(frame(spark, rows), longest=2, least=20, modulus=1)) == brute(rows, 2, 20)


def test_full_filter_changes_nothing(spark):
    rows = texts()
    dictionary = phrases.parse(frame(spark, rows))
    kept = [sorted((r.lang, r.k, r.phrase, r.f) for r in phrases.frequent_runs(dictionary, bits=b).collect()) for b in (7, 26)]
    assert kept[0] == kept[1] and {k for _, k, _, _ in kept[0]} == {1, 2, 3, 4}


def test_dictionary_puts_the_texts_together(spark):
    """Chunks overlap by three symbols; every word is owned by one chunk."""
    rows = texts()
    dictionary = phrases.parse(frame(spark, rows), modulus=8).collect()
    words = Counter()
    for r in dictionary:
        symbols = r.chunk.split(" ")
        own = symbols if r.final else symbols[:-3]
        assert sum(s != "." for s in own) == r.own
        words.update({(r.lang, s): r.n * n for s, n in Counter(own).items() if s != "."})
    want = Counter()
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        want.update((lang or "und", w) for w in re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", lowered))
    assert words == want
    # The passage of forty documents is in the dictionary once, but for its ends.
    assert max(r.n for r in dictionary if r.chunk.startswith("p")) >= 40


def test_nothing(spark):
    assert found(phrases.collocations(frame(spark, texts()).limit(0))) == []
    assert found(phrases.collocations(frame(spark, [(None, None), ("", "en")]))) == []
