"""Small corpora with the awkward cases: nulls, empties, ties, repeats, long texts, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string, set long, n long, part long"


def prose(rng, n, words=40):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def corpus(seed=1):
    """Rows ``(doc_id, text)``: random texts, exact and near copies, shared passages, edges."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 90), 400) for _ in range(40)]
    texts += texts[:5]
    for base in texts[5:12]:
        words = base.split()
        for _ in range(3):
            edited = list(words)
            edited[rng.randrange(len(edited))] = "edited"
            texts.append(" ".join(edited))
    passage = prose(rng, 60, 500)
    texts += [f"{prose(rng, 30, 500)} {passage}\n{prose(rng, 10, 500)}" for _ in range(6)]
    texts += [passage + " " + passage, "a a a a " * 30, "", "   \n\t ", None, "one", "one", "two words", "Two WORDS"]
    texts += [prose(rng, 3000, 30), "x" * 5000, "é ü ñ " * 12, "\u2028 \x1c " * 15]
    rows = list(enumerate(texts))
    rows += [rows[3], rows[50]]  # repeated rows
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    """The rows with further columns, some of which clash with names the operators use."""
    data = [(i, t, "en", None if i is None or i % 5 == 0 else f"src{i % 3}", None, "x", 1, 2, 3) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
