import hashlib
import random
import zlib

import pytest

from wattloom.llm import chat, convtrie
from wattloom.llm.scan import running

TURNS = "conv_id long, turn long, role string, text string, parts int, pos int, h1 string, k double, n long"


def frame(spark, rows):
    """Turns with further columns, some of which clash with names the operators use."""
    return spark.createDataFrame([(*r, 1, 2, "x", 0.5, 3) for r in rows], TURNS).repartition(3)


def conversations(seed=5):
    """Shared heads, copies, a long conversation, nulls, empty and control texts, repeated rows."""
    rng = random.Random(seed)
    words = ["<|im_end|>", "<|image|>", "\\", "<\\|", "a", "é", "", "\n", "<|im_start|>assistant\nhi", "|>"]
    rows, heads = [], [[("user", "hello"), ("assistant", "hi <|im_end|>"), ("user", ""), ("user", "more")], [("system", "x")]]
    for c in range(60):
        turns = list(rng.choice(heads))[: rng.randrange(5)]
        turns += [(rng.choice(["user", "assistant"]), "".join(rng.choices(words, k=3))) for _ in range(rng.randrange(9))]
        rows += [(c, 10 * i, *t) for i, t in enumerate(turns)]
    rows += [(c, i, "user", f"copy {i}") for c in range(70, 80) for i in range(6)]
    rows += [(90, i, "user" if i % 2 else "assistant", f"turn {i % 7}") for i in range(150)]
    rows += [(91, None, None, "null turn"), (91, 3, "user", None), (91, 3, "user", None), (91, -4, None, None)]
    rows += [(92, 0, "role\nwith\\n|<|", "long " * 20000), (100, 0, "user", "own"), (101, 0, "user", "late"), (-7, 0, "user", "minus")]
    rng.shuffle(rows)
    return rows


def by_conversation(rows):
    found = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        found.setdefault(c, []).append((role or "", text or ""))
    return found


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_running_totals(spark):
    rng = random.Random(2)
    rows = [(1, i, rng.randrange(-50, 50)) for i in range(900)] + [(g, i, g) for g in range(2, 40) for i in range(g % 5)]
    df = spark.createDataFrame(rows, "g long, at long, v long").repartition(5)
    want, sums, xors = [], {}, {}
    for g, i, v in sorted(rows):
        sums[g], xors[g] = sums.get(g, 0) + v, xors.get(g, 0) ^ v
        want.append((g, i, v, sums[g], xors[g]))
    df = df.withColumn("w", df["v"])
    found = running(df, "g", ["at"], sums=["v"], xors=["w"])
    assert found.columns == ["g", "at", "v", "w", "run_v", "run_w"]
    assert sorted(tuple(r) for r in found.drop("w").collect()) == want
    assert running(df.limit(0), "g", ["at"], sums=["v"]).count() == 0


def test_chat_round_trip(spark):
    rows = [*conversations(), (None, 0, "assistant", "nobody's")]
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(frame(spark, rows))).collect()}
    want = by_conversation(rows)
    assert set(found) == set(want)
    for c, turns in want.items():
        learnt = "".join(text for role, text in turns if role == "assistant")
        r = found[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns))), c
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), sha(learnt)), c
        assert r.n_attachments == r.attachment_tokens == 0
    whole = sorted(chat.format_conversations(frame(spark, rows)).where("conv_id = 90").collect(), key=lambda r: r.turn)
    assert found[90].formatted_chars == len("".join(r.formatted for r in whole))
    assert chat.read_turns("".join(r.formatted for r in whole)) == want[90]


def test_chat_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices(["\\", "<", "|", "n", "\n", "im_end", ">", "é"], k=rng.randrange(9)))
        assert "<|" not in chat.escape(text) and chat._unescape_text(chat.escape(text)) == text
        assert "\n" not in chat._escape_role(text) and chat.unescape(chat._escape_role(text)) == text


def test_chat_parts(spark):
    parts = [
        ("text", "see <|image|> ", None, None, None, None, None),
        ("image", None, "a.png", 56, 57, None, None),
        ("audio", None, "b.wav", None, None, 2.01, None),
        None,
        ("document", None, "c.pdf", None, None, None, 3),
        ("video", None, "d.mp4", None, None, None, None),
        (None, " end", None, None, None, None, None),
        ("image", None, None, None, None, None, None),
    ]
    kind = f"conv_id string, turn int, role string, content array<struct<{chat.PART.replace(' ', ':').replace(',:', ',')}>>"
    df = spark.createDataFrame([("x", 1, "assistant", parts), ("x", 2, "user", None), ("x", 3, "user", [])], kind)
    first, second, third = sorted(chat.format_conversations(df, parts="content").collect(), key=lambda r: r.turn)
    body = "see <\\|image|> <|image|><|audio|><|document|><|attachment|> end<|image|>"
    assert first.formatted == f"<|im_start|>assistant\n{body}<|im_end|>\n"
    assert [(a.type, a.ref, a.tokens) for a in first.attachments] == [
        ("image", "a.png", 6), ("audio", "b.wav", 51), ("document", "c.pdf", 3072), ("video", "d.mp4", 1), ("image", None, 256),
    ]
    assert [first.formatted[a.at :].split(">")[0] for a in first.attachments] == [
        "<|image|", "<|audio|", "<|document|", "<|attachment|", "<|image|",
    ]
    assert first.tokens == 6 + 51 + 3072 + 1 + 256
    assert [first.formatted[s.begin : s.end] for s in first.loss] == ["see <\\|image|> ", " end"]
    assert second.formatted == third.formatted == "<|im_start|>user\n<|im_end|>\n" and not second.attachments
    read = chat.read_back(chat.format_conversations(df, parts="content")).collect()[0]
    said = "assistant\nsee <|image|>  end\nuser\n\nuser\n\n"
    assert (read.n_turns, read.turns_sha256, read.n_attachments) == (3, sha(said), 5)
    assert (read.loss_chars, read.loss_sha256) == (len("see <|image|>  end"), sha("see <|image|>  end"))


def test_chat_on_nothing(spark):
    assert chat.read_back(chat.format_conversations(frame(spark, conversations()).limit(0))).count() == 0


def brute_trie(paths):
    """Nodes as the contract states them, from the rebuilt turns of every conversation."""
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, found in members.items():
        subtree = [n for n in members if n[: len(node)] == node]
        childless = [n for n in subtree if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in subtree if n)
        ends = sorted(c for c in found if len(paths[c]) == len(node))
        out.append(
            (
                min(found), len(node), min(members[node[:-1]]) if node else None, len(found),
                sum(1 for m in members if len(m) == len(node) + 1 and m[: len(node)] == node),
                len(childless), saved, sha(",".join(map(str, ends))),
            )
        )
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("block", [1, 3, 4])
def test_prefix_trie(spark, monkeypatch, block):
    monkeypatch.setattr(convtrie, "BLOCK", block)
    rows = [*conversations(), (None, 0, "user", "nobody's")]
    found = convtrie.prefix_trie(frame(spark, rows)).select(*COLUMNS).collect()
    paths = {c: turns for c, turns in by_conversation(rows).items() if c is not None}
    # Turns with equal numbers come in the order of a hash: those of 91 are equal, or empty.
    assert sorted((tuple(r) for r in found), key=repr) == brute_trie(paths)


def test_trie_of_rebuilt_conversations(spark):
    rows = conversations()
    rows = [r for r in rows if r[0] != 0] + [(0, 0, "user", "only"), (0, 1, "user", "two")]
    rows += [(c, 0, "user", "all of it") for c in range(301, 311)]  # the head of their hundred is absent
    own = by_conversation(rows)
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - c % 100 if c >= 0 else c + (-c) % 100  # the remainder has the sign of c
        paths[c] = own.get(base, [])[:h] + turns[h:]
    assert any(not p for p in paths.values())
    numbered = convtrie.numbered_turns(frame(spark, rows))
    found = convtrie.trie_of(convtrie.with_shared_heads(numbered), numbered.select("conv_id")).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_trie(paths)


def test_trie_of_nothing_and_of_turnless(spark):
    nothing = frame(spark, conversations()).limit(0)
    assert convtrie.prefix_trie(nothing).count() == 0
    ids = spark.createDataFrame([(3,), (1,), (3,)], "conv_id long")
    found = convtrie.trie_of(convtrie.numbered_turns(nothing), ids).select(*COLUMNS).collect()
    assert [tuple(r) for r in found] == [(1, 0, None, 2, 0, 1, 0, sha("1,3"))]
