import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fixtures import corpus, frame, got
from wattloom.llm import mixing, sharding, toxicity, urls
from wattloom.llm.decontaminate import contamination, cut_spans, drop_contaminated

ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BENCH = "item_id string, text string"


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def item_words(text):
    return ITEM.findall(ascii_lower(text))


def judged(rows, bench):
    windows = defaultdict(set)
    for item, text in bench:
        w = item_words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows[tuple(w[i : i + n])].add(item or "")
    out = {}
    for i, text in rows:
        w, hit, items = item_words(text), set(), set()
        for gram, names in windows.items():
            for s in range(len(w) - len(gram) + 1):
                if tuple(w[s : s + len(gram)]) == gram:
                    hit |= set(range(s, s + len(gram)))
                    items |= names
        out[i] = (i, len(w), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(w))
    return out


def test_contamination_matches_brute_force(spark):
    rows = corpus()
    texts = dict(rows)
    bench = [("b1", texts[2]), ("b10", texts[2]), ("b2", "two words"), ("b3", None), ("b4", ""), (None, texts[20])]
    bench += [("b5", " ".join(texts[45].upper().split())), ("b6", texts[60])]
    want = judged(rows, bench)
    docs, table = frame(spark, rows), spark.createDataFrame(bench, BENCH)
    found = contamination(docs, table).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert {r.doc_id: tuple(r) for r in found} == want and len(found) == len(want)
    kept = drop_contaminated(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, w in want.items() if not w[4]}
    cut = {r.doc_id: r.text for r in cut_spans(docs, table).collect()}
    for i, w in want.items():
        assert len(item_words(cut[i])) == w[1] - w[2]


def test_contamination_in_blocks_and_on_nothing(spark, monkeypatch):
    rows, bench = [(None, "one two three four"), (2, "one two"), (2, "five six")], [("a", "one two"), ("b", "six")]
    docs, table = frame(spark, rows), spark.createDataFrame(bench, BENCH)
    want = [(2, 4, 3, True), (None, 4, 2, True)]
    columns = ("doc_id", "n_words", "n_hit", "contaminated")
    assert got(contamination(docs, table), *columns) == want
    monkeypatch.setattr("wattloom.llm.decontaminate.BROADCAST_WINDOWS", 1)
    assert got(contamination(docs, table), *columns) == want
    assert got(contamination(docs, table.limit(0)), *columns) == [(2, 4, 0, False), (None, 4, 0, False)]
    assert contamination(docs.limit(0), table).count() == 0


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return ascii_lower(host), re.match(r"[^?#]*", rest[len(host) :]).group()


def test_urls_match_brute_force(spark):
    hosts = ["a.com", "B.A.com", "example.org", "en.example.org", "xexample.org", "net", "org", ""]
    paths = ["", "/", "/fr/x", "/de/1?q=/fr/", "/en/1", "/en/2#/es/", "/es/", "?x", "#y/fr/"]
    links = [f"{s}://{h}{p}" for s in ("http", "") for h in hosts for p in paths]
    links += [None, "", "no scheme", "http:/one.com/fr/", "x://y://z.com/fr/"]
    rows = [(i, u, "h") for i, u in enumerate(links + links[:4])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    listed = {h + p for h, p in map(parse, links) if len(h + p) % 3 == 0}
    table = spark.createDataFrame([(k,) for k in [*listed, "elsewhere", None]], "key string")

    def expected(url):
        host, path = parse(url)
        fits = [(len(r), r, v) for v, r in urls.RULES for h, _, p in [r.partition("/")]
                if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        best = max(fits, default=None)
        verdict = best[2] if best else "block" if host + path in listed else "allow"
        return host, path, best[1] if best else None, verdict

    found = {r.page_id: tuple(r)[1:] for r in urls.filter_urls(pages, table).collect()}
    assert found == {i: expected(u) for i, u, _ in rows}
    assert urls.filter_urls(pages.limit(0), table).count() == 0


@pytest.mark.parametrize("limit", [100_000, 40])
def test_cascade_is_exact_over_the_universe(spark, monkeypatch, limit):
    monkeypatch.setattr(urls, "SLICE_KEYS", limit)
    monkeypatch.setattr(urls, "BITS_PER_KEY", 3)  # many false positives, so many levels
    rows = [(i, f"http://host{i}.net/{i % 7}") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = {f"host{i}.net/{i % 7}" for i in range(0, 3000, 11)}
    found = urls.filter_urls(pages, spark.createDataFrame([(k,) for k in listed], "key string"))
    assert {r.page_id for r in found.where("verdict = 'block'").collect()} == set(range(0, 3000, 11))


def test_short_list_over_a_large_universe(spark, monkeypatch):
    """The false positives decide about the slices, so no level grows beyond its bound."""
    monkeypatch.setattr(urls, "SLICE_KEYS", 60)
    sizes, level = [], urls.Level
    monkeypatch.setattr(urls, "Level", lambda m, n, s: (sizes.append((s, m.groupBy("slice").count().agg(F.max("count")).first()[0])), level(m, n, s))[1])
    pages = spark.range(20000).selectExpr("id AS page_id", "concat('http://host', id, '.net/') AS url")
    listed = spark.createDataFrame([(f"host{i}.net/",) for i in (5, 700, 19000)], "key string")
    found = urls.filter_urls(pages, listed)
    assert {r.page_id for r in found.where("verdict = 'block'").collect()} == {5, 700, 19000}
    assert sizes[0][0] >= 4 and max(most for _, most in sizes) < 120


def test_sharding(spark):
    rows = corpus() + [(None, "null id"), (None, None)]
    found = sharding.shard_documents(frame(spark, rows), n_shards=4).collect()
    data = lambda t: (t or "").encode()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len(data(t)) + 1, zlib.crc32(data(t))) for i, t in rows
    )
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(frame(spark, []), n_shards=4).count() == 0


def test_sharding_balances_bytes_and_splits_hot_texts(spark):
    rng = random.Random(4)
    rows = [(i, "hot text " * 20 if i % 3 == 0 else f"{i} " + "y" * rng.randrange(300)) for i in range(6000)]
    found = sharding.shard_documents(frame(spark, rows)).collect()
    load, places = Counter(), defaultdict(set)
    for r in found:
        load[r["shard"]] += r.size
        places[r.text_crc32].add(r["shard"])
    assert len(load) == 8 and max(load.values()) - min(load.values()) < 0.02 * sum(load.values()) / 8
    assert sum(len(p) > 1 for p in places.values()) <= 1
    again = sharding.shard_documents(frame(spark, rows).repartition(7)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_equal_texts_share_a_shard(spark):
    """Copies stay together in small tables, among many rows, and in the cell of a hot text."""
    spread = lambda found: {c for c, s in found.items() if len(s) > 1}

    def places(rows):
        found = defaultdict(set)
        for r in sharding.shard_documents(frame(spark, rows)).collect():
            found[r.text_crc32].add(r["shard"])
        return found

    crc = lambda t: zlib.crc32(t.encode())
    few = [(i, f"{i // 2} " + "z" * 40) for i in range(60)] + [(100 + i, "q" * 3000 + str(i)) for i in range(60)]
    assert not spread(places(few))
    short = [(i, "ab") for i in range(40)] + [(100 + i, "x" * 700 + str(i)) for i in range(600)]
    assert not spread(places(short))
    hot = "hot text " * 20
    texts = spark.range(200_000).select(F.concat(F.lit("t"), "id").alias("t"))
    cell = lambda c: F.pmod(F.xxhash64(F.encode(c, "UTF-8")), F.lit(sharding.CELLS))
    near = [r.t for r in texts.where(cell(F.col("t")) == cell(F.lit(hot))).limit(5).collect()]
    rows = [(i, hot) for i in range(1000)] + [(2000 + i, near[i % len(near)]) for i in range(40)]
    rows += [(5000 + i, f"{i} " + "y" * 150) for i in range(2000)]
    assert near and spread(places(rows)) == {crc(hot)}


def test_a_new_shard_takes_little_from_the_others(spark):
    """With one shard more, texts move, but far fewer than a deal by remainder would move."""
    rng = random.Random(3)
    rows = [(i, "x" * rng.randrange(1, 400) + str(i)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before, after = ({r.doc_id: (r.shard, r.size) for r in sharding.shard_documents(docs, n).collect()} for n in (8, 9))
    total = sum(size for _, size in before.values())
    moved = sum(size for i, (shard, size) in before.items() if after[i][0] != shard)
    to_new = sum(size for i, (_, size) in before.items() if after[i][0] == 8)
    assert abs(to_new / total - 1 / 9) < 0.01
    assert moved < 0.35 * total  # 8 of 9 by remainder; 1 of 9 at least


def sized(rows):
    tokens = Counter()
    for i, text, source in rows:
        tokens[source, i] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return tokens


@pytest.mark.parametrize("target", [{"max_repeats": 2.0}, {"entropy": 1.0}, {"max_repeats": 1.5, "budget": 900}])
def test_mix_keeps_its_budgets(spark, target):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 12), "big" if i % 4 else "small" if i % 3 else None) for i in range(400)]
    rows += [(7, None, "big"), (8, "", "empty"), rows[5], (None, "a b", "big")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = sized(rows)
    totals = Counter()
    for (source, _), n in tokens.items():
        totals[source] += n
    mix = mixing.mix_sources(docs, **target).collect()
    budgets = {
        r.source: r
        for r in mixing.source_budgets(mixing._sized(docs), **target).collect()
    }
    assert abs(sum(b.weight for b in budgets.values()) - 1) < 1e-9
    reads, epochs, seats = Counter(), defaultdict(Counter), defaultdict(list)
    for r in mix:
        assert r.n_tokens == tokens[r.source, r.doc_id]
        reads[r.source] += r.n_tokens
        epochs[r.source, r.epoch][r.doc_id] += 1
        seats[r.source, r.epoch, r.block_rank].append(r.seat)
    for source, b in budgets.items():
        whole = {d for s, d in tokens if s == source}
        for e in range(b.epochs):
            assert epochs[source, e] == Counter(whole)
        most = b.epochs * totals[source] + b.rest
        longest = max(n for (s, _), n in tokens.items() if s == source)
        assert most - longest <= reads[source] <= most
    assert all(sorted(s) == list(range(len(s))) for s in seats.values())
    if "budget" not in target:
        assert all(b.epochs >= 1 for b in budgets.values())
    if "max_repeats" in target:
        often = [b.weight / b.share for b in budgets.values() if b.tokens]
        assert max(often) / min(often) <= target["max_repeats"] + 1e-6
    again = mixing.mix_sources(docs.repartition(5), **target).collect()
    assert sorted(map(repr, mix)) == sorted(map(repr, again))


def test_mixed_documents_keep_columns(spark):
    docs = frame(spark, corpus())
    mixed = mixing.mixed_documents(docs, max_repeats=2.0)
    assert mixed.columns == docs.columns
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in docs.collect()}
    assert mixing.mixed_documents(docs.limit(0), max_repeats=2.0).count() == 0


def brute_reads(totals, max_repeats, budget):
    """How often each source is read, by trying exponents in small steps."""
    whole = sum(totals.values())
    budget = min(budget, max_repeats * whole)
    found = {s: 0.0 for s in totals}
    for step in range(2001):
        a = 1 - step / 2000
        weights = {s: (n / whole) ** a for s, n in totals.items()}
        norm = sum(weights.values())
        reads = {s: weights[s] / norm * budget / n for s, n in totals.items()}
        if max(reads.values()) > max_repeats * (1 + 1e-9) or max(reads.values()) > max_repeats * min(reads.values()) * (1 + 1e-9):
            break
        found = reads
    return found


@pytest.mark.parametrize("budget", [0, 1, 30, 900, 1500, 4000, 100000])
def test_mix_under_a_budget_and_a_limit(spark, budget):
    sizes = {"big": [7] * 100, "small": [5] * 12, "tiny": [4] * 3}
    rows = [(f"{s}{i}", "w " * n, s) for s, ns in sizes.items() for i, n in enumerate(ns)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    mix = mixing.mix_sources(docs, max_repeats=3, budget=budget).collect()
    want = brute_reads({s: sum(ns) for s, ns in sizes.items()}, 3, budget)
    read, often = Counter(), Counter()
    for r in mix:
        assert r.epoch >= 0
        read[r.source] += r.n_tokens
        often[r.doc_id] += 1
    assert sum(read.values()) <= budget and max(often.values(), default=0) <= 3
    for s, ns in sizes.items():
        # Short of the budget by less than a document and the step of the search.
        assert want[s] * sum(ns) * 1.01 + 1 >= read[s] >= want[s] * sum(ns) * 0.99 - max(ns) - 1, s


def test_mixed_documents_with_any_column_names(spark):
    rows = [(i, "a b", f"s{i % 2}", i, i, i) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_copy int, `a.b` int, often int")
    mixed = mixing.mixed_documents(docs, max_repeats=2.0)
    assert mixed.columns == docs.columns
    assert {(r.doc_id, r["a.b"], r.mix_copy) for r in mixed.collect()} == {(i, i, i) for i in range(9)}
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int")
    assert toxicity.drop_toxic(docs, labels.limit(0)).columns == docs.columns
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == 9
