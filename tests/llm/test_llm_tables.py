"""Operators over vectors, urls, sources and shards, and the pipeline, against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_tools import AWKWARD, SF_DIR, alnum, awkward, empty, listed, spaced, table  # noqa: F401
from pyspark.sql import functions as F
from test_llm_words import brute_contamination, brute_groups

import corpus_pipeline
import oracle
from tidemark.llm import embeddings, urls
from tidemark.llm.components import components
from tidemark.llm.embeddings import near_duplicates
from tidemark.llm.mixing import apportion, mix, targets
from tidemark.llm.queries import ORACLES
from tidemark.llm.sharding import pack, shard, shard_report


def brute_components(edges):
    label = {v: v for e in edges for v in e if None not in e}
    for _ in label:
        for a, b in edges:
            if a is not None and b is not None:
                label[a] = label[b] = min(label[a], label[b])
    return sorted((v, c) for v, c in label.items())


@pytest.mark.parametrize(
    "edges",
    [
        [],
        [(1, 1)],
        [(1, None), (2, 3)],
        [(n, n + 1) for n in range(40)],
        [(40 - n, 41 - n) for n in range(0, 40, 2)] + [(50, n) for n in range(60, 90)] + [(60, 41)],
        [(5, 9), (9, 5), (5, 9), (9, 7), (2, 7), (11, 12)],
    ],
)
def test_components(frame, edges):
    got = components(frame(edges, "a long, b long"))
    nodes = [r for r in brute_components(edges) if any(r[0] in e and e[0] != e[1] for e in edges)]
    assert sorted(map(tuple, got.collect())) == nodes


def brute_links(rows, cosine=0.98):
    """By row: links and component."""
    usable = []
    for k, (i, v, label) in enumerate(rows):
        good = v is not None and label is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
        usable.append((k, np.array(v, float), label) if good else None)
    links, label = Counter(), {r[0]: r[0] for r in rows}
    pairs = []
    for a in filter(None, usable):
        for b in filter(None, usable):
            if a[0] < b[0] and a[2] == b[2] and len(a[1]) == len(b[1]):
                if a[1] @ b[1] / (np.linalg.norm(a[1]) * np.linalg.norm(b[1])) >= cosine:
                    pairs.append((a[0], b[0]))
                    links.update((a[0], b[0]))
    for _ in rows:
        for a, b in pairs:
            i, j = rows[a][0], rows[b][0]
            label[i] = label[j] = min(label[i], label[j])
    return sorted((r[0], links[k], label[r[0]], r[0] == label[r[0]]) for k, r in enumerate(rows))


COLUMNS = ("vec_id", "n_links", "component_id", "kept")


def planted(dim, seed):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for group in range(6):
        centre = rng.normal(size=dim)
        for k in range(8):
            noise = rng.normal(size=dim) * (0.02, 0.08, 0.13, 0.2)[k % 4]
            rows.append((1000 - n, (centre + noise).astype(np.float32).tolist(), group % 2))
            n += 1
    for _ in range(60):
        rows.append((1000 - n, rng.normal(size=dim).astype(np.float32).tolist(), n % 2))
        n += 1
    return rows


@pytest.mark.parametrize("dim", [3, 8, 20, 64])
def test_vectors_lose_no_link(frame, dim):
    rows = planted(dim, dim)
    got = near_duplicates(frame(rows, "vec_id long, embedding array<float>, label int"))
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == brute_links(rows)


@pytest.mark.parametrize("dim", [3, 8])
def test_pairs_at_the_threshold_link(frame, dim):
    rng = np.random.default_rng(dim)
    rows = []
    for i in range(200):
        x, y = np.linalg.qr(rng.normal(size=(dim, 2)))[0].T
        c = 0.98 + 2e-10
        rows += [(2 * i, str(i), x.tolist()), (2 * i + 1, str(i), (c * x + np.sqrt(1 - c * c) * y).tolist())]
    found = near_duplicates(frame(rows, "vec_id long, label string, embedding array<double>"))
    assert {r.vec_id: r.n_links for r in found.collect()} == {i: 1 for i in range(400)}


def test_a_radius_beyond_the_probed_cells_is_refused(frame):
    some = frame([(1, "a", [1.0, 0.0])], "vec_id long, label string, embedding array<double>")
    for options in ({"cosine": 0.8}, {"scale": 0.25}):
        with pytest.raises(ValueError, match="lattice"):
            near_duplicates(some, **options)


def test_crowded_cells_are_dealt_into_blocks(frame, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 5)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * 0.14).tolist(), 1) for i in range(60)]
    got = near_duplicates(frame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == brute_links(rows)


def test_vectors_take_awkward_rows(frame):
    nan, inf = float("nan"), float("inf")
    odd = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None),
        (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [None, 1.0], 1),
        (12, [1.0, 0.0, 0.0], 1), (13, [1e30, 0.0], 1), (14, [-1.0, 0.0], 1),
    ]
    schema = "vec_id long, embedding array<float>, label int"
    got = near_duplicates(frame(odd, schema).withColumns({c: F.lit("x") for c in ("rep", "raw", "dim", "cell", "links")}))
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == brute_links(odd)
    no_id = near_duplicates(frame([(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1)], schema))
    assert listed(no_id, *COLUMNS) == [(5, 1, 5, True), (None, 1, None, False)]
    assert near_duplicates(frame([], schema)).collect() == []


def test_every_point_within_the_radius_is_probed():
    """The lattice step by itself: a cell with a point close by is among the probed ones."""
    rng = np.random.default_rng(5)
    shells = embeddings._shells()
    assert len(shells) == 2400
    x = rng.normal(size=(400, 8)) * 1.5
    step = rng.normal(size=(400, 8))
    y = x + step / np.linalg.norm(step, axis=1)[:, None] * 0.24
    cell, other = embeddings._decode(x), embeddings._decode(y)
    assert ((x - cell) ** 2).sum(1).max() <= 1 + 1e-9
    away = other - cell
    moved = np.abs(away).sum(1) > 0
    assert moved.any()
    known = {tuple(s) for s in shells}
    assert all(tuple(a) in known for a in away[moved])
    assert (embeddings._reach(x - other) <= 1 + 0.24 * 2**0.5 + 1e-9).all()


PAGES = [
    (1, "https://www.Example.com/en/1"), (2, "http://a.www.example.com/en/"), (3, "http://example.com/en"),
    (4, "http://blog.example.com/en/x?y#z"), (5, "http://notexample.com/en/1"), (6, "http://x.net/es/1"), (7, "http://net/fr/"),
    (8, "http://x.net/de/"), (9, "http://a.com"), (10, "http://a.com?x=/"), (11, "a.com/en/"), (12, None), (13, ""),
    (14, "://com/"), (15, "http:///en/"), (16, "HTTP://A.COM#/"), (17, "x://y://z.net/es/"), (18, "http://com./"),
    (19, "http://example.com\n/en/1"), (20, "http://ex\n.net/fr/"), (20, "http://ex\n.net/fr/"),
]


def brute_url(url, rules):
    rest = url.partition("://")[2] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
    path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


RESULT = ("page_id", "host", "path", "rule", "verdict")


def test_url_rules(spark, frame):
    pages = frame(PAGES, "page_id long, url string").withColumns({c: F.lit(1) for c in ("rule", "host", "key", "block", "listed")})
    got = urls.filter_urls(pages, spark.createDataFrame(list(urls.RULES), urls.RULE_SCHEMA))
    assert listed(got, *RESULT) == sorted(((i, *brute_url(u, urls.RULES)) for i, u in PAGES), key=lambda r: [(v is None, str(v)) for v in r])


def test_url_cascade_is_exact_over_many_keys(spark, frame):
    hosts = [f"h{i % 50}.d{i}.org" for i in range(3000)]
    pages = [(i, f"http://{h}/{i % 7}/p") for i, h in enumerate(hosts)]
    rules = [(f"d{i}.org", f"/{i % 7}/", "block" if i % 2 else "allow") for i in range(0, 3000, 11)]
    rules += [("d5.org", "/", "allow"), ("d5.org", "/", "block"), (None, "/", "block"), ("", "", "block")]
    got = urls.filter_urls(frame(pages, "page_id long, url string"), spark.createDataFrame(rules, urls.RULE_SCHEMA))
    known = [r for r in rules if r[0]]
    assert sorted(map(tuple, got.select(*RESULT).collect()), key=lambda r: r[0]) == [
        (i, *(("h5.d5.org", "/5/p", "d5.org/", "block") if i == 5 else brute_url(u, known))) for i, u in pages
    ]


def test_urls_without_rules_or_pages(spark, frame):
    none = spark.createDataFrame([], urls.RULE_SCHEMA)
    got = urls.filter_urls(frame(PAGES, "page_id long, url string"), none)
    assert {r.verdict for r in got.collect()} == {"allow"} and got.count() == len(PAGES)
    rules = spark.createDataFrame(list(urls.RULES), urls.RULE_SCHEMA)
    assert urls.filter_urls(frame([], "page_id long, url string"), rules).collect() == []


def brute_targets(size, weights=(1, 2, 3), repeats=3):
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        open_ = [s for s in order if s not in full]
        left = sum(size.values()) - sum(repeats * size[s] for s in full)
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weight[s] > repeats * size[s]}
        if not over:
            return {s: repeats * size[s] if s in full else level * weight[s] for s in order}
        full |= over


@pytest.mark.parametrize(
    "size",
    [{"a": 10}, {"a": 0, None: 0}, {"a": 1, "b": 1000, "c": 5, "Z": 2000, "ä": 3, None: 40}, {f"s{i}": 3**i for i in range(9)}],
)
def test_targets_fill_up_and_share_the_rest(frame, size):
    got = targets(frame([(s, n) for s, n in size.items()], "source string, size long"))
    assert {r.source: r.target for r in got.collect()} == pytest.approx(brute_targets(size))


def brute_seats(shares, seats):
    held = [0] * len(shares)
    for _ in range(seats if sum(shares) else 0):
        best = max(range(len(shares)), key=lambda i: (shares[i] / (2 * held[i] + 1), -i))
        held[best] += 1
    return held


@pytest.mark.parametrize("seed", range(8))
def test_apportionment_is_that_of_the_highest_quotients(frame, seed):
    rng = np.random.default_rng(seed)
    shares = [float(v) for v in (rng.pareto(0.5, 30) * (10 if seed % 2 else 0.3)).round(2)]
    if seed == 4:
        shares = [1.0] * 10
    seats = int(rng.integers(1, 300))
    if seed > 5:  # ties that rounding gives too much, or too little
        shares, seats = [1.0, 2.0, 3.0] * 7, (63 if seed == 6 else 58)
    rows = [(g, i, v, seats) for g in ("x", None) for i, v in enumerate(shares)]
    got = apportion(frame(rows, "g string, i int, share double, seats long"), ("g",), "share", "seats", ("i",))
    for g in ("x", None):
        mine = [r.quota for r in sorted((r for r in got.collect() if r.g == g), key=lambda r: r.i)]
        assert mine == brute_seats(shares, seats)


def check_mix(rows, got, room):
    size = Counter()
    for _, text, source in rows:
        size[source] += len(spaced(text))
    wanted, taken = brute_targets(dict(size)), Counter()
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - wanted[s]) <= room
    assert len(got) == len(rows)


def test_mix_of_a_table(table):
    docs = table("documents")
    first = mix(docs).collect()
    check_mix([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], first, 16)
    assert sorted(map(tuple, first)) == sorted(map(tuple, mix(docs.repartition(7)).collect()))


def test_mix_of_many_shards(table):
    docs = table("documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    check_mix(rows, mix(docs, shard_rows=3, block_words=4).collect(), 40)


def test_mix_takes_awkward_rows(awkward, empty):
    got = mix(awkward).collect()
    check_mix([(r[0], r[1], r[3]) for r in AWKWARD], got, 40)
    assert {r.taken for r in got if r.size == 0} == {0}
    assert mix(empty).collect() == []


def check_shards(rows, got, spread):
    assert len(got) == len(rows)
    size = Counter()
    for r in got:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
        size[r.shard] += r.size
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) - min(size.get(k, 0) for k in range(24)) <= spread


def test_shards_of_a_table(table):
    docs = table("documents")
    got = shard(docs).collect()
    check_shards(docs.collect(), got, max(r.size for r in got))
    again = shard(docs.repartition(5))
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == sorted((r.doc_id, r.shard, r.slot) for r in again.collect())


def test_a_large_group_is_split_and_small_ones_stay_together(frame):
    rows = [(i, "copy " * 20) for i in range(3000)] + [(10_000 + i, f"text {i // 2} " * 10) for i in range(2000)]
    got = shard(frame(rows, "doc_id long, text string")).collect()
    check_shards(rows, got, 8000)
    homes = defaultdict(set)
    for r in got:
        homes[r.text].add(r.shard)
    assert len(homes["copy " * 20]) == 24
    assert sum(len(h) == 1 for t, h in homes.items() if t.startswith("text")) == 1000


def test_shards_take_awkward_rows(awkward, empty):
    got = shard(awkward)
    assert got.columns[-4:] == ["size", "text_crc32", "slot", "shard"]
    check_shards(AWKWARD, got.collect(), 500_000)
    assert shard_report(got).columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert shard(empty).collect() == []


def test_packing_balances_every_dimension():
    rng = np.random.default_rng(3)
    loads = np.column_stack([rng.pareto(1.5, 2000) + 1, rng.random(2000), np.ones(2000)])
    loads = loads[np.argsort(-loads[:, 0])]
    bins = pack(loads, 8, (0.4, 0.3, 0.3))
    sums = np.array([loads[bins == b].sum(0) for b in range(8)])
    assert (sums.max(0) / sums.mean(0) < 1.03).all()


def test_pipeline_stages(spark, table):
    """What the filtering stages keep is known; the mix and the shards keep their promises."""
    docs = table("documents")
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    one = stages["language"](spark, docs, SF_DIR)
    assert one.columns == docs.columns
    assert {r.doc_id for r in one.collect()} == {i for i, r in rows.items() if r.text and any(c.isalpha() for c in r.text)}
    two = stages["near_copies"](spark, one, SF_DIR)
    held = [(r.doc_id, r.text) for r in one.collect()]
    first = {i for i, _, c in brute_groups(held) if i == c}
    assert two.columns == docs.columns and {r.doc_id for r in two.collect()} == first and two.count() == len(first)
    three = stages["benchmark"](spark, two, SF_DIR)
    items = [tuple(r) for r in table("benchmark").select("item_id", "text").collect()]
    clean = {r[0] for r in brute_contamination([(i, rows[i].text) for i in first], items) if not r[-1]}
    assert three.columns == docs.columns and {r.doc_id for r in three.collect()} == clean
    four = stages["mix"](spark, three, SF_DIR)
    times = Counter(r.doc_id for r in four.collect())
    assert four.columns == docs.columns and set(times) <= clean and max(times.values()) <= 3
    mixed = {r.doc_id: r for r in mix(three).collect()}
    assert all(abs(times[i] * r.size - r.taken) <= r.size / 2 for i, r in mixed.items())
    five = stages["shards"](spark, four, SF_DIR)
    check_shards(four.collect(), five.collect(), 25_000)
    run = corpus_pipeline.run(spark, SF_DIR)
    assert Counter(r.doc_id for r in run.collect()) == times


def test_pipeline_takes_awkward_rows(spark, awkward):
    docs = awkward.select("doc_id", "text", "lang", "source")
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert {r.doc_id for r in docs.collect()} <= {1, 7, 8, 9, 11, None}
    nothing = docs.limit(0).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, SF_DIR)
    assert nothing.collect() == []


@pytest.mark.parametrize("lang", [None, "und"])
def test_pipeline_keeps_letters_without_a_language(spark, awkward, lang):
    docs = awkward.select("doc_id", "text", F.lit(lang).cast("string").alias("lang"), "source")
    rows = docs.collect()
    kept = dict(corpus_pipeline.STAGES)["language"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert Counter(kept.collect()) == Counter(r for r in rows if any(c.isalpha() for c in r.text or ""))


def test_words_of_both_kinds_differ():
    assert spaced("A-b c") == ["a-b", "c"] and alnum("A-b c") == ["a", "b", "c"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    assert oracle.mismatch(spark, oracle.connect(SF_DIR), name, SF_DIR) is None
