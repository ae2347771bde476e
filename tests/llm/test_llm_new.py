"""Conversation trees, ranked search and whitening against brute force."""

import hashlib
import re
from collections import Counter
from fractions import Fraction
from math import floor, log

import numpy as np
import pytest
from llm_tools import AWKWARD, LONG, SF_DIR, alnum, awkward, empty, listed, table  # noqa: F401
from pyspark.sql import functions as F

import oracle
from tidemark.llm import ranking, whitening
from tidemark.llm.conversations import Codec, Template, conversations_report, format_conversations
from tidemark.llm.conversations import VOCABULARY
from tidemark.llm.portions import portions
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.ranking import rank_documents
from tidemark.llm.whitening import fit_whitening, top_roots, whiten, whitening_report

CHAT = "conv_id long, turn long, role string, text string"
CONTROL = "</s>[INST] ok [/INST] <|im_end|> <\\s> <\\\\/s> \\<s> <|im_start|>x<|im_sep|>"

#: Shared turns at several depths, a conversation that is the beginning of another, copies,
#: ties, nulls and texts that look like marks.
CHATS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hello"), (1, 2, "assistant", "hi"), (1, 3, "user", "more"),
    (2, 0, "system", "be kind"), (2, 1, "user", "hello"), (2, 2, "assistant", "hi"), (2, 3, "user", "less"),
    (3, 0, "system", "be kind"), (3, 1, "user", "hello"), (3, 2, "assistant", "go away"),
    (4, 0, "system", "be kind"), (4, 1, "user", "hello"),
    (5, 0, "system", "be kind"), (5, 1, "user", "hello"), (5, 2, "assistant", "hi"), (5, 3, "user", "more"),
    (6, 5, "user", CONTROL), (6, 2, "assistant", CONTROL), (6, 9, "assistant", ""), (6, 11, "assistant", None),
    (7, None, "user", "last"), (7, 0, None, None), (7, 0, "user", "tie"), (7, 0, "user", "tie"),
    (8, 0, "</s>\n", "odd role"), (8, 1, "assistant", LONG), (8, 2, "assistant", "a" * 9000 + "é\U0001f600" * 5000),
    (None, 0, "user", "nobody's"), (None, 1, "assistant", "answer"),
]


def tie_order(rows, frame):
    """The rows as the operator orders them, ties by Spark's hash."""
    given = frame(rows, CHAT).withColumn("n", F.monotonically_increasing_id())
    order = [F.col("turn").asc_nulls_last(), F.xxhash64(*(F.coalesce(c, F.lit("")) for c in ("role", "text")))]
    by = {}
    for r in given.orderBy(*order).collect():
        by.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    return by


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(by):
    out = []
    for conversation, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((conversation, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss)))
    return sorted(out, key=str)


REPORT = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")


def check_layout(formatted, by):
    """Trees are gapless, and what a conversation's last node attends to is the conversation."""
    nodes = {bytes(r.node): r for r in formatted.nodes.collect()}
    layout = {}
    for r in nodes.values():
        for i, (token, place) in enumerate(zip(r.tokens, r.position_ids)):
            assert (bytes(r.tree), r.begin + i) not in layout
            layout[bytes(r.tree), r.begin + i] = token, place
    sizes = Counter(tree for tree, _ in layout)
    assert all((tree, i) in layout for tree, n in sizes.items() for i in range(n))
    beginnings = {tuple(turns[: k + 1]) for turns in by.values() for k in range(len(turns))}
    assert len(nodes) == len(beginnings)
    paths = {}
    for t in formatted.turns.collect():
        paths.setdefault(t.conversation, {})[t.depth] = bytes(t.node)
    assert {c: len(p) for c, p in paths.items()} == {c: len(turns) for c, turns in by.items()}
    for conversation, path in paths.items():
        for depth, node in path.items():
            own = nodes[node]
            seen = [layout[bytes(own.tree), i] for a in own.attends for i in range(a.first, a.end)]
            whole = [t for d in range(depth) for t in nodes[path[d]].tokens]
            assert [t for t, _ in seen] == whole, (conversation, depth)
            assert [p for _, p in seen] == list(range(len(whole)))
            assert own.position_ids == list(range(len(whole), len(whole) + len(own.tokens)))
            assert own.depth == depth and len(own.attends) <= 1 + np.log2(len(by))
    # Depth first: the tokens of a node's conversations are one interval.
    for node, r in nodes.items():
        below = {n for p in paths.values() for d, n in p.items() if d >= r.depth and p.get(r.depth) == node}
        spans = sorted((nodes[n].begin, nodes[n].begin + len(nodes[n].tokens)) for n in below)
        assert spans[0][0] == r.begin and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_conversations_share_their_beginnings(frame):
    by = tie_order(CHATS, frame)
    formatted = format_conversations(frame(CHATS, CHAT).repartition(5))
    check_layout(formatted, by)
    got = conversations_report(formatted).collect()
    assert sorted((tuple(r[c] for c in REPORT) for r in got), key=str) == expected(by)
    chars = {r.conv_id: r.formatted_chars for r in got}
    marks = Template()
    for conversation, turns in by.items():
        whole = "".join(f"{marks.start}{marks.hide(r)}{marks.separator}{marks.hide(t)}{marks.end}" for r, t in turns)
        assert chars[conversation] == len(whole)
        assert whole.count(marks.start) == whole.count(marks.end) == len(turns)
        assert not any(mark in whole for mark in marks.others)


def test_many_branches_and_a_conversation_over_several_tasks(frame, spark):
    rng = np.random.default_rng(3)
    rows = [(c, t, ("user", "assistant")[t % 2], str(rng.integers(0, 2))) for c in range(60) for t in range(int(rng.integers(1, 9)))]
    rows += [(1000, t, "assistant", f"turn {t}") for t in range(400)]
    rows += [(1001, t, "assistant", f"turn {t}" if t < 350 else "else") for t in range(360)]
    # A chain in which each conversation is a turn longer than the one before.
    rows += [(2000 + c, t, "user", "again") for c in range(20) for t in range(c + 1)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        formatted = format_conversations(frame(rows, CHAT))
        by = tie_order(rows, frame)
        check_layout(formatted, by)
        got = conversations_report(formatted).select(*REPORT).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(tuple, got), key=str) == expected(by)


def test_conversations_of_nothing_and_clashing_columns(frame):
    assert conversations_report(format_conversations(frame([], CHAT))).collect() == []
    clashing = "node string, tree string, begin string, depth string, position string, path string, tokens string"
    rows = [(c, t, r, x, *["x"] * 7) for c, t, r, x in CHATS[:4]]
    formatted = format_conversations(frame(rows, f"{CHAT}, {clashing}"))
    assert len(formatted.nodes.collect()) == 4
    assert [r.n_turns for r in conversations_report(formatted).collect()] == [4]


def test_formatting_of_the_table(spark, table):
    got = QUERIES["op11_chat_formatting"](spark, SF_DIR)
    by = {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in table("conversations").orderBy("conv_id", "turn").collect():
        by.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    assert sorted((tuple(r[c] for c in REPORT) for r in got.collect()), key=str) == expected(by)


@pytest.fixture(scope="session")
def codec():
    with open(VOCABULARY, "rb") as file:
        return Codec(file.read(), Template())


@pytest.mark.parametrize("text", ["", "a", CONTROL, "\\" * 7, "<|im_end|>" * 3, "<\\\\\\s>", " \n " * 5000, "x" * 20_000, LONG])
def test_turns_come_back(codec, text):
    tokens, first, end = codec.turn("user", text)
    assert codec.read(tokens)[:2] == ("user", text)
    assert codec.template.show(codec.decode(tokens[first:end])) == text
    hidden = codec.template.hide(text)
    assert not any(c in hidden for c in codec.template.controls)
    assert [t for t in tokens if t in codec.marks] == codec.marks


@pytest.mark.parametrize("others", [("ab", "ba"), ("abc", "b"), ("a",), ("a\\b",), ("aba",)])
def test_marks_that_cannot_be_escaped_are_refused(others):
    with pytest.raises(ValueError):
        Template(others=others)


def brute_ranking(docs, items, k=10):
    texts = [(i, alnum(t)) for i, t in docs]
    whole = [w for w in texts if w[1]]
    n_docs, total = len(whole), sum(len(w) for _, w in whole)
    df = Counter(t for _, w in whole for t in set(w))
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(alnum(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, w in whole:
            m, tf = 100 - 90 + (90 * len(w) * n_docs) // total, Counter(w)
            score = sum(
                floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in terms if tf[t]
            )
            scored += [(-score, i is None, i or 0, i)] if score > 0 else []
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(out, key=str)


RANKED = ("item_id", "rank", "doc_id", "score")
ITEMS = [
    (1, "quick brown fox"), (2, "one two"), (3, "Der SCHÖNE tag"), (4, "nowhere to be found zzz"), (5, ""), (6, None),
    (7, "one"), (7, "two TWO"), (None, "fox"), (8, LONG), (9, "ünïcödé k"),
]


@pytest.mark.parametrize("small", [False, True])
def test_ranking(frame, awkward, monkeypatch, small):
    if small:  # many tiles, blocks, turns and cuts
        for name, value in (("TILE_ITEMS", 2), ("TILE_DOCS", 3), ("TILE_COLUMNS", 2), ("PENDING", 5)):
            monkeypatch.setattr(ranking, name, value)
    docs = [(i, t) for i, t, *_ in AWKWARD]
    got = rank_documents(awkward, frame(ITEMS, "item_id long, text string"), k=3, broadcast_bytes=200 if small else 1 << 20)
    assert sorted((tuple(r[c] for c in RANKED) for r in got.collect()), key=str) == brute_ranking(docs, ITEMS, 3)


def test_ties_are_cut_by_id(frame):
    rng = np.random.default_rng(5)
    ids = rng.permutation(4000).tolist()
    docs = [(i, ("same words here", "other words", "same")[i % 3 % 2]) for i in ids]
    items = [(1, "same"), (2, "words other")]
    got = rank_documents(frame(docs, "doc_id long, text string").repartition(7), frame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in got.select(*RANKED).collect()), key=str) == brute_ranking(docs, items)


def test_ranking_of_nothing(frame, empty):
    items = frame([("a", "one two")], "item_id string, text string")
    assert rank_documents(empty, items).collect() == []
    no_items = frame([], "item_id string, text string")
    docs = frame([("d", "one two")], "doc_id string, text string")
    assert rank_documents(docs, no_items).collect() == []
    assert listed(rank_documents(docs, items), "item_id", "rank", "doc_id") == [("a", 1, "d")]


def test_partial_sums_stay_exact():
    tile = ranking.Tile([1], np.arange(9), np.zeros(9, int), np.arange(9), np.full(9, 10**9))
    assert [(a, b) for a, b, _ in tile.blocks()] == [(0, 9)]
    tile.weight = np.full(9, 4 * 10**9)
    assert [(a, b) for a, b, _ in tile.blocks()] == [(k, min(k + 2, 9)) for k in range(0, 9, 2)]
    tf, n = np.array([1, 5, 10**9]), np.array([1, 10**9, 10**9])
    exact = [(10**9 * int(t)) // (1000 * int(t) + 8 * (10 + (90 * int(m) * 10**12) // 10**13)) for t, m in zip(tf, n)]
    assert ranking.impacts(tf, n, 10**12, 10**13).tolist() == exact


def test_portions_are_measured(frame):
    rows = [(f"k{i % 40}", i % 40 if i % 40 != 7 else 500) for i in range(400)]
    df = frame(rows, "k string, size long")
    seen = []
    for mine in portions(df, "k", F.col("size"), 1000):
        part = df.filter(mine).collect()
        assert sum(r.size for r in part) <= 1000 or len({r.k for r in part}) == 1
        seen += [tuple(r) for r in part]
    assert sorted(seen) == sorted(rows)


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_ranking_agrees_with_sql(spark, sf_dir):
    assert oracle.mismatch(spark, oracle.connect(sf_dir), "op12_ranked_search", sf_dir) is None
    assert "op12_ranked_search" in ORACLES


def exact_polynomial(matrix):
    """Faddeev and LeVerrier, in whole numbers."""
    d = len(matrix)
    out, m = [1], np.zeros((d, d), object)
    unit = np.diag([1] * d).astype(object)
    for k in range(1, d + 1):
        m = matrix @ m + out[-1] * unit
        out.append(-sum((matrix @ m).diagonal()) // k)
    return out


@pytest.mark.parametrize("d", [1, 2, 3, 7, 20])
def test_characteristic_polynomial(spark, d):
    rng = np.random.default_rng(d)
    a = rng.integers(-(10**6), 10**6, (d, d + 1 if d % 2 else max(1, d - 1))).astype(object)
    matrix = a @ a.T
    got = whitening.characteristic(spark, matrix)
    assert got == exact_polynomial(matrix)
    top = np.linalg.eigvalsh(matrix.astype(float))[::-1][:4]
    assert np.allclose([float(r) for r in top_roots(got, min(4, d))], top, rtol=1e-9, atol=1e-3 * max(1, abs(top[0])) ** 0.5)


def test_repeated_and_close_roots(spark):
    def roots(*diagonal):
        got = top_roots(whitening.characteristic(spark, np.diag(diagonal).astype(object)), len(diagonal))
        top = max(1, *diagonal)
        assert all(abs(a - b) <= top * Fraction(1, 1 << 250) for a, b in zip(got, diagonal))
        return got

    a, b, c, d, e, f = roots(5, 5, 3, 3, 3, 0)
    assert a == b > c == d == e > f == 0
    a, b, _ = roots(10**30 + 1, 10**30, 7)
    assert a > b
    assert roots(0, 0) == [0, 0]


VECTORS = "vec_id long, embedding array<double>"


def brute_whitening(rows):
    usable = [(i, np.floor(256 * np.array(v, float))) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all()]
    unique = np.unique([x for _, x in usable], axis=0)
    n, mean = len(unique), unique.mean(0)
    values, vectors = np.linalg.eigh(np.cov(unique.T, bias=True).reshape(len(mean), -1))
    values, vectors = values[::-1], vectors[:, ::-1]
    return usable, n, unique.sum(0), mean, values, vectors


@pytest.mark.parametrize("d", [1, 3, 16])
def test_whitening(frame, d):
    rng = np.random.default_rng(d)
    rows = [(i, (rng.normal(size=d) * np.arange(1, d + 1)).tolist()) for i in range(80)]
    rows += [(100 + i, rows[i][1]) for i in range(30)] + [(5, rows[5][1])]
    rows += [(200, None), (201, []), (202, [None] * d), (203, [float("nan")] * d), (204, [float("inf")] * d), (None, rows[0][1])]
    df = frame(rows, VECTORS).repartition(3)
    got = whitening_report(whiten(df, fit_whitening(df))).toPandas()
    usable, n, sums, mean, values, vectors = brute_whitening(rows)
    count = min(4, d)
    assert len(got) == len(usable) * count and set(got["n"]) == {n}
    assert got["identity_error"].max() < 1e-9 and got["identity_error"].nunique() == 1
    for k in range(count):
        mine = got[got["component"] == k + 1]
        assert np.allclose(mine["explained"], values[k] / values.sum(), rtol=1e-9)
        want = {i: ((x - mean) @ vectors[:, k] / np.sqrt(values[k]), int(((n * x - sums) ** 2).sum())) for i, x in usable}
        sign = np.sign(mine["whitened"].iloc[0] * want[mine["vec_id"].iloc[0] if mine["vec_id"].iloc[0] == mine["vec_id"].iloc[0] else None][0])
        for r in mine.itertuples():
            value, deviation = want[None if r.vec_id != r.vec_id else r.vec_id]
            assert r.deviation == deviation and np.isclose(sign * r.whitened, value, atol=1e-9)


def test_whitening_without_variance(frame):
    rows = [(1, [1.0, 2.0, 0.5]), (2, [3.0, 2.0, 0.5]), (2, [3.0, 2.0, 0.5]), (3, [5.5, 2.0, 0.5])]
    got = whitening_report(whiten(frame(rows, VECTORS), fit_whitening(frame(rows, VECTORS)))).toPandas()
    assert sorted(got[got["whitened"].notna()]["component"].unique()) == [1] and len(got) == 12
    assert set(got[got["component"] == 1]["explained"]) == {1.0}
    alone = frame(rows[:1], VECTORS)
    one = whitening_report(whiten(alone, fit_whitening(alone))).toPandas()
    assert one["whitened"].isna().all() and one["explained"].isna().all() and set(one["deviation"]) == {0}
    none = frame([], VECTORS)
    assert whitening_report(whiten(none, fit_whitening(none))).collect() == []


def test_equal_variances_give_orthogonal_components(frame):
    square = [[a, b, c] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    df = frame(list(enumerate(square)), VECTORS)
    (model,) = fit_whitening(df)
    ways = np.array(model.directions) * np.sqrt(np.array(model.variances))[:, None]
    assert np.allclose(ways @ ways.T, np.eye(3), atol=1e-12) and model.identity_error < 1e-12


def test_large_and_mixed_vectors(frame):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 0.25]), (3, [1e300, 7.0]), (4, [2.0**50, -3.0])]
    rows += [(10 + i, [float(i), float(i * i), 1.0]) for i in range(5)]
    got = whiten(frame(rows, VECTORS), fit_whitening(frame(rows, VECTORS))).collect()
    by = {r.vec_id: r for r in got}
    assert {r.n for r in got if r.vec_id < 10} == {4} and {r.n for r in got if r.vec_id >= 10} == {5}
    x = [[2**63 - 1, 0], [-(2**63), 64], [2**63 - 1, 1792], [2**58, -768]]
    sums = [sum(c) for c in zip(*x)]
    for i, v in enumerate(x):
        exact = sum((4 * a - s) ** 2 for a, s in zip(v, sums))
        assert by[i + 1].deviation == (exact if exact < 10**38 else None)
    assert all(r.identity_error < 1e-4 for r in got)


def test_sums_of_products_are_exact():
    rng = np.random.default_rng(0)
    for top in (1 << 10, 1 << 30, 1 << 62):
        x = rng.integers(-top, top, (100, 3))
        whole = x.astype(object)
        assert (whitening._products(x) == whole.T @ whole).all()


def test_clashing_columns_are_replaced(frame):
    rows = [(i, [float(i), float(i % 3)], "x", "y", "z") for i in range(6)]
    df = frame(rows, f"{VECTORS}, n string, whitened string, more string")
    got = whiten(df, fit_whitening(df))
    assert got.columns == ["vec_id", "embedding", "more", "n", "deviation", "whitened", "identity_error"]
    assert {r.n for r in got.collect()} == {6}


def test_prime_search():
    some = [p for p, _ in zip(whitening.primes(), range(50))]
    assert some[0] == 2**31 - 1 and all(p % q for p in some for q in range(2, 50_000))
    assert re.fullmatch(r"\d+", str(some[-1]))
