"""Large groups and templates in the n-gram join, repeated ids and dense cells of vectors."""

import numpy as np
import pytest
from llm_tools import SF_DIR, listed
from test_llm_words import brute_groups, near_copies

import __spark_entry__ as entry
from tidemark.files import Files
from tidemark.llm import embeddings, jaccard
from tidemark.llm.embeddings import near_duplicates
from tidemark.llm.jaccard import jaccard_groups

TEXTS = "doc_id long, text string"


def grouped(frame, rows):
    found = jaccard_groups(frame(rows, TEXTS).repartition(3))
    return sorted(listed(found, "doc_id", "n_shingles", "component_id"))


def template_pages(count, own, copies=1):
    template = [f"site{i}" for i in range(86)]
    pages = [" ".join([*(f"p{n}w{k}" for k in range(own)), *template]) for n in range(count)]
    return [(c * count + n, page) for c in range(copies) for n, page in enumerate(pages)]


@pytest.mark.parametrize("own, copies", [(20, 1), (14, 1), (14, 2), (6, 1)])
def test_pages_of_a_template_are_not_all_compared(frame, monkeypatch, own, copies):
    kept = []
    may_link = jaccard._may_link

    def counted(*given):  # what it reads goes when the operator ends
        edges = may_link(*given)
        kept.append(edges.distinct().count())
        return edges

    monkeypatch.setattr(jaccard, "_may_link", counted)
    rows = template_pages(40, own, copies)
    assert grouped(frame, rows) == brute_groups(rows)
    assert kept == [39 if own == 6 else 0]


@pytest.mark.parametrize("block_rows, seed", [(2, 0), (5, 1), (512, 2)])
def test_groups_of_all_shapes(frame, monkeypatch, block_rows, seed):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(seed)
    rows = near_copies() if seed == 0 else []
    for group in range(4):
        base = [f"g{group}w{i}" for i in range(int(rng.integers(20, 70)))]
        for n in range(int(rng.integers(3, 25))):
            words = list(base)
            for _ in range(int(rng.integers(0, 6))):
                words[int(rng.integers(0, len(words)))] = f"x{rng.integers(0, 40)}"
            first = int(rng.integers(0, len(words) // 3))
            base = words if rng.random() < 0.3 else base  # chains
            rows.append((1000 + 100 * group + n, " ".join(words[first:])))
    assert grouped(frame, rows) == brute_groups(rows)


@pytest.mark.parametrize("block_bytes", [1, 40, 6 << 20])
def test_any_number_of_column_blocks(frame, monkeypatch, block_bytes):
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", block_bytes)
    rows = near_copies() + template_pages(6, 20)
    if block_bytes == 1:  # more than 2^16 blocks
        rows.append((9999, " ".join(f"long{i}" for i in range(9000))))
    assert grouped(frame, rows) == brute_groups(rows)


def brute_rows(rows, cosine=0.98):
    """Links and component by row, not by id."""
    unit = [np.array(v, float) / np.linalg.norm(v) for _, v, _ in rows]
    near = [[a != b and rows[a][2] == rows[b][2] and unit[a] @ unit[b] >= cosine for b in range(len(rows))] for a in range(len(rows))]
    label = [r[0] for r in rows]
    for _ in rows:
        label = [min([label[a], *(label[b] for b in range(len(rows)) if near[a][b])]) for a in range(len(rows))]
    return sorted((r[0], sum(near[k]), label[k], r[0] == label[k]) for k, r in enumerate(rows))


@pytest.mark.parametrize("seed", range(2))
def test_repeated_ids_with_other_vectors(frame, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 16))
    rows = []
    for n in range(60):
        noisy = centres[rng.integers(0, 6)] + rng.normal(size=16) * rng.choice([0.0, 0.05, 0.12])
        rows.append((int(rng.integers(0, 25)), noisy.tolist(), 1))
    v, w = rng.normal(size=(2, 16))
    rows += [(101, v.tolist(), 1), (101, w.tolist(), 1), (102, (w + 0.01).tolist(), 1)]
    got = near_duplicates(frame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted(map(tuple, got.collect())) == brute_rows(rows)


def test_dense_cells_keep_groups_small(frame, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 20)
    monkeypatch.setattr(embeddings, "GROUP_ROWS", 500)
    sent = []
    in_cells = embeddings._in_cells

    def counted(*given, **options):
        messages = in_cells(*given, **options)
        sent.append([r["count"] for r in messages.groupBy("bucket").count().collect()])
        return messages

    monkeypatch.setattr(embeddings, "_in_cells", counted)
    rng = np.random.default_rng(7)
    centre = rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * 0.01).tolist(), 1) for i in range(600)]
    got = near_duplicates(frame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(599, 0)}
    for sizes in sent:
        assert max(sizes) <= 500 < sum(sizes)


@pytest.mark.parametrize("name, left", [("op1_near_duplicate_vectors", 1), ("pipeline", 3)])
def test_what_is_written_in_between_is_removed(spark, name, left):
    root = Files(spark, spark.conf.get("spark.checkpoint.dir") + "/tidemark")
    before = set(root.names())
    entry.queries()[name](spark, SF_DIR).collect()
    assert len(set(root.names()) - before) <= left
