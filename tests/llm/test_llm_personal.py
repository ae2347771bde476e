"""The semi-Markov field: its decoding against the plain recursion, held-out recall, long texts."""

import random
import tracemalloc
import zlib

import numpy as np
import pytest
from test_llm_words import brute_personal

from tidemark.llm import personal
from tidemark.llm.personal import KINDS, OUTSIDE, base_spans, candidates, train, zones

WORDS = [
    "12", "3.5", "1,234", "+49 30 123456", "4111 1111 1111 1111", "192.168.1.7", "a@b.de", "2024-01-02", "x1", "(5)", "-7",
    "1e5", "99%", "@", "0", "0.0.0.0", "1..2", "@@", "x@y", "١٢", "²3", "a_1", "1\t2", "300.1.1.1", "4111-1111-1111-1111",
]


@pytest.fixture(scope="module")
def field(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    return train(docs.filter("crc32(cast(doc_id AS string)) % 3 <> 1"))


def scores(field, zone):
    """By segment, the scores of its labels."""
    none = (0.0,) * (OUTSIDE + 1)
    out = {}
    for i, j, names in candidates(zone):
        rows = np.array([field.weights.get(f, none) for f in names]).sum(0)
        out[i, j, names[0] == "o"] = rows[OUTSIDE:] if names[0] == "o" else rows[:OUTSIDE]
    return out


def best_total(scored, n):
    best = [0.0] + [-np.inf] * n
    for i, j, _ in sorted(scored):
        best[j] = max([best[j], *(best[i] + scored[i, j, o].max() for o in (True, False) if (i, j, o) in scored)])
    return best[n]


def test_decoding_finds_the_best_segmentation(field, monkeypatch):
    rng = random.Random(1)
    taken = 0
    for part in (8192, 5):
        monkeypatch.setattr(personal, "_DECODED", part)
        for _ in range(150):
            text = rng.choice(["", "call ", "Tel: "]) + " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 40)))
            for zone in zones(text):
                scored = scores(field, zone)
                begin = {s: k for k, (s, _) in enumerate(zone.tokens.tolist())}
                finish = {e: k + 1 for k, (_, e) in enumerate(zone.tokens.tolist())}
                total, at = 0.0, len(zone.tokens)
                for kind, first, end in field.decode(zone):
                    i, j = begin[first - zone.start], finish[end - zone.start]
                    total += scored[i, j, False][kind] + sum(scored[k, k + 1, True][0] for k in range(j, at))
                    at, taken = i, taken + 1
                total += sum(scored[k, k + 1, True][0] for k in range(at))
                assert abs(total - best_total(scored, len(zone.tokens))) < 1e-9, text
    assert taken > 300


def test_recall_on_documents_not_learned_from(spark, field):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    found = {k: [0, 0] for k in range(len(KINDS))}
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 3 == 1:
            mine = {s for z in zones(r.text or "") for s in field.decode(z)}
            for span in brute_personal(r.text):
                found[span[0]][0] += span in mine
                found[span[0]][1] += 1
    hits, total = (sum(x) for x in zip(*found.values()))
    assert total > 20 and hits >= 0.9 * total, found


def test_a_table_of_numbers_is_read_in_flat_memory(field):
    rng = random.Random(2)
    text = " ".join(str(rng.randint(0, 10 ** rng.randint(1, 8))) + rng.choice(["", ".5", ","]) for _ in range(170_000))
    assert len(text) > 1_000_000
    (zone,) = zones(text)
    tracemalloc.start()
    spans = field.decode(zone)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 600 * len(zone.tokens)
    assert all(0 <= a < b <= len(text) for _, a, b in spans)


@pytest.mark.parametrize("text", ["0" * 5000 + ".1.2.3", "1.2." + "0" * 5000 + "256.3", "0" * 9000 + "255.0.0." + "0" * 4400])
def test_parts_of_many_zeros(text):
    wanted = [] if "256" in text else [(1, 0, len(text))]
    assert [s for s in base_spans(text) if s[0] == 1] == wanted
