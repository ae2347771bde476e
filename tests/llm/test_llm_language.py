"""Language identification against a plain loop over one text's trigrams."""

import numpy as np
import pytest
from llm_tools import UNBROKEN, awkward, listed, table  # noqa: F401

from tidemark.llm import language
from tidemark.llm.language import LETTERS, identify, learn_profiles


def letter(char):
    low = char.lower()[0]
    if not char.isalpha():
        return 0
    return ord(low) - ord("a") + 1 if "a" <= low <= "z" else 27 + (ord(low) * 2654435761 >> 8) % (LETTERS - 27)


def brute(text, profiles):
    signs = np.random.default_rng(profiles.seed).integers(0, 2, (LETTERS, profiles.width), np.int8) * 2 - 1
    signs = signs.astype(float)
    classes = [0, *(letter(c) for c in text or ""), 0]
    bundle = np.zeros(profiles.width)
    for a, b, c in zip(classes, classes[1:], classes[2:]):
        if b:
            bundle += np.roll(signs[a], 2) * np.roll(signs[b], 1) * signs[c]
    if not bundle.any():
        return "und", 0.0
    cosine = profiles.vectors.astype(float) @ bundle / np.linalg.norm(bundle)
    return profiles.names[int(cosine.argmax())], float(np.clip(cosine.max(), 0, 1))


@pytest.mark.parametrize("block", [3, None])
def test_bundles_are_those_of_a_plain_loop(table, awkward, monkeypatch, block):
    if block:
        monkeypatch.setattr(language, "GRAM_BLOCK", block)
    profiles = learn_profiles(table("documents"))
    some = table("documents").select("doc_id", "text").limit(60).collect()
    for df, rows in ((table("documents").limit(60), some), (awkward.filter("doc_id <> 8"), awkward.filter("doc_id <> 8").collect())):
        got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in identify(df, profiles).collect()}
        for r in rows:
            name, score = brute(r.text, profiles)
            assert got[r.doc_id, r.text][0] == name
            assert np.isclose(got[r.doc_id, r.text][1], score, atol=1e-4)


def test_repeated_rows_are_judged_alike(awkward, table):
    profiles = learn_profiles(table("documents"))
    got = listed(identify(awkward, profiles).filter("doc_id = 2"), "lang_pred", "score")
    assert len(got) == 2 and got[0] == got[1]
    assert identify(awkward.limit(0), profiles).collect() == []
    assert len(UNBROKEN) == 300_000
